"""Queries over the training-text problems, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import canonical, emails, leaks, neardup, pack, pii, spans, split
from docloom.llm.sql import ORACLE
from docloom.plans.data import table
from docloom.session import spread


def _mails(spark: SparkSession, d: str) -> DataFrame:
    return emails.mails(table(spark, d, "search_results"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return emails.new_lines(_mails(spark, d)).select("id", "line_no")


def p2_new_bodies(spark: SparkSession, d: str) -> DataFrame:
    return emails.new_bodies(_mails(spark, d))


def p2_rules(spark: SparkSession, d: str) -> DataFrame:
    """How many lines each rule takes away; ``new`` for those that stay."""
    lines = emails.ruled_lines(_mails(spark, d))
    return lines.groupBy(F.coalesce("rule", F.lit("new")).alias("rule")).agg(F.count("*").alias("n_lines"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.similar_pairs(spread(table(spark, d, "parsed_content").select("content_id", "text")), "content_id", "text")
    return pairs.select(F.col("id_a").alias("content_id_a"), F.col("id_b").alias("content_id_b"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(spread(table(spark, d, "parsed_content").select("content_id", "text")), "content_id", "text")


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of equal texts of every record; where it is large, its lead stands for it in ``p4_found``."""
    return neardup.copy_classes(spread(table(spark, d, "parsed_content").select("content_id", "text")), "content_id", "text")


def p4_group_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Groups of two or more records with their number of records and of different content hashes.

    Hashes count but for case, from the records and from the catalog entries of the same versions.
    """
    kept = table(spark, d, "parsed_content").select("content_id", F.col("salesforce_content_version_id").alias("version"), F.lower("content_hash").alias("hash"))
    grouped = p4_groups(spark, d).join(kept, "content_id")
    listed = table(spark, d, "catalog_files").select(F.col("salesforce_content_version_id").alias("version"), F.lower("content_hash").alias("listed")).distinct()
    other = grouped.join(listed, "version").select("group_id", F.lit(None).cast("bigint").alias("content_id"), F.col("listed").alias("hash"))
    both = grouped.select("group_id", "content_id", "hash").unionByName(other)
    counts = both.groupBy("group_id").agg(F.countDistinct("content_id").alias("n_records"), F.countDistinct("hash").alias("n_hashes"))
    return counts.where("n_records > 1")


def _pii(spark: SparkSession, d: str, make) -> DataFrame:
    texts = table(spark, d, "redaction_results"), table(spark, d, "search_results")
    given = pii.known_names(texts[1], ["negotiated_by"])
    return make(texts[0], "redaction_id", ["redacted_text"], given).unionByName(make(texts[1], "id", ["customer_comments", "current_narrative"], given))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _pii(spark, d, pii.found).drop("end_pos").distinct()


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return _pii(spark, d, pii.redacted)


def _names(spark: SparkSession, d: str) -> DataFrame:
    vendors = canonical.listed(table(spark, d, "vendor_mapping"), "id", "account_name", "aliases")
    clients = canonical.listed(table(spark, d, "client_registry"), "salesforce_client_id", "client_name", "aliases")
    return canonical.resolved(spread(table(spark, d, "search_results").select("id", "vendor", "vendor_name", "client")), "id", {"vendor": vendors, "vendor_name": vendors, "client": clients})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("field", "id", "account_id").distinct()


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values that mean no listed entry, with their number of rows."""
    return _names(spark, d).where("account_id = ''").groupBy("field", "value").agg(F.count("*").alias("n_rows"))


def p7_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_rows(table(spark, d, "parsed_content"), "content_id", "text")


def p7_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Every long text put together again from its pieces, and whether these keep to the limit and the overlap."""
    p = p7_pieces(spark, d).groupBy("content_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "start_pos", "end_pos", "piece"))).alias("p"))
    first = F.array(F.struct(F.lit(0).cast("bigint").alias("end"), F.lit("").alias("said")))[0]
    joined = F.aggregate("p", first, lambda done, x: F.struct(x["end_pos"].alias("end"), F.concat(done["said"], F.substring(x["piece"], done["end"] - x["start_pos"] + 1, F.lit(split.LIMIT))).alias("said")))
    overlap = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.get("p", i - 1)["end_pos"] - F.get("p", i)["start_pos"])
    return p.select(
        "content_id", F.md5(joined["said"].cast("binary")).alias("text_md5"), F.exists("p", lambda x: F.length(x["piece"]) > split.LIMIT).alias("too_long"),
        F.exists(overlap, lambda x: (x < split.OVERLAP // 2) | (x > split.OVERLAP * 2)).alias("odd_overlap"),
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_pieces(spark, d).where("chunk_index = 0").select("content_id").distinct()


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack.packed(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the packing: documents packed, containers over the capacity, texts cut in vain, waste beyond 5 %."""
    items = p8_containers(spark, d).where("container is not null")
    none = F.lit(0).cast("bigint")
    boxes = items.groupBy("container").agg(F.sum("n_tokens").alias("filled")).select(
        none.alias("doc"), (F.col("filled") > pack.CAPACITY).cast("bigint").alias("over"), none.alias("cut"), "filled", F.lit(1).cast("bigint").alias("box")
    )
    texts = items.groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("n")).select(
        F.lit(1).cast("bigint").alias("doc"), none.alias("over"), (F.col("parts") != F.ceil(F.col("n") / pack.CAPACITY)).cast("bigint").alias("cut"), none.alias("filled"), none.alias("box")
    )
    sums = [F.coalesce(F.sum(c), none).alias(n) for c, n in (("doc", "n_docs"), ("over", "n_over"), ("cut", "n_cut_in_vain"))]
    return boxes.unionByName(texts).agg(*sums, F.coalesce(F.sum("filled") < 0.95 * pack.CAPACITY * F.sum("box"), F.lit(False)).alias("wasteful"))


def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "item_text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_spans(spark, d).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked, with the number of documents that hold them."""
    return p9_spans(spark, d).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = spans.shared_pairs(table(spark, d, "documents"), "doc_id", "text")
    return pairs.select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of equal texts of every document; where it is large, its lead stands for it in ``p10_found``."""
    each = spans.members(table(spark, d, "documents"), "doc_id", "text")
    return each.select(F.col("id").alias("doc_id"), F.col("lead").alias("class_id"), F.col("copies").alias("n_copies"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return spans.shares(table(spark, d, "documents"), "doc_id", "text")


def p10_spans(spark: SparkSession, d: str) -> DataFrame:
    """The stretches of each document that stand elsewhere too."""
    found = spans.shared_spans(table(spark, d, "documents"), "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), F.inline("spans")).select("doc_id", F.col("start").alias("start_pos"), F.col("stop").alias("end_pos"))


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return spans.levels(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p2_new_bodies, p2_rules, p4_found, p4_groups, p4_classes, p4_group_hashes, p5_found, p5_redacted, p6_found, p6_unmatched, p7_found, p7_pieces, p7_rebuilt, p8_containers, p8_checks,
        p9_found, p9_spans, p9_items, p10_found, p10_classes, p10_shares, p10_spans, p10_levels,
    )
}
__all__ = ["ORACLE", "QUERIES"]
