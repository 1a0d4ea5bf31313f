"""Joins that bring records and files together: mapping, backfill, overlay, prioritised matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.nulls import NULL_LIKE, is_missing, money, present

# Endings of file names that mark another version of a file.
VERSION_ENDINGS = ("_v2", "_V2", " v2", " V2", "_v3", "_V3", " v3", " V3", "_final", "_Final", "_FINAL", "_copy", "_Copy", "_COPY")


def friendly_id(prefix: str, value: Column) -> Column:
    """``prefix-`` and the last 8 characters of an id, or ``Unknown prefix``."""
    return F.when(is_missing(value), F.lit(f"Unknown {prefix}")).otherwise(F.concat(F.lit(f"{prefix}-"), F.right(F.trim(value), F.lit(8))))


def first_link(links: DataFrame, key: str, target: str, seq: str) -> DataFrame:
    """The first target of each key in file order."""
    return links.where(F.col(target).isNotNull()).groupBy(key).agg(F.min_by(target, seq).alias(target))


def map_to_deals(files: DataFrame, direct: str, deals: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """Files with the columns of their deal and ``mapping_status``: unmapped, mapped_no_metadata or mapped."""
    right = deals.select(F.col(key).alias("_key"), F.lit(True).alias("_hit"), *wanted)
    joined = files.withColumn("_ref", F.trim(present(F.col(direct)))).join(right, F.col("_ref") == F.col("_key"), "left")
    status = F.when(F.col("_ref").isNull(), "unmapped").when(F.col("_hit").isNull(), "mapped_no_metadata").otherwise("mapped")
    return joined.withColumn("mapping_status", status).drop("_key", "_hit", "_ref")


def savings_percent(proposed: Column, final: Column) -> Column:
    """Percent saved, to two places; null unless both amounts are there and the first is positive."""
    first, last = money(proposed), money(final)
    return F.when((first > 0) & (last != 0), F.round((first - last) / first * 100, 2))


def short_key(value: Column) -> Column:
    """The 15-character form of an 18-character id."""
    return F.substring(F.trim(value), 1, 15)


def match_files(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each file with the best entry of a mapping ``seq, file_name, relative_path, ref`` and the method that found it.

    Methods in order: same name, same path, mapped path ending in the file's path, name without a version
    ending (or without extension), same base name. Within a method the first entry by ``seq`` wins. Files
    ``name, path`` are unique by path. Every method is an equi-join: endings are matched on the reversed
    path's leading folder steps, of which a path has few.
    """
    base = lambda c: F.substring_index(c, "/", -1)
    stem = F.regexp_replace("name", r"\.[^./]*$", "")
    ext = F.substring("name", F.length(stem) + 1, 255)
    bare = F.regexp_replace(stem, f"(?:{'|'.join(VERSION_ENDINGS)})$", "")
    probes = [
        F.when(F.col("name") != "", F.struct(F.lit(1).alias("rank"), F.lit("n").alias("kind"), F.col("name").alias("probe"))),
        F.struct(F.lit(2).alias("rank"), F.lit("p").alias("kind"), F.col("path").alias("probe")),
        F.when(F.col("path") != "", F.struct(F.lit(3).alias("rank"), F.lit("e").alias("kind"), F.col("path").alias("probe"))),
        F.when(bare != stem, F.struct(F.lit(4).alias("rank"), F.lit("n").alias("kind"), F.concat(bare, ext).alias("probe"))),
        F.when(ext != "", F.struct(F.lit(5).alias("rank"), F.lit("n").alias("kind"), stem.alias("probe"))),
        F.struct(F.lit(6).alias("rank"), F.lit("b").alias("kind"), base(F.col("path")).alias("probe")),
    ]
    asked = files.select("name", "path", F.inline(F.array_compact(F.array(*probes))))
    steps = F.split("relative_path", "/")
    # Every ending of a mapped path that begins at a folder step, with and without its slash.
    ends = F.flatten(
        F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array(F.array_join(F.slice(steps, i, F.size(steps)), "/"), F.when(i > 1, F.concat(F.lit("/"), F.array_join(F.slice(steps, i, F.size(steps)), "/")))))
    )
    forms = F.concat(
        F.array(F.struct(F.lit("n").alias("kind"), F.col("file_name").alias("probe")), F.struct(F.lit("p").alias("kind"), F.col("relative_path").alias("probe")), F.struct(F.lit("b").alias("kind"), base(F.col("relative_path")).alias("probe"))),
        F.transform(F.array_distinct(F.array_compact(ends)), lambda e: F.struct(F.lit("e").alias("kind"), e.alias("probe"))),
    )
    offered = mapping.select("seq", "ref", F.inline(forms)).groupBy("kind", "probe").agg(F.min(F.struct("seq", "ref")).alias("m"))
    hits = asked.join(offered, ["kind", "probe"])
    best = hits.groupBy("path").agg(F.min(F.struct("rank", "m")).alias("b"))
    names = F.array(*[F.lit(x) for x in ("exact_name", "exact_path", "path_ending", "version_name", "bare_name", "base_name")])
    found = best.select("path", F.element_at(names, F.col("b.rank")).alias("method"), F.col("b.m.ref").alias("ref"))
    return files.join(found, "path", "left")


def backfill(df: DataFrame, column: str, key: Column, names: DataFrame, name_key: str, name: str) -> DataFrame:
    """Fill a missing name by id; adds ``<column>_source``: kept, filled or missing."""
    right = names.select(F.col(name_key).alias("_k"), F.col(name).alias("_n"))
    joined = df.withColumn("_ref", key).join(right, F.col("_ref") == F.col("_k"), "left")
    has = ~is_missing(F.col(column))
    source = F.when(has, "kept").when(F.col("_n").isNotNull(), "filled").otherwise("missing")
    return joined.withColumn(f"{column}_source", source).withColumn(column, F.when(has, F.col(column)).otherwise(F.col("_n"))).drop("_k", "_n", "_ref")


def backfill_by_deal(df: DataFrame, vendor: str, name: str, deal: Column, deals: DataFrame, vendors: DataFrame) -> DataFrame:
    """Missing vendor ids filled from the deal, and names from the vendor; adds ``outcome``.

    ``deals`` has ``deal, vendor_id``, ``vendors`` has ``vendor_id, vendor_name``, each key once. Outcomes: ``populated`` (an id
    was there), ``no_deal_mapping``, ``id_added``, ``id_and_name_added``.
    """
    mapped = deals.select(F.col("deal").alias("_deal"), F.trim(present(F.col("vendor_id"), NULL_LIKE)).alias("_vendor")).where("_deal is not null and _vendor is not null")
    named = vendors.select(F.col("vendor_id").alias("_key"), F.col("vendor_name").alias("_name"))
    has = ~is_missing(F.col(vendor), NULL_LIKE)
    joined = df.withColumn("_ref", F.when(~has, deal)).join(mapped, F.col("_ref") == F.col("_deal"), "left").join(named, F.col("_vendor") == F.col("_key"), "left")
    outcome = F.when(has, "populated").when(F.col("_vendor").isNull(), "no_deal_mapping").when(F.col("_name").isNull(), "id_added").otherwise("id_and_name_added")
    filled = {vendor: F.when(has, F.col(vendor)).otherwise(F.coalesce("_vendor", F.col(vendor))), name: F.coalesce("_name", F.col(name))}
    return joined.withColumn("outcome", outcome).withColumns(filled).drop("_ref", "_deal", "_vendor", "_key", "_name")


def overlay(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left rows with the right side's values wherever the key is found, blank ones included."""
    other = right.select(F.col(key).alias("_k"), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_r_{c}") for c in columns])
    joined = left.join(other, left[key] == F.col("_k"), "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in left.columns])


def overlap_counts(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """Per group: keys on both sides, on the left only, on the right only."""
    a, b = left.select(by, key).distinct().withColumn("_l", F.lit(1)), right.select(by, key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, [by, key], "full")
    return both.groupBy(by).agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_both"),
        F.count_if(F.col("_r").isNull()).alias("n_left_only"),
        F.count_if(F.col("_l").isNull()).alias("n_right_only"),
    )


def resolve_paths(versions: DataFrame, listing: DataFrame) -> DataFrame:
    """The stored file of each version ``cv_id, document_id, deal_id`` in a listing of ``path`` (relative to the export).

    In order: flat file named by version, file in the version's folder, file in the deal's folder of an export
    batch, attachment named by document. Within a place the first visible path wins.
    """
    part = lambda i: F.get(F.split("path", "/"), F.lit(i))
    name = F.substring_index("path", "/", -1)
    place = (
        F.when(F.col("path").rlike("^ContentVersion/[^/]+$"), F.struct(F.lit(0).alias("rank"), F.lit("cv").alias("kind"), part(1).alias("ref")))
        .when(F.col("path").rlike("^ContentVersions/VersionData/[^/]+/"), F.struct(F.lit(1).alias("rank"), F.lit("cv").alias("kind"), part(2).alias("ref")))
        .when(F.col("path").rlike("^Deal__cs/0EM[^/]*/[^/]+/"), F.struct(F.lit(2).alias("rank"), F.lit("deal").alias("kind"), part(2).alias("ref")))
        .when(F.col("path").rlike("^Attachments/Body/[^/]+$"), F.struct(F.lit(3).alias("rank"), F.lit("doc").alias("kind"), part(2).alias("ref")))
    )
    offered = listing.where(~F.startswith(name, F.lit("."))).select("path", place.alias("p")).where("p is not null")
    offered = offered.groupBy("p.kind", "p.ref", "p.rank").agg(F.min("path").alias("path"))
    refs = F.array(*[F.struct(F.lit(k).alias("kind"), F.trim(present(F.col(c), NULL_LIKE)).alias("ref")) for k, c in (("cv", "cv_id"), ("deal", "deal_id"), ("doc", "document_id"))])
    asked = versions.select("cv_id", F.inline(F.filter(refs, lambda x: x["ref"].isNotNull())))
    best = asked.join(offered, ["kind", "ref"]).groupBy("cv_id").agg(F.min(F.struct("rank", "path")).alias("b"))
    return versions.join(best.select("cv_id", F.col("b.path").alias("stored_path"), F.col("b.rank").alias("place")), "cv_id", "left")


def ordered_distinct(df: DataFrame, key: Column, value: str, seq: str) -> DataFrame:
    """The first row of each key in order of ``seq``."""
    return df.groupBy(key.alias("key")).agg(F.min_by(value, seq).alias(value), F.min(seq).alias(seq))


def chunk_gaps(df: DataFrame, key: str, index: str) -> DataFrame:
    """Keys with their number of distinct chunk numbers and whether any between the least and greatest is missing."""
    n, low, high = F.countDistinct(index), F.min(index), F.max(index)
    return df.groupBy(key).agg(n.alias("n_chunks"), low.alias("first_index"), high.alias("last_index"), (n != high - low + 1).alias("has_gap"))


def reconstruct(df: DataFrame, key: str, index: str, text: str, section: Column) -> DataFrame:
    """The text of a document from its chunks in order, a marker line wherever the section changes."""
    order = Window.partitionBy(key).orderBy(index)
    marked = df.withColumn("_s", section).withColumn("_p", F.lag("_s").over(order))
    piece = F.when(F.col("_s").isNotNull() & ~F.col("_s").eqNullSafe(F.col("_p")), F.concat(F.lit("=== "), F.col("_s"), F.lit(" ===\n"), F.col(text))).otherwise(F.col(text))
    parts = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), piece.alias("t"))))
    return marked.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias("full_text"), F.count("*").alias("n_chunks"))
