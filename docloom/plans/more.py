"""Further queries: stored projections, criteria search, batches, set operations, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import records
from docloom.functions.nulls import is_missing
from docloom.functions.text import non_ascii_percent
from docloom.operators import enrich, filters, quality, redaction, retrieval
from docloom.operators.embedding import sampled_pages
from docloom.plans.data import table
from docloom.plans.records import _MISS, _clean, _seconds
from docloom.plans.texts import _PHONE, _q
from docloom.streaming.feeds import latest_status, pending


def stored_records(spark: SparkSession, d: str) -> DataFrame:
    """Search results as an index stores them."""
    rows = table(spark, d, "search_results").select("load_seq", "file_name", "client", "vendor_name", "deal_status", "contract_term", "final_amount", "contract_start", "contract_end")
    return records.stored(rows)


def criteria_top(spark: SparkSession, d: str) -> DataFrame:
    """The best results that meet every criterion."""
    spec = {"deal_status": "Open", "content_source": "document_file", "chunk_index": {"$gte": 1}}
    rows = table(spark, d, "search_results").where(filters.compile_filter(spec)).where("pinecone_score is not null")
    return rows.orderBy(F.col("pinecone_score").desc(), "load_seq").limit(20).select("load_seq", "id", "pinecone_score")


def size_classes(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalog_files")
    return files.groupBy(F.coalesce(records.size_class(F.col("size_mb")), F.lit("unknown")).alias("size_class")).agg(F.count("*").alias("n_files"), F.sum("size").alias("total_size"))


def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results").where(F.col("document_path").isNotNull())
    return rows.select("load_seq", records.chunk_key(F.col("document_path"), F.col("chunk_index")).alias("chunk_id"))


def deal_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Results that name a deal in any spelling."""
    deals = table(spark, d, "deals").groupBy("id").agg(F.min("name").alias("name"))
    forms = deals.select(F.col("id").alias("deal"), F.explode(F.array_distinct(F.array("id", F.substring("id", 1, 15), "name"))).alias("form"))
    rows = table(spark, d, "search_results")
    cells = rows.select("load_seq", F.explode(F.array(F.trim("deal_id"), F.trim("deal_name"))).alias("form"))
    return cells.join(forms, "form").groupBy("deal").agg(F.countDistinct("load_seq").alias("n_rows"))


def vendor_sets(spark: SparkSession, d: str) -> DataFrame:
    """Vendor ids that results name and the registry has, and those on one side only."""
    named = table(spark, d, "search_results").where(~is_missing(F.col("vendor_id"))).select(F.trim("vendor_id").alias("v"))
    known = table(spark, d, "vendor_mapping").select(F.col("id").alias("v"))
    parts = [("both", named.intersect(known)), ("results_only", named.distinct().exceptAll(known)), ("registry_only", known.exceptAll(named.distinct())), ("either", named.union(known).distinct())]
    out = None
    for label, part in parts:
        row = part.agg(F.lit(label).alias("side"), F.count("*").alias("n_ids"))
        out = row if out is None else out.unionByName(row)
    return out


def extraction_report(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the extraction: rows, mean confidence, how many are sure, association with deals."""
    rows = table(spark, d, "search_results")
    sure = F.coalesce(F.col("extraction_confidence") >= 0.8, F.lit(False))
    return rows.agg(
        F.count("*").alias("n_rows"), F.round(F.avg("extraction_confidence"), 3).alias("mean_confidence"), F.count_if(sure).alias("n_sure"),
        F.countDistinct(F.when(~is_missing(F.col("deal_id")), F.trim("deal_id"))).alias("n_deals"), F.count_if(~is_missing(F.col("deal_id"))).alias("n_associated"),
    )


def type_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Parsed content per parser: number, pages and words at index percentiles, mean words per page."""
    rows = table(spark, d, "parsed_content").withColumn("parser", F.coalesce("parser", F.lit("none")))
    shares = rows.groupBy("parser").agg(F.sum("page_count").alias("n_pages"), F.sum("word_count").alias("n_words"))
    return quality.index_percentiles(rows, "parser", "word_count").join(shares, "parser")


def page_samples(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "parsed_content").where("page_count > 0")
    return rows.select("content_id", F.array_join(F.transform(sampled_pages(F.col("page_count")), lambda p: p.cast("string")), ",").alias("pages"))


def redaction_status(spark: SparkSession, d: str) -> DataFrame:
    """The last redaction of each version, and whether it is still to be done again."""
    log = table(spark, d, "redaction_results").where(F.col("salesforce_content_version_id").isNotNull()).select("salesforce_content_version_id", F.struct("processed_at", "redaction_id").alias("at"), F.coalesce("success", F.lit(False)).alias("success"))
    last = latest_status(log, "salesforce_content_version_id", "at")
    open_ones = pending(last.select("salesforce_content_version_id"), last, "salesforce_content_version_id", F.col("success")).withColumn("open", F.lit(True))
    return last.join(open_ones, "salesforce_content_version_id", "left").select("salesforce_content_version_id", F.col("at.redaction_id").alias("redaction_id"), F.coalesce("open", F.lit(False)).alias("is_open"))


def redaction_failures(spark: SparkSession, d: str) -> DataFrame:
    """What redacted texts still hold, by the validators."""
    rows = table(spark, d, "redaction_results").where(F.col("redacted_text").isNotNull())
    return rows.select(F.explode(redaction.failures(F.col("redacted_text"))).alias("kind")).groupBy("kind").agg(F.count("*").alias("n_texts"))


def side_by_side(spark: SparkSession, d: str) -> DataFrame:
    """Files rebuilt from results against their parsed content: both, one side only, and the differences in length."""
    chunks = table(spark, d, "search_results").where(F.col("document_path").isNotNull() & F.col("text").isNotNull())
    left = chunks.groupBy(F.col("document_path").alias("path")).agg(F.sum(F.length("text")).alias("left_chars"), F.countDistinct("chunk_index").alias("n_chunks"))
    right = table(spark, d, "parsed_content").groupBy("path").agg(F.max(F.length("text")).cast("bigint").alias("right_chars"), F.max(F.round(non_ascii_percent(F.col("text")), 2)).alias("right_non_ascii"))
    both = left.join(right, "path", "full")
    status = F.when(F.col("left_chars").isNull(), "right_only").when(F.col("right_chars").isNull(), "left_only").otherwise("both")
    return both.select("path", status.alias("status"), "n_chunks", (F.col("left_chars") - F.col("right_chars")).alias("char_delta"), "right_non_ascii")


def first_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of results without repeats, the first in load order."""
    rows = table(spark, d, "search_results").where(F.col("text").isNotNull()).select("text", "load_seq", "id")
    found = enrich.ordered_distinct(rows, F.md5("text"), "id", "load_seq")
    return found.select(F.col("key").alias("text_md5"), "load_seq")


def sparse_checks(spark: SparkSession, d: str) -> DataFrame:
    """Sparse vectors of evaluation items made valid for an index: none is empty."""
    terms = retrieval.term_vectors(table(spark, d, "eval_items"), "item_id", "item_text")
    packed = terms.groupBy("key").agg(F.sort_array(F.collect_list(F.crc32("term"))).alias("i"), F.collect_list(F.col("weight").cast("double")).alias("v"))
    every = table(spark, d, "eval_items").select(F.col("item_id").alias("key")).join(packed, "key", "left")
    return every.select("key", retrieval.valid_sparse(F.col("i"), F.col("v")).alias("s")).select("key", F.size("s.indices").alias("n_terms"))


QUERIES = {
    f.__name__: f
    for f in (
        stored_records, criteria_top, size_classes, chunk_ids, deal_mentions, vendor_sets, extraction_report, type_outcomes, page_samples, redaction_status, redaction_failures,
        side_by_side, first_texts, sparse_checks,
    )
}


def _stored(column: str, cap: int | None = None) -> str:
    clean = _clean(column)
    return f"left({clean}, {cap}) AS {column}" if cap else f"{clean} AS {column}"


_FAR = "len(regexp_extract_all(text, '[^\\x00-\\x7F]')) * 100.0 / length(text)"
ORACLE = {
    "stored_records": "SELECT load_seq, " + ", ".join(_stored(c, records.CAPS.get(c)) for c in ("file_name", "client", "vendor_name", "deal_status", "contract_term", "contract_start", "contract_end"))
    + f", coalesce(final_amount, 0.0) AS final_amount, {_seconds('contract_start')} AS contract_start_ts, {_seconds('contract_end')} AS contract_end_ts FROM search_results",
    "criteria_top": "SELECT load_seq, id, pinecone_score FROM search_results WHERE deal_status = 'Open' AND content_source = 'document_file' AND chunk_index >= 1 AND pinecone_score IS NOT NULL ORDER BY pinecone_score DESC, load_seq LIMIT 20",
    "size_classes": "SELECT CASE WHEN size_mb < 1 THEN 'small' WHEN size_mb < 10 THEN 'medium' WHEN size_mb >= 10 THEN 'large' ELSE 'unknown' END AS size_class, count(*) AS n_files, sum(size)::BIGINT AS total_size FROM catalog_files GROUP BY 1",
    "chunk_ids": "SELECT load_seq, md5(document_path) || '-chunk-' || lpad(chunk_index::VARCHAR, 4, '0') AS chunk_id FROM search_results WHERE document_path IS NOT NULL",
    "deal_mentions": """WITH f AS (SELECT id, min(name) AS name FROM deals GROUP BY id), s AS (SELECT id AS deal, unnest([id, substr(id, 1, 15), name]) AS form FROM f),
        c AS (SELECT load_seq, unnest([trim(deal_id), trim(deal_name)]) AS form FROM search_results) SELECT deal, count(DISTINCT load_seq) AS n_rows FROM c JOIN s USING (form) GROUP BY 1""",
    "vendor_sets": f"""WITH a AS (SELECT DISTINCT trim(vendor_id) AS v FROM search_results WHERE vendor_id IS NOT NULL AND lower(trim(vendor_id)) NOT IN {_MISS}), b AS (SELECT id AS v FROM vendor_mapping)
        SELECT 'both' AS side, count(*) AS n_ids FROM a SEMI JOIN b USING (v) UNION ALL SELECT 'results_only', count(*) FROM a ANTI JOIN b USING (v)
        UNION ALL SELECT 'registry_only', count(*) FROM b ANTI JOIN a USING (v) UNION ALL SELECT 'either', count(*) FROM (SELECT v FROM a UNION SELECT v FROM b)""",
    "extraction_report": f"""SELECT count(*) AS n_rows, round(avg(extraction_confidence), 3) AS mean_confidence, count(*) FILTER (extraction_confidence >= 0.8) AS n_sure,
        count(DISTINCT trim(deal_id)) FILTER (lower(trim(deal_id)) NOT IN {_MISS}) AS n_deals, count(*) FILTER (lower(trim(deal_id)) NOT IN {_MISS}) AS n_associated FROM search_results""",
    "type_outcomes": """WITH r AS (SELECT coalesce(parser, 'none') AS parser, page_count, word_count FROM parsed_content), l AS (SELECT parser, list_sort(list(word_count) FILTER (word_count IS NOT NULL)) AS v, sum(page_count)::BIGINT AS n_pages, sum(word_count)::BIGINT AS n_words FROM r GROUP BY 1)
        SELECT parser, len(v) AS n, v[1] AS min_value, v[-1] AS max_value, v[floor(len(v) * 0.5)::INT + 1] AS p50, v[floor(len(v) * 0.9)::INT + 1] AS p90, v[floor(len(v) * 0.99)::INT + 1] AS p99, n_pages, n_words FROM l WHERE len(v) > 0""",
    "page_samples": """WITH p AS (SELECT content_id, page_count AS n, greatest(page_count // 2 - 2, 1) AS m FROM parsed_content WHERE page_count > 0)
        SELECT content_id, array_to_string(list_sort(list_distinct(range(1, least(greatest(n // 3, 1), 10) + 1) || range(m, least(m + 4, n) + 1) || range(greatest(n - least(greatest(n // 4, 1), 5) + 1, 1), n + 1))), ',') AS pages FROM p""",
    "redaction_status": "SELECT salesforce_content_version_id, redaction_id, NOT coalesce(success, false) AS is_open FROM redaction_results WHERE salesforce_content_version_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY salesforce_content_version_id ORDER BY processed_at DESC, redaction_id DESC) = 1",
    "redaction_failures": f"""SELECT kind, count(*) AS n_texts FROM (SELECT unnest([CASE WHEN regexp_matches(redacted_text, {_q(redaction.EMAIL)}) THEN 'email' END,
        CASE WHEN regexp_matches(redacted_text, {_q(_PHONE)}) THEN 'phone' END]) AS kind FROM redaction_results WHERE redacted_text IS NOT NULL) WHERE kind IS NOT NULL GROUP BY 1""",
    "side_by_side": f"""WITH l AS (SELECT document_path AS path, sum(length(text)) AS lc, count(DISTINCT chunk_index) AS n FROM search_results WHERE document_path IS NOT NULL AND text IS NOT NULL GROUP BY 1),
        r AS (SELECT path, max(length(text)) AS rc, max(CASE WHEN length(text) > 0 THEN round({_FAR}, 2) ELSE 0.0 END) AS na FROM parsed_content GROUP BY 1)
        SELECT coalesce(l.path, r.path) AS path, CASE WHEN lc IS NULL THEN 'right_only' WHEN rc IS NULL THEN 'left_only' ELSE 'both' END AS status, n AS n_chunks, (lc - rc)::BIGINT AS char_delta, na::DOUBLE AS right_non_ascii FROM l FULL JOIN r ON l.path = r.path""",
    "first_texts": "SELECT md5(text) AS text_md5, min(load_seq) AS load_seq FROM search_results WHERE text IS NOT NULL GROUP BY 1",
    "sparse_checks": "SELECT item_id AS key, greatest(len(list_distinct(regexp_extract_all(lower(item_text), '[a-z0-9]+'))), 1)::INT AS n_terms FROM eval_items",
}
