"""Reports over records: backfills, rollups, signals, queues, redacted metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import records
from docloom.functions import text as T
from docloom.functions.nulls import is_missing
from docloom.operators import enrich, filters, quality, redaction
from docloom.plans.data import table
from docloom.plans.records import _seconds
from docloom.plans.texts import _count_sql, _q
from docloom.session import spread
from docloom.streaming.queues import queue_status


def backfill_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What became of results whose vendor is missing: filled by their deal, or why not."""
    deals = filters.latest_rows(table(spark, d, "deals").select("id", "exported_at", "load_seq", "primary_deal_vendor__c"), ["id"], ["exported_at", "load_seq"])
    vendors = table(spark, d, "vendor_mapping").select(F.col("id").alias("vendor_id"), F.col("account_name").alias("vendor_name"))
    rows = table(spark, d, "search_results").select("load_seq", "vendor_id", "vendor_name", "deal_id")
    filled = enrich.backfill_by_deal(rows, "vendor_id", "vendor_name", F.trim("deal_id"), deals.select(F.col("id").alias("deal"), F.col("primary_deal_vendor__c").alias("vendor_id")), vendors)
    return filled.groupBy("outcome").agg(F.count("*").alias("n_rows"), F.countDistinct("vendor_id").alias("n_vendors"))


def presence_rollup(spark: SparkSession, d: str) -> DataFrame:
    """By source of content: rows, and how many hold any and all of the descriptive fields."""
    rows = table(spark, d, "search_results")
    return quality.rollup_presence(rows, F.coalesce("content_source", F.lit("none")), ["deal_name", "deal_status", "contract_term", "contract_start", "contract_end", "negotiated_by", "final_amount"])


def top_scores(spark: SparkSession, d: str) -> DataFrame:
    """The twenty best scores of each parser."""
    rows = table(spark, d, "search_results").where("parser is not null and pinecone_score is not null").select("parser", "load_seq", "pinecone_score")
    return quality.top_scores(rows, "parser", "pinecone_score", "load_seq", 20)


def party_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows by vendor and by client as typed, most first."""
    rows = table(spark, d, "search_results")
    parts = [rows.groupBy(F.lit(c).alias("field"), F.when(is_missing(F.col(c)), "Unknown").otherwise(F.trim(c)).alias("party")).agg(F.count("*").alias("n_rows")) for c in ("vendor", "client")]
    return parts[0].unionByName(parts[1])


def pricing_signals(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return docs.select("doc_id", *[c.cast("long").alias(n) for n, c in T.pricing_signals(F.col("text")).items()])


def cut_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of parsed content cut to a thousand tokens at the end of a sentence or line."""
    rows = table(spark, d, "parsed_content").where(F.col("text").isNotNull())
    cut = T.cut_tokens(F.col("text"), 1_000)
    return rows.select("content_id", F.length(cut).alias("n_chars"), F.md5(cut).alias("text_md5"))


def stored_fields(spark: SparkSession, d: str) -> DataFrame:
    """All fields that an index stores of a result, as one hash, and some of them."""
    rows = table(spark, d, "search_results")
    names = {"salesforce_deal_id": "deal_id", "salesforce_client_id": "client_id", "salesforce_vendor_id": "vendor_id", "client_name": "client", "deal_creation_date": "deal_start_date"}
    found = records.stored_fields(rows.withColumn("key", F.col("load_seq")), names)
    kept = ["file_name", "deal_id", "salesforce_vendor_id", "client_name", "vendor_name", "deal_status", "contract_term", "report_type", "final_amount", "savings_1yr", "chunk_index", "has_parsing_errors"]
    return found.select(*kept, F.md5("text").alias("text_md5"), "contract_end_ts")


def redacted_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Client names out of the metadata of results."""
    rows = table(spark, d, "search_results").select("load_seq", F.when(~is_missing(F.col("client")), F.trim("client")).alias("client"), "deal_name", "file_name")
    return redaction.redact_metadata(rows, "file_name", "client", ["deal_name"])


def organisation_clients(spark: SparkSession, d: str) -> DataFrame:
    """Party names of results that hold, or are held by, a client's name, with the longest such client."""
    spans = table(spark, d, "search_results").where(~is_missing(F.col("vendor_name"))).select(F.trim("vendor_name").alias("span")).unionByName(
        table(spark, d, "search_results").where(~is_missing(F.col("client"))).select(F.trim("client").alias("span"))
    ).distinct()
    return redaction.organisation_clients(spans, table(spark, d, "client_registry").select("client_name").distinct(), "span", "client_name")


def centroid_cosines(spark: SparkSession, d: str) -> DataFrame:
    """How near the centroid of each label is to that of all vectors."""
    parts = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x"))
    own = parts.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    whole = parts.groupBy("dim").agg(F.avg(F.col("x").cast("double")).alias("w"))
    norm = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)))
    cosine = F.sum(F.col("m") * F.col("w")) / (norm("m") * norm("w"))
    return own.join(whole, "dim").groupBy("label").agg(F.round(cosine, 6).alias("cosine"))


def redaction_progress(spark: SparkSession, d: str) -> DataFrame:
    """Redactions as batches of a hundred by number: how far they are."""
    rows = table(spark, d, "redaction_results").select(F.floor(F.col("redaction_id") / 100).alias("batch_no"), F.coalesce("success", F.lit(False)).alias("ok"))
    states = rows.groupBy("batch_no").agg(F.count("*").alias("n_rows"), F.count_if(~F.col("ok")).alias("n_failed"))
    return queue_status(states.withColumn("state", F.when(F.col("n_failed") == F.col("n_rows"), "failed").otherwise("processed")))


QUERIES = {
    f.__name__: f
    for f in (
        backfill_outcomes, presence_rollup, top_scores, party_counts, pricing_signals, cut_texts, stored_fields, redacted_metadata, organisation_clients, centroid_cosines, redaction_progress,
    )
}

_NULLS = "('', 'none', 'nan', 'null')"
_MISS = "('', 'none', 'nan', 'null', 'n/a')"
_clean = lambda c: f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN {_NULLS} THEN '' ELSE trim({c}) END"
_full = lambda c: f"(coalesce(lower(trim({c})) NOT IN {_NULLS}, false))::INT"
_PRESENT = " + ".join([_full(c) for c in ("deal_name", "deal_status", "contract_term", "contract_start", "contract_end", "negotiated_by")] + ["(coalesce(NOT isnan(final_amount) AND final_amount <> 0, false))::INT"])
_WORDS = "trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_CUT = "left(text, 4000)"
_ends = " ".join(
    f"WHEN instr(reverse({_CUT}), {e}) > 0 AND 4000 - instr(reverse({_CUT}), {e}) + 1 - {n} > 3200 THEN left(text, 4000 - instr(reverse({_CUT}), {e})::INT + 1)"
    for e, n in (("' .'", 2), ("' !'", 2), ("' ?'", 2), ("chr(10) || chr(10)", 2), ("chr(10)", 1))
)
ORACLE = {
    "backfill_outcomes": f"""WITH l AS (SELECT id, trim(primary_deal_vendor__c) AS v FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY exported_at DESC, load_seq DESC) AS r FROM deals) WHERE r = 1 AND primary_deal_vendor__c IS NOT NULL AND lower(trim(primary_deal_vendor__c)) NOT IN {_NULLS}),
        s AS (SELECT load_seq, vendor_id, trim(deal_id) AS deal, vendor_id IS NOT NULL AND lower(trim(vendor_id)) NOT IN {_NULLS} AS has FROM search_results)
        SELECT CASE WHEN has THEN 'populated' WHEN v IS NULL THEN 'no_deal_mapping' WHEN m.id IS NULL THEN 'id_added' ELSE 'id_and_name_added' END AS outcome, count(*) AS n_rows,
        count(DISTINCT CASE WHEN has THEN vendor_id ELSE coalesce(v, vendor_id) END) AS n_vendors FROM s LEFT JOIN l ON NOT has AND l.id = s.deal LEFT JOIN vendor_mapping m ON m.id = l.v GROUP BY 1""",
    "presence_rollup": f"SELECT coalesce(content_source, 'none') AS group_key, count(*) AS n_rows, count(*) FILTER ({_PRESENT} > 0) AS n_any, count(*) FILTER ({_PRESENT} = 7) AS n_all FROM search_results GROUP BY 1",
    "top_scores": "SELECT parser, row_number() OVER (PARTITION BY parser ORDER BY pinecone_score DESC, load_seq)::INTEGER AS place, load_seq, pinecone_score FROM search_results WHERE parser IS NOT NULL AND pinecone_score IS NOT NULL QUALIFY place <= 20",
    "party_counts": " UNION ALL ".join(f"SELECT '{c}' AS field, CASE WHEN {c} IS NULL OR lower(trim({c})) IN {_MISS} THEN 'Unknown' ELSE trim({c}) END AS party, count(*) AS n_rows FROM search_results GROUP BY 2" for c in ("vendor", "client")),
    "pricing_signals": "SELECT doc_id, " + ", ".join(f"coalesce({_count_sql(p)}, 0)::BIGINT AS {n}" for n, p in T.SIGNALS.items())
    + ", (" + " + ".join(f"coalesce(contains(lower(text), {_q(w)}), false)::INT" for w in T.TREND_WORDS) + ")::BIGINT AS n_trend_words FROM documents",
    "cut_texts": f"SELECT content_id, length(t)::INTEGER AS n_chars, md5(t) AS text_md5 FROM (SELECT content_id, CASE WHEN length(text) <= 4000 THEN text {_ends} ELSE {_CUT} END AS t FROM parsed_content WHERE text IS NOT NULL)",
    "stored_fields": "SELECT " + ", ".join(f"left({_clean(c)}, {cap}) AS {n}" if cap else f"{_clean(c)} AS {n}" for n, c, cap in (
        ("file_name", "file_name", 200), ("deal_id", "deal_id", None), ("salesforce_vendor_id", "vendor_id", None), ("client_name", "client", 100), ("vendor_name", "vendor_name", 100), ("deal_status", "deal_status", None), ("contract_term", "contract_term", 100)))
    + f", '' AS report_type, CASE WHEN isnan(final_amount) THEN 0.0 ELSE coalesce(final_amount, 0.0) END AS final_amount, 0.0::DOUBLE AS savings_1yr, coalesce(chunk_index, 0) AS chunk_index, false AS has_parsing_errors, md5(left({_clean('text')}, 37000)) AS text_md5, {_seconds('contract_end')} AS contract_end_ts FROM search_results",
    "redacted_metadata": f"""WITH s AS (SELECT load_seq, CASE WHEN client IS NOT NULL AND lower(trim(client)) NOT IN {_MISS} THEN trim(client) END AS c, deal_name, file_name FROM search_results)
        SELECT load_seq, CASE WHEN c IS NOT NULL THEN '<<CLIENT>>' END AS client, CASE WHEN c IS NULL THEN deal_name ELSE regexp_replace(deal_name, '(?i)' || regexp_escape(c), '<<CLIENT>>', 'g') END AS deal_name,
        CASE WHEN c IS NULL THEN file_name ELSE regexp_replace(file_name, '(?i)' || regexp_escape(c), '<<CLIENT>>', 'g') END AS file_name FROM s""",
    "organisation_clients": f"""WITH s AS (SELECT DISTINCT trim(x) AS span FROM (SELECT vendor_name AS x FROM search_results UNION ALL SELECT client FROM search_results) WHERE x IS NOT NULL AND lower(trim(x)) NOT IN {_MISS}),
        c AS (SELECT DISTINCT client_name FROM client_registry WHERE client_name IS NOT NULL), p AS (SELECT span, client_name, ' ' || {_WORDS.format(c='span')} || ' ' AS a, ' ' || {_WORDS.format(c='client_name')} || ' ' AS b FROM s, c)
        SELECT span, client_name AS matched_client FROM p WHERE trim(a) <> '' AND trim(b) <> '' AND (contains(a, b) OR contains(b, a)) QUALIFY row_number() OVER (PARTITION BY span ORDER BY length(client_name) DESC, client_name DESC) = 1""",
    "centroid_cosines": """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), o AS (SELECT label, i, avg(x) AS m FROM e GROUP BY ALL), w AS (SELECT i, avg(x) AS w FROM e GROUP BY 1)
        SELECT label, round(sum(m * w) / (sqrt(sum(m * m)) * sqrt(sum(w * w))), 6) AS cosine FROM o JOIN w USING (i) GROUP BY 1""",
    "redaction_progress": """WITH b AS (SELECT redaction_id // 100 AS b, count(*) AS n, count(*) FILTER (NOT coalesce(success, false)) AS f FROM redaction_results GROUP BY 1), t AS (SELECT *, f = n AS bad FROM b)
        SELECT count(*) AS n_batches, count(*) FILTER (NOT bad) AS n_processed, count(*) FILTER (bad) AS n_failed, 0::BIGINT AS n_open, coalesce(sum(n), 0)::BIGINT AS n_rows, coalesce(sum(n - f) FILTER (NOT bad), 0)::BIGINT AS n_rows_done,
        (coalesce(sum(n) FILTER (bad), 0) + coalesce(sum(f) FILTER (NOT bad), 0))::BIGINT AS n_rows_failed, 100.0::DOUBLE AS progress_percent FROM t""",
}
