"""Queries that judge result lists: the results of each client ranked by two scores, as two strategies would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.nulls import is_missing
from docloom.operators import evaluation, retrieval
from docloom.plans.data import table

K = 20


def _lists(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "search_results").where(~is_missing(F.col("client_id"))).select(
        F.trim("client_id").alias("query_id"), F.col("load_seq").alias("key"), "vendor", "client", "file_type", F.col("pinecone_score").alias("a"), F.col("extraction_confidence").alias("b")
    )
    lists = [retrieval.ranked(rows.where(F.col(c).isNotNull()).withColumn("score", F.col(c)), ["query_id"], "score", "key", K).drop("a", "b") for c in ("a", "b")]
    return lists[0], lists[1]


def list_overlap(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.overlap_percent(*_lists(spark, d), "key")
    return found.select("query_id", "n_common", *[F.round(c, 6).alias(c) for c in ("of_left", "of_union")])


def vendor_matches(spark: SparkSession, d: str) -> DataFrame:
    """How many of the first ten results are of a vendor or type that the query's best rows by the other score name."""
    left, right = _lists(spark, d)
    low = lambda c: F.lower(F.trim(c))
    wanted = right.where("rank <= 3").groupBy("query_id").agg(F.collect_set(low(F.col("vendor"))).alias("vendors"), F.collect_set(low(F.col("file_type"))).alias("types"))
    return evaluation.expected_matches(left, wanted, {"vendor": "vendors", "file_type": "types"})


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    left, right = _lists(spark, d)
    both = left.withColumn("s", F.lit("index")).unionByName(right.withColumn("s", F.lit("extraction")))
    return evaluation.query_metrics(both, F.col("s"))


def strategy_report(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.strategy_report(_metrics(spark, d))
    return found.select("strategy", "n_queries", "n_answered", "n_results", "n_good", *[F.round(c, 6).alias(c) for c in ("mean_score", "mean_max_score", "mean_confidence")])


def session_report(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.session_summary(_metrics(spark, d))
    return found.select("n_queries", *[F.round(c, 6).alias(c) for c in ("answered_percent", "empty_percent", "good_percent")])


def top_quality(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.top_quality(_lists(spark, d)[0], {"vendor": "n_vendors", "client": "n_clients"})


def hybrid_top(spark: SparkSession, d: str) -> DataFrame:
    """Vectors and the words of the document of the same number, searched together."""
    base = table(spark, d, "embeddings").select("vec_id", "embedding").join(table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text"), "vec_id")
    found = retrieval.hybrid_topk(base, base.where(F.col("vec_id") % 100 == 0), "vec_id", "embedding", "text", K)
    return found.select("query_id", "rank", "vec_id", F.round("score", 4).alias("score"))


QUERIES = {f.__name__: f for f in (list_overlap, vendor_matches, strategy_report, session_report, top_quality, hybrid_top)}

_MISS = "('', 'none', 'nan', 'null', 'n/a')"


def _list(c: str) -> str:
    return f"""SELECT trim(client_id) AS query_id, load_seq AS key, vendor, client, file_type, {c} AS score, row_number() OVER (PARTITION BY trim(client_id) ORDER BY {c} DESC, load_seq) AS rank
        FROM search_results WHERE client_id IS NOT NULL AND lower(trim(client_id)) NOT IN {_MISS} AND {c} IS NOT NULL QUALIFY rank <= {K}"""


_BOTH = f"WITH l AS ({_list('pinecone_score')}), r AS ({_list('extraction_confidence')})"
_METRICS = _BOTH + """, b AS (SELECT 'index' AS strategy, * FROM l UNION ALL SELECT 'extraction', * FROM r),
    m AS (SELECT strategy, query_id, count(*) AS n, avg(score) AS mean_score, max(score) AS max_score, count(*) FILTER (score > 0.8) AS n_good,
      least(1.0, least(count(*) / 10.0, 1.0) * 0.3 + avg(score) FILTER (rank <= 10) * 0.7) AS confidence FROM b GROUP BY ALL)"""
_HIT = "len(list_filter({w}, lambda x: x <> '' AND (contains(lower(trim({c})), x) OR contains(x, lower(trim({c})))))) > 0 AND trim({c}) <> ''"
ORACLE = {
    "list_overlap": _BOTH + """, k AS (SELECT query_id, key, bool_or(s = 1) AS a, bool_or(s = 2) AS b FROM (SELECT query_id, key, 1 AS s FROM l UNION ALL SELECT query_id, key, 2 FROM r) GROUP BY ALL)
        SELECT query_id, count(*) FILTER (a AND b) AS n_common, round(CASE WHEN count(*) FILTER (a) > 0 THEN count(*) FILTER (a AND b) * 100.0 / count(*) FILTER (a) ELSE 0 END, 6)::DOUBLE AS of_left,
        round(count(*) FILTER (a AND b) * 100.0 / count(*), 6)::DOUBLE AS of_union FROM k GROUP BY 1""",
    "vendor_matches": _BOTH + f""", w AS (SELECT query_id, list(DISTINCT lower(trim(vendor))) FILTER (vendor IS NOT NULL) AS vs, list(DISTINCT lower(trim(file_type))) FILTER (file_type IS NOT NULL) AS ts FROM r WHERE rank <= 3 GROUP BY 1)
        SELECT query_id, count(*) FILTER (coalesce({_HIT.format(w='vs', c='vendor')}, false)) AS n_vendor, count(*) FILTER (coalesce({_HIT.format(w='ts', c='file_type')}, false)) AS n_file_type
        FROM l LEFT JOIN w USING (query_id) WHERE rank <= 10 GROUP BY 1""",
    "strategy_report": _METRICS + """ SELECT strategy, count(*) AS n_queries, count(*) FILTER (n > 0) AS n_answered, sum(n)::BIGINT AS n_results, sum(n_good)::BIGINT AS n_good, round(avg(mean_score), 6) AS mean_score,
        round(avg(max_score), 6) AS mean_max_score, round(avg(confidence), 6) AS mean_confidence FROM m GROUP BY 1""",
    "session_report": _METRICS + """ SELECT count(*) AS n_queries, round(count(*) FILTER (n > 0) * 100.0 / count(*), 6)::DOUBLE AS answered_percent, round(count(*) FILTER (n = 0) * 100.0 / count(*), 6)::DOUBLE AS empty_percent,
        round(count(*) FILTER (n_good > 0) * 100.0 / count(*), 6)::DOUBLE AS good_percent FROM m""",
    "top_quality": _BOTH + """ SELECT query_id, count(*) AS n_top, count(*) FILTER (score > 0.8) AS n_good, count(DISTINCT nullif(trim(vendor), '')) AS n_vendors, count(DISTINCT nullif(trim(client), '')) AS n_clients FROM l WHERE rank <= 5 GROUP BY 1""",
    "hybrid_top": f"""WITH b AS (SELECT vec_id, embedding::DOUBLE[] AS e, text FROM embeddings JOIN documents ON doc_id = vec_id), t AS (SELECT vec_id AS k, term, count(*) AS w FROM (SELECT vec_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM b) GROUP BY ALL),
        s AS (SELECT q.k AS q, x.k AS k, sum(q.w * x.w)::DOUBLE AS s FROM t q JOIN t x USING (term) WHERE q.k % 100 = 0 GROUP BY ALL),
        m AS (SELECT q.vec_id AS query_id, x.vec_id, 0.6::DOUBLE * list_inner_product(q.e, x.e) + 0.4::DOUBLE * coalesce(s.s, 0) AS score FROM b q JOIN b x ON q.vec_id % 100 = 0 LEFT JOIN s ON s.q = q.vec_id AND s.k = x.vec_id)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, round(score, 4) AS score FROM m QUALIFY rank <= {K}""",
}
