"""Queries over vectors, terms and ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import retrieval
from docloom.plans.data import table
from docloom.session import spread

K = 20


def _asked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base = table(spark, d, "embeddings").select("vec_id", "embedding")
    return base, base.where(F.col("vec_id") % 100 == 0)


def dense_top(spark: SparkSession, d: str) -> DataFrame:
    base, asked = _asked(spark, d)
    return retrieval.dense_topk(base, asked, "vec_id", "embedding", K).withColumn("score", F.round("score", 5))


def cosine_top(spark: SparkSession, d: str) -> DataFrame:
    base, asked = _asked(spark, d)
    return retrieval.dense_topk(base, asked, "vec_id", "embedding", K, cosine=True).withColumn("score", F.round("score", 5))


def list_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How far the lists by inner product and by cosine agree, for each query."""
    base, asked = _asked(spark, d)
    left = retrieval.dense_topk(base, asked, "vec_id", "embedding", K)
    right = retrieval.dense_topk(base, asked, "vec_id", "embedding", K, cosine=True)
    found = retrieval.compare_lists(left, right, "vec_id")
    return found.select("query_id", "n_both", "n_left_only", "n_right_only", *[F.round(c, 6).alias(c) for c in ("jaccard", "rank_agreement", "rank_correlation")])


def vector_profiles(spark: SparkSession, d: str) -> DataFrame:
    found = retrieval.vector_profile(table(spark, d, "embeddings"), "label", "embedding")
    return found.select("label", "n_vectors", "n_distinct", "repeat_share", *[F.round(c, 4).alias(c) for c in ("mean_norm", "centroid_norm")])


def vector_faults(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.vector_faults(table(spark, d, "embeddings"), "embedding", 64)


def term_top(spark: SparkSession, d: str) -> DataFrame:
    """The documents that match each evaluation item best by their words."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return retrieval.term_topk(docs, "doc_id", "text", table(spark, d, "eval_items"), "item_id", "item_text", 10)


QUERIES = {f.__name__: f for f in (dense_top, cosine_top, list_agreement, vector_profiles, vector_faults, term_top)}


def _top(score: str) -> str:
    return f"""SELECT query_id, rank, vec_id, score FROM (SELECT q.vec_id AS query_id, b.vec_id, {score} AS s, round(s, 5) AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY {score} DESC, b.vec_id) AS rank FROM embeddings q JOIN embeddings b ON q.vec_id % 100 = 0) WHERE rank <= {K}"""


_DOT = "list_inner_product(q.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_COS = "list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_TERMS = "SELECT k, term, count(*) AS w FROM (SELECT {k} AS k, unnest(regexp_extract_all(lower({t}), '[a-z0-9]+')) AS term FROM {f}) GROUP BY ALL"
ORACLE = {
    "dense_top": _top(_DOT),
    "cosine_top": _top(_COS),
    "list_agreement": f"""WITH l AS ({_top(_DOT)}), r AS ({_top(_COS)}), j AS (SELECT coalesce(l.query_id, r.query_id) AS query_id, l.rank AS ra, r.rank AS rb, l.rank IS NOT NULL AND r.rank IS NOT NULL AS b FROM l FULL JOIN r ON l.query_id = r.query_id AND l.vec_id = r.vec_id),
        p AS (SELECT *, row_number() OVER (PARTITION BY query_id, b ORDER BY ra) AS pa, row_number() OVER (PARTITION BY query_id, b ORDER BY rb) AS pb FROM j),
        s AS (SELECT query_id, count(*) FILTER (b) AS n, count(*) AS m, count(*) FILTER (rb IS NULL) AS lo, count(*) FILTER (ra IS NULL) AS ro, sum(CASE WHEN b THEN (ra - rb) * (ra - rb) ELSE 0 END) AS d1, sum(CASE WHEN b THEN (pa - pb) * (pa - pb) ELSE 0 END) AS d2 FROM p GROUP BY 1)
        SELECT query_id, n AS n_both, lo AS n_left_only, ro AS n_right_only, round(n / m, 6)::DOUBLE AS jaccard, round(CASE WHEN n < 2 THEN 0 ELSE 1 - 6 * d1 / (n * (n * n - 1)) END, 6)::DOUBLE AS rank_agreement, round(CASE WHEN n < 2 THEN 0 ELSE 1 - 6 * d2 / (n * (n * n - 1)) END, 6)::DOUBLE AS rank_correlation FROM s""",
    "vector_profiles": """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, sqrt(sum(m * m)) AS centroid_norm FROM (SELECT label, i, avg(x) AS m FROM e GROUP BY ALL) GROUP BY 1)
        SELECT label, n_vectors, n_distinct, round(1 - n_distinct / n_vectors, 4)::DOUBLE AS repeat_share, round(mean_norm, 4) AS mean_norm, round(centroid_norm, 4) AS centroid_norm FROM (SELECT label, count(*) AS n_vectors, count(DISTINCT embedding) AS n_distinct, avg(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS mean_norm FROM embeddings GROUP BY 1) JOIN c USING (label)""",
    "vector_faults": "SELECT count(*) AS n_vectors, count(*) FILTER (coalesce(len(embedding) <> 64, true)) AS n_wrong_size, count(*) FILTER (list_sum(list_transform(embedding, lambda x: abs(x))) = 0) AS n_zero, count(*) FILTER (len(list_filter(embedding, lambda x: isnan(x) OR x IS NULL)) > 0) AS n_not_a_number FROM embeddings",
    "term_top": f"""WITH d AS ({_TERMS.format(k='doc_id', t='text', f='documents')}), q AS ({_TERMS.format(k='item_id', t='item_text', f='eval_items')}), s AS (SELECT q.k AS query_id, d.k AS key, sum(d.w * q.w)::BIGINT AS score FROM d JOIN q ON d.term = q.term GROUP BY ALL)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS rank, key, score FROM s QUALIFY rank <= 10""",
}
