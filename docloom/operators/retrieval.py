"""Search over vectors and terms, ranked lists and their comparison."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documented bound: query vectors that are sent to the executors at once.
QUERY_BLOCK = 4_096


def dense_topk(base: DataFrame, queries: DataFrame, key: str, vector: str, k: int, cosine: bool = False, min_score: float | None = None) -> DataFrame:
    """``query_id, rank, key, score``: the ``k`` best rows of ``base`` for each query by inner product (or cosine).

    Exact: every query against every row, in blocks of ``QUERY_BLOCK`` queries. A task keeps the best ``k`` of its
    rows for each query, so what is shuffled is bounded by tasks times queries times ``k``. Ties go to the
    lower key. Vectors of different dimensions are never compared: each query is held against the rows of its own. Null
    vectors are left out.
    """
    kind = dict(base.dtypes)[key]
    rows = base.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    out = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).sort("key").collect()
        widths = {w: [r for r in part if len(r.vector) == w] for w in {len(r.vector) for r in part}}
        sent = base.sparkSession.sparkContext.broadcast({w: ([r.key for r in of], np.array([r.vector for r in of], np.float64).reshape(len(of), w)) for w, of in widths.items()})

        def each(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            best = {w: _Best(names, matrix, cosine, k) for w, (names, matrix) in sent.value.items()}
            for batch in batches:
                size = batch["vector"].map(len)
                for w, kept in best.items():
                    if len(own := batch[size == w]):
                        kept.add(own["key"].to_numpy(object), np.array(own["vector"].tolist(), np.float64))
            for kept in best.values():
                yield kept.rows()

        found = rows.mapInPandas(each, f"query_id {kind}, key {kind}, score double")
        out = found if out is None else out.unionByName(found)
    if min_score is not None:
        out = out.where(F.col("score") >= min_score)
    return ranked(out, ["query_id"], "score", "key", k).select("query_id", "rank", F.col("key").alias(key), "score")


class _Best:
    """The best ``k`` rows for each of some query vectors, as rows come."""

    def __init__(self, names: list, matrix: np.ndarray, cosine: bool, k: int) -> None:
        self.names, self.cosine, self.k = names, cosine, k
        self.matrix = self._unit(matrix)
        self.scores, self.keys = np.empty((len(names), 0)), np.empty((len(names), 0), object)

    def _unit(self, v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) if self.cosine else v

    def add(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        scores = np.concatenate([self.scores, self.matrix @ self._unit(vectors).T], axis=1)
        every = np.concatenate([self.keys, np.broadcast_to(keys, (len(self.names), len(keys)))], axis=1)
        order = np.stack([np.lexsort((every[i], -scores[i]))[: self.k] for i in range(len(self.names))])
        self.scores, self.keys = np.take_along_axis(scores, order, 1), np.take_along_axis(every, order, 1)

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": np.repeat(np.array(self.names, object), self.scores.shape[1]), "key": self.keys.ravel(), "score": self.scores.ravel()})


def ranked(df: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    """The best ``k`` rows of each group with their rank from 1; Spark prunes to ``k`` per task before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def term_vectors(df: DataFrame, key: str, text: str, among: DataFrame | None = None) -> DataFrame:
    """``key, term, weight``: how often each lower-case word of letters and digits occurs (a sparse vector in rows).

    With ``among``, only its terms are counted; the rest are dropped before anything is shuffled by key.
    """
    terms = F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
    rows = df.select(F.col(key).alias("key"), terms.alias("term"))
    if among is not None:
        rows = rows.join(among.select("term").distinct(), "term", "left_semi")
    return rows.groupBy("key", "term").agg(F.count("*").alias("weight"))


def sparse_topk(base: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, key, score`` by the inner product of sparse vectors in rows."""
    asked = queries.select(F.col("key").alias("query_id"), "term", F.col("weight").alias("_q"))
    scores = base.join(asked, "term").groupBy("query_id", "key").agg(F.sum(F.col("weight") * F.col("_q")).alias("score"))
    return ranked(scores, ["query_id"], "score", "key", k).select("query_id", "rank", "key", "score")


#: Documented bound: bytes of query terms that are sent to the executors.
MAX_TERM_BYTES = 64_000_000


def term_topk(base: DataFrame, key: str, text: str, queries: DataFrame, query_key: str, query_text: str, k: int) -> DataFrame:
    """``query_id, rank, key, score``: the ``k`` texts that match each query best, by the product of their word counts.

    A text is scored where it is read, against the words of all queries, which travel as one broadcast after a check of
    their size; a task keeps the best ``k`` of its texts for each query. Ties go to the lower key; null keys are left out.
    """
    asked = term_vectors(queries.where(F.col(query_key).isNotNull()), query_key, query_text)
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    if size > MAX_TERM_BYTES:
        raise ValueError(f"{size} bytes of query terms are not broadcast; ask them in several sets, or use sparse_topk")
    listed: dict[str, list[tuple[int, int]]] = {}
    names: dict = {}
    for row in asked.sort("key", "term").collect():
        listed.setdefault(row.term, []).append((names.setdefault(row.key, len(names)), row.weight))
    lists = {term: (np.array([q for q, _ in x], np.int64), np.array([w for _, w in x], np.int64)) for term, x in listed.items()}
    sent = base.sparkSession.sparkContext.broadcast((list(names), lists))
    kinds = dict(base.dtypes)[key], dict(queries.dtypes)[query_key]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, lists = sent.value
        best: list[list] = [[] for _ in names]
        for batch in batches:
            for ident, words in zip(batch["key"], batch["words"], strict=True):
                scores = np.zeros(len(names), np.int64)
                for word, n in Counter(w for w in words if w in lists).items():
                    at, weight = lists[word]
                    scores[at] += n * weight
                for q in np.flatnonzero(scores).tolist():
                    best[q].append((-int(scores[q]), ident))
                    if len(best[q]) > 4 * k:
                        best[q] = sorted(best[q])[:k]
        rows = [(names[q], ident, -score) for q, found in enumerate(best) for score, ident in sorted(found)[:k]]
        yield pd.DataFrame(rows, columns=["query_id", "key", "score"])

    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z0-9]+"), F.lit(0))
    rows = base.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), words.alias("words"))
    found = rows.mapInPandas(each, f"query_id {kinds[1]}, key {kinds[0]}, score bigint")
    return ranked(found, ["query_id"], "score", "key", k).select("query_id", "rank", "key", "score")


def hybrid(dense: DataFrame, sparse: DataFrame, alpha: float, k: int) -> DataFrame:
    """Two scored lists ``query_id, key, score`` joined: ``alpha`` times dense plus the rest times sparse, both as they are.

    Weighting the two parts of a query vector and taking one inner product gives the same. A row that one list lacks has nothing from it.
    """
    both = dense.select("query_id", "key", F.col("score").alias("d")).join(sparse.select("query_id", "key", F.col("score").alias("s")), ["query_id", "key"], "full")
    zero = F.lit(0.0)
    mixed = both.withColumn("score", F.coalesce("d", zero) * alpha + F.coalesce("s", zero) * (1 - alpha))
    return ranked(mixed, ["query_id"], "score", "key", k).select("query_id", "rank", "key", "score")


def hybrid_topk(base: DataFrame, queries: DataFrame, key: str, vector: str, text: str, k: int, alpha: float = 0.6) -> DataFrame:
    """``query_id, rank, key, score``: ``alpha`` times the inner product of vectors plus the rest times that of word counts.

    Exact: a row is scored where it is read, against blocks of queries with the words of each; a task keeps its best ``k``.
    Rows without a vector, or of another dimension, score by their words alone, and the other way round.
    """
    kind = dict(base.dtypes)[key]
    words = lambda c: F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    shape = lambda df: df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"), words(text).alias("words"))
    asked = shape(queries)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    out = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).sort("key").collect()
        width = {len(r.vector) for r in part if r.vector is not None}
        lists: dict[str, tuple[list, list]] = {}
        for q, row in enumerate(part):
            for word, n in Counter(row.words).items():
                lists.setdefault(word, ([], []))[0].append(q)
                lists[word][1].append(n)
        vectors = {w: ([q for q, r in enumerate(part) if r.vector is not None and len(r.vector) == w], np.array([r.vector for r in part if r.vector is not None and len(r.vector) == w], np.float64)) for w in width}
        sent = base.sparkSession.sparkContext.broadcast(([r.key for r in part], vectors, {t: (np.array(a), np.array(b)) for t, (a, b) in lists.items()}))

        def each(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            names, vectors, lists = sent.value
            keys, best = np.empty((len(names), 0), object), np.empty((len(names), 0))
            for batch in batches:
                scores = np.zeros((len(names), len(batch)))
                for at, v in enumerate(batch["vector"]):
                    if v is not None and len(v) in vectors:
                        of, matrix = vectors[len(v)]
                        scores[of, at] += alpha * (matrix @ np.asarray(v, np.float64))
                for at, said in enumerate(batch["words"]):
                    for word, n in Counter(w for w in said if w in lists).items():
                        of, weight = lists[word]
                        scores[of, at] += (1 - alpha) * n * weight
                scores = np.concatenate([best, scores], axis=1)
                every = np.concatenate([keys, np.broadcast_to(batch["key"].to_numpy(object), (len(names), len(batch)))], axis=1)
                if len(names):
                    order = np.stack([np.lexsort((every[i], -scores[i]))[:k] for i in range(len(names))])
                    best, keys = np.take_along_axis(scores, order, 1), np.take_along_axis(every, order, 1)
            yield pd.DataFrame({"query_id": np.repeat(np.array(names, object), best.shape[1]), "key": keys.ravel(), "score": best.ravel()})

        found = shape(base).mapInPandas(each, f"query_id {kind}, key {kind}, score double")
        out = found if out is None else out.unionByName(found)
    return ranked(out, ["query_id"], "score", "key", k).select("query_id", "rank", F.col("key").alias(key), "score")


def best_per_key(df: DataFrame, key: Column, score: str, seq: str, columns: list[str]) -> DataFrame:
    """The best row of each key, the first by ``seq`` where scores tie; a maximum of structs, combined before the shuffle."""
    row = F.struct(F.col(score).alias("score"), (-F.col(seq)).alias("first"), *[F.col(c).alias(f"c_{c}") for c in columns])
    best = df.groupBy(key.alias("result_key")).agg(F.max(row).alias("r"))
    return best.select("result_key", F.col("r.score").alias(score), (-F.col("r.first")).alias(seq), *[F.col(f"r.c_{c}").alias(c) for c in columns])


def result_key(path: Column, name: Column) -> Column:
    """What tells results apart: the path, or the file name where the path is blank."""
    return F.coalesce(F.nullif(F.trim(path), F.lit("")), name)


def rerank(results: DataFrame, scores: DataFrame, by: str, key: str, top: int) -> DataFrame:
    """Results ordered anew by another model's scores, joined by row id; results without a score come last."""
    joined = results.join(scores.select(by, key, F.col("score").alias("rerank_score")), [by, key], "left")
    order = Window.partitionBy(by).orderBy(F.col("rerank_score").desc_nulls_last(), "rank")
    return joined.withColumn("new_rank", F.row_number().over(order)).where(F.col("new_rank") <= top)


def compare_lists(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per query, how far two ranked lists ``query_id, rank, key`` agree.

    ``jaccard`` (1 where both are empty), ``rank_agreement`` by the rank-difference formula on the lists' own
    ranks, ``rank_correlation`` by the same formula on ranks within the overlap, and counts.
    """
    a = left.select("query_id", F.col(key).alias("k"), F.col("rank").alias("ra"))
    b = right.select("query_id", F.col(key).alias("k"), F.col("rank").alias("rb"))
    joined = a.join(b, ["query_id", "k"], "full").withColumn("both", F.col("ra").isNotNull() & F.col("rb").isNotNull())
    place = lambda r: F.row_number().over(Window.partitionBy("query_id", "both").orderBy(r))
    joined = joined.withColumns({"pa": place("ra"), "pb": place("rb")})
    n = F.count_if("both")
    square = lambda x, y: F.sum(F.when(F.col("both"), (F.col(x) - F.col(y)) * (F.col(x) - F.col(y))).otherwise(0))
    formula = lambda d: F.when(n < 2, 0.0).otherwise(1 - 6 * d / (n * (n * n - 1)))
    return joined.groupBy("query_id").agg(
        (n / F.count("*")).alias("jaccard"), formula(square("ra", "rb")).alias("rank_agreement"), formula(square("pa", "pb")).alias("rank_correlation"),
        n.alias("n_both"), F.count_if(F.col("rb").isNull()).alias("n_left_only"), F.count_if(F.col("ra").isNull()).alias("n_right_only"),
    )


def confidence(n: Column, mean: Column) -> Column:
    """A result list's confidence from its length and its mean score."""
    return F.least(F.lit(1.0), F.least(n / 10.0, F.lit(1.0)) * 0.3 + mean * 0.7)


def vector_profile(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Per group: number and distinct number of vectors, mean norm, norm of the centroid, share of repeats."""
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    parts = df.select(group, F.posexplode(vector).alias("dim", "x")).groupBy(group, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    centroid = parts.groupBy(group).agg(F.sqrt(F.sum(F.col("mean") * F.col("mean"))).alias("centroid_norm"))
    each = df.groupBy(group).agg(F.count("*").alias("n_vectors"), F.countDistinct(vector).alias("n_distinct"), F.avg(F.sqrt(squares)).alias("mean_norm"))
    return each.join(centroid, group).withColumn("repeat_share", F.round(1 - F.col("n_distinct") / F.col("n_vectors"), 4))


def vector_faults(df: DataFrame, vector: str, size: int) -> DataFrame:
    """One row: vectors of another size, all zero, and with a value that is no number."""
    odd = F.exists(vector, lambda x: F.isnan(x) | x.isNull())
    return df.agg(
        F.count("*").alias("n_vectors"), F.count_if(F.coalesce(F.size(vector) != size, F.lit(True))).alias("n_wrong_size"),
        F.count_if(F.forall(vector, lambda x: x == 0)).alias("n_zero"), F.count_if(odd).alias("n_not_a_number"),
    )


def valid_sparse(indices: Column, values: Column) -> Column:
    """A sparse vector as a struct; an empty one becomes a single tiny weight, as an index takes no empty vector."""
    empty = F.coalesce(F.size(indices), F.lit(0)) == 0
    return F.struct(F.when(empty, F.array(F.lit(0).cast("bigint"))).otherwise(indices).alias("indices"), F.when(empty, F.array(F.lit(0.01))).otherwise(values).alias("values"))


def merge_results(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    """Two result lists ``query_id, key, score`` as one: each key once with its best score, the best ``k``."""
    both = first.select("query_id", "key", "score").unionByName(second.select("query_id", "key", "score"))
    return ranked(both.groupBy("query_id", "key").agg(F.max("score").alias("score")), ["query_id"], "score", "key", k)


def with_fallback(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    """The first list where it has at least ``max(3, k // 4)`` results for a query, else the second list."""
    enough = first.groupBy("query_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= max(3, k // 4)).select("query_id")
    return first.join(enough, "query_id", "left_semi").unionByName(second.join(enough, "query_id", "left_anti"))


def update_metadata(index: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Index rows with the non-null values of a change table put in; keys that are not in the index change nothing."""
    new = changes.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    joined = index.join(new, index[key] == F.col("_k"), "left")
    return joined.select(*[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in index.columns])


def replace_documents(index: DataFrame, fresh: DataFrame, document: str) -> DataFrame:
    """Index rows with all rows of the documents in ``fresh`` replaced, so no stale tail chunk stays."""
    return index.join(fresh.select(document).distinct(), document, "left_anti").unionByName(fresh)


def business_context(where: dict | None) -> dict[str, str] | None:
    """What a filter says of vendor, client, year and document type, for the rewriting of a query; None where it says nothing."""
    plain = {f: v.get("$eq") if isinstance(v, dict) else v for f, v in (where or {}).items() if f in ("vendor", "client", "year", "document_type")}
    return {f: v for f, v in plain.items() if isinstance(v, str)} or None


# Criteria of a business search.
CRITERIA = ("vendor", "client", "deal_number", "year", "week_number", "document_type", "deal_status")


def criteria_filter(**given) -> dict:
    """A filter of equalities on the criteria that are given; empty and zero values do not filter."""
    unknown = set(given) - set(CRITERIA)
    if unknown:
        raise ValueError(f"unknown criteria {sorted(unknown)}")
    return {f: given[f] for f in CRITERIA if given.get(f)}


# Messages of errors that pass with time or smaller batches, and of errors that do not.
PASSING = ("429", "rate limit", "quota", "too many requests", "upsert size limit", "max upsert size", "throttled", "request size", "exceeds the maximum", "metadata size")
LASTING = ("sparse vector must contain at least one value", "invalid sparse vector", "malformed vector")


def passing(error: BaseException) -> bool:
    """Whether an operation that failed so is worth another try."""
    said = str(error).lower()
    return not any(x in said for x in LASTING) and any(x in said for x in PASSING)
