"""The whole way of a document: discover, filter, parse, redact, chunk, embed, index, search, compare."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.paths import path_fields
from docloom.functions.records import chunk_key
from docloom.functions.text import file_class, query_kind
from docloom.operators import chunking, embedding, filters, redaction, retrieval
from docloom.sources.files import FileSource
from docloom.sources.parsers import parse_contents
from docloom.session import children, remove, rename
from docloom.sources.sinks import write_table


@dataclass(frozen=True)
class ProcessRules:
    """How documents are processed; the defaults are those of the command line."""

    catalog: filters.CatalogFilter = field(default_factory=filters.CatalogFilter)
    vendors: str | None = None
    clients: str | None = None
    document_types: str | None = None
    limit: int | None = None
    chunks: chunking.ChunkRules = field(default_factory=chunking.ChunkRules)
    strategy: str = "business_aware"
    redact: bool = False
    namespace: str = "documents"


def discover(source: FileSource, hashed: bool = False) -> DataFrame:
    """The catalog of a source: files with path fields, a class by name, and optionally a content hash."""
    listed = path_fields(source.list_documents(), "path")
    named = listed.withColumn("_c", file_class(F.col("name")))
    catalog = named.select(*listed.columns, F.col("_c.document_type").alias("document_type"), F.col("_c.confidence").alias("document_type_confidence"), F.lit(False).alias("processed"))
    catalog = catalog.withColumn("modified_time", F.date_format("modified_time", "yyyy-MM-dd'T'HH:mm:ss"))
    return catalog.join(source.hashes().withColumnRenamed("content_hash", "content_hash"), "path", "left") if hashed else catalog


def selected(catalog: DataFrame, rules: ProcessRules) -> DataFrame:
    """The files that pass every filter; the limit comes last."""
    kept = filters.with_reasons(catalog, rules.catalog).where(F.col("reject_reason").isNull()).drop("reject_reason")
    for column, values in (("vendor", rules.vendors), ("client", rules.clients), ("document_type", rules.document_types)):
        kept = filters.in_set(kept, column, values)
    return kept.orderBy("path").limit(rules.limit) if rules.limit else kept


def process(catalog: DataFrame, contents: DataFrame, rules: ProcessRules, model: embedding.Embedder, registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The chunk index and the status of each file.

    Index rows: ``chunk_id, path, name, chunk_index, section, chunk_type, chunk, vector, namespace`` with the file's
    fields. A file that cannot be parsed has a status with its error and no chunks.
    """
    files = selected(catalog, rules)
    parsed = parse_contents(contents.join(files.select("path"), "path", "left_semi"))
    texts = parsed.where(F.col("text").isNotNull()).select("path", "text")
    if rules.redact:
        texts = redaction.redact_contacts(texts, "text").select("path", F.col("redacted").alias("text"))
        if registry is not None:
            keyed = texts.join(files.select("path", F.col("client").alias("_client")), "path")
            texts = redaction.redact_clients(keyed, "text", "_client", registry).select("path", F.col("client_redacted").alias("text"))
    if rules.strategy == "semantic":
        chunks = embedding.semantic_chunks(texts, "path", "text", model).withColumns({"section": F.lit("main"), "chunk_type": F.lit("general")})
    else:
        chunks = chunking.chunk_rows(texts, "path", "text", rules.chunks).drop("chunk_id")
    described = chunks.join(files.drop("processed"), "path")
    index = embedding.embedded(described, "chunk", model).withColumns({"chunk_id": chunk_key(F.col("path"), F.col("chunk_index")), "namespace": F.lit(rules.namespace)})
    counts = chunks.groupBy("path").agg(F.count("*").alias("chunks_created"))
    status = parsed.select("path", "parser", "error").join(counts, "path", "left").select(
        "path", "parser", "error", F.coalesce("chunks_created", F.lit(0)).cast("bigint").alias("chunks_created"), F.col("error").isNull().alias("processed")
    )
    return index, status


def upsert_index(spark: SparkSession, path: str, fresh: DataFrame) -> None:
    """Documents of a run put into a stored index: their old chunks go, whatever their number was.

    The new index is written aside and folders are renamed then, so that a whole index stands at every moment under one name
    or the other; what a run that broke off left behind is put right first.
    """
    if not children(spark, path) and children(spark, f"{path}.old"):
        rename(spark, f"{path}.old", path)
    if not children(spark, path):
        return write_table(fresh, path)
    old = spark.read.parquet(path)
    write_table(retrieval.replace_documents(old, fresh.select(*old.columns), "path"), f"{path}.new")
    remove(spark, f"{path}.old")
    rename(spark, path, f"{path}.old")
    rename(spark, f"{path}.new", path)
    return remove(spark, f"{path}.old")


def search(
    index: DataFrame, query: str, model: embedding.Embedder, k: int = 20, where: dict[str, Any] | None = None, alpha: float = 0.6, mode: str = "traditional",
    rewriter: embedding.QueryRewriter | None = None,
) -> DataFrame:
    """``rank, score`` and the index columns of the best chunks for a query.

    The filter comes before the ranking. Scores mix vectors and words by ``alpha``. Modes: ``traditional`` searches the
    query, ``rewritten`` its first rewriting, ``combined`` takes half from each, ``fallback`` the rewriting where it
    finds enough. A document path occurs once, with its best chunk.
    """
    spark = index.sparkSession
    rows = index.where(filters.compile_filter(where))

    def ask(text: str) -> DataFrame:
        return _asked(rows, [("q", text)], model, k, alpha)

    found = ask(query)
    if mode != "traditional":
        if rewriter is None:
            raise ValueError(f"mode {mode} needs a rewriter")
        kind = spark.range(1).select(query_kind(F.lit(query), F.lit(None).cast("string")).alias("k")).first().k
        other = ask(rewriter.rewrite(query, kind)[0])
        if mode == "rewritten":
            found = other
        elif mode == "combined":
            found = retrieval.merge_results(found.where(F.col("rank") <= k // 2), other.where(F.col("rank") <= k - k // 2), k)
        elif mode == "fallback":
            found = retrieval.with_fallback(other, found, k)
        else:
            raise ValueError(f"unknown mode {mode}")
    named = found.select(F.col("key").alias("chunk_id"), "score").join(rows, "chunk_id")
    best = named.groupBy("path").agg(F.max(F.struct("score", "chunk_id")).alias("b"))
    once = named.join(best.select(F.col("b.chunk_id").alias("chunk_id")), "chunk_id", "left_semi")
    return retrieval.ranked(once.withColumn("query_id", F.lit("q")), ["query_id"], "score", "chunk_id", k).drop("query_id")


def _asked(rows: DataFrame, queries: list[tuple[str, str]], model: embedding.Embedder, k: int, alpha: float) -> DataFrame:
    """All queries in one pass over the rows: vectors and words of every row are held against all of them."""
    spark = rows.sparkSession
    vectors = model.embed([text for _, text in queries]).tolist()
    asked = spark.createDataFrame([(q, text, v) for (q, text), v in zip(queries, vectors, strict=True)], "chunk_id string, chunk string, vector array<float>")
    return retrieval.hybrid_topk(rows.select("chunk_id", "chunk", "vector"), asked, "chunk_id", "vector", "chunk", k, alpha).withColumnRenamed("chunk_id", "key")


def compare(left: DataFrame, right: DataFrame, queries: list[str], model: embedding.Embedder, k: int = 20, alpha: float = 0.6) -> DataFrame:
    """Per query, how far the lists from two indexes agree; a row for each query. Each index is read once for all queries."""
    lists = []
    for index in (left, right):
        found = _asked(index, [(q, q) for q in dict.fromkeys(queries)], model, k, alpha)
        named = found.join(index.select(F.col("chunk_id").alias("key"), "path"), "key")
        best = named.groupBy("query_id", "path").agg(F.max("score").alias("score"))
        lists.append(retrieval.ranked(best, ["query_id"], "score", "path", k).select("query_id", "rank", F.col("path").alias("key"), "score"))
    return retrieval.compare_lists(lists[0], lists[1], "key")


def summarised(comparison: DataFrame) -> DataFrame:
    """Mean, least and greatest agreement over all queries."""
    measures = ("jaccard", "rank_agreement", "rank_correlation", "n_both")
    return comparison.agg(F.count("*").alias("n_queries"), *[f(m).alias(f"{n}_{m}") for m in measures for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))])
