"""Models behind small interfaces, with deterministic stand-ins that need no network."""

from __future__ import annotations

import re
import zlib
from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.chunking import sentences

_TOKEN = re.compile(r"[a-z0-9]+")


class Embedder(ABC):
    """Texts to vectors of one size. An instance is sent to the executors, so it must be small or load lazily."""

    size: int

    @abstractmethod
    def embed(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder(Embedder):
    """Words hashed to signed places of a unit vector: a stand-in for a model, the same on every machine."""

    def __init__(self, size: int = 256) -> None:
        self.size = size

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), np.float32)
        for i, text in enumerate(texts):
            for token in _TOKEN.findall((text or "").lower()):
                h = zlib.crc32(token.encode())
                out[i, (h >> 1) % self.size] += 1 if h & 1 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class QueryRewriter(ABC):
    """A query to texts that an answer might look like."""

    @abstractmethod
    def rewrite(self, query: str, kind: str) -> list[str]: ...


# Sentences that an answer of each kind might hold.
TEMPLATES = {
    "pricing_proposal": ("The quoted price for {q} is set out by unit, term and discount.", "This proposal lists the costs and fees of {q}."),
    "vendor_contract": ("The parties agree on {q} under the terms of this contract.", "This agreement governs {q}, its renewal and its termination."),
    "technical_specification": ("The system meets these requirements: {q}.", "The implementation of {q} is specified as follows."),
    "compliance_security": ("The audit covers {q} and the controls for it.", "The policy requires {q} for compliance."),
    "vendor_comparison": ("Compared with other vendors, {q} is evaluated as follows.", "The alternatives for {q} differ in price and scope."),
    "general": ("This document describes {q}.", "The following concerns {q}."),
}


class TemplateRewriter(QueryRewriter):
    """A stand-in: the query put into sentences of its kind, with what is known of the business in brackets."""

    def __init__(self, context: dict[str, str] | None = None) -> None:
        self.context = context or {}

    def rewrite(self, query: str, kind: str) -> list[str]:
        known = ", ".join(f"{k}: {v}" for k, v in self.context.items())
        said = f"{query} ({known})" if known else query
        return [t.format(q=said) for t in TEMPLATES.get(kind, TEMPLATES["general"])]


def embedded(df: DataFrame, text: str, model: Embedder, out: str = "vector", batch: int = 24) -> DataFrame:
    """Adds the vector of each text, a batch at a time; null and blank texts have a null vector."""

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            vectors: list[list[float] | None] = [None] * len(texts)
            at = [i for i, t in enumerate(texts) if t and t.strip()]
            for k in range(0, len(at), batch):
                part = at[k : k + batch]
                for i, v in zip(part, model.embed([texts.iloc[i] for i in part]), strict=True):
                    vectors[i] = v.tolist()
            yield pd.Series(vectors)

    return df.withColumn(out, F.pandas_udf(each, "array<float>")(F.col(text)))


def breakpoints(parts: list[str], model: Embedder, percentile: float = 95.0) -> list[str]:
    """Sentences joined up to where neighbours differ more than the given percentile of all neighbours."""
    if len(parts) < 3:
        return [" ".join(parts)] if parts else []
    v = model.embed(parts)
    apart = 1 - np.sum(v[1:] * v[:-1], axis=1)
    cuts = np.flatnonzero(apart > np.percentile(apart, percentile)) + 1
    return [" ".join(parts[a:b]) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)], strict=True)]


def semantic_chunks(df: DataFrame, key: str, text: str, model: Embedder, percentile: float = 95.0) -> DataFrame:
    """``key, chunk_index, chunk`` cut where the meaning changes most."""

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: breakpoints(sentences(t), model, percentile) if t else [])

    made = F.posexplode(F.pandas_udf(each, "array<string>")(F.col(text))).alias("chunk_index", "chunk")
    return df.select(F.col(key).alias("_k"), made).withColumnRenamed("_k", key)


def sampled_pages(n: Column) -> Column:
    """Page numbers from 1 to look at: up to ten of the first third, five in the middle, five of the last quarter."""
    third, quarter = F.greatest(F.floor(n / 3).cast("int"), F.lit(1)), F.greatest(F.floor(n / 4).cast("int"), F.lit(1))
    middle = F.greatest(F.floor(n / 2).cast("int") - 2, F.lit(1))
    pages = F.concat(
        F.sequence(F.lit(1), F.least(third, F.lit(10))), F.sequence(middle, F.least(middle + 4, n)), F.sequence(F.greatest(n - F.least(quarter, F.lit(5)) + 1, F.lit(1)), n)
    )
    return F.when(n > 0, F.array_sort(F.array_distinct(pages))).otherwise(F.array().cast("array<int>"))
