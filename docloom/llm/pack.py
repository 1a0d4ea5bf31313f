"""Texts packed into containers of a fixed number of tokens.

Sizes are tokens of a public tokenizer. Documents are packed shard by shard by the sum-of-squares rule: a
document goes to the open container, or to a new one, that makes the sum over all gaps of the squared
number of open containers with that gap smallest. The rule drives the gaps apart, so that later
documents find a gap they fill; no sorting and no look-ahead is needed.

A shard has a bounded number of documents (``SHARD_DOCS``), so the work of a task does not grow with the
data. What a shard leaves in containers that are not full is packed again, together with what other shards left, round by
round, until one shard holds it all or nothing more is gained. Only keys and sizes are shuffled.

Shards and order within them follow from a hash of key, size and number of the copy, so the same table gives the same
packing however its files are laid out; copies of a row are told apart by a number, so they spread over the shards.

Defined results: a text beyond the capacity is cut into full containers and a rest, nothing else is cut;
null and empty texts have no tokens and no container (null); repeated rows are packed each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import scratch_path

CAPACITY = 2_048
SHARD_DOCS = 50_000


@cache
def _encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """``key, n_tokens``: tokens of each text, 0 for null and empty; special tokens count as plain text."""

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoding(tokenizer).encode_ordinary
        for texts in batches:
            yield texts.map(lambda t: len(encode(t)) if t else 0).astype("int64")

    return df.select(F.col(key), F.pandas_udf(each, "bigint")(F.col(text)).alias("n_tokens"))


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each size, in the given order; sizes are within 1 and the capacity."""
    open_at = np.zeros(capacity + 1, np.int64)  # open containers per gap; gap 0 is closed and not counted
    stacks: dict[int, list[int]] = {}
    out = np.empty(len(sizes), np.int64)
    made = 0
    for i, w in enumerate(sizes.tolist()):
        rest = open_at[: capacity - w + 1]
        gaps = w + np.flatnonzero(open_at[w:capacity])
        after = 2 * rest[gaps - w] + 1
        after[gaps == w] = 0
        change = after - 2 * open_at[gaps] + 1
        fresh = 2 * int(open_at[capacity - w]) + 1 if w < capacity else 0
        k = int(change.argmin()) if len(gaps) else -1
        if k >= 0 and change[k] <= fresh:
            gap = int(gaps[k])
            container = stacks[gap].pop()
            open_at[gap] -= 1
        else:
            gap, container = capacity, made
            made += 1
        if gap > w:
            open_at[gap - w] += 1
            stacks.setdefault(gap - w, []).append(container)
        out[i] = container
    return out


def _pack_shard(turn: int):
    def each(label: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "_key", "copy", "piece"], kind="stable")
        size = pdf["n_tokens"].to_numpy()
        container = sum_of_squares(size, int(pdf["capacity"].iloc[0]))
        gap = int(pdf["capacity"].iloc[0]) - np.bincount(container, size).astype(np.int64)
        names = np.array([f"{turn}-{label[0]}-{c}" for c in range(len(gap))], object)
        return pdf[["_key", "copy", "piece", "first_token", "n_tokens"]].assign(container=names[container], gap=gap[container])

    return each


def packed(df: DataFrame, key: str, text: str, tokenizer: str | None = None, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``key, piece, first_token, n_tokens, container`` (a text): where each document, or part of one, went."""
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    sizes = token_counts(df, key, text, tokenizer or default_tokenizer()).select(F.col(key).alias("_key"), "n_tokens")
    copies = sizes.groupBy("_key", "n_tokens").count().select("_key", F.col("n_tokens").alias("n"), F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("copy"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)).cast("int")
    items = copies.select("_key", "copy", "n", F.explode(F.sequence(F.lit(0), parts - 1)).alias("piece")).withColumn("first_token", F.col("piece").cast("bigint") * capacity)
    items = items.withColumn("n_tokens", F.least(F.lit(capacity).cast("bigint"), F.col("n") - F.col("first_token"))).withColumn("place", F.xxhash64("_key", "n", "copy", "piece"))
    items.write.parquet(path := scratch_path(spark, "sizes"))
    items = spark.read.parquet(path)
    result = ["_key", "piece", "first_token", "n_tokens", "container"]
    done = items.where("n_tokens = 0").select(*result[:-1], F.lit(None).cast("string").alias("container"))
    rest, left, turn = items.where("n_tokens > 0").drop("n"), items.where("n_tokens > 0").count(), 0
    while left:
        shards = -(-left // shard_docs)
        sharded = rest.withColumn("shard", F.pmod(F.xxhash64("place", F.lit(turn)), F.lit(shards))).withColumn("capacity", F.lit(capacity))
        made = sharded.groupBy("shard").applyInPandas(_pack_shard(turn), f"_key {kind}, copy int, piece int, first_token bigint, n_tokens bigint, container string, gap bigint")
        made.write.parquet(path := scratch_path(spark, "packed"))
        made = spark.read.parquet(path)
        open_ones = made.where("gap > 0")
        again = open_ones.count() if shards > 1 else 0
        if shards == 1 or again > 0.9 * left:
            return done.unionByName(made.select(*result)).withColumnRenamed("_key", key)
        done = done.unionByName(made.where("gap = 0").select(*result))
        rest = open_ones.select("_key", "copy", "piece", "first_token", "n_tokens", F.xxhash64("_key", "copy", "piece", "n_tokens").alias("place"))
        left, turn = again, turn + 1
    return done.withColumnRenamed("_key", key)
