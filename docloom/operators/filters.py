"""Catalog filters with a reason for each rejected row, and a small filter language."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.dates import epoch_seconds
from docloom.functions.nulls import is_true
from docloom.functions.paths import effective_type, extension


@dataclass(frozen=True)
class CatalogFilter:
    """Bounds are inclusive; a bound that is None does not filter."""

    include_processed: bool = False
    include_types: tuple[str, ...] = ()
    exclude_types: tuple[str, ...] = field(default=(".png",))
    min_size_kb: float | None = None
    max_size_mb: float | None = None
    modified_after: str | None = None
    modified_before: str | None = None
    created_after: str | None = None
    created_before: str | None = None


def _dots(types: tuple[str, ...]) -> list[str]:
    return [t.lower() if t.startswith(".") else f".{t.lower()}" for t in types]


def reject_reason(rule: CatalogFilter, processed: Column, file_type: Column, size_mb: Column, modified: Column, created: Column) -> Column:
    """The first rule that rejects a row, or null for a row that stays.

    In order: processed, type, least size, greatest size, modified range, created range. An unknown type
    is not included, an unknown size is below and above any bound, an unreadable date is outside any range.
    ``modified`` and ``created`` are epoch seconds.
    """
    none = F.lit(None).cast("string")
    reason = F.when(F.lit(not rule.include_processed) & F.coalesce(processed, F.lit(False)), "processed")
    kind = F.coalesce(file_type, F.lit(""))
    if rule.exclude_types:
        reason = reason.when((kind != "") & kind.isin(_dots(rule.exclude_types)), "file_type")
    if rule.include_types:
        reason = reason.when(~kind.isin(_dots(rule.include_types)), "file_type")
    if rule.min_size_kb is not None:
        reason = reason.when(size_mb.isNull() | (size_mb * 1024 < rule.min_size_kb), "min_size")
    if rule.max_size_mb is not None:
        reason = reason.when(size_mb.isNull() | (size_mb > rule.max_size_mb), "max_size")
    for name, value, after, before in (
        ("modified", modified, rule.modified_after, rule.modified_before),
        ("created", created, rule.created_after, rule.created_before),
    ):
        if after or before:
            reason = reason.when(value.isNull(), f"{name}_missing")
        if after:
            reason = reason.when(value < epoch_seconds(F.lit(after)), f"{name}_after")
        if before:
            reason = reason.when(value > epoch_seconds(F.lit(before)), f"{name}_before")
    return reason.otherwise(none)


def with_reasons(df: DataFrame, rule: CatalogFilter) -> DataFrame:
    """Adds ``reject_reason`` to rows with ``file_type, name, path, size, size_mb, modified_time``.

    ``processed`` and ``deal_date`` are used where the table has them.
    """
    kind = effective_type(F.col("file_type"), F.col("name"), F.col("path"))
    size = F.coalesce("size_mb", F.col("size") / (1024 * 1024))
    processed = F.col("processed") if "processed" in df.columns else F.lit(False)
    created = epoch_seconds(F.col("deal_date")) if "deal_date" in df.columns else F.lit(None).cast("long")
    return df.withColumn("reject_reason", reject_reason(rule, processed, kind, size, epoch_seconds(F.col("modified_time")), created))


def compile_filter(spec: dict[str, Any] | None) -> Column:
    """A dictionary filter as a column.

    Fields map to a value or to operators ``$eq $ne $gt $gte $lt $lte $in $nin $exists``; ``$and`` and ``$or`` take
    lists. Null never satisfies a comparison. An empty filter accepts every row.
    """
    if not spec:
        return F.lit(True)
    compare = {
        "$eq": lambda c, v: c == F.lit(v), "$ne": lambda c, v: c != F.lit(v), "$gt": lambda c, v: c > F.lit(v), "$gte": lambda c, v: c >= F.lit(v),
        "$lt": lambda c, v: c < F.lit(v), "$lte": lambda c, v: c <= F.lit(v), "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~c.isin(list(v)),
        "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
    }
    terms = []
    for key, value in spec.items():
        if key in ("$and", "$or"):
            parts = [compile_filter(v) for v in value]
            terms.append(reduce(lambda a, b: a & b if key == "$and" else a | b, parts))  # noqa: B023
        elif isinstance(value, dict):
            terms += [F.coalesce(compare[op](F.col(key), v), F.lit(False)) for op, v in value.items()]
        else:
            terms.append(F.coalesce(F.col(key) == F.lit(value), F.lit(False)))
    return reduce(lambda a, b: a & b, terms)


def in_set(df: DataFrame, column: str, values: str | None) -> DataFrame:
    """Rows whose value is in a comma-separated list, but for case; no list keeps all rows."""
    wanted = [v.strip().lower() for v in (values or "").split(",") if v.strip()]
    return df.where(F.lower(F.trim(column)).isin(wanted)) if wanted else df


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the latest by ``order``; found by a maximum of structs, which combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    found = df.groupBy(*keys).agg(F.max(by).alias("_last"))
    return found.select(*[F.col(k) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns for k in [c]])


def live_rows(df: DataFrame, deleted: str = "is_deleted", prefix: tuple[str, str] | None = None) -> DataFrame:
    """Rows that are not deleted and, if asked for, whose id begins with a prefix."""
    kept = df.where(~is_true(F.col(deleted)))
    return kept.where(F.startswith(F.col(prefix[0]), F.lit(prefix[1]))) if prefix else kept


def visible_files(df: DataFrame, name: str = "name", size: str = "size", floor_kb: float = 10.0) -> DataFrame:
    """Files that are not hidden and reach the least size."""
    return df.where(~F.startswith(F.col(name), F.lit(".")) & (F.col(size) >= floor_kb * 1024))


def balanced_top(df: DataFrame, kind: str, size: str, path: str, per_kind: int) -> DataFrame:
    """The largest files of each kind, each path (but for case) once."""
    once = df.groupBy(extension(F.col(kind)).alias("kind"), F.lower(path).alias("path_key")).agg(F.max(F.struct(size, path)).alias("f"))
    ranked = once.select("kind", F.col(f"f.{size}").alias(size), F.col(f"f.{path}").alias(path)).withColumn(
        "place", F.row_number().over(Window.partitionBy("kind").orderBy(F.col(size).desc(), F.col(path)))
    )
    return ranked.where(F.col("place") <= per_kind)


def seeded_order(key: Column, seed: int) -> Column:
    """An order of keys that depends on the seed alone, the same in every engine that has MD5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The same ``n`` keys for a seed, whatever the partitioning; null keys are not drawn."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(seeded_order(F.col(key), seed), key).limit(n)


def sample_per_group(df: DataFrame, group: str, key: str, most: int, seed: int) -> DataFrame:
    """Up to ``most`` rows of each group, drawn by seed: a sample with a cap for each group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(seeded_order(F.col(key), seed), key))
    return df.where(F.col(key).isNotNull()).withColumn("place", place).where(F.col("place") <= most).drop("place")


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in order, as a listing is paged through."""
    return df.orderBy(*order).offset(offset).limit(limit)
