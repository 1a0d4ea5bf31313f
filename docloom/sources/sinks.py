"""Sinks: atomic tables, reports in CSV and JSON, batched upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, by: list[str] | None = None, append: bool = False) -> None:
    """A Parquet table, committed as a whole."""
    writer = df.write.mode("append" if append else "overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A report for people: arrays joined by ``; ``, doubles with two places."""
    shown = []
    for name, dtype in df.dtypes:
        column = F.col(f"`{name}`")
        if dtype == "array<string>":
            column = F.concat_ws("; ", column)
        elif dtype == "double":
            column = F.round(column, 2)
        shown.append(column.alias(name))
    writer = df.select(*shown).write.mode("overwrite")
    writer.option("header", "true").csv(path) if kind == "csv" else writer.json(path)


def no_special_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinite doubles as null, as JSON has neither."""
    fine = lambda c: F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)
    return df.select(*[fine(F.col(f"`{n}`")).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes])


def upsert(df: DataFrame, send: Callable[[list[dict[str, Any]]], None], size: int = 30, attempts: int = 3) -> None:
    """Rows handed to ``send`` in batches, on the executors; a batch that fails is tried again.

    ``send`` must be idempotent by key, as a task that is lost is run again.
    """

    def each(rows: Iterator) -> None:
        batch: list[dict[str, Any]] = []

        def flush() -> None:
            for attempt in range(attempts):
                try:
                    send(batch)
                    break
                except Exception:
                    if attempt == attempts - 1:
                        raise
            batch.clear()

        for row in rows:
            batch.append(row.asDict(recursive=True))
            if len(batch) == size:
                flush()
        if batch:
            flush()

    df.foreachPartition(each)
