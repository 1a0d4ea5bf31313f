"""Work in batches that outlives a run: queues of batches with their states, tables kept for some hours, rates."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import children, mark, modified, numbered, remove

STATES = ("pending", "processing", "processed", "failed")


@dataclass(frozen=True)
class BatchQueue:
    """Rows in numbered batches of one size, and a log of what became of each batch.

    The rows are written once. The log is append-only and its last entry counts, so a run that breaks off leaves a batch
    that is still to be done, and marking a batch does not touch another.
    """

    spark: SparkSession
    root: str

    def create(self, rows: DataFrame, order: str, size: int) -> int:
        """Write the rows in batches from 1 in order; gives the number of batches. An earlier queue in the folder goes."""
        self.clear()
        batched = numbered(rows, order, "_row").withColumn("batch_no", (F.floor(F.col("_row") / size) + 1).cast("long")).drop("_row")
        batched.write.partitionBy("batch_no").parquet(f"{self.root}/rows")
        mark(self.spark, f"{self.root}/created")
        return len(self.numbers())

    def numbers(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in children(self.spark, f"{self.root}/rows") if n.startswith("batch_no="))

    def complete(self) -> bool:
        """Whether all rows were written."""
        return "created" in children(self.spark, self.root)

    def rows(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows").where(F.col("batch_no") == batch).drop("batch_no")

    def mark(self, batch: int, state: str, n_failed: int = 0) -> None:
        """Set the state of a batch; ``n_failed`` of its rows may have failed though it was processed."""
        if state not in STATES:
            raise ValueError(f"unknown state {state}")
        entry = [(batch, state, n_failed, time.time_ns())]
        self.spark.createDataFrame(entry, "batch_no long, state string, n_failed long, at long").coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def states(self) -> DataFrame:
        """``batch_no, state, n_rows, n_failed`` of every batch."""
        sizes = self.spark.read.parquet(f"{self.root}/rows").groupBy(F.col("batch_no").cast("long").alias("batch_no")).agg(F.count("*").alias("n_rows"))
        if not children(self.spark, f"{self.root}/log"):
            return sizes.select("batch_no", F.lit("pending").alias("state"), "n_rows", F.lit(0).cast("long").alias("n_failed"))
        last = self.spark.read.parquet(f"{self.root}/log").groupBy("batch_no").agg(F.max_by(F.struct("state", "n_failed"), "at").alias("s"))
        return sizes.join(last, "batch_no", "left").select("batch_no", F.coalesce("s.state", F.lit("pending")).alias("state"), "n_rows", F.coalesce("s.n_failed", F.lit(0)).alias("n_failed"))

    def next_batch(self) -> int | None:
        """The first batch that is neither processed nor failed."""
        row = self.states().where(F.col("state").isin("pending", "processing")).agg(F.min("batch_no")).first()
        return row[0]

    def status(self) -> DataFrame:
        """One row: batches and rows by state, and the progress in percent."""
        return queue_status(self.states())

    def clear(self) -> None:
        remove(self.spark, self.root)


def queue_status(states: DataFrame) -> DataFrame:
    """Totals of batches ``state, n_rows, n_failed``: of each batch its rows count once, as done, failed or open."""
    of = lambda *names: F.col("state").isin(*names)
    rows = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0)).cast("long")
    failed = rows(of("failed"), F.col("n_rows")) + rows(of("processed"), F.col("n_failed"))
    done = rows(of("processed"), F.col("n_rows") - F.col("n_failed"))
    total = F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long")
    return states.agg(
        F.count("*").alias("n_batches"), F.count_if(of("processed")).alias("n_processed"), F.count_if(of("failed")).alias("n_failed"), F.count_if(of("pending", "processing")).alias("n_open"),
        total.alias("n_rows"), done.alias("n_rows_done"), failed.alias("n_rows_failed"), F.when(total > 0, F.round((done + failed) * 100.0 / total, 1)).otherwise(0.0).alias("progress_percent"),
    )


def kept_table(spark: SparkSession, path: str, make: Callable[[], DataFrame], hours: float = 24.0) -> DataFrame:
    """A table that is made anew only where the stored one is older than some hours, or not whole."""
    at = modified(spark, f"{path}/_SUCCESS")
    if at is None or time.time() - at > hours * 3_600:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def rate(done: Column, seconds: Column) -> Column:
    """Rows a minute; null before any time has passed."""
    return F.when(seconds > 0, done * 60.0 / seconds)


def seconds_left(done: Column, total: Column, seconds: Column) -> Column:
    """Seconds that the rest takes at the rate so far; null where nothing is done yet."""
    return F.when(done > 0, F.greatest(total - done, F.lit(0)) * seconds / done)
