"""Feeds: discovery of new files, status logs, and orphan references kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.orphans import OrphanState
from docloom.session import numbered, shared_dir


def discover(spark: SparkSession, incoming: str, schema: str, out: str, checkpoint: str, kind: str = "json", per_trigger: int = 1_000) -> StreamingQuery:
    """Take in new catalog files and stop; what was taken in before is known by the checkpoint, so it resumes."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(kind).load(incoming)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_status(log: DataFrame, key: str, at: str) -> DataFrame:
    """The last entry of each document in an append-only status log."""
    rest = [c for c in log.columns if c not in (key, at)]
    last = log.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("s"))
    return last.select(key, f"s.{at}", *[f"s.{c}" for c in rest])


def pending(documents: DataFrame, status: DataFrame, key: str, done: Column) -> DataFrame:
    """Documents whose last status is not done."""
    return documents.join(status.where(done).select(key), key, "left_anti")


def batched(df: DataFrame, order: str, size: int) -> DataFrame:
    """``batch_no`` from 1 in order; offsets come from per-partition counts, so no task sees all rows."""
    rows = numbered(df, order, "_row")
    return rows.withColumn("batch_no", F.floor(F.col("_row") / size) + 1).drop("_row")


class OrphanFeed:
    """Orphan references over a stream of events.

    An event row holds either a parent (``kind = 'parent'``) or a reference (``kind = 'reference'``: ``id``, ``ref_table``,
    ``ref``, ``first_ref``). Each micro-batch is folded into the state under its number. State and progress lie in one
    folder of the feed's own, so a feed that is made anew with the same name goes on where the last one stopped, and a
    batch that is run again is not folded twice. Two feeds need two names.
    """

    def __init__(self, spark: SparkSession, name: str = "orphan-feed", root: str | None = None) -> None:
        self.spark, self.root = spark, root or f"{shared_dir(spark)}/{name}"
        self.state = OrphanState.open(spark, f"{self.root}/state")

    def fold(self, batch: DataFrame, number: int) -> None:
        parents = batch.where("kind = 'parent'").select("ref_table", "parent_id", "name", "first_seen", "last")
        refs = F.filter(F.array(F.struct("ref_table", "ref")), lambda x: x["ref"].isNotNull())
        references = batch.where("kind = 'reference'").select("id", "first_ref", refs.alias("refs"))
        self.state = self.state.advance(parents, references, number)

    def run(self, events: DataFrame) -> StreamingQuery:
        return events.writeStream.foreachBatch(self.fold).option("checkpointLocation", f"{self.root}/progress").trigger(availableNow=True).start()
