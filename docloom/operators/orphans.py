"""References to records that do not exist, kept up to date as references and records arrive.

The state is keyed and lies in a folder that all executors share. It is advanced batch by batch, and a batch is
joined to the state; the history is never folded again:

* ``facts``: per record, when it was first seen and its latest row; only the records of a batch are looked up;
* ``index``: per spelling of a record, the record that stands for it; written for the spellings that changed;
* ``seen``: per referring row, its earliest time and its references; only the ids of a batch are looked up;
* ``pending``: the references whose record is absent or deleted, keyed by table and reference;
* ``states``: a log of what each reference was found to be, one entry for each time it was looked at.

New references probe the index. Records that arrive resolve the pending references that wait for them. Where a record
is deleted, or its times change, the settled references to it are looked at again; where a batch has no such
record, settled references are not read. A batch is committed by a marker once its tables stand, so a batch that is
run again, and a feed that is started again, go on from the last committed batch.

All facts are minima and maxima, so any split into batches, in any order, ends in the same state.

Defined results: missing references have no state; rows without a key of their own (null id) are one referring row;
records without a key are left out; repeated rows change nothing; an empty batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.nulls import is_missing
from docloom.session import children, hot_left_join, mark, scratch_path

PARENT_SCHEMA = "ref_table string, parent_id string, name string, first_seen timestamp, last struct<at:timestamp,seq:bigint,deleted:boolean>"
REFERENCE_SCHEMA = "id string, first_ref timestamp, refs array<struct<ref_table:string,ref:string>>"
_BEST = "struct<deleted:boolean,first_seen:timestamp,parent_id:string>"
_STATE = "ref_table string, ref string, id string, first_ref timestamp, parent_id string, state string, gen int"
_LOGS = {
    "facts": f"{PARENT_SCHEMA}, gen int",
    "index": f"ref_table string, ref string, p {_BEST}, known boolean, gen int",
    "seen": f"{REFERENCE_SCHEMA}, gen int",
    "pending": _STATE,
    "states": _STATE,
}
OPEN = ("absent", "deleted")


def parent_rows(df: DataFrame, table: str, key: str, at: str, deleted: Column, seq: Column | None = None, name: str | None = None) -> DataFrame:
    """Rows of a parent table in the common form; rows without a key name no record and are left out."""
    return df.where(F.col(key).isNotNull()).select(
        F.lit(table).alias("ref_table"),
        F.col(key).alias("parent_id"),
        (F.col(name) if name else F.lit(None).cast("string")).alias("name"),
        F.col(at).cast("timestamp").alias("first_seen"),
        F.struct(F.col(at).cast("timestamp").alias("at"), (seq if seq is not None else F.lit(0)).cast("bigint").alias("seq"), deleted.alias("deleted")).alias("last"),
    )


def reference_rows(df: DataFrame, key: str, at: str, columns: dict[str, tuple[str, tuple[str, ...]]]) -> DataFrame:
    """Rows ``id, first_ref, refs``; ``refs`` has a struct ``ref_table, ref`` for each reference that is not missing.

    ``columns`` maps a reference column to its table and to further spellings that mean "none". Rows without
    a reference stay, as they too tell since when an id is there.
    """
    pairs = F.array(*[
        F.struct(F.lit(table).alias("ref_table"), F.when(~is_missing(F.col(c)) & ~F.trim(F.col(c)).isin(*none), F.trim(F.col(c))).alias("ref"))
        for c, (table, none) in columns.items()
    ])
    return df.select(F.col(key).cast("string").alias("id"), F.col(at).cast("timestamp").alias("first_ref"), F.filter(pairs, lambda x: x["ref"].isNotNull()).alias("refs"))


def _fold_parents(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ref_table", "parent_id").agg(F.max("name").alias("name"), F.min("first_seen").alias("first_seen"), F.max("last").alias("last"))


def _fold_references(rows: DataFrame) -> DataFrame:
    """One row per referring id: its earliest time and its different references; copies combine before the shuffle."""
    return rows.groupBy("id").agg(F.min("first_ref").alias("first_ref"), F.array_distinct(F.flatten(F.collect_set("refs"))).alias("refs"))


def _spelled(facts: DataFrame) -> DataFrame:
    """Facts by spelling: 18-character id, its first 15, its name, prefix plus last 8."""
    tail = F.right(F.col("parent_id"), F.lit(8))
    prefix = F.when(F.col("ref_table") == "clients", "Client-").when(F.col("ref_table") == "vendors", "Vendor-")
    forms = F.array_distinct(F.filter(F.array("parent_id", F.substring("parent_id", 1, 15), "name", F.concat(prefix, tail)), lambda x: x.isNotNull()))
    return facts.select("ref_table", F.explode(forms).alias("ref"), F.struct(F.coalesce("last.deleted", F.lit(False)).alias("deleted"), "first_seen", "parent_id").alias("p"))


def _exploded(seen: DataFrame) -> DataFrame:
    return seen.select("id", "first_ref", F.inline("refs")).select("ref_table", "ref", "id", "first_ref")


def _judged(refs: DataFrame) -> DataFrame:
    """References with the record ``p`` that stands for them: ``ok``, ``absent``, ``deleted`` or ``late`` (arrived afterwards)."""
    state = (
        F.when(F.col("p").isNull(), "absent").when(F.col("p.deleted"), "deleted").when(F.col("p.first_seen") > F.col("first_ref"), "late").otherwise("ok")
    )
    return refs.select("ref_table", "ref", "id", "first_ref", F.col("p.parent_id").alias("parent_id"), state.alias("state"))


@dataclass(frozen=True)
class OrphanState:
    """The committed batches of a state folder."""

    spark: SparkSession
    root: str
    batches: tuple[int, ...] = ()

    @staticmethod
    def empty(spark: SparkSession) -> OrphanState:
        """A state without batches, in a new folder of the shared folder."""
        return OrphanState(spark, scratch_path(spark, "orphans"))

    @staticmethod
    def open(spark: SparkSession, root: str) -> OrphanState:
        """The state that a folder holds; what an unfinished batch left there is not read."""
        return OrphanState(spark, root, tuple(sorted(int(n) for n in children(spark, f"{root}/commits") if n.isdigit())))

    def _log(self, name: str, batches: tuple[int, ...] | None = None) -> DataFrame:
        paths = [f"{self.root}/{b}/{name}" for b in (self.batches if batches is None else batches)]
        return self.spark.read.schema(_LOGS[name]).parquet(*paths) if paths else self.spark.createDataFrame([], _LOGS[name])

    def _write(self, df: DataFrame, name: str, batch: int) -> DataFrame:
        columns = [c.split(" ")[0] for c in _LOGS[name].split(", ") if not c.startswith("gen ")]
        df.select(*columns, F.lit(batch).alias("gen")).write.mode("overwrite").parquet(f"{self.root}/{batch}/{name}")
        return self._log(name, (batch,))

    def _index(self, batches: tuple[int, ...]) -> DataFrame:
        """The record that stands for each spelling, unique per ``ref_table, ref``.

        Where several records share a spelling, the reference is good if it is good for one of them; the earliest
        live record stands for them, else the earliest dead one.
        """
        log = self._log("index", batches)
        return log.select("ref_table", "ref", "p") if len(batches) < 2 else log.groupBy("ref_table", "ref").agg(F.max_by("p", "gen").alias("p"))

    def advance(self, parents: DataFrame | None = None, references: DataFrame | None = None, number: int | None = None) -> OrphanState:
        """Fold one batch of parent rows (arrivals, re-exports, deletions) and reference rows.

        ``number`` names the batch; one that is committed already is not folded again.
        """
        batch = number if number is not None else max(self.batches, default=-1) + 1
        if batch in self.batches:
            return self
        parents = parents if parents is not None else self.spark.createDataFrame([], PARENT_SCHEMA)
        references = references if references is not None else self.spark.createDataFrame([], REFERENCE_SCHEMA)
        moved = self._fold_arrivals(parents, batch)
        fresh = self._fold_seen(references, batch)
        asked = hot_left_join(_exploded(fresh), self._index((*self.batches, batch)), ["ref_table", "ref"], F.xxhash64("id"))
        judged = _judged(asked)
        if self.batches:
            again = self._waiting(moved)
            same = ["ref_table", "ref", "id"]
            # A row of this batch that stood before is judged once, with its newest first time.
            judged = judged.unionByName(_judged(again.join(fresh.select("id"), again["id"].eqNullSafe(fresh["id"]), "left_anti")))
            states = self._write(judged, "states", batch)
            kept, new = self._log("pending", self.batches[-1:]).drop("gen"), states.select(*same)
            match = (kept["ref_table"] == new["ref_table"]) & (kept["ref"] == new["ref"]) & kept["id"].eqNullSafe(new["id"])
            waiting = kept.join(new, match, "left_anti").unionByName(states.drop("gen").where(F.col("state").isin(*OPEN)))
        else:
            states = self._write(judged, "states", batch)
            waiting = states.where(F.col("state").isin(*OPEN))
        self._write(waiting, "pending", batch)
        mark(self.spark, f"{self.root}/commits/{batch}")
        return replace(self, batches=(*self.batches, batch))

    def _fold_arrivals(self, parents: DataFrame, batch: int) -> DataFrame:
        """Fold the records of a batch; the spellings whose record changed, ``known`` where they had one before."""
        new = _fold_parents(parents)
        if self.batches:
            before = self._log("facts").drop("gen").join(new.select("ref_table", "parent_id"), ["ref_table", "parent_id"], "left_semi")
            new = _fold_parents(new.unionByName(before.select(*new.columns)))
        facts = self._write(new, "facts", batch)
        touched = _spelled(facts)
        if not self.batches:
            best = touched.groupBy("ref_table", "ref").agg(F.min("p").alias("p")).withColumn("known", F.lit(False))
            return self._write(best, "index", batch)
        # Records outside the batch that share a touched spelling; for those in it the newest facts count.
        others = _spelled(_fold_parents(self._log("facts").join(facts.select("ref_table", "parent_id"), ["ref_table", "parent_id"], "left_anti")))
        spelled = touched.select("ref_table", "ref").distinct()
        shared = others.join(spelled, ["ref_table", "ref"], "left_semi")
        best = touched.unionByName(shared).groupBy("ref_table", "ref").agg(F.min("p").alias("p"))
        was = self._index(self.batches).withColumnRenamed("p", "old")
        changed = best.join(was, ["ref_table", "ref"], "left").where(~F.col("p").eqNullSafe(F.col("old")))
        return self._write(changed.withColumn("known", F.col("old").isNotNull()), "index", batch)

    def _fold_seen(self, references: DataFrame, batch: int) -> DataFrame:
        """Fold the referring rows of a batch, with what was seen of their ids before."""
        new = _fold_references(references)
        if self.batches:
            log, ids = self._log("seen").drop("gen"), new.select(F.col("id").alias("_id"))
            before = log.join(ids, log["id"].eqNullSafe(F.col("_id")), "left_semi")
            new = _fold_references(new.unionByName(before))
        return self._write(new, "seen", batch)

    def _waiting(self, moved: DataFrame) -> DataFrame:
        """Earlier references that the changed spellings concern: pending ones, and settled ones where a record was known."""
        keys = ["ref_table", "ref"]
        found = self._log("pending", self.batches[-1:]).select("ref_table", "ref", "id", "first_ref").join(moved.select(*keys, "p"), keys)
        reopened = moved.where("known")
        if reopened.limit(1).count():
            log = self._log("seen").select("id", F.explode("refs").alias("r"), "gen").select("r.ref_table", "r.ref", "id", "gen")
            ids = log.join(reopened.select(*keys), keys, "left_semi").select(F.col("id").alias("_id")).distinct()
            seen = self._log("seen")
            rows = seen.join(ids, seen["id"].eqNullSafe(F.col("_id")), "left_semi")
            last = rows.groupBy("id").agg(F.max_by(F.struct("first_ref", "refs"), "gen").alias("s")).select("id", "s.*")
            found = found.unionByName(_exploded(last).join(reopened.select(*keys, "p"), keys)).distinct()
        return found

    def resolved(self) -> DataFrame:
        """Every reference with its state: ``ok``, ``absent``, ``deleted`` or ``late`` (arrived afterwards)."""
        log = self._log("states")
        if len(self.batches) < 2:
            return log.drop("gen")
        last = log.groupBy("ref_table", "ref", "id").agg(F.max_by(F.struct("first_ref", "parent_id", "state"), "gen").alias("s"))
        return last.select("ref_table", "ref", "id", "s.*")

    def pending(self) -> DataFrame:
        """The references that wait for their record now."""
        return self._log("pending", self.batches[-1:]).drop("gen")

    def orphans(self) -> DataFrame:
        """The references that were orphans when they came or are orphans now."""
        return self.resolved().where(F.col("state") != "ok")

    def snapshot(self) -> DataFrame:
        """Counts per referred table, month of the reference and state."""
        month = F.date_format("first_ref", "yyyy-MM")
        return self.resolved().groupBy("ref_table", month.alias("month"), "state").agg(F.count("*").alias("n_refs"))

    def compacted(self, root: str | None = None) -> OrphanState:
        """The same state as one batch in another folder, which a long-running feed wants from time to time."""
        new = OrphanState(self.spark, root or scratch_path(self.spark, "orphans"))
        batch = max(self.batches, default=0)
        new._write(_fold_parents(self._log("facts")), "facts", batch)
        new._write(self._index(self.batches).withColumn("known", F.lit(False)), "index", batch)
        new._write(_fold_references(self._log("seen")), "seen", batch)
        new._write(self.pending(), "pending", batch)
        new._write(self.resolved(), "states", batch)
        mark(self.spark, f"{new.root}/commits/{batch}")
        return replace(new, batches=(batch,))
