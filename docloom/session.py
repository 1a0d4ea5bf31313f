"""Session helpers: where shared files go, how wide to shuffle, how to salt."""

from __future__ import annotations

import atexit
import os
import pathlib
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Only on a local master, where driver and executors are one process, may it be unset: a temporary folder
    stands in for it then. On a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_dirs:
        folder = tempfile.mkdtemp(prefix="docloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_dirs[context.applicationId] = "file://" + folder
    return _own_dirs[context.applicationId]


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table that is written and read again."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system; none where it is missing."""
    at, system = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(at)) if system.exists(at) else []


def modified(spark: SparkSession, path: str) -> float | None:
    """When a file was last written, in seconds since 1970; None where it is missing."""
    at, system = _hadoop(spark, path)
    return system.getFileStatus(at).getModificationTime() / 1_000 if system.exists(at) else None


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, written at once: it tells that something is complete."""
    at, system = _hadoop(spark, path)
    system.create(at, True).close()


def remove(spark: SparkSession, path: str) -> None:
    at, system = _hadoop(spark, path)
    system.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    at, system = _hadoop(spark, path)
    if not system.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} cannot be renamed to {to}")


def numbered(df: DataFrame, order: str | list[str], name: str) -> DataFrame:
    """Rows with their place in order, from 0, in column ``name``.

    The sorted rows are written once; a row's place is its place in its partition plus the rows of the partitions
    before, of which there is one count each. No task sees all rows.
    """
    sorted_rows = df.sort(order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    sorted_rows.write.parquet(path := scratch_path(df.sparkSession, "sorted"))
    placed = df.sparkSession.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    at = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_base")
    return placed.join(counts, "_part").select(*df.columns, at.alias(name))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def hot_left_join(left: DataFrame, right: DataFrame, keys: list[str], by: Column, salts: int = 16) -> DataFrame:
    """Left join to a table that is unique on ``keys``, which a hot key cannot pull into one task.

    Adaptive execution splits the partition of a hot key as it finds it, and repeats no more of ``right`` than
    that partition needs. Where it is switched off, the left rows of a key are dealt over salts by ``by`` (a hash of
    something other than the key) and each row of ``right`` is repeated for every salt.
    """
    conf = left.sparkSession.conf
    adaptive = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    if all(conf.get(name, "true") == "true" for name in adaptive):
        return left.join(right, keys, "left")
    wide = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = left.withColumn("_salt", F.pmod(by, F.lit(salts)).cast("int"))
    return salted.join(wide, [*keys, "_salt"], "left").drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than cores, dealt out over the cores; any wider one as it is.

    For costly work on the rows of a small file. At size a scan has many more partitions than cores, and
    nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, through Spark's own file service."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="docloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = pathlib.Path(folder, "docloom.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
