"""Reports on how well fields are filled and how values spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.nulls import AUDIT_EMPTY, is_missing, populated_strict
from docloom.session import scratch_path


def _long(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each field of each row: ``field, value`` (text), ``filled`` by the strict rule."""
    kinds = dict(df.dtypes)
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), populated_strict(F.col(f), kinds[f]).alias("filled")) for f in fields]
    return df.select(F.inline(F.array(*cells)))


def field_coverage(df: DataFrame, fields: list[str], samples: int = 3) -> DataFrame:
    """``field, n_filled, n_empty, percent, samples``: the samples are the least distinct values, 50 characters each.

    Counts combine before the shuffle; of the samples, a task keeps no more than are wanted.
    """
    long = _long(df, fields)
    counts = long.groupBy("field").agg(F.count_if("filled").alias("n_filled"), F.count_if(~F.col("filled")).alias("n_empty"))
    short = long.where("filled").select("field", F.left("value", F.lit(50)).alias("value"))
    values = short.distinct()
    # Spark keeps no more than the wanted rows of a field in a task before they are brought together.
    place = F.row_number().over(Window.partitionBy("field").orderBy("value"))
    least = values.withColumn("place", place).where(F.col("place") <= samples)
    shown = least.groupBy("field").agg(F.array_sort(F.collect_list("value")).alias("samples"))
    return counts.join(shown, "field", "left").select(
        "field", "n_filled", "n_empty", (F.col("n_filled") * 100.0 / (F.col("n_filled") + F.col("n_empty"))).alias("percent"), "samples"
    )


def presence_pairs(df: DataFrame, ident: str, name: str) -> DataFrame:
    """How often both, one or none of an id and a name are there."""
    has_id, has_name = ~is_missing(F.col(ident)), ~is_missing(F.col(name))
    kind = F.when(has_id & has_name, "both").when(has_id, "id_only").when(has_name, "name_only").otherwise("neither")
    return df.groupBy(kind.alias("presence")).agg(F.count("*").alias("n_rows"))


def audit(df: DataFrame, fields: list[str], required: tuple[str, ...], texts: tuple[str, ...], dates: tuple[str, ...], amounts: tuple[str, ...]) -> DataFrame:
    """``field`` with counts of nan and none spellings, empty required, long, odd dates, zero amounts, and the filled count."""
    value = F.trim(F.col("value"))
    low = F.lower(value)
    dated = value.rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}") | value.rlike(r"^\d{4}-\d{2}-\d{2}")
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    long = df.select(F.inline(F.array(*cells)))
    among = lambda names: F.col("field").isin(list(names)) if names else F.lit(False)
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return long.groupBy("field").agg(
        count(low == "nan").alias("n_nan_text"),
        count(low.isin("none", "null")).alias("n_none_text"),
        count(among(required) & is_missing(F.col("value"), AUDIT_EMPTY)).alias("n_required_empty"),
        count(among(texts) & (F.length("value") > 500)).alias("n_long"),
        count(among(dates) & ~low.isin("", "nan", "none") & ~dated).alias("n_odd_date"),
        count(among(amounts) & (F.coalesce(F.col("value").try_cast("double"), F.when(is_missing(F.col("value")), 0.0)) == 0)).alias("n_zero_amount"),
        count(value.rlike(r"[^\x00-\x7F]")).alias("n_non_ascii"),
        count(~is_missing(F.col("value"), AUDIT_EMPTY)).alias("n_filled"),
    )


def distribution(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(F.coalesce(value.cast("string"), F.lit("Unknown")).alias(name)).agg(F.count("*").alias("n_rows"))


def size_stats(df: DataFrame, size: str) -> DataFrame:
    """One row: sum, mean, least and greatest of the sizes that are not zero, and how many are beyond 10 and 50."""
    kept = df.where(F.coalesce(F.col(size), F.lit(0.0)) != 0)
    number = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 2)
    return kept.agg(
        number(F.sum(size)).alias("total_size"), number(F.avg(size)).alias("mean_size"), number(F.min(size)).alias("min_size"),
        number(F.max(size)).alias("max_size"), F.count_if(F.col(size) > 10).alias("n_over_10"), F.count_if(F.col(size) > 50).alias("n_over_50"),
    )


def at_places(df: DataFrame, group: str, value: str, places: dict[str, Column]) -> DataFrame:
    """Values at places of each group in order: ``group, n, min_value, max_value`` and a column for each of ``places``, from 0 by ``n``.

    Counts of different values are sorted over all tasks by ranges; a value's place is the running count in its task plus the
    counts of the tasks before, so no task holds a group, and a hot group is cut like any other.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).alias("v")).agg(F.count("*").alias("c"))
    sorted_counts = counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id())
    sorted_counts.write.parquet(path := scratch_path(df.sparkSession, "counts"))
    stored = df.sparkSession.read.parquet(path)
    sums = stored.groupBy("g", "part").agg(F.sum("c").alias("c"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = sums.select("g", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = stored.groupBy("g").agg(F.sum("c").alias("n"), F.min("v").alias("min_value"), F.max("v").alias("max_value"))
    run = stored.withColumn("upto", F.sum("c").over(inside)).join(based, ["g", "part"]).withColumn("upto", F.col("upto") + F.col("base"))
    placed = run.join(whole, "g")
    picks = [F.min(F.when(F.col("upto") > at, F.col("v"))).alias(name) for name, at in places.items()]
    found = placed.groupBy("g").agg(F.first("n").alias("n"), F.first("min_value").alias("min_value"), F.first("max_value").alias("max_value"), *picks)
    return found.withColumnRenamed("g", group)


def index_percentiles(df: DataFrame, group: str, value: str, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Values at index ``int(n * q)`` of each group in order, with least, greatest and count. Groups without a name are left out."""
    return at_places(df, group, value, {f"p{int(round(q * 100))}": F.floor(F.col("n") * F.lit(q)) for q in quantiles})


def score_stats(df: DataFrame, group: str, score: str) -> DataFrame:
    """Mean, median, greatest, least and sample deviation (0 for a single score) of each group."""
    plain = df.groupBy(group).agg(
        F.avg(score).alias("mean_score"), F.max(score).alias("max_score"), F.min(score).alias("min_score"),
        F.coalesce(F.stddev_samp(score), F.lit(0.0)).alias("std_score"), F.count(score).alias("n_scores"),
    )
    half = at_places(df, group, score, {"low": F.floor((F.col("n") - 1) / 2), "high": F.floor(F.col("n") / 2)})
    middle = half.select(F.col(group).alias("_g"), ((F.col("low") + F.col("high")) / 2).alias("median_score"))
    return plain.join(middle, F.col(group) == F.col("_g"), "left").drop("_g")


def top_scores(df: DataFrame, group: str, score: str, tie: str, k: int = 20) -> DataFrame:
    """The ``k`` best scores of each group with their place; no task keeps more of a group before they are brought together."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), tie))
    return df.withColumn("place", place).where(F.col("place") <= k).select(group, "place", tie, score)


def rollup_presence(df: DataFrame, group: Column, fields: list[str]) -> DataFrame:
    """Rows by group, and of these how many hold any, and how many all of the fields by the strict rule."""
    kinds = dict(df.dtypes)
    filled = [populated_strict(F.col(f), kinds[f]).cast("int") for f in fields]
    total = sum(filled[1:], filled[0])
    return df.groupBy(group.alias("group_key")).agg(F.count("*").alias("n_rows"), F.count_if(total > 0).alias("n_any"), F.count_if(total == len(fields)).alias("n_all"))
