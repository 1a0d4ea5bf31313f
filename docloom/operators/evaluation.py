"""How good and how alike ranked result lists are: by query, by strategy and over a session.

Lists are long tables ``query_id, rank, key, score`` with what a report needs of each result. All measures are
aggregates by query, combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documented choices of the reports: results that overlap is measured on, results that matches are counted in, and a good score.
OVERLAP_TOP, MATCH_TOP, GOOD = 20, 10, 0.8


def overlap_percent(left: DataFrame, right: DataFrame, key: str, top: int = OVERLAP_TOP) -> DataFrame:
    """``query_id, n_common, of_left, of_union``: shared results of the first ``top``, in percent of the left list and of both together."""
    sides = [x.where(F.col("rank") <= top).select("query_id", F.col(key).alias("k"), F.lit(name).alias("side")) for x, name in ((left, 1), (right, 2))]
    held = sides[0].unionByName(sides[1]).groupBy("query_id", "k").agg(F.bit_or("side").alias("s"))
    n = {name: F.count_if(F.col("s").bitwiseAND(F.lit(bit)) > 0) for name, bit in (("left", 1), ("any", 3))}
    common = F.count_if(F.col("s") == 3)
    share = lambda whole: F.when(whole > 0, common * 100.0 / whole).otherwise(0.0)
    return held.groupBy("query_id").agg(common.alias("n_common"), share(n["left"]).alias("of_left"), share(n["any"]).alias("of_union"))


def expected_matches(results: DataFrame, expected: DataFrame, fields: dict[str, str], top: int = MATCH_TOP) -> DataFrame:
    """``query_id`` and ``n_<field>`` for each field: results of the first ``top`` whose value holds, or is held by, one that was expected.

    ``fields`` maps a column of the results to the array column of ``expected``; case does not count, missing values match nothing.
    Queries without an expectation count nothing.
    """
    low = lambda c: F.lower(F.trim(c))
    joined = results.where(F.col("rank") <= top).join(expected.select("query_id", *[F.col(e).alias(f"_{e}") for e in fields.values()]), "query_id", "left")

    def hit(field: str, wanted: str) -> Column:
        value = low(F.col(field))
        some = F.exists(F.coalesce(F.col(f"_{wanted}"), F.array().cast("array<string>")), lambda x: (low(x) != "") & (value.contains(low(x)) | low(x).contains(value)))
        return F.coalesce(some & (value != ""), F.lit(False))

    return joined.groupBy("query_id").agg(*[F.count_if(hit(f, e)).alias(f"n_{f}") for f, e in fields.items()])


def query_metrics(results: DataFrame, strategy: Column) -> DataFrame:
    """``strategy, query_id, n_results, mean_score, max_score, n_good, confidence`` of each query; a row without a key stands for a query without results."""
    found = F.col("key").isNotNull()
    n, top = F.count_if(found), F.avg(F.when(found & (F.col("rank") <= 10), F.col("score")))
    sure = F.least(F.lit(1.0), F.least(n / 10.0, F.lit(1.0)) * 0.3 + F.coalesce(top, F.lit(0.0)) * 0.7)
    return results.groupBy(strategy.alias("strategy"), "query_id").agg(
        n.alias("n_results"), F.avg("score").alias("mean_score"), F.max("score").alias("max_score"), F.count_if(F.col("score") > GOOD).alias("n_good"), sure.alias("confidence")
    )


def strategy_report(metrics: DataFrame) -> DataFrame:
    """By strategy: queries, those with results, results, mean of the mean and greatest scores, good results."""
    return metrics.groupBy("strategy").agg(
        F.count("*").alias("n_queries"), F.count_if(F.col("n_results") > 0).alias("n_answered"), F.sum("n_results").alias("n_results"), F.avg("mean_score").alias("mean_score"),
        F.avg("max_score").alias("mean_max_score"), F.sum("n_good").alias("n_good"), F.avg("confidence").alias("mean_confidence"),
    )


def session_summary(metrics: DataFrame) -> DataFrame:
    """One row for a session: queries, and in percent those answered, without results, and with a good result."""
    percent = lambda c: F.coalesce(F.count_if(c) * 100.0 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0))
    return metrics.agg(
        F.count("*").alias("n_queries"), percent(F.col("n_results") > 0).alias("answered_percent"), percent(F.col("n_results") == 0).alias("empty_percent"), percent(F.col("n_good") > 0).alias("good_percent")
    )


def top_quality(results: DataFrame, fields: dict[str, str], top: int = 5) -> DataFrame:
    """``query_id, n_top, n_good`` and the number of different values of each of ``fields`` among the first ``top`` results."""
    first = results.where(F.col("rank") <= top)
    return first.groupBy("query_id").agg(
        F.count("*").alias("n_top"), F.count_if(F.col("score") > GOOD).alias("n_good"), *[F.countDistinct(F.nullif(F.trim(F.col(c)), F.lit(""))).alias(name) for c, name in fields.items()]
    )
