"""Fields read from folder paths and file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of company names in paths that stand for another name.
NAME_ALIASES = (("p&g", "Procter & Gamble"), ("procter_gamble", "Procter & Gamble"), ("pg", "Procter & Gamble"))

_YEAR = r"(?i)(\d{4})\s*deal\s*docs?"


def extension(value: Column) -> Column:
    """Lower-case extension with a dot; the empty string for null and blank."""
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when((text == "") | F.startswith(text, F.lit(".")), text).otherwise(F.concat(F.lit("."), text))


def effective_type(file_type: Column, name: Column, path: Column) -> Column:
    """The extension by the type column, else by the name, else by the path."""
    tail = lambda c: F.when(c.contains("."), extension(F.substring_index(F.trim(c), ".", -1)))
    return F.coalesce(F.nullif(extension(file_type), F.lit("")), tail(name), tail(path), F.lit(""))


def company_name(value: Column) -> Column:
    """Separators to spaces, known spellings replaced, each word with one capital."""
    clean = F.trim(F.translate(value, "_-", "  "))
    named = F.when(F.coalesce(value, F.lit("")) == "", F.lit(""))
    for key, full in NAME_ALIASES:
        named = named.when(F.lower(clean).contains(key), F.lit(full))
    return named.otherwise(F.initcap(F.regexp_replace(clean, r"\s+", " ")))


def path_fields(df: DataFrame, path: str) -> DataFrame:
    """Adds ``year, week_number, week_date, vendor, client, deal_number, deal_name, confidence, problems``.

    Parts are read by place: root folder, year folder, week folder, vendor, client, deal; a path may begin
    with its year folder. Each part that can be read adds 0.2 to the confidence, and a vendor named in the
    deal adds 0.1. A null path has nothing.
    """
    parts = F.split(F.concat(F.lit("/"), F.ltrim(F.col(path), F.lit("/"))), "/")
    rooted = F.when(F.coalesce(F.get(parts, F.lit(1)), F.lit("")).rlike(_YEAR), F.concat(F.array(F.lit("")), parts)).otherwise(parts)
    df = df.withColumn("__parts", F.when(F.col(path).isNotNull(), rooted))
    part = lambda i: F.coalesce(F.get("__parts", F.lit(i)), F.lit(""))
    group = lambda i, rx, k: F.nullif(F.regexp_extract(part(i), rx, k), F.lit(""))
    week = r"(?i)week(\d+)-(\d{2})(\d{2})(\d{4})"
    size = F.coalesce(F.size("__parts"), F.lit(0))
    df = df.withColumns(
        {
            "year": group(2, _YEAR, 1),
            "week_number": group(3, week, 1).try_cast("int"),
            "week_date": F.nullif(F.concat_ws("/", group(3, week, 2), group(3, week, 3), group(3, week, 4)), F.lit("")),
            "vendor": F.nullif(company_name(part(4)), F.lit("")),
            "client": F.nullif(company_name(part(5)), F.lit("")),
            "deal_number": group(6, r"(?i)deal[_\-]?(\d+)", 1),
            "deal_name": F.when(part(6).rlike(r"(?i)deal[_\-]?\d+"), part(6)),
        }
    )
    read = ["year", "week_number", "vendor", "client", "deal_number"]
    agrees = F.lower("deal_name").contains(F.lower("vendor"))
    tenths = sum((F.when(F.col(c).isNotNull(), 2).otherwise(0) for c in read), F.when(agrees, 1).otherwise(0))
    problems = F.array_compact(
        F.array(
            F.when((size >= 3) & F.col("year").isNull(), "year"),
            F.when((size >= 4) & F.col("week_number").isNull(), "week"),
            F.when((size >= 7) & F.col("deal_number").isNull(), "deal"),
            F.when(~agrees, "vendor differs"),
        )
    )
    return df.withColumns({"confidence": tenths / 10.0, "problems": problems}).drop("__parts")


def path_warnings() -> Column:
    """Warnings over the columns of :func:`path_fields`: missing fields, low confidence, odd year or week."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in ("year", "vendor", "client")]))
    good_date = F.concat_ws("-", F.substring("week_date", 7, 4), F.substring("week_date", 1, 2), F.substring("week_date", 4, 2)).try_cast("date")
    return F.array_compact(
        F.array(
            F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))),
            F.when(F.col("week_date").isNotNull() & good_date.isNull(), "date"),
            F.when(F.col("confidence") < 0.5, "low confidence"),
            F.when(F.col("year").try_cast("int") < 2020, "unusual year"),
            F.when(~F.col("week_number").between(1, 53), "week number"),
        )
    )


def safe_name(value: Column, size: int = 120) -> Column:
    """A file name of safe characters only."""
    return F.left(F.regexp_replace(F.regexp_replace(F.trim(value), "[^a-zA-Z0-9._-]+", "_"), "^_+|_+$", ""), F.lit(size))
