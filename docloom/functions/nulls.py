"""Missing-value rules: which spellings stand for "no value"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing value, compared trimmed and in lower case.
MISSING = ("", "none", "nan", "null", "n/a")
NULL_LIKE = ("", "none", "nan", "null")
AUDIT_EMPTY = ("", "none", "nan", "null", "undefined", "n/a")


def is_missing(value: Column, spellings: tuple[str, ...] = MISSING) -> Column:
    """True for null and for every spelling of a missing value; never null itself."""
    return value.isNull() | F.lower(F.trim(value)).isin(*spellings)


def present(value: Column, spellings: tuple[str, ...] = MISSING) -> Column:
    """The value itself, or null where it is missing."""
    return F.when(~is_missing(value, spellings), value)


def clean_text(value: Column, default: str = "") -> Column:
    """Trimmed text; the default for null-like spellings."""
    return F.when(is_missing(value, NULL_LIKE), F.lit(default)).otherwise(F.trim(value))


def clean_number(value: Column) -> Column:
    """A double; 0.0 for null, NaN and what cannot be read as a number."""
    number = F.expr("NULL").cast("double") if value is None else value.try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(0.0))


def is_true(value: Column, also: tuple[str, ...] = ("true", "1", "yes")) -> Column:
    """Boolean flags kept as text; anything unlisted, null included, is false."""
    return F.coalesce(F.lower(F.trim(value)).isin(*also), F.lit(False))


def money(value: Column) -> Column:
    """Amount text to double: null-like and the text '0' are null, separators and signs of money ignored."""
    bare = F.regexp_replace(F.trim(value), "[$,\\s]", "")
    return F.when(is_missing(value) | (bare == "0"), F.lit(None).cast("double")).otherwise(bare.try_cast("double"))


def populated_strict(value: Column, kind: str) -> Column:
    """Coverage rule: null, blank, null-like text, zero and false count as not populated."""
    if kind == "string":
        return ~is_missing(value, NULL_LIKE)
    if kind == "boolean":
        return F.coalesce(value, F.lit(False))
    if kind in ("double", "float"):
        return F.coalesce(~F.isnan(value) & (value != 0), F.lit(False))
    return F.coalesce(value != 0, F.lit(False))


def populated_loose(value: Column, kind: str) -> Column:
    """Result-set rule: only null and blank text count as not populated."""
    if kind == "string":
        return F.coalesce(F.trim(value) != "", F.lit(False))
    return value.isNotNull()
