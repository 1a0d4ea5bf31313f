"""Date text to epoch seconds and calendar years, by a fixed list of forms; naive times are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.nulls import NULL_LIKE, present

_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:[+-]\d{2}:\d{2})?)?$"
_US = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})(?: (\d{1,2}):(\d{1,2}))?$"


def _us_seconds(text: Column) -> Column:
    part = lambda i: F.regexp_extract(text, _US, i)
    short = part(3).try_cast("int")
    year = F.when(F.length(part(3)) == 4, short).otherwise(short + F.when(short < 69, 2000).otherwise(1900))
    day = F.format_string("%04d-%02d-%02d", year, part(1).try_cast("int"), part(2).try_cast("int")).try_cast("date")
    hour, minute = (F.coalesce(part(i).try_cast("int"), F.lit(0)) for i in (4, 5))
    return F.when(text.rlike(_US) & (hour < 24) & (minute < 60), F.unix_date(day).cast("long") * 86_400 + hour * 3_600 + minute * 60)


def epoch_seconds(value: Column) -> Column:
    """Seconds since 1970 of a date text; null where no form fits.

    ISO forms with or without time and offset (``Z``, ``+0000``), fractions dropped; then month/day/year with
    two or four year digits, with or without hour and minute.
    """
    text = F.trim(present(value, NULL_LIKE))
    plain = F.regexp_replace(text, r"\.\d+(Z|[+-]\d{2}:?\d{2})$", "$1")
    plain = F.regexp_replace(F.regexp_replace(plain, "Z$", "+00:00"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    plain = F.regexp_replace(plain, r"([T ]\d{2}:\d{2})($|[+-])", "$1:00$2")
    zoned = F.when(F.length(plain) == 10, F.concat(plain, F.lit(" 00:00:00+00:00"))).when(
        plain.rlike(r"[+-]\d{2}:\d{2}$"), plain
    ).otherwise(F.concat(plain, F.lit("+00:00")))
    iso = F.when(plain.rlike(_ISO), F.unix_seconds(zoned.try_cast("timestamp")))
    return F.coalesce(iso, _us_seconds(text))


def year_of(value: Column) -> Column:
    """Year of a date text by its first 19 characters, in the ISO forms only."""
    head = F.substring(value, 1, 19)
    whole = head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}:\d{1,2})?$")
    day = F.regexp_extract(head, r"^(\d{4}-\d{1,2}-\d{1,2})", 1).try_cast("date")
    return F.when(whole, F.year(day))
