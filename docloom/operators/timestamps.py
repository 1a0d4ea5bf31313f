"""Timestamps in mixed formats, precisions and zones, brought to one UTC instant.

Parsing is a column expression: a value is matched to one of a few shapes, rewritten to a field
list, and turned into microseconds since 1970; zone rules come from the JVM's zone tables. No Python runs on the rows.

Rows that declare no zone take the one that :func:`estimate_zones` finds for their source and month: local times are aligned
with the times they were taken in (or, where these are missing, with the sequence of the rows), and the history of
offsets with the least violations is chosen. Only counts by source, month and candidate are shuffled for it.

Defined results
* null, blank, missing spellings, vague words, impossible dates and unknown zone names give null;
* a zone or offset in the value wins, then the declared zone, then the estimated one, then UTC;
* a wall time that occurs twice is the earlier instant, a skipped one is read with the offset before;
* digits finer than a microsecond are cut off.
"""

from __future__ import annotations

import zoneinfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.nulls import is_missing
from docloom.session import hot_left_join

# Month names and their short forms (English, German, French, Spanish).
MONTHS = (
    ("january", "jan", "januar", "janvier", "janv", "enero", "ene", "jän", "jänner"),
    ("february", "feb", "februar", "février", "fevrier", "févr", "fev", "febrero"),
    ("march", "mar", "märz", "maerz", "mär", "mrz", "mars", "marzo"),
    ("april", "apr", "avril", "avr", "abril", "abr"),
    ("may", "mai", "mayo"),
    ("june", "jun", "juni", "juin", "junio"),
    ("july", "jul", "juli", "juillet", "juil", "julio"),
    ("august", "aug", "août", "aout", "agosto", "ago"),
    ("september", "sep", "sept", "septembre", "septiembre"),
    ("october", "oct", "oktober", "okt", "octobre", "octubre"),
    ("november", "nov", "novembre", "noviembre"),
    ("december", "dec", "dezember", "dez", "décembre", "decembre", "déc", "diciembre", "dic"),
)
# Zone abbreviations as minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "JST": 540, "AEST": 600, "AEDT": 660, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

_TIME = r"(?:(?:,? +| ?T ?)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?(?: ?(?:Uhr|h))?"
_HALF = r" ?((?i:[AP]\.?M\.?(?![A-Za-z]))?)"
_ZONE = r" ?((?:Z|[A-Za-z][A-Za-z0-9_+/-]+)?(?:(?<![A-Z])(?:UTC|GMT)?[+-]\d{2}(?::?\d{2})?)?(?:\[[^\]]+\])?)"
_DAY = r"(?:\p{L}{2,10}\.?,? )?"
_WORD = r"(\p{L}{3,10})"
# Each shape is rewritten to a mark and year|month|day|hour|minute|second|fraction|half|zone. The mark stands first and matches no
# other shape, so each value is tried once against each. Marks: N for two numbers in the order of the locale, W, D for digits.
_MARK = "\x01"
_SHAPES = (
    (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}|\d{{2}}){_TIME}{_HALF}{_ZONE}$", "N|$4|$1|$3|$5|$6|$7|$8|$9|$10"),
    (rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_TIME}{_HALF}{_ZONE}$", "W|$1|$3|$4|$5|$6|$7|$8|$9|$10"),
    (r"^(\d+)(?:\.(\d+))?$", "D|$1|$2"),
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?()" + _ZONE + "$", "W|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    (rf"^{_DAY}(\d{{1,2}})(?:st|nd|rd|th)?[. -] ?{_WORD}[.,]?[ -](\d{{4}}|\d{{2}}){_TIME}{_HALF}{_ZONE}$", "W|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (rf"^{_DAY}{_WORD}\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}}){_TIME}{_HALF}{_ZONE}$", "W|$3|$1|$2|$4|$5|$6|$7|$8|$9"),
)


def _zones(df: DataFrame) -> list[str]:
    """The regions that the JVM has rules for; any other name is an unknown zone."""
    try:
        known = df.sparkSession._jvm.java.time.ZoneId.getAvailableZoneIds()
    except Exception:  # no gateway to the JVM: what Python knows
        known = zoneinfo.available_timezones()
    return ["UTC", "GMT", *sorted(z for z in map(str, known) if "/" in z and not z.startswith("SystemV/"))]


def _month(word: Column) -> Column:
    names = F.create_map(*[F.lit(x) for number, forms in enumerate(MONTHS, 1) for name in forms for x in (name, number)])
    return F.coalesce(word.try_cast("int"), F.try_element_at(names, F.lower(word)))


def _to_utc(wall_us: Column, zone: Column) -> Column:
    """Wall-clock microseconds in a region to UTC; ``zone`` must be a known name or null."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall_us), zone))


def _wall(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, micro: Column) -> Column:
    date = F.format_string("%04d-%02d-%02d", year, month, day).try_cast("date")
    fine = (hour < 24) & (minute < 60) & (second < 60)
    return F.when(fine, F.unix_date(date).cast("long") * 86_400_000_000 + ((hour * 60 + minute) * 60 + second) * 1_000_000 + micro)


def _known(zone: Column, zones: list[str]) -> Column:
    return F.when(zone.isin(*zones), zone)


def _fields(value: Column) -> Column:
    """The parts of a value behind its mark, or null where it has no known shape."""
    shape = F.translate(value, _MARK, "")
    for pattern, order in _SHAPES:
        shape = F.regexp_replace(shape, pattern, _MARK + order)
    return F.split(shape, r"\|", 10)


def _written(part: Column, locale: Column) -> Column:
    """Wall time of a written date and time."""
    number = lambda i: F.coalesce(F.get(part, F.lit(i)).try_cast("int"), F.lit(0)).cast("long")
    swapped = (part[0] == _MARK + "N") & (F.coalesce(locale, F.lit("en_US")) != "en_US")
    month, day = F.when(swapped, part[3]).otherwise(part[2]), F.when(swapped, number(2)).otherwise(number(3))
    year = F.when(F.length(part[1]) == 2, number(1) + 2000).otherwise(number(1))
    half = F.upper(F.substring(part[8], 1, 1))
    hour = F.when(half == "", number(4)).when(number(4).between(1, 12), number(4) % 12 + F.when(half == "P", 12).otherwise(0))
    micro = F.rpad(F.substring(part[7], 1, 6), 6, "0").cast("long")
    return F.when(part[0] != _MARK + "D", _wall(year, _month(month), day, hour, number(5), number(6), micro))


def _counted(part: Column) -> Column:
    """Digits alone: a wall time (calendar dates, day serials) or an instant (epoch counts), by size."""
    digit = (part[1], part[2])
    size, zero = F.length(digit[0]), F.lit(0).cast("long")
    whole = digit[0].try_cast("long")
    fine = F.rpad(F.substring(digit[1], 1, 12), 12, "0").cast("long")
    piece = lambda at, n: F.substring(digit[0], at, n).cast("long")
    clock = (F.when(size >= 8 + at, piece(7 + at, 2)).otherwise(zero) for at in (2, 4, 6))
    calendar = F.when(
        size.isin(8, 12, 14) & piece(1, 4).between(1900, 2199) & (digit[1] == ""), _wall(piece(1, 4), piece(5, 2), piece(7, 2), *clock, zero)
    )
    serial = F.when(size == 5, (whole - 25_569) * 86_400_000_000 + F.floor(fine * 864 / 10_000))
    epoch = (
        F.when(size.between(9, 10), whole * 1_000_000 + F.floor(fine / 1_000_000))
        .when(size.between(11, 13), whole * 1_000 + F.floor(fine / 1_000_000_000))
        .when(size.between(14, 16), whole)
        .when(size.between(17, 19), F.substring(digit[0], 1, size - 3).cast("long"))
    )
    wall = F.coalesce(calendar, serial)
    return F.when(part[0] == _MARK + "D", F.struct(wall.alias("wall"), F.when(wall.isNull(), epoch).alias("instant")))


def _zone_of(label: Column, zones: list[str]) -> Column:
    """The offset in minutes or the region that a value itself names; null where it names none."""
    signed = r"([+-])(\d{2}):?(\d{2})?(?:\[.*)?$"
    minutes = F.regexp_extract(label, signed, 2).try_cast("int") * 60 + F.coalesce(F.regexp_extract(label, signed, 3).try_cast("int"), F.lit(0))
    offset = F.when(label.rlike(signed) & ~label.contains("Etc/"), F.when(F.regexp_extract(label, signed, 1) == "-", -minutes).otherwise(minutes))
    short = F.try_element_at(F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair]), F.upper(label))
    region = _known(F.regexp_extract(label, r"^\[?([A-Za-z0-9_+/-]+)\]?$", 1), zones)
    return F.when(label != "", F.struct(F.coalesce(offset, short).alias("offset"), region.alias("region")))


def _times(values: Column, zones: list[str]) -> Column:
    """From an array of structs ``field, value, locale`` to one of ``field, instant, wall``.

    A value that names its zone, or counts from 1970, gives an instant (microseconds); any other a wall time. The steps are
    array transforms in a row: each names its result once, so that no pattern is matched twice for a value.
    """
    step = F.transform(values, lambda x: F.struct(x["field"].alias("field"), x["locale"].alias("locale"), _fields(F.regexp_replace(F.trim(x["value"]), r"\s+", " ")).alias("p")))
    step = F.filter(step, lambda x: F.startswith(x["p"][0], F.lit(_MARK)))
    step = F.transform(
        step,
        lambda x: F.struct(
            x["field"].alias("field"), _written(x["p"], x["locale"]).alias("written"), _counted(x["p"]).alias("n"),
            F.when(x["p"][0] != _MARK + "D", _zone_of(x["p"][9], zones)).alias("z"),
        ),
    )
    step = F.transform(
        step,
        lambda x: F.struct(
            x["field"].alias("field"),
            F.when(x["z"]["offset"].isNotNull(), x["written"] - x["z"]["offset"].cast("long") * 60_000_000)
            .when(x["z"].isNotNull(), _to_utc(x["written"], x["z"]["region"]))
            .otherwise(x["n"]["instant"])
            .alias("instant"),
            F.when(x["z"].isNull(), F.coalesce(x["written"], x["n"]["wall"])).alias("wall"),
        ),
    )
    return F.filter(step, lambda x: x["instant"].isNotNull() | x["wall"].isNotNull())


def _parsed(df: DataFrame, columns: list[str], locale: str | None) -> Column:
    said = F.col(locale) if locale else F.lit(None).cast("string")
    values = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), said.alias("locale")) for c in columns])
    return _times(F.filter(values, lambda x: ~is_missing(x["value"])), _zones(df))


def to_instants(
    df: DataFrame, columns: list[str], key: str, zone: str | None = None, locale: str | None = None, ingested: str | None = None, sequence: str | None = None,
    fallback: str = "UTC", estimate: bool = True, group: str | None = None,
) -> DataFrame:
    """Long form: one row ``field, record_id, epoch_us`` for each value that is a possible instant.

    ``zone`` and ``locale`` name the columns with the declared zone and locale of a row (null: none). Local times of rows that
    declare no zone are read in the zone that :func:`estimate_zones` finds for their field, locale and ``group`` from ``ingested`` and ``sequence``,
    which is ``fallback`` unless the data say otherwise; with ``estimate`` off, or no ``ingested``, in ``fallback``. Rows whose key is
    null keep a null ``record_id``; repeated rows stay repeated. An empty table gives an empty result.
    """
    none = F.lit(None).cast("string")
    zones = _zones(df)
    declared = F.coalesce(F.col(zone), none) if zone else none
    seen = F.col(ingested).cast("timestamp") if ingested else F.lit(None).cast("timestamp")
    rows = df.select(
        F.col(key).cast("string").alias("record_id"), declared.alias("declared"), (F.col(locale) if locale else none).alias("locale"), F.date_format(seen, "yyyy-MM").alias("month"), (F.col(group).cast("string") if group else none).alias("group"), F.explode(_parsed(df, columns, locale)).alias("t"),
    )
    used = F.coalesce("declared", F.lit(fallback))
    if estimate and ingested:
        undeclared = df.where(F.col(zone).isNull()) if zone else df
        histories = estimate_zones(undeclared, columns, ingested, locale, sequence, fallback, group=group)
        # A row for each field, locale and month that has evidence for another zone than the fallback.
        told = histories.where(F.col("zone") != fallback).select(F.col("source").alias("_source"), F.col("month").alias("_month"), F.col("zone").alias("_zone"))
        rows = rows.withColumn("_source", F.when(F.col("declared").isNull(), source_of(F.col("t.field"), F.col("locale"), F.col("group")))).withColumn("_month", F.coalesce("month", F.lit("")))
        rows = hot_left_join(rows, told, ["_source", "_month"], F.xxhash64("record_id"))
        used = F.coalesce("declared", "_zone", F.lit(fallback))
    epoch = F.coalesce("t.instant", _to_utc(F.col("t.wall"), _known(used, zones)))
    return rows.select(F.col("t.field").alias("field"), "record_id", epoch.alias("epoch_us")).where("epoch_us is not null")


def source_of(field: Column, locale: Column, group: Column) -> Column:
    """Rows of one field, locale and group come from one source."""
    return F.concat_ws("/", field, F.coalesce(locale, F.lit("")), F.coalesce(group, F.lit("")))


# Documented choices of the estimate. Hours that offsets can span: a time further from its ingestion lies on one side of it in every
# zone. What a change of zone within a source costs, in violations. Evidence against the fallback: so many violations less, and so
# many deviations; and a share of violations that the zone found may have. Rows of a sequence whose ingestion times stand for each other.
SPAN_HOURS = 26
CHANGE_COST = 4.0
LEAST_GAIN, DEVIATIONS, MOST_VIOLATIONS = 5.0, 1.0, 0.05
SEQUENCE_BLOCK = 1_000
CANDIDATE_ZONES = (
    "UTC", "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Sao_Paulo", "Europe/London",
    "Europe/Berlin", "Europe/Istanbul", "Asia/Dubai", "Asia/Kolkata", "Asia/Singapore", "Asia/Tokyo", "Australia/Sydney",
    "Pacific/Auckland",
)


def _history(cost: np.ndarray, change: float) -> list[int]:
    """The cheapest sequence of zones over the months (rows of ``cost``), a change costing ``change``."""
    total, back = cost[0].copy(), []
    for row in cost[1:]:
        stay, best = total, int(total.argmin())
        moved = stay > total[best] + change
        back.append(np.where(moved, best, np.arange(len(row))))
        total = np.where(moved, total[best] + change, stay) + row
    path = [int(total.argmin())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def _chosen(candidates: tuple[str, ...]):
    def each(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """The history of one source: at most a row for each month and candidate comes in."""
        table = lambda c: pdf.pivot_table(index="month", columns="rank", values=c, aggfunc="sum", fill_value=0).reindex(columns=range(len(candidates)), fill_value=0).sort_index()
        cost, bad, near, rows = (table(c) for c in ("cost", "violations", "near", "n_rows"))
        found = _history(cost.to_numpy(), CHANGE_COST)
        # Month by month the history that was found stands against the fallback only where the evidence is clear, over all months of one zone.
        zones = np.array(found)
        for zone in set(found) - {0}:
            own = zones == zone
            gain = float(cost.to_numpy()[own, 0].sum() - cost.to_numpy()[own, zone].sum())
            seen = float(near.to_numpy()[own, zone].sum())
            if gain < LEAST_GAIN + DEVIATIONS * np.sqrt(seen) or bad.to_numpy()[own, zone].sum() > MOST_VIOLATIONS * seen:
                zones[own] = 0
        at = np.arange(len(zones))
        out = pd.DataFrame({"source": key[0], "month": cost.index, "zone": [candidates[z] for z in zones], "violations": bad.to_numpy()[at, zones].astype(np.int64), "n_rows": rows.to_numpy()[:, 0].astype(np.int64)})
        if "" in cost.index:
            return out
        # Rows whose ingestion is unknown are read in the zone of most others.
        most = out.groupby("zone")["n_rows"].sum().idxmax()
        return pd.concat([out, pd.DataFrame({"source": [key[0]], "month": [""], "zone": [most], "violations": [0], "n_rows": [0]})])

    return each


def estimate_zones(
    df: DataFrame, columns: list[str], ingested: str, locale: str | None = None, sequence: str | None = None, fallback: str = "UTC", candidates: tuple[str, ...] = CANDIDATE_ZONES, group: str | None = None
) -> DataFrame:
    """The history of zones that explains best the local times of each source: ``source, month, zone, violations, n_rows``.

    A local time cannot lie after its ingestion, and lies the nearer to it the better. For each source (field, locale, ``group``), month
    of ingestion and candidate zone the times after their ingestion are counted, and the delays of the others added; the sequence of
    zones over the months with the least cost wins, in which a change of zone costs some violations. Times further from their
    ingestion than offsets span lie on the same side of it in every zone: they cost the same in all. Without
    clear evidence the zone is ``fallback``: every source has an answer.

    Rows without an ingestion time take the earliest one of the next ``SEQUENCE_BLOCK`` rows in ``sequence``, as those were taken in later;
    rows that have neither take no part; month ``''`` is the answer for rows without an ingestion time. Values with a zone of their own and epoch counts say nothing and are left out.
    Counts are made before the shuffle, so a hot source costs no more than others.
    """
    order = (fallback, *(z for z in candidates if z != fallback))
    none = F.lit(None)
    seen = F.unix_micros(F.col(ingested).cast("timestamp"))
    place = F.floor(F.col(sequence) / SEQUENCE_BLOCK).cast("long") if sequence else none.cast("long")
    rows = df.select(seen.alias("seen"), place.alias("block"), (F.col(locale) if locale else none.cast("string")).alias("locale"), (F.col(group).cast("string") if group else none.cast("string")).alias("group"), F.explode(_parsed(df, columns, locale)).alias("t"))
    local = rows.where("t.wall is not null").select(source_of(F.col("t.field"), F.col("locale"), F.col("group")).alias("source"), "seen", "block", F.col("t.wall").alias("wall"))
    if sequence:
        following = df.where(F.col(ingested).isNotNull()).select((place - 1).alias("block"), seen.alias("next")).groupBy("block").agg(F.min("next").alias("next"))
        known, lost = local.where("seen is not null").drop("block"), local.where("seen is null")
        local = known.unionByName(hot_left_join(lost, following, ["block"], F.xxhash64("wall")).select("source", F.col("next").alias("seen"), "wall"))
    month = F.coalesce(F.date_format(F.timestamp_micros("seen"), "yyyy-MM"), F.lit(""))
    tried = local.select("source", month.alias("month"), "wall", "seen", F.posexplode(F.array(*[F.lit(z) for z in order])).alias("rank", "zone"))
    delay = (F.col("seen") - _to_utc(F.col("wall"), F.col("zone"))) / 3_600_000_000
    near = F.abs("delay") <= SPAN_HOURS
    # Every row counts in every zone, a long delay as half a violation: else a zone would gain by moving rows out of reach.
    cost = F.when(F.col("delay") < 0, 1.0).otherwise(F.least(F.col("delay") / (2 * SPAN_HOURS), F.lit(0.5)))
    scored = tried.withColumn("delay", delay).groupBy("source", "month", "rank").agg(
        F.sum(cost).alias("cost"), F.count_if(near & (F.col("delay") < 0)).alias("violations"), F.count_if(near).alias("near"), F.count("*").alias("n_rows")
    )
    return scored.groupBy("source").applyInPandas(_chosen(order), "source string, month string, zone string, violations bigint, n_rows bigint")
