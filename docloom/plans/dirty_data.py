"""Queries over the general data problems: timestamps (1) and orphan references (3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.nulls import is_true
from docloom.operators.orphans import OrphanState, parent_rows, reference_rows
from docloom.operators.timestamps import ABBREVIATIONS, MONTHS, estimate_zones, to_instants
from docloom.plans.data import table
from docloom.session import spread


DATES = ["deal_start_date", "contract_start", "contract_end"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    taken = ["source_tz", "source_locale"]
    results = spread(table(spark, d, "search_results").select("id", *DATES, *taken, "indexed_at", "load_seq"))
    files = spread(table(spark, d, "catalog_files").select("salesforce_content_version_id", "modified_time", *taken, "discovered_at", "load_seq"))
    rows = to_instants(results, DATES, "id", *taken, "indexed_at", "load_seq").unionByName(
        to_instants(files, ["modified_time"], "salesforce_content_version_id", *taken, "discovered_at", "load_seq")
    )
    return rows.distinct()


def p1_zone_estimates(spark: SparkSession, d: str) -> DataFrame:
    """The zones by source and month of the rows that declare none, over all four fields."""
    results, files = (table(spark, d, name).where("source_tz is null") for name in ("search_results", "catalog_files"))
    return estimate_zones(results, DATES, "indexed_at", "source_locale", "load_seq").unionByName(estimate_zones(files, ["modified_time"], "discovered_at", "source_locale", "load_seq"))


REFERENCES = {
    "deal_id": ("deals", ("",)),
    "client_id": ("clients", ("Unknown Client", "Unknown Vendor")),
    "vendor_id": ("vendors", ("Unknown Client", "Unknown Vendor")),
}


#: Periods that the tables are brought in by.
BATCHES = 3


def orphan_state(spark: SparkSession, d: str, batches: int = BATCHES) -> OrphanState:
    """The orphan state after batches in order of time, as a feed would bring them: each a period of ``indexed_at``.

    A period is bounded by times, so its rows are filtered in the scans; rows without a time come first.
    """
    gone = is_true(F.col("is_deleted"))
    results = table(spark, d, "search_results")
    ends = results.agg(F.min("indexed_at").cast("double").alias("a"), F.max("indexed_at").cast("double").alias("b")).first()
    first, last = ends["a"] or 0.0, ends["b"] or 0.0
    limits = [first + (last - first) * k / batches for k in range(1, batches)]

    def period(df: DataFrame, at: str, k: int) -> DataFrame:
        low, high = (F.lit(x).cast("timestamp") for x in (limits[max(0, k - 1)] if limits else 0, limits[min(k, batches - 2)] if limits else 0))
        if batches == 1:
            return df
        if k == 0:
            return df.where((F.col(at) < high) | F.col(at).isNull())
        return df.where(F.col(at) >= low) if k == batches - 1 else df.where((F.col(at) >= low) & (F.col(at) < high))

    deals, clients, vendors = (table(spark, d, name) for name in ("deals", "client_registry", "vendor_mapping"))
    state = OrphanState.empty(spark)
    for k in range(batches):
        parents = (
            parent_rows(period(deals, "exported_at", k), "deals", "id", "exported_at", gone, F.col("load_seq"), "name")
            .unionByName(parent_rows(period(clients, "arrived_at", k), "clients", "salesforce_client_id", "arrived_at", gone))
            .unionByName(parent_rows(period(vendors, "arrived_at", k), "vendors", "id", "arrived_at", gone))
        )
        state = state.advance(parents, reference_rows(period(results, "indexed_at", k), "id", "indexed_at", REFERENCES))
    return state


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return orphan_state(spark, d).orphans().select("id", "ref_table").distinct()


def p3_monthly(spark: SparkSession, d: str) -> DataFrame:
    return orphan_state(spark, d).snapshot()


QUERIES = {f.__name__: f for f in (p1_found, p1_zone_estimates, p3_found, p3_monthly)}

_MISSING = "('', 'none', 'nan', 'null', 'n/a')"
_STATES = f"""
WITH refs AS (
  SELECT id, ref_table, trim(ref) AS ref, indexed_at FROM (
    SELECT id, 'deals' AS ref_table, deal_id AS ref, indexed_at FROM search_results
    UNION ALL SELECT id, 'clients', client_id, indexed_at FROM search_results
    UNION ALL SELECT id, 'vendors', vendor_id, indexed_at FROM search_results)
  WHERE ref IS NOT NULL AND lower(trim(ref)) NOT IN {_MISSING}
    AND NOT (ref_table <> 'deals' AND trim(ref) IN ('Unknown Client', 'Unknown Vendor'))),
firsts AS (SELECT id, min(indexed_at) AS first_ref FROM search_results GROUP BY ALL),
each AS (SELECT DISTINCT r.id, r.ref_table, r.ref, f.first_ref FROM refs r JOIN firsts f ON r.id IS NOT DISTINCT FROM f.id),
parents AS (
  SELECT 'deals' AS ref_table, id AS pid, name, NULL AS prefix, min(exported_at) AS first_seen,
         coalesce(lower(trim(max_by(coalesce(is_deleted, ''), struct_pack(a := exported_at, b := load_seq)))) IN ('true', '1', 'yes'), false) AS deleted
  FROM deals GROUP BY id, name
  UNION ALL
  SELECT 'clients', salesforce_client_id, NULL, 'Client-', min(arrived_at),
         bool_or(coalesce(lower(trim(is_deleted)) IN ('true', '1', 'yes'), false)) FROM client_registry GROUP BY 2
  UNION ALL
  SELECT 'vendors', id, NULL, 'Vendor-', min(arrived_at),
         bool_or(coalesce(lower(trim(is_deleted)) IN ('true', '1', 'yes'), false)) FROM vendor_mapping GROUP BY 2),
spelled AS (
  SELECT ref_table, ref, min(struct_pack(deleted := deleted, first_seen := first_seen)) AS p FROM (
    SELECT *, unnest([pid, substr(pid, 1, 15), name, prefix || right(pid, 8)]) AS ref FROM parents)
  WHERE ref IS NOT NULL GROUP BY ALL),
states AS (
  SELECT e.*, CASE WHEN s.p IS NULL THEN 'absent' WHEN s.p.deleted THEN 'deleted'
                   WHEN s.p.first_seen > e.first_ref THEN 'late' ELSE 'ok' END AS state
  FROM each e LEFT JOIN spelled s ON s.ref_table = e.ref_table AND s.ref = e.ref)
"""
# Timestamps in SQL: each shape in named parts, months and zone names as tables, wall times turned by the engine's own zone rules. Of a
# wall time that occurs twice the engine takes the later instant; an hour earlier is looked at for that. Zones are declared or UTC.
_TIME = r"(?:(?:,? +| ?T ?)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?(?: ?(?:Uhr|h))?"
_TAIL = _TIME + r" ?((?:[AaPp]\.?[Mm]\b\.?)?) ?((?:Z|[A-Za-z][A-Za-z0-9_/]*)?(?:[+-]\d{2}(?::?\d{2})?)?(?:\[[^\]]+\])?)$"
_CLOCK = ("h", "mi", "s", "f", "half", "zone")
_FORMS = (
    ("n", r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})" + _TAIL, ("a", "b", "y", *_CLOCK)),
    ("w", r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TAIL, ("y", "a", "b", *_CLOCK)),
    ("w", r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?() ?((?:Z|[A-Za-z][A-Za-z0-9_/]*)?(?:[+-]\d{2}(?::?\d{2})?)?)$", ("y", "a", "b", *_CLOCK)),
    ("w", r"^(?:\p{L}{2,10}\.?,? )?(\d{1,2})(?:st|nd|rd|th)?[. -] ?(\p{L}{3,10})[.,]?[ -](\d{4}|\d{2})" + _TAIL, ("b", "a", "y", *_CLOCK)),
    ("w", r"^(?:\p{L}{2,10}\.?,? )?(\p{L}{3,10})\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})" + _TAIL, ("a", "b", "y", *_CLOCK)),
)


def _sql_list(items) -> str:
    return ", ".join("(" + ", ".join("'" + x + "'" if isinstance(x, str) else str(x) for x in row) + ")" for row in items)


def _form(number: int, kind: str, pattern: str, names: tuple[str, ...]) -> str:
    part = {n: f"x[{i + 1}]" for i, n in enumerate(names)}
    groups = ", ".join(f"regexp_extract(v, '{pattern}', {i + 1})" for i in range(len(names)))
    a, b = (f"CASE WHEN loc = 'en_US' THEN {part['a']} ELSE {part['b']} END", f"CASE WHEN loc = 'en_US' THEN {part['b']} ELSE {part['a']} END") if kind == "n" else (part["a"], part["b"])
    return f"SELECT {number} AS form, field, rid, tz, {part['y']} AS y, {a} AS mo, {b} AS d, " + ", ".join(f"{part[n]} AS {n}" for n in _CLOCK) + f" FROM (SELECT *, [{groups}] AS x FROM v WHERE regexp_matches(v, '{pattern}'))"


_WALLS = f"""
WITH r AS (
  SELECT field, rid, value, source_tz AS tz, coalesce(source_locale, 'en_US') AS loc FROM (
    SELECT id AS rid, source_tz, source_locale, unnest(['deal_start_date', 'contract_start', 'contract_end']) AS field, unnest([deal_start_date, contract_start, contract_end]) AS value FROM search_results
    UNION ALL SELECT salesforce_content_version_id, source_tz, source_locale, 'modified_time', modified_time FROM catalog_files)),
v AS (SELECT field, rid, tz, loc, regexp_replace(trim(value), '\\s+', ' ', 'g') AS v FROM r WHERE value IS NOT NULL AND lower(trim(value)) NOT IN {_MISSING}),
months AS (SELECT * FROM (VALUES {_sql_list((w, n) for n, forms in enumerate(MONTHS, 1) for w in forms)}) AS t(word, number)),
short AS (SELECT * FROM (VALUES {_sql_list(ABBREVIATIONS.items())}) AS t(name, minutes)),
every AS ({" UNION ALL ".join(_form(i, *f) for i, f in enumerate(_FORMS))}),
first AS (SELECT * FROM every QUALIFY rank() OVER (PARTITION BY field, rid, tz, y, mo, d, h, mi, s, f, half, zone ORDER BY form) = 1),
parts AS (SELECT field, rid, tz, zone, try_cast(y AS INT) + CASE WHEN length(y) = 2 THEN 2000 ELSE 0 END AS y, coalesce(try_cast(mo AS INT), number) AS mo, try_cast(d AS INT) AS d, coalesce(try_cast(h AS INT), 0) AS h,
  coalesce(try_cast(mi AS INT), 0) AS mi, coalesce(try_cast(s AS INT), 0) AS s, try_cast(rpad(left(f, 6), 6, '0') AS BIGINT) AS us, upper(left(half, 1)) AS half FROM first LEFT JOIN months ON word = lower(mo)),
written AS (SELECT field, rid, tz, zone, try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', y, mo, d) AS DATE) AS day, CASE WHEN half = '' THEN h WHEN h BETWEEN 1 AND 12 THEN h % 12 + CASE half WHEN 'P' THEN 12 ELSE 0 END END AS h, mi, s, coalesce(us, 0) AS us FROM parts),
digits AS (SELECT field, rid, tz, regexp_extract(v, '^(\\d+)', 1) AS n, regexp_extract(v, '\\.(\\d+)$', 1) AS f FROM v WHERE regexp_matches(v, '^\\d+(\\.\\d+)?$')),
calendar AS (SELECT *, CASE WHEN f = '' AND length(n) IN (8, 12, 14) AND left(n, 4)::INT BETWEEN 1900 AND 2199 THEN try_cast(left(n, 4) || '-' || substr(n, 5, 2) || '-' || substr(n, 7, 2) AS DATE) END AS day,
  coalesce(try_cast(substr(n, 9, 2) AS INT), 0) AS h, coalesce(try_cast(substr(n, 11, 2) AS INT), 0) AS mi, coalesce(try_cast(substr(n, 13, 2) AS INT), 0) AS s FROM digits),
walls AS (
  SELECT field, rid, tz, zone, day + to_microseconds(((h * 60 + mi) * 60 + s)::BIGINT * 1000000 + us) AS wall FROM written WHERE day IS NOT NULL AND h < 24 AND mi < 60 AND s < 60
  UNION ALL SELECT field, rid, tz, '', day + to_microseconds(((h * 60 + mi) * 60 + s)::BIGINT * 1000000) FROM calendar WHERE day IS NOT NULL AND h < 24 AND mi < 60 AND s < 60
  UNION ALL SELECT field, rid, tz, '', TIMESTAMP '1899-12-30' + to_microseconds(n::BIGINT * 86400000000 + floor(coalesce(try_cast(rpad(left(f, 12), 12, '0') AS BIGINT), 0) * 864 / 10000)::BIGINT) FROM digits WHERE length(n) = 5),
zones AS (SELECT *, regexp_extract(zone, '([+-])(\\d{{2}}):?(\\d{{2}})?(\\[.*)?$', 1) AS sign, regexp_extract(zone, '([+-])(\\d{{2}}):?(\\d{{2}})?(\\[.*)?$', 2) AS zh, regexp_extract(zone, '([+-])(\\d{{2}}):?(\\d{{2}})?(\\[.*)?$', 3) AS zm,
  regexp_extract(zone, '^\\[?([A-Za-z0-9_+/-]+)\\]?$', 1) AS named, minutes FROM walls LEFT JOIN short ON name = upper(zone)),
offsets AS (SELECT field, rid, wall, CASE WHEN sign <> '' AND NOT contains(zone, 'Etc/') THEN (CASE sign WHEN '-' THEN -1 ELSE 1 END) * (zh::INT * 60 + coalesce(try_cast(zm AS INT), 0)) ELSE minutes END AS off, CASE WHEN zone <> '' THEN named ELSE coalesce(tz, 'UTC') END AS region FROM zones),
known AS (SELECT name FROM pg_timezone_names() WHERE contains(name, '/') OR name IN ('UTC', 'GMT')),
instants AS (
  SELECT field, rid, epoch_us(wall) - off::BIGINT * 60000000 AS us FROM offsets WHERE off IS NOT NULL
  UNION ALL SELECT field, rid, epoch_us(CASE WHEN timezone(name, timezone(name, wall) - INTERVAL 1 HOUR) = wall THEN timezone(name, wall) - INTERVAL 1 HOUR ELSE timezone(name, wall) END) FROM offsets JOIN known ON name = region WHERE off IS NULL
  UNION ALL SELECT field, rid, CASE WHEN length(n) <= 10 THEN n::BIGINT * 1000000 + coalesce(try_cast(rpad(left(f, 6), 6, '0') AS BIGINT), 0) WHEN length(n) <= 13 THEN n::BIGINT * 1000 + coalesce(try_cast(rpad(left(f, 3), 3, '0') AS BIGINT), 0)
    WHEN length(n) <= 16 THEN n::BIGINT ELSE left(n, length(n) - 3)::BIGINT END FROM calendar WHERE day IS NULL AND length(n) BETWEEN 9 AND 19)
"""
ORACLE = {
    "p1_found": _WALLS + "SELECT DISTINCT field, rid AS record_id, us::BIGINT AS epoch_us FROM instants WHERE us IS NOT NULL",
    "p3_found": _STATES + "SELECT DISTINCT id, ref_table FROM states WHERE state <> 'ok'",
    "p3_monthly": _STATES + "SELECT ref_table, strftime(first_ref, '%Y-%m') AS month, state, count(*) AS n_refs FROM states GROUP BY ALL",
}
