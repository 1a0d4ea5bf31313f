import datetime as dt
import random
import zoneinfo

import pytest

from docloom.operators.timestamps import estimate_zones, to_instants

CASES = [
    # value, zone, locale, expected (UTC, or None)
    ("2021-03-04T05:06:07.123456789Z", None, None, "2021-03-04 05:06:07.123456"),
    ("2021-03-04 05:06", "America/New_York", None, "2021-03-04 10:06:00"),
    ("2021-03-04T05:06:07+0530", "America/New_York", None, "2021-03-03 23:36:07"),
    ("2024-01-25T18:10+05:30[Asia/Kolkata]", "UTC", None, "2024-01-25 12:40:00"),
    ("2024-03-10 02:06:04 America/New_York", None, None, "2024-03-10 07:06:04"),
    ("2021-10-31 02:30:00", "Europe/Berlin", "de_DE", "2021-10-31 00:30:00"),
    ("2021-03-28 02:30:00", "Europe/Berlin", "de_DE", "2021-03-28 01:30:00"),
    ("03/04/2021", None, "en_US", "2021-03-04 00:00:00"),
    ("03/04/2021", None, "en_GB", "2021-04-03 00:00:00"),
    ("03/04/21 17:05", None, None, "2021-03-04 17:05:00"),
    ("1/29/2019 8:56 PM", None, "en_US", "2019-01-29 20:56:00"),
    ("12/29/2019 12:05 AM", None, "en_US", "2019-12-29 00:05:00"),
    ("Nov 6, 2022 1:54 AM EDT", None, None, "2022-11-06 05:54:00"),
    ("15. März 2021, 05:44 Uhr", "Europe/Berlin", "de_DE", "2021-03-15 04:44:00"),
    ("Sun, 12 Mar 2023 01:25:18 -0500", None, None, "2023-03-12 06:25:18"),
    ("19-Oct-25", None, None, "2025-10-19 00:00:00"),
    ("20220622T172107Z", None, None, "2022-06-22 17:21:07"),
    ("20200802", "America/New_York", None, "2020-08-02 04:00:00"),
    ("43780.75", "America/Chicago", None, "2019-11-12 00:00:00"),
    ("1591376257", "America/Chicago", None, "2020-06-05 16:57:37"),
    ("1720788988756", None, None, "2024-07-12 12:56:28.756000"),
    ("2023-02-30", None, None, None),
    ("13/13/2022", None, "en_US", None),
    ("0000-00-00", None, None, None),
    ("25:00", None, None, None),
    ("mid-2024", None, None, None),
    ("TBD", None, None, None),
    (" N/A ", None, None, None),
    ("", None, None, None),
    (None, "UTC", None, None),
    ("2021-03-04 05:06", "Nowhere/Land", None, None),
    ("2021-03-04 05:06 Nowhere/Land", None, None, None),
    ("x" * 100_000, None, None, None),
]


def test_values(spark):
    rows = [(str(i), v, z, loc) for i, (v, z, loc, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id string, v string, tz string, loc string")
    got = {int(r.record_id): r.epoch_us for r in to_instants(df, ["v"], "id", "tz", "loc").collect()}
    epoch = dt.datetime(1970, 1, 1)
    for i, (value, _, _, want) in enumerate(CASES):
        expected = None
        if want:
            expected = (dt.datetime.fromisoformat(want) - epoch) // dt.timedelta(microseconds=1)
        assert got.get(i) == expected, value


def test_session_zone_does_not_matter(spark):
    df = spark.createDataFrame([("1", "2021-07-01 12:00", "Europe/London")], "id string, v string, tz string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert to_instants(df, ["v"], "id", "tz").first().epoch_us == 1_625_137_200_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_nulls_and_other_columns(spark):
    empty = spark.createDataFrame([], "id string, v string, field string, epoch_us long")
    assert to_instants(empty, ["v"], "id").count() == 0
    df = spark.createDataFrame([(None, "2021-01-01", "x", 5), (None, "2021-01-01", "x", 5)], "id string, v string, field string, epoch_us long")
    assert [(r.field, r.record_id) for r in to_instants(df, ["v"], "id").collect()] == [("v", None)] * 2


UTC = dt.timezone.utc


def logged(zones, n=300, every=29, lag=lambda k: k % 7):
    """Local times logged shortly before their ingestion, in the zones of a history of equal parts: source, value, ingestion, sequence, instant."""
    rows = []
    for k in range(n):
        seen = dt.datetime(2022, 1, 1, tzinfo=UTC) + dt.timedelta(hours=every * k)
        true = seen - dt.timedelta(minutes=lag(k))
        local = true.astimezone(zoneinfo.ZoneInfo(zones[k * len(zones) // n]))
        rows.append((f"r{k}", local.strftime("%Y-%m-%d %H:%M:%S"), seen, k, int(true.timestamp() * 1_000_000)))
    return rows


SCHEMA = "id string, v string, seen timestamp, seq long, want long"


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Europe/Berlin", "UTC"])
def test_undeclared_times_are_read_in_the_estimated_zone(spark, zone):
    rows = logged([zone]) + [("z", "2022-01-01T00:00:00Z", None, 5, 1_640_995_200_000_000)]
    df = spark.createDataFrame(rows + [("n", None, None, None, None), ("t", "TBD", rows[0][2], 1, None)], SCHEMA)
    found = estimate_zones(df, ["v"], "seen").collect()
    assert {r.zone for r in found} == {zone} and sum(r.violations for r in found) == 0 and sum(r.n_rows for r in found) == 300
    got = {r.record_id: r.epoch_us for r in to_instants(df, ["v"], "id", ingested="seen").collect()}
    # A wall time that occurs twice means the earlier instant, which here may be the wrong one.
    assert len(got) == len(rows) and sum(got[r[0]] != r[4] for r in rows) <= 1
    assert estimate_zones(df.limit(0), ["v"], "seen").count() == 0 and to_instants(df.limit(0), ["v"], "id", ingested="seen").count() == 0


def test_a_source_that_moves(spark):
    rows = logged(["Asia/Tokyo", "America/Chicago"], n=600)
    df = spark.createDataFrame([(f"{g}{r[0]}", *r[1:], g) for g, part in (("a", rows), ("b", logged(["Europe/London"]))) for r in part], SCHEMA + ", g string")
    found = estimate_zones(df, ["v"], "seen", group="g").collect()
    zones = {}
    for r in sorted(found, key=lambda r: r.month):
        if r.month:
            zones.setdefault(r.source, []).append(r.zone)
    assert set(zones["v//b"]) == {"Europe/London"} and list(dict.fromkeys(zones["v//a"])) == ["Asia/Tokyo", "America/Chicago"]
    got = {r.record_id: r.epoch_us for r in to_instants(df, ["v"], "id", ingested="seen", group="g").collect()}
    wrong = sum(got["a" + r[0]] != r[4] for r in rows)
    assert wrong <= 25  # the month of the move is read in one zone


def test_declared_zones_and_lack_of_evidence(spark):
    far = logged(["Asia/Tokyo"], lag=lambda k: 60 * (k * 7919 % 9_000 - 4_500))  # as many hours after as before
    few = logged(["Asia/Tokyo"], n=3)
    for rows in (far, few):
        got = to_instants(spark.createDataFrame(rows, SCHEMA), ["v"], "id", ingested="seen").collect()
        assert {r.epoch_us - 9 * 3_600_000_000 for r in got} == {r[4] for r in rows}
    told = spark.createDataFrame([(*r, "America/Denver") for r in logged(["America/Denver"])] + [(f"u{r[0]}", *r[1:], None) for r in logged(["Asia/Tokyo"])], SCHEMA + ", tz string")
    assert all(r.epoch_us == r.want for r in to_instants(told, ["v"], "id", "tz", ingested="seen").join(told.withColumnRenamed("id", "record_id"), "record_id").collect())


def test_sequence_stands_for_ingestion(spark, monkeypatch):
    monkeypatch.setattr("docloom.operators.timestamps.SEQUENCE_BLOCK", 10)
    rows = logged(["America/New_York"], every=0.05)
    df = spark.createDataFrame([(i, v, seen if k % 10 == 2 else None, k, want) for i, v, seen, k, want in rows], SCHEMA)
    got = {r.record_id: r.epoch_us for r in to_instants(df, ["v"], "id", ingested="seen", sequence="seq").collect()}
    assert got == {r[0]: r[4] for r in rows}


@pytest.mark.parametrize("hours", [lambda r: r.uniform(-72, 72), lambda r: r.gauss(0, 12), lambda r: r.uniform(0, 120), lambda r: -r.uniform(0, 120), lambda r: -r.uniform(0, 17_520)])
def test_times_that_tell_nothing_stay_in_the_fallback(spark, hours):
    """Times around, after or long before their ingestion, in UTC: no source may be read in another zone."""
    rng = random.Random(11)
    rows = []
    for group in range(40):
        for _ in range(rng.choice([30, 100, 400, 1_500])):
            seen = dt.datetime(2022, 1, 1, tzinfo=UTC) + dt.timedelta(minutes=rng.randrange(2 * 365 * 1_440))
            rows.append((str(group), (seen + dt.timedelta(hours=hours(rng))).strftime("%Y-%m-%d %H:%M:%S"), seen))
    found = estimate_zones(spark.createDataFrame(rows, "g string, v string, seen timestamp"), ["v"], "seen", group="g")
    assert found.where("zone <> 'UTC'").count() == 0 and found.agg({"n_rows": "sum"}).first()[0] == len(rows)
