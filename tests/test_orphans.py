import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.nulls import is_true
from docloom.operators.orphans import OrphanState, parent_rows, reference_rows
from docloom.streaming.feeds import OrphanFeed

DAY = dt.datetime(2021, 1, 1)


def _rows(seed: int, n: int):
    rng = random.Random(seed)
    keys = [f"{'abcdefghij' * 2}"[:15] + f"{k:03d}" for k in range(12)]
    parents = [(rng.choice(keys), f"Deal-{k}", DAY + dt.timedelta(days=rng.randrange(60)), rng.choice(["true", "no", None, "YES", "0"]), k) for k in range(n)]
    parents = [(key, f"Deal-{keys.index(key)}", at, gone, seq) for key, _, at, gone, seq in parents]
    form = [lambda k: k, lambda k: f" {k} ", lambda k: f"Deal-{keys.index(k)}", lambda k: "gone", lambda k: None, lambda k: "N/A"]
    refs = [(f"r{rng.randrange(n)}", rng.choice(form)(rng.choice(keys)), DAY + dt.timedelta(days=rng.randrange(60))) for _ in range(3 * n)]
    return parents, refs


def _brute(parents, refs):
    first, last = {}, {}
    for key, name, at, gone, seq in parents:
        first[key] = min(first.get(key, at), at)
        last[key] = max(last.get(key, (at, seq, gone)), (at, seq, gone), key=lambda x: x[:2])
    names = {name: key for key, name, *_ in parents}
    seen = {}
    for ident, ref, at in refs:
        seen[ident] = min(seen.get(ident, at), at)
    out = set()
    for ident, ref, _ in refs:
        if ref is None or ref.strip().lower() in ("", "n/a"):
            continue
        key = names.get(ref.strip(), ref.strip())
        key = next((k for k in first if key in (k, k[:15])), None) if key not in first else key
        if key is None or (last[key][2] or "").strip().lower() in ("true", "1", "yes") or first[key] > seen[ident]:
            out.add((ident, ref.strip()))
    return out


def _frames(spark, parents, refs):
    p = spark.createDataFrame(parents, "id string, name string, at timestamp, gone string, seq long")
    r = spark.createDataFrame(refs, "rid string, ref string, at timestamp")
    return (
        parent_rows(p, "deals", "id", "at", is_true(F.col("gone")), F.col("seq"), "name"),
        reference_rows(r, "rid", "at", {"ref": ("deals", ())}),
    )


def test_against_brute_force_and_any_order_of_batches(spark):
    parents, refs = _rows(3, 40)
    p, r = _frames(spark, parents, refs)
    want = _brute(parents, refs)
    once = OrphanState.empty(spark).advance(p, r)
    assert {(x.id, x.ref) for x in once.orphans().collect()} == want
    state = OrphanState.empty(spark)
    for k in reversed(range(3)):
        pk, rk = _frames(spark, parents[k::3], refs[k::3])
        state = state.advance(references=rk).advance(parents=pk)
    assert {(x.id, x.ref) for x in state.orphans().collect()} == want
    assert {tuple(x) for x in state.resolved().collect()} == {tuple(x) for x in once.resolved().collect()}
    assert {tuple(x) for x in state.pending().collect()} == {tuple(x) for x in state.resolved().where("state in ('absent', 'deleted')").collect()}
    assert {tuple(x) for x in state.snapshot().collect()} == {tuple(x) for x in once.snapshot().collect()}
    small = state.compacted()
    assert {tuple(x) for x in small.resolved().collect()} == {tuple(x) for x in once.resolved().collect()}
    gone, _ = _frames(spark, [(k, n, at + dt.timedelta(days=99), "yes", 999) for k, n, at, _, _ in parents], [])
    assert not small.advance(gone).resolved().where("state = 'ok'").count()


def test_arrival_resolves_and_deletion_reopens(spark):
    key = "a0W" + "x" * 15
    _, refs = _frames(spark, [(key, "n", DAY, None, 1)], [("r", key, DAY)])
    one, _ = _frames(spark, [(key, "n", DAY, "no", 1)], [("r", key, DAY)])
    gone, earlier = _frames(spark, [(key, "n", DAY + dt.timedelta(days=1), "1", 2)], [("r", None, DAY - dt.timedelta(days=1))])
    state = OrphanState.empty(spark).advance(references=refs)
    assert [x.state for x in state.resolved().collect()] == ["absent"]
    state = state.advance(one)
    assert [x.state for x in state.resolved().collect()] == ["ok"] and not state.pending().count()
    late = state.advance(references=earlier)
    assert [x.state for x in late.resolved().collect()] == ["late"]
    state = late.advance(gone)
    assert [x.state for x in state.resolved().collect()] == ["deleted"] and state.pending().count() == 1
    assert state.advance(one, number=3) is state
    assert OrphanState.empty(spark).orphans().count() == 0
    assert OrphanState.empty(spark).advance().orphans().count() == 0


def test_a_shared_spelling_is_good_if_one_record_is(spark):
    a, b = "a0W" + "s" * 12 + "AAA", "a0W" + "s" * 12 + "BBB"
    one, refs = _frames(spark, [(a, "n1", DAY, "true", 1)], [("r", a[:15], DAY), (None, a[:15], DAY)])
    two, _ = _frames(spark, [(b, "n2", DAY, None, 1)], [])
    state = OrphanState.empty(spark).advance(one, refs)
    assert [x.state for x in state.resolved().collect()] == ["deleted", "deleted"]
    assert [(x.state, x.parent_id) for x in state.advance(two).resolved().collect()] == [("ok", b), ("ok", b)]


FORM = "kind string, ref_table string, parent_id string, name string, first_seen timestamp, last struct<at:timestamp,seq:bigint,deleted:boolean>, id string, ref string, first_ref timestamp"


def _events(spark, parents, refs):
    p, r = _frames(spark, parents, refs)
    flat = r.select("id", "first_ref", F.explode_outer("refs").alias("x")).select("id", "first_ref", "x.ref_table", "x.ref")
    return p.withColumn("kind", F.lit("parent")).unionByName(flat.withColumn("kind", F.lit("reference")), allowMissingColumns=True)


def test_feed_goes_on_after_a_restart(spark, tmp_path):
    parents, refs = _rows(5, 20)
    stream = lambda: spark.readStream.schema(FORM).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    for k in range(2):
        _events(spark, parents[k::2], refs[k::2]).repartition(2).write.mode("append").json(str(tmp_path / "in"))
        feed = OrphanFeed(spark, root=str(tmp_path / "feed"))
        feed.run(stream()).awaitTermination()
    assert len(feed.state.batches) == 4
    assert {(x.id, x.ref) for x in feed.state.orphans().collect()} == _brute(parents, refs)
    assert OrphanFeed(spark, "other").state.batches == ()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_key(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", adaptive)
    key = "a0W" + "h" * 15
    p, r = _frames(spark, [(key, "n", DAY, None, 1)], [(f"r{k}", key, DAY) for k in range(2_000)])
    found = OrphanState.empty(spark).advance(p, r).resolved()
    assert found.where("state = 'ok'").count() == 2_000
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
