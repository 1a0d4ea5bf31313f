import pathlib
import random

import pandas as pd
import pytest

from docloom.llm import neardup, queries, spans
from docloom.llm.words import words_of


def texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(3, 120))] for _ in range(n // 3)]
    out = []
    for k in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(len(t))
            t[at : at + rng.randrange(0, 2)] = [rng.choice(words)]
        out.append((k, " ".join(t)))
    return [*out, (n, None), (n + 1, ""), (n + 2, "a b"), (n + 3, out[0][1].upper()), (n + 4, out[0][1]), (0, out[0][1])]


def similar(rows):
    sets = {}
    for k, t in rows:
        w = words_of(t)
        sets[k] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    return {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]) - 1e-9}


@pytest.mark.parametrize(("seed", "block", "sent"), [(1, 8_192, 1_000_000), (2, 2, 1_000_000), (3, 8_192, 0)])
def test_similar_pairs(spark, monkeypatch, seed, block, sent):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SENT_ROWS", sent)
    rows = texts(seed, 90)
    df = spark.createDataFrame(rows, "id long, text string")
    want = similar(rows)
    assert {tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()} == want and len(want) > 20
    lead = {k: k for k, _ in rows}
    for _ in lead:
        for a, b in want:
            lead[a] = lead[b] = min(lead[a], lead[b])
    got = neardup.groups(df, "id", "text").collect()
    assert {r.id: r.group_id for r in got} == lead
    assert {r.id: r.n_links for r in got} == {k: sum(k in p for p in want) for k in lead}


def test_rows_of_a_class_are_put_together():
    rng = random.Random(1)
    rows = [(c, 9, r, r * 2) for c in (5, 3, 8, 1) for r in rng.sample(range(50), rng.randrange(1, 9))]
    for size in (1, 2, 3, 5, 50):
        parts = (pd.DataFrame(rows[i : i + size], columns=["class", "n", "rank", "df"]) for i in range(0, len(rows), size))
        got = pd.concat(list(neardup._reassembled(parts)))
        assert got["class"].tolist() == [5, 3, 8, 1]
        assert all(list(r) == sorted(x[2] for x in rows if x[0] == c) and list(d) == [2 * x for x in r] for c, r, d in zip(got["class"], got["ranks"], got["dfs"], strict=True))


def test_star_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "STAR", 3)
    df = spark.createDataFrame([(k, "one two three four five six seven eight nine ten") for k in range(6)] + [(9, "one two three four five six seven eight nine ten eleven")], "id long, text string")
    got = {tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()}
    assert got == {(0, k) for k in range(1, 6)} | {(0, 9)}
    assert {r.n_links for r in neardup.groups(df, "id", "text").collect()} == {6}
    assert neardup.similar_pairs(df.limit(0), "id", "text").count() == 0 and neardup.groups(df.limit(0), "id", "text").count() == 0


def rebuilt(found, classes):
    """All pairs that pairs and classes ``id, class_id, n_copies`` stand for."""
    lead, members = {k: c for k, c, _ in classes}, {}
    for k, c, _ in classes:
        members.setdefault(c, set()).add(k)
    assert all(len(members[c]) == n for _, c, n in classes)
    pairs = {(x, y) for a, b in found for x in members[lead[a]] for y in members[lead[b]]} | {(x, y) for m in members.values() for x in m for y in m}
    return {(min(p), max(p)) for p in pairs if p[0] != p[1]}


def test_star_of_copies_only(spark, monkeypatch):
    monkeypatch.setattr(neardup, "STAR", 3)
    text = "one two three four five six seven eight nine ten"
    spelled = [text.upper(), text.title(), text + ".", text.replace(" ", "\n"), text.replace(" ", ", "), text + "!"]
    rows = [(k, text) for k in range(6)] + list(enumerate(spelled, 10)) + [(20, text + " eleven"), (21, text + " eleven"), (0, text), (30, "a b"), (31, "a b")]
    df = spark.createDataFrame(rows, "id long, text string")
    found = {tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()}
    classes = [tuple(r) for r in neardup.copy_classes(df, "id", "text").collect()]
    apart = [0, *range(10, 16), 20, 21]
    assert found == {(0, k) for k in range(1, 6)} | {(a, b) for a in apart for b in apart if a < b}
    assert sorted(classes) == [(k, 0, 6) for k in range(6)] + [(k, k, 1) for k in range(10, 16)] + [(20, 20, 2), (21, 20, 2)]
    assert rebuilt(found, classes) == similar(dict(rows).items())


def test_star_of_an_id_with_two_texts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "STAR", 3)
    one, two = ("one two three four five six seven eight nine ten", "red green blue white black brown pink grey")
    rows = [(k, one) for k in range(6)] + [(k, two) for k in (0, *range(10, 15))] + [(20, two + " cyan")]
    df = spark.createDataFrame(rows, "id long, text string")
    found = {tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()}
    classes = [tuple(r) for r in neardup.copy_classes(df, "id", "text").collect()]
    every = [(a, b) for part in (range(6), (0, *range(10, 15), 20)) for a in part for b in part if a < b]
    assert rebuilt(found, classes) == set(every)


def written(spark, folder):
    """Bytes shuffled so far, and bytes of the tables in the shared folder."""
    shuffled = spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    return shuffled + sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*") if p.is_file())


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_similar_pairs_on_little_disk(spark, monkeypatch, tmp_path, sent):
    monkeypatch.setattr(neardup, "SENT_ROWS", sent)
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 12))) for _ in range(4_000)]
    rows, want = [], set()
    for k in range(0, 3_000, 2):
        words = [rng.choice(vocabulary) for _ in range(250)]
        other = [*words[:120], rng.choice(vocabulary), *words[120:]]
        rows += [(k, " ".join(words)), (k + 1, " ".join(other))]
        want.add((k, k + 1))
    spark.createDataFrame(rows, "id long, text string").repartition(2).write.parquet(path := str(tmp_path / "texts"))
    size = sum(p.stat().st_size for p in pathlib.Path(path).glob("*.parquet"))
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = written(spark, folder)
    found = {tuple(r) for r in neardup.similar_pairs(spark.read.parquet(path), "id", "text").collect()}
    assert found == want
    assert written(spark, folder) - before < 4 * size


def test_words_of_ascii_texts():
    rng = random.Random(12)
    for _ in range(500):
        text = "".join(chr(rng.randrange(128)) for _ in range(rng.randrange(80)))
        assert words_of(text) == words_of(text + " é")[:-1]


def shared(rows, length):
    held = {}
    for k, t in rows:
        for i in range(len(t or "") - length + 1):
            held.setdefault(t[i : i + length], set()).add(k)
    pairs = {(a, b) for ids in held.values() for a in ids for b in ids if a < b}
    many = {w for w, ids in held.items() if len(ids) > 1}
    cover = {k: sum(any(t[i : i + length] in many for i in range(max(0, p - length + 1), p + 1) if i + length <= len(t)) for p in range(len(t or ""))) for k, t in rows}
    return pairs, cover


@pytest.mark.parametrize(("seed", "crowd", "batch"), [(1, 64, 1_000_000), (2, 1, 1_000_000), (3, 64, 150)])
def test_shared_spans(spark, monkeypatch, seed, crowd, batch):
    monkeypatch.setattr(spans, "CROWD", crowd)
    monkeypatch.setattr(spans, "BATCH_CHARS", batch)
    rng = random.Random(seed)
    rand = lambda n: "".join(rng.choice("abcdé😀 ") for _ in range(n))
    seeds = [rand(rng.randrange(30, 70)) for _ in range(6)] + ["-" * 90, "ab" * 40]
    rows = []
    for k in range(40):
        s = rng.choice(seeds)
        a = rng.randrange(0, 25)
        rows.append((k, rand(rng.randrange(0, 60)) + s[a : a + rng.randrange(30, 60)] + rand(rng.randrange(0, 60))))
    rows += [(50, None), (51, ""), (52, rows[3][1]), (53, rows[3][1])]
    df = spark.createDataFrame([*rows, rows[0]], "id long, text string")
    pairs, cover = shared(rows, 40)
    assert {tuple(r) for r in spans.shared_pairs(df, "id", "text", 40).collect()} == pairs and len(pairs) > 10
    assert {r.id: r.shared_chars for r in spans.shares(df.distinct(), "id", "text", 40).collect()} == cover
    assert spans.shared_pairs(df.limit(0), "id", "text", 40).count() == 0 and spans.shares(df.limit(0), "id", "text", 40).count() == 0


def test_star_of_spans(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(spans, "STAR", 3)
    rng = random.Random(5)
    rand = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    one, two = rand(420), rand(400)
    rows = [(k, one) for k in range(3, 9)] + [(1, rand(30) + one[100:330]), (2, two), (12, two), (20, one[:210] + two[:250]), (21, rand(300)), (22, "ab"), (23, "ab"), (24, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {tuple(r) for r in queries.p10_found(spark, str(tmp_path)).collect()}
    classes = [tuple(r) for r in queries.p10_classes(spark, str(tmp_path)).collect()]
    want = shared(rows, 200)[0]
    assert found < want and rebuilt(found, classes) == want
    assert {c[1:] for c in classes if 3 <= c[0] < 9} == {(3, 6)} and not {22, 23, 24} & {c[0] for c in classes}


@pytest.mark.parametrize("crowd", [64, 5])
def test_shared_ruled_lines(spark, monkeypatch, crowd):
    monkeypatch.setattr(spans, "CROWD", crowd)
    rng = random.Random(7)
    rand = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    near = rand(150)
    rows = [(0, rand(90) + "-" * 1_000 + rand(70)), (1, rand(50) + "-" * 1_000 + rand(60)), (2, rand(40) + "=" * 730 + near), (3, "=" * 230 + near), (4, rand(300) + "=" * 150 + rand(50))]
    rows += [(5, rand(20) + "#" * 930), (6, "#" * 200 + rand(20)), (7, rand(10) + "-" * 640)]
    df = spark.createDataFrame(rows, "id long, text string")
    pairs, cover = shared(rows, 200)
    assert {tuple(r) for r in spans.shared_pairs(df, "id", "text").collect()} == pairs
    got = {r.id: r for r in spans.shares(df, "id", "text").collect()}
    assert {k: r.shared_chars for k, r in got.items()} == cover
    found = {r.id: [tuple(x) for x in r.spans] for r in spans.shared_spans(df, "id", "text").collect()}
    assert found[0] == [(90, 1_090)] and found[6] == [(0, 200)] and found[4] == []


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_levels_of_doubling(spark, monkeypatch, sent):
    monkeypatch.setattr(spans, "SENT_ROWS", sent)
    rng = random.Random(9)
    rand = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    long, brief = rand(3_000), rand(260)
    rows = [(0, rand(70) + long), (1, long + rand(90)), (2, rand(50) + brief + rand(80)), (3, brief + rand(300)), (4, rand(900)), (5, None), (6, long + rand(90))]
    got = {r.id: r.longest for r in spans.levels(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert got[0] == got[1] == got[6] == 1_600 and {got[2], got[3]} <= {100, 200} and 4 not in got
    assert spans.levels(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0
