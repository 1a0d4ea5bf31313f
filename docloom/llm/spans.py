"""Long spans that stand verbatim in more than one document.

Level-wise doubling. At the first level windows of half the required length are taken at the places that
winnowing picks: among the windows of any stretch of the required length, the one with the least hash. So
two documents that share such a stretch pick the same window in it. Windows that occur in one text alone
are dropped; the survivors alone are extended to twice their length, up to as much again to either side, and
compared exactly: that is the required length, and all that pairs and shares need, as longer stretches are the
union of the pieces found at their windows. :func:`levels` goes on: what is still repeated is extended to twice
its length, and again, until no candidates survive; it tells how long the stretches are.

Copies of a whole text are one class, known by a hash of the text, so they add no work.
Places of a window in up to ``CROWD`` texts are compared in one group of that size. A window that stands in more
is not paired: its extensions are cut into every window of the full length. For shares it is enough that
such a window stands elsewhere; for pairs, windows that the same texts hold are one.

Windows are cut once and stored. What survives is joined to them, and its places to the texts, by broadcast where a
count shows that it is small (``SENT_ROWS``), else by sort and merge.

Defined results: null texts and texts below the required length share nothing; a text that occurs in
several documents is shared as a whole between them; positions count code points; rows that repeat
an id and its text count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import mix
from docloom.session import scratch_path

LENGTH = 200
CROWD = 64
#: Classes with more copies than this are linked to their lowest id instead of pair by pair.
STAR = 1_000
BATCH_CHARS = 1_000_000
#: Rows of two numbers that are broadcast at most, after they were counted.
SENT_ROWS = 250_000
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        row = np.full(n, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def window_hashes(codes: np.ndarray, size: int, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A hash of the ``size`` code points from each position, as 63-bit numbers."""
    n = len(codes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64)) * powers[0][:n], out=total[1:])
    return (mix((total[size:] - total[:-size]) * powers[1][: n - size + 1]) >> np.uint64(1)).astype(np.int64)


def _sliding(x: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """The best of each ``width`` neighbours, by running bests within blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, fill, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[str], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, position and hash of the windows of half the length that winnowing picks."""
    size = length // 2
    width = length - size + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes, total = _codes(texts), int(sizes.sum())
    none = np.empty(0, np.int64)
    if total < length:
        return none, none, none
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(total)  # code points from here to the end of the text
    hashes = window_hashes(codes, size, _powers(total + 1))
    least = _sliding(hashes, width, np.minimum, np.iinfo(np.int64).max)
    least[left[: len(least)] < length] = -1
    edge = np.full(width - 1, -1, np.int64)
    most = _sliding(np.concatenate([edge, least, edge]), width, np.maximum, -1)
    picked = most == hashes
    # Of a run of one window, as in a ruled line, the first and the last place are kept, and between them one
    # at each step that an extension spans: whatever part of the run is shared, the pieces found there meet.
    same = np.zeros(len(hashes), bool)
    same[1:-1] = (hashes[1:-1] == hashes[:-2]) & (hashes[1:-1] == hashes[2:]) & picked[:-2] & picked[2:]
    places = np.arange(len(hashes))
    since = places - np.maximum.accumulate(np.where(same, 0, places))
    at = np.flatnonzero(picked & ~(same & (since % (length - size) > 0)))
    which = np.searchsorted(ends, at, "right")
    return which, at - (ends[which] - sizes[which]), hashes[at]


def _pieces(classes: list[int], texts: list[str], length: int) -> Iterator[tuple[int, int, str]]:
    """Class, offset and text; very long texts in pieces that overlap by what a window of the full length needs."""
    for label, text in zip(classes, texts, strict=True):
        for start in range(0, max(1, len(text) - length + 1), BATCH_CHARS):
            yield label, start, text[start : start + BATCH_CHARS + length - 1]


def _anchor_rows(length: int):
    def batched(held: list[tuple[int, int, str]]) -> pd.DataFrame:
        which, at, hashes = anchors([t for _, _, t in held], length)
        label, first = (np.array([h[i] for h in held], np.int64) for i in (0, 1))
        return pd.DataFrame({"hash": hashes, "class": label[which], "pos": (at + first[which]).astype("int32")})

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size = [], 0
            for piece in _pieces(batch["class"].tolist(), batch["text"].tolist(), length):
                if held and size + len(piece[2]) > BATCH_CHARS:
                    yield batched(held)
                    held, size = [], 0
                held.append(piece)
                size += len(piece[2])
            if held:
                yield batched(held)

    return each


def _documents(df: DataFrame, key: str, text: str, length: int) -> DataFrame:
    return df.where((F.length(text) >= length) & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(text).alias("class"), F.col(text).alias("text"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    df.write.parquet(path := scratch_path(df.sparkSession, name))
    return df.sparkSession.read.parquet(path)


def _small(df: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked for broadcast where it has few rows."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def members(df: DataFrame, key: str, text: str, length: int = LENGTH) -> DataFrame:
    """``id, class, lead, copies``: the class of each text, the lowest id in it and its number of ids."""
    each = _documents(df, key, text, length).select("id", "class").distinct()
    lead = each.groupBy("class").agg(F.min("id").alias("lead"), F.count("*").alias("copies"))
    return each.join(lead, "class")


def _survivors(docs: DataFrame, length: int) -> DataFrame:
    """Windows of half the length that stand in more than one text: ``hash, class, pos, n``."""
    rows = _stored(docs.select("class", "text").mapInPandas(_anchor_rows(length), "hash bigint, class bigint, pos int"), "windows")
    shared = rows.groupBy("hash").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.count("*").alias("n")).where("a <> b").select("hash", "n")
    return _stored(rows.join(_small(_stored(shared, "repeated")), "hash").distinct(), "survivors")


def _located(docs: DataFrame, places: DataFrame, each: DataFrame) -> DataFrame:
    """The texts that hold places, one document for a class: ``id, text, places``."""
    held = places.groupBy("class").agg(F.collect_set(F.struct(*[c for c in places.columns if c != "class"])).alias("places"))
    wanted = held.join(each.select("class", F.col("lead").alias("id")).distinct(), "class")
    few = places.count() <= SENT_ROWS
    return docs.join(F.broadcast(wanted) if few else wanted, ["id", "class"])


def extended(df: DataFrame, key: str, text: str, each: DataFrame, length: int = LENGTH) -> DataFrame:
    """Survivors with what stands around them: ``hash, n, lead, pos, skip, region``; ``each`` as from :func:`members`."""
    docs = _documents(df, key, text, length)
    half, rest = length // 2, length - length // 2
    found = _located(docs, _survivors(docs, length), each)
    at = F.col("p.pos") + 1
    first = F.greatest(F.lit(1), at - rest)
    return found.select("id", "text", F.explode("places").alias("p")).select(
        F.col("p.hash").alias("hash"), F.col("p.n").alias("n"), F.col("id").alias("lead"), F.col("p.pos").alias("pos"),
        (at - first).alias("skip"), F.substring("text", first, at - first + half + rest).alias("region"),
    )


def _agree(a: str, b: str) -> int:
    """How many first characters two texts have in common."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _stretches(leads: list, regions: list[str], skips: list[int], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Numbers of two places of one window, and how far they agree to its left and right, if that is far enough."""
    half = length // 2
    cores = [r[s : s + half] for r, s in zip(regions, skips, strict=True)]
    before = [r[:s][::-1] for r, s in zip(regions, skips, strict=True)]
    after = [r[s + half :] for r, s in zip(regions, skips, strict=True)]
    for i in range(len(leads)):
        for j in range(i):
            if leads[i] != leads[j] and cores[i] == cores[j]:
                left, right = _agree(before[i], before[j]), _agree(after[i], after[j])
                if left + right + half >= length:
                    yield i, j, left, right


def _near(far: DataFrame, length: int, kind: str, paired: bool) -> DataFrame:
    """From the groups of places of windows in few texts: ``lead_a, lead_b`` or the stretches ``lead, start, stop``.

    A group has no more than ``CROWD`` places.
    """
    half = length // 2
    parts = [F.collect_list(c).alias(c) for c in ("lead", "pos", "skip", "region")]
    grouped = far.where(F.col("n") <= CROWD).groupBy("hash").agg(*parts).where(F.size("lead") > 1)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: set[tuple] = set()
            for leads, places, skips, regions in zip(batch["lead"], batch["pos"], batch["skip"], batch["region"], strict=True):
                for i, j, left, right in _stretches(leads, regions, skips, length):
                    if paired:
                        rows.add((min(leads[i], leads[j]), max(leads[i], leads[j])))
                    else:
                        rows.update((leads[k], int(places[k]) - left, int(places[k]) + half + right) for k in (i, j))
            yield pd.DataFrame(list(rows), columns=["lead_a", "lead_b"] if paired else ["lead", "start", "stop"])

    out = f"lead_a {kind}, lead_b {kind}" if paired else f"lead {kind}, start bigint, stop bigint"
    return grouped.drop("hash").mapInPandas(each, out)


def _crowded(far: DataFrame, length: int) -> DataFrame:
    """Windows of the full length around windows in many texts, as far as they stand elsewhere too: ``w, v, lead, start``."""
    steps = F.sequence(F.lit(0), F.length("region") - length)
    full = (
        far.where((F.col("n") > CROWD) & (F.length("region") >= length))
        .select("lead", F.explode(F.transform(steps, lambda i: F.struct((F.col("pos") - F.col("skip") + i).cast("bigint").alias("start"), F.substring(F.col("region"), i + 1, F.lit(length)).alias("w")))).alias("x"))
        .select("lead", "x.start", F.xxhash64("x.w").alias("w"), F.crc32("x.w").alias("v"))
        .distinct()
    )
    full = _stored(full, "crowded")
    shared = full.groupBy("w", "v").agg(F.min("lead").alias("a"), F.max("lead").alias("b")).where("a <> b").select("w", "v")
    return full.join(shared, ["w", "v"])


def shared_pairs(df: DataFrame, key: str, text: str, length: int = LENGTH) -> DataFrame:
    """``id_a < id_b``: documents with at least ``length`` consecutive characters in common.

    Classes of more than ``STAR`` copies are given by their lowest id, to which each copy is linked;
    ``members`` tells which records these are.
    """
    each = _stored(members(df, key, text, length), "classes")
    far = _stored(extended(df, key, text, each, length), "extended")
    kind = dict(far.dtypes)["lead"]
    near = _near(far, length, kind, True)
    holders = _crowded(far, length).select("w", "v", "lead").distinct()
    # Windows that the same texts hold give the same pairs: one of them is enough. The texts are told by two sums of hashes.
    sums = [F.sum((F.xxhash64("lead", F.lit(k)) / 4).cast("decimal(38,0)")).alias(f"sum{k}") for k in (1, 2)]
    one = holders.groupBy("w", "v").agg(F.count("*").alias("n"), *sums).groupBy("n", "sum1", "sum2").agg(F.min(F.struct("w", "v")).alias("x")).select("x.w", "x.v")
    holders = _stored(holders.join(one, ["w", "v"], "left_semi"), "holders")
    crowd = holders.withColumnRenamed("lead", "lead_a").join(holders.withColumnRenamed("lead", "lead_b"), ["w", "v"]).where("lead_a < lead_b")
    leads = near.unionByName(crowd.select("lead_a", "lead_b")).distinct()
    shown = each.where((F.col("copies") <= STAR) | (F.col("id") == F.col("lead"))).select("lead", "id")
    across = (
        leads.join(shown.select(F.col("lead").alias("lead_a"), F.col("id").alias("a")), "lead_a")
        .join(shown.select(F.col("lead").alias("lead_b"), F.col("id").alias("b")), "lead_b")
        .select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    )
    copies = each.where((F.col("copies") > 1) & (F.col("copies") <= STAR)).select("lead", "id")
    inside = copies.select("lead", F.col("id").alias("id_a")).join(copies.select("lead", F.col("id").alias("id_b")), "lead").where("id_a < id_b")
    star = each.where((F.col("copies") > STAR) & (F.col("id") != F.col("lead"))).select(F.col("lead").alias("id_a"), F.col("id").alias("id_b"))
    # Leads are one pair once; two leads, or a lead and a copy, never give the same pair of ids.
    return across.unionByName(inside.select("id_a", "id_b")).unionByName(star)


def levels(df: DataFrame, key: str, text: str, length: int = LENGTH) -> DataFrame:
    """``key, longest, n_windows``: for each document with a repeated window, the length up to which doubling went and the windows left there.

    From half the required length on, what is repeated in another text is extended to the right to twice its
    length, level by level, until no candidate survives. Only survivors go from level to level; each level is
    stored, and the texts that hold survivors are stored once.
    """
    docs = _documents(df, key, text, length)
    each = _stored(members(df, key, text, length), "classes")
    alive = _survivors(docs, length).select("class", "pos", "hash").distinct()
    held = _stored(_located(docs, alive.select("class", "pos"), each).select("class", "text"), "texts")
    size, kept = length // 2, []
    while alive.limit(1).count():
        kept.append(alive.groupBy("class").agg(F.count("*").alias("n_windows")).withColumn("longest", F.lit(size)))
        size *= 2
        places = alive.groupBy("class").agg(F.collect_set("pos").alias("places"))
        wider = held.where(F.length("text") >= size).join(places, "class").select("class", "text", F.explode("places").alias("pos")).where(F.col("pos") + size <= F.length("text"))
        cut = _stored(wider.select("class", "pos", F.xxhash64(F.substring(F.col("text"), F.col("pos") + 1, F.lit(size))).alias("hash")), "level")
        shared = cut.groupBy("hash").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("hash")
        alive = _stored(cut.join(shared, "hash", "left_semi"), "level")
    if not kept:
        kept.append(each.limit(0).select("class", F.lit(0).cast("bigint").alias("n_windows"), F.lit(0).alias("longest")))
    every = kept[0]
    for level in kept[1:]:
        every = every.unionByName(level)
    last = every.groupBy("class").agg(F.max(F.struct("longest", "n_windows")).alias("l"))
    return each.join(last, "class").select(F.col("id").alias(key), "l.longest", "l.n_windows")


def _merged(spans: Column) -> Column:
    """Sorted ``(start, stop)`` spans, those that touch or overlap made one."""
    first = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("stop")))
    empty = F.filter(first, lambda x: x["stop"] >= 0)

    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        more = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))))
        return F.when((F.size(done) > 0) & (x["start"] <= last["stop"]), more).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), empty, add)


def shared_spans(df: DataFrame, key: str, text: str, length: int = LENGTH) -> DataFrame:
    """``id, n_chars, spans``: for every document the stretches ``start, stop`` that stand elsewhere too.

    No pairs are made: places of windows in few texts are compared in their group, and of a window in many it is enough to
    know that it stands in another text.
    """
    each = _stored(members(df, key, text, length), "classes")
    far = _stored(extended(df, key, text, each, length), "extended")
    sides = _near(far, length, dict(far.dtypes)["lead"], False).unionByName(_crowded(far, length).select("lead", "start", (F.col("start") + length).alias("stop")))
    spans = sides.groupBy("lead").agg(_merged(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    held = each.join(spans, "lead", "left").select("id", "copies", "spans")
    sizes = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("n_chars"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_chars").alias("stop")))
    nothing = F.filter(whole, lambda x: F.lit(False))
    return sizes.join(held, "id", "left").select("id", "n_chars", F.when(F.col("copies") > 1, whole).otherwise(F.coalesce("spans", nothing)).alias("spans"))


def shares(df: DataFrame, key: str, text: str, length: int = LENGTH) -> DataFrame:
    """``key, n_chars, shared_chars, share, n_spans``: how much of every document stands elsewhere too."""
    shared = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    return shared_spans(df, key, text, length).select(
        F.col("id").alias(key), "n_chars", shared.alias("shared_chars"),
        F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(F.lit(0.0)).alias("share"), F.size("spans").alias("n_spans"),
    )
