"""Near-duplicate records: every pair whose word-shingle sets are similar enough, without comparing all.

A T-occurrence search by DivideSkip, spread over blocks of sets. A set of ``n`` shingles with similarity ``t`` to another
shares at least ``T = ceil(t * n)`` of them. Its inverted lists are ordered by length: the longest, ``T - c`` of
them, are set aside, and a partner must occur at least ``c`` times in the rest. A task holds the short lists of a block and merges
them for the sets of other blocks; the long lists of partners that reach ``c`` are then probed, each by
a binary search in the partner's sorted list, and pairs are kept that reach the overlap the similarity asks for.

The order of the lists need not be exact, only the same for all sets: occurrences are counted by bucket of the shingles' numbers, and
lists are ordered by the logarithm of the count and then by number. Shingles of buckets that count one occur in one set alone,
have no list to merge and go no further. So neither shingles nor candidates are shuffled: the sets are written once, to files that
the tasks read from the shared folder, and only counts, labels and the pairs found are moved.
Records with equal sets are one class, and take part once.

Defined results: null and empty texts, and texts with fewer words than a shingle, match nothing; equal sets
have similarity 1; rows that repeat an id are one record (the union of their pairs).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs, parquet
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import shingles, word_numbers, words_of
from docloom.session import checkpointed, scratch_path

WORDS, SIMILARITY = 3, 0.7
SHORT = 3
#: Items that a task holds as inverted lists, reads at once against them, and entries that it merges at once.
BLOCK, PROBED, MERGED = 12_000_000, 2_000_000, 2_000_000
STAR = 1_000
#: Classes of several records that are broadcast at most, after they were counted.
SENT_ROWS = 1_000_000
#: Occurrences are counted by bucket, in parts; and so many in memory.
BUCKET_BITS, PART_BITS, COUNTED = 26, 6, 8_000_000


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingles of a text, as signed 64-bit numbers."""
    return np.unique(shingles(word_numbers(words_of(text)), words).view(np.int64))


def _text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _class_hash(items: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """``shingle_set`` of each text; the shingles of some hundred texts are made at once."""
    out = []
    for at in range(0, len(texts), 256):
        numbers = [word_numbers(words_of(t)) for t in texts[at : at + 256]]
        every = shingles(np.concatenate(numbers), words).view(np.int64)
        begin = 0
        for x in numbers:
            own = np.sort(every[begin : begin + max(0, len(x) - words + 1)])
            out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
            begin += len(x)
    return out


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(text) != "")).select(F.col(key).alias("id"), F.col(text).alias("text"))


def _facts(words: int):
    """``id, class, copy`` of the records that have a shingle and, in rows without an id, ``part, counts``: how often shingles occur by bucket.

    Equal sets have the same class; in a class, equal texts, byte by byte, have the same ``copy``. A class counts once in a task.
    """

    def counted(held: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        buckets, counts = np.unique(np.concatenate(held) & ((1 << BUCKET_BITS) - 1), return_counts=True)
        edges = np.searchsorted(buckets, np.arange((1 << PART_BITS) + 1) << (BUCKET_BITS - PART_BITS))
        parts = [k for k in range(1 << PART_BITS) if edges[k] < edges[k + 1]]
        packed = [_packed(buckets[edges[k] : edges[k + 1]] - (k << (BUCKET_BITS - PART_BITS)), counts[edges[k] : edges[k + 1]]) for k in parts]
        none = [pa.nulls(len(parts), t) for t in (kind, pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays([*none, pa.array(parts, pa.int32()), pa.array(packed, pa.binary())], names=["id", "class", "copy", "part", "counts"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size, kind = [], 0, None
        for batch in batches:
            kind, texts = batch.column("id").type, batch.column("text").to_pylist()
            sets = shingle_sets(texts, words)
            some = [k for k, s in enumerate(sets) if len(s)]
            classes = [_class_hash(sets[k]) for k in some]
            for k, c in zip(some, classes, strict=True):
                if c not in seen:
                    seen.add(c)
                    held.append(sets[k])
                    size += len(sets[k])
            ids = batch.column("id").take(pa.array(some, pa.int64()))
            copies = pa.array([_text_hash(texts[k]) for k in some], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(classes, pa.int64()), copies, pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.binary())], names=["id", "class", "copy", "part", "counts"])
            if size > COUNTED:
                yield counted(held, kind)
                held, size = [], 0
                seen.clear()
        if held:
            yield counted(held, kind)

    return each


def _packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    return zlib.compress(np.concatenate([np.diff(places, prepend=0), counts]).astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view(np.uint32).reshape(2, -1).astype(np.int64)
    return np.cumsum(steps), counts


def _part_levels(bits: int):
    """The levels of the buckets of one part: 0 where at most one shingle occurs, at most once; else by logarithm of the occurrences."""

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << (BUCKET_BITS - PART_BITS), np.int64)
        for data in pdf["counts"]:
            places, counts = _unpacked(data)
            total[places] += counts
        total = total.reshape(1 << (bits - PART_BITS), -1).sum(axis=1)
        levels = np.where(total < 2, 0, 1 + np.minimum(62, 3 * np.log2(np.maximum(total, 2) / 2)).astype(np.int64)).astype(np.uint8)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "levels": [zlib.compress(levels.tobytes(), 1)]})

    return each


def _levels(facts: DataFrame) -> np.ndarray:
    """How common the shingles of each bucket are; at most ``2 ** BUCKET_BITS`` bytes, about four buckets for each different shingle."""
    parts = facts.where("part is not null").select("part", "counts")
    # A bucket takes some two bytes in the counts.
    size = parts.agg(F.sum(F.length("counts"))).first()[0] or 0
    bits = min(BUCKET_BITS, max(PART_BITS + 4, int(2 * size).bit_length()))
    levels = np.zeros((1 << PART_BITS, 1 << (bits - PART_BITS)), np.uint8)
    for row in parts.groupBy("part").applyInPandas(_part_levels(bits), "part int, levels binary").collect():
        levels[row["part"]] = np.frombuffer(zlib.decompress(row["levels"]), np.uint8)
    return levels.reshape(-1)


def _coded(levels: Broadcast, words: int, similarity: float):
    """``id, class, n, items`` of the sets that can have a partner: their repeated shingles, rare ones first.

    The first six bits of an item are its level and the others the shingle's, so ascending order is the order of the lists.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = levels.value
        shift = BUCKET_BITS - (len(known).bit_length() - 1)
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            n = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets) if sets else np.empty(0, np.int64)
            level = known[(every & ((1 << BUCKET_BITS) - 1)) >> shift].astype(np.uint64)
            code = (((level << np.uint64(58)) | (every.view(np.uint64) >> np.uint64(6))) ^ np.uint64(1 << 63)).view(np.int64)
            repeated = np.append(0, np.cumsum(level > 0))
            ends = np.cumsum(n)
            m = repeated[ends] - repeated[ends - n]
            some = np.flatnonzero((n > 0) & (m >= _least(n, similarity)))
            items = [np.sort(code[a:b][level[a:b] > 0]) for a, b in zip((ends - n)[some].tolist(), ends[some].tolist(), strict=True)]
            offsets = pa.array(np.append(0, np.cumsum(m[some])), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(items) if items else np.empty(0, np.int64)))
            classes = pa.array([_class_hash(sets[k]) for k in some.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(some)), classes, pa.array(n[some].astype(np.int32)), pa.array(m[some].astype(np.int32)), lists], names=["id", "class", "n", "m", "items"])

    return each


def _least(n: np.ndarray, similarity: float) -> np.ndarray:
    return np.maximum(1, np.ceil(similarity * n - 1e-9)).astype(np.int64)


@dataclass
class _Sets:
    """Some sets with their items one behind the other; ``take`` is the number of their short lists."""

    label: np.ndarray
    n: np.ndarray
    items: np.ndarray
    ends: np.ndarray
    take: np.ndarray

    @classmethod
    def of(cls, batches: list[pa.RecordBatch], similarity: float, short: int) -> _Sets:
        n, m = (np.concatenate([b.column(x).to_numpy() for b in batches]).astype(np.int64) for x in ("n", "m"))
        least = _least(n, similarity)
        items = np.concatenate([b.column("items").flatten().to_numpy() for b in batches])
        return cls(np.concatenate([b.column("class").to_numpy() for b in batches]), n, items, np.cumsum(m), m - least + np.minimum(short, least))

    def heads(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Item, set, place and number of items behind it, for all short lists."""
        begin = np.append(0, self.ends[:-1])
        owner = np.repeat(np.arange(len(self.n)), self.take)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(self.take) - self.take, self.take)
        return self.items[begin[owner] + place], owner, place, (self.ends - begin)[owner] - place - 1

    def set(self, k: int) -> np.ndarray:
        return self.items[self.ends[k - 1] if k else 0 : self.ends[k]]


class _Index:
    """The inverted short lists of some sets, each ordered by the size of the sets."""

    def __init__(self, sets: _Sets, similarity: float, short: int) -> None:
        self.sets, self.similarity, self.short = sets, similarity, short
        item, owner, place, rest = sets.heads()
        order = np.lexsort((sets.n[owner], item))
        item, self.owner, self.place, self.rest = item[order], *(x[order].astype(np.int32) for x in (owner, place, rest))
        new = np.append(True, item[1:] != item[:-1])
        self.known = item[new]
        self.stride = int(sets.n.max()) + 1
        self.at = (np.cumsum(new) - 1) * self.stride + sets.n[self.owner]

    def partners(self, other: _Sets, own: bool) -> Iterator[pd.DataFrame]:
        """The pairs of a set of ``other`` and one of these that are similar enough; ``own``: both sides are the same sets."""
        item, owner, place, rest = other.heads()
        # In the order of the items, as searches for ascending numbers are much faster.
        order = np.argsort(item)
        item = item[order]
        where = np.minimum(np.searchsorted(self.known, item), len(self.known) - 1)
        met = self.known[where] == item
        where, order = where[met] * self.stride, order[met]
        n = other.n[owner[order]]
        low, high = np.ceil(self.similarity * n - 1e-9).astype(np.int64), np.floor(n / self.similarity + 1e-9).astype(np.int64)
        begin = np.searchsorted(self.at, where + np.minimum(low, self.stride - 1))
        length = np.searchsorted(self.at, where + np.minimum(high, self.stride - 1), "right") - begin
        some = np.flatnonzero(length > 0)
        some = some[np.argsort(order[some])]
        order, begin, length = order[some], begin[some], length[some]
        owner, place, rest = owner[order], place[order], rest[order]
        reached = np.cumsum(length)
        last = np.append(np.flatnonzero(owner[1:] != owner[:-1]) + 1, len(owner))
        start = 0
        while start < len(owner):
            # Whole sets, of about so many entries together.
            past = (reached[start - 1] if start else 0) + MERGED
            fits = last[(last > start) & (reached[last - 1] <= past)]
            stop = int(fits[-1]) if len(fits) else int(last[np.searchsorted(last, start, "right")])
            part = slice(start, stop)
            start = stop
            yield from self._merged(other, own, owner[part], place[part], rest[part], begin[part], length[part])

    def _merged(self, other: _Sets, own: bool, owner: np.ndarray, place: np.ndarray, rest: np.ndarray, begin: np.ndarray, length: np.ndarray) -> Iterator[pd.DataFrame]:
        mine, t = self.sets, self.similarity
        to = np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)
        x, y = np.repeat(owner, length), self.owner[to]
        # An entry can lead to an overlap of at most the lesser place, itself and the lesser rest.
        reach = np.minimum(np.repeat(place, length), self.place[to]) + 1 + np.minimum(np.repeat(rest, length), self.rest[to]) + 1e-9
        good = reach >= t / (1 + t) * (other.n[x] + mine.n[y])
        good &= other.label[x] < mine.label[y] if own else other.label[x] != mine.label[y]
        pair = np.sort(x[good].astype(np.int64) * len(mine.n) + y[good])
        if not len(pair):
            return
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        k = np.diff(np.append(starts, len(pair)))
        x, y = np.divmod(pair[starts], len(mine.n))
        enough = k >= np.minimum(self.short, _least(np.minimum(other.n[x], mine.n[y]), t))
        x, y, k = x[enough], y[enough], k[enough]
        # Lists up to the last short one of either set were merged; the rest of that set can add no more than its length.
        ends = [s.items[np.append(0, s.ends[:-1])[z] + s.take[z] - 1] for s, z in ((other, x), (mine, y))]
        behind = [(s.ends - np.append(0, s.ends[:-1]) - s.take)[z] for s, z in ((other, x), (mine, y))]
        total = other.n[x] + mine.n[y]
        need = t / (1 + t) * total - 1e-9
        can = k + np.where(ends[0] < ends[1], behind[0], behind[1]) >= need
        x, y, k, total = x[can], y[can], k[can], total[can]
        end, overlap = np.minimum(*ends)[can], k.copy()
        for i, (p, q, e) in enumerate(zip(x.tolist(), y.tolist(), end.tolist(), strict=True)):
            one, two = other.set(p), mine.set(q)
            one = one[np.searchsorted(one, e, "right") :]
            at = np.searchsorted(two, one)
            overlap[i] += np.count_nonzero(two[np.minimum(at, len(two) - 1)] == one)
        similar = overlap >= t * (total - overlap) - 1e-9
        if similar.any():
            yield pd.DataFrame({"a": other.label[x], "b": mine.label[y], "overlap": overlap, "similarity": overlap / (total - overlap)})[similar]


def _read(files: list[str], most: int, similarity: float, short: int) -> Iterator[_Sets]:
    """The sets of some files, so many items at once."""
    held, size = [], 0
    for name in files:
        system, path = fs.FileSystem.from_uri(name)
        with system.open_input_file(path) as f:
            for batch in parquet.ParquetFile(f).iter_batches(1_024, columns=["class", "n", "m", "items"]):
                held.append(batch)
                size += len(batch.column("items").flatten())
                if size >= most:
                    yield _Sets.of(held, similarity, short)
                    held, size = [], 0
    if held:
        yield _Sets.of(held, similarity, short)


def _compared(most: int, similarity: float, short: int):
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for index, against, own in zip(batch["index"], batch["against"], batch["own"], strict=True):
                for sets in _read(list(index), most, similarity, short):
                    held = _Index(sets, similarity, short)
                    for files, same in [(index, True)] * own + [(against, False)]:
                        for other in _read(list(files), PROBED, similarity, short):
                            yield from held.partners(other, same)

    return each


def _comparisons(files: list[tuple[str, int]], most: int, tasks: int) -> list[tuple[list[str], list[str], bool]]:
    """Which files are held and which are read against them, so that every two files meet once.

    Files are put together to blocks of about ``most`` items; each block is held against itself and half of the others.
    """
    blocks: list[list[str]] = []
    size = most
    for name, items in files:
        if size + items > most:
            blocks.append([])
            size = 0
        blocks[-1].append(name)
        size += items
    b = len(blocks)
    out = []
    for i in range(b):
        others = [(i + d) % b for d in range(1, b // 2 + 1) if 2 * d < b or i < d]
        pieces = min(len(others) + 1, max(1, -(-tasks // b)))
        shares = [[blocks[j] for j in [None, *others][p::pieces] if j is not None] for p in range(pieces)]
        out += [(blocks[i], sum(share, []), p == 0) for p, share in enumerate(shares)]
    return out


def _written(df: DataFrame, name: str) -> DataFrame:
    df.write.parquet(path := scratch_path(df.sparkSession, name))
    return df.sparkSession.read.parquet(path)


def _reassembled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows ``class, n, rank, df``, those of a class one behind the other, as one row for each class, shortest list first."""
    held: list[pd.DataFrame] = []

    def made(part: pd.DataFrame) -> pd.DataFrame:
        label = part["class"].to_numpy()
        starts = np.append(0, np.flatnonzero(np.diff(label)) + 1)
        stops = np.append(starts[1:], len(label))
        rank, df = part["rank"].to_numpy(), part["df"].to_numpy()
        orders = [a + np.argsort(rank[a:b], kind="stable") for a, b in zip(starts, stops, strict=True)]
        return pd.DataFrame({"class": label[starts], "n": part["n"].to_numpy()[starts], "ranks": [rank[o] for o in orders], "dfs": [df[o] for o in orders]})

    for batch in batches:
        if not len(batch):
            continue
        # The last class of a batch may go on in the next one.
        last = batch["class"].iloc[-1]
        other = np.flatnonzero(batch["class"].to_numpy() != last)
        cut = int(other[-1]) + 1 if len(other) else 0
        if held and held[-1]["class"].iloc[-1] != batch["class"].iloc[0]:
            yield made(pd.concat(held))
            held = []
        if cut:
            yield made(pd.concat([*held, batch.iloc[:cut]]))
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield made(pd.concat(held))


def _lists(df: DataFrame, facts: DataFrame, key: str, text: str, words: int, similarity: float) -> str:
    """The path of the sets that can have a partner, one for each class.

    Sets are made from the texts again instead of stored. Of equal sets, the one of the lowest id is kept; the others are left out
    where the sets are made, so that no set is moved, unless too many classes have several records to broadcast them.
    """
    levels = df.sparkSession.sparkContext.broadcast(_levels(facts))
    kind = dict(facts.dtypes)["id"]
    made = _rows(df, key, text).mapInArrow(_coded(levels, words, similarity), f"id {kind}, class bigint, n int, m int, items array<bigint>")
    several = facts.where("part is null").groupBy("class").agg(F.min("id").alias("lead"), F.max("id").alias("most")).where("lead <> most").select("class", "lead")
    several = _written(several, "several")
    if (count := several.count()) > 0:
        made = made.join(F.broadcast(several) if count <= SENT_ROWS else several, "class", "left").where("lead is null or id = lead")
    # Large dictionaries: an item then takes the bits of its number in the file, not eight bytes.
    path = scratch_path(df.sparkSession, "lists")
    made.select("class", "n", "m", "items").write.options(**{"maxRecordsPerFile": 20_000, "parquet.dictionary.page.size": 1 << 26, "parquet.page.size": 1 << 23}).parquet(path)
    return path


def similar_classes(df: DataFrame, facts: DataFrame, key: str, text: str, words: int = WORDS, similarity: float = SIMILARITY, short: int = SHORT) -> DataFrame:
    """``a, b, overlap, similarity`` of classes, each pair once; ``facts`` are the stored facts of the records."""
    spark = df.sparkSession
    lists = spark.read.parquet(_lists(df, facts, key, text, words, similarity))
    files = [(r["name"], r["items"]) for r in lists.groupBy(F.input_file_name().alias("name")).agg(F.sum("m").alias("items")).orderBy("name").collect()]
    tasks = 3 * spark.sparkContext.defaultParallelism
    # Large blocks are read against each other less often; so many of them make enough pairs for all tasks.
    most = max(1, min(BLOCK, sum(items for _, items in files) // math.isqrt(2 * tasks)))
    rows = _comparisons(files, most, tasks)
    kind = "index array<string>, against array<string>, own boolean"
    compared = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), kind).mapInPandas(_compared(BLOCK, similarity, short), "a bigint, b bigint, overlap bigint, similarity double")
    return _written(compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "overlap", "similarity").distinct(), "links")


def _stored(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """The facts of the records, from a table in the shared folder; the sets themselves are not stored."""
    rows = _rows(df, key, text)
    return _written(rows.mapInArrow(_facts(words), f"id {dict(rows.dtypes)['id']}, class bigint, copy bigint, part int, counts binary"), "facts")


def _records(facts: DataFrame) -> DataFrame:
    return facts.where("part is null").select("id", "class", "copy")


def class_links(df: DataFrame, key: str, text: str, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The records ``id, class, lead, copies``, and the links ``lead_a, lead_b`` between different classes."""
    facts = _stored(df, key, text, words)
    rows = _records(facts)
    records = rows.select("id", "class").distinct().join(rows.groupBy("class").agg(F.min("id").alias("lead"), F.countDistinct("id").alias("copies")), "class")
    leads = records.select("class", "lead").distinct()
    links = (
        similar_classes(df, facts, key, text, words, similarity)
        .join(leads.select(F.col("class").alias("a"), F.col("lead").alias("lead_a")), "a")
        .join(leads.select(F.col("class").alias("b"), F.col("lead").alias("lead_b")), "b")
    )
    return records, links.select("lead_a", "lead_b", "similarity")


def _copy_groups(stored: DataFrame) -> DataFrame:
    """``id, class, lead, copies, mixed``: the records of each class in groups of equal texts, with their lowest id.

    An id that has several texts is a group of its own, as no other record stands for all of them.
    """
    held = stored.groupBy("id").agg(F.collect_set(F.struct("class", "copy")).alias("texts"))
    texts = held.select("id", (F.size("texts") > 1).alias("mixed"), F.inline("texts"))
    sole = texts.where(~F.col("mixed"))
    leads = sole.groupBy("class", "copy").agg(F.min("id").alias("lead"), F.count("*").alias("copies"))
    alone = texts.where("mixed").select("id", "class", F.col("id").alias("lead"), F.lit(1).cast("bigint").alias("copies"), "mixed").distinct()
    return sole.join(leads, ["class", "copy"]).select("id", "class", "lead", "copies", "mixed").unionByName(alone)


def copy_classes(df: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """``key, class_id, n_copies``: the lowest id with the same text, byte by byte, and the number of such ids.

    With it every pair follows from ``similar_pairs``: where a class has more than ``STAR`` copies, its lead
    stands for all of them. One row for each record that can be similar to another; an id that has several
    texts is alone in its class.
    """
    groups = _copy_groups(_records(_stored(df, key, text, words))).select("id", "lead", "copies").distinct()
    return groups.select(F.col("id").alias(key), F.col("lead").alias("class_id"), F.col("copies").alias("n_copies"))


def similar_pairs(df: DataFrame, key: str, text: str, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``id_a < id_b``: records that are similar enough, copies included.

    More than ``STAR`` records of one text, byte by byte, are given by their lowest id, to which each is linked;
    ``copy_classes`` tells which they are. Records of different texts are always given pair by pair.
    """
    facts = _stored(df, key, text, words)
    groups = _written(_copy_groups(_records(facts)), "groups")
    links = similar_classes(df, facts, key, text, words, similarity)
    shown = groups.where((F.col("copies") <= STAR) | (F.col("id") == F.col("lead")))
    ends = [shown.select(F.col("class").alias(c), F.col("id").alias(x), F.col("mixed").alias(f"mixed_{x}")) for c, x in (("a", "x"), ("b", "y"), ("class", "x"), ("class", "y"))]
    across = links.select("a", "b").join(ends[0], "a").join(ends[1], "b").where("x <> y")
    inside = ends[2].join(ends[3], "class").where("x < y")
    pairs = [p.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), (F.col("mixed_x") | F.col("mixed_y")).alias("mixed")) for p in (across, inside)]
    both = pairs[0].unionByName(pairs[1])
    star = groups.where((F.col("copies") > STAR) & (F.col("id") != F.col("lead"))).select(F.col("lead").alias("id_a"), F.col("id").alias("id_b"))
    # Only an id of several texts can be in a pair twice.
    once = both.where(~F.col("mixed")).drop("mixed").unionByName(star)
    return once.unionByName(both.where("mixed").drop("mixed").distinct()) if groups.where("mixed").limit(1).count() else once


def components(links: DataFrame) -> DataFrame:
    """``id, group``: the lowest id that each id is linked to over any number of links ``a, b``.

    Labels move along links and then jump to their labels' labels, until nothing changes. Each round is
    checkpointed in the shared folder; only a count comes to the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = checkpointed(both)
    labels = checkpointed(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("group")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "group"), "b").groupBy(F.col("a").alias("id")).agg(F.min("group").alias("best"))
        moved = labels.join(near, "id").select("id", F.col("group").alias("was"), F.least("group", "best").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("group").alias("far"))
        new = checkpointed(moved.join(jump, "to").select("id", "was", F.least("to", "far").alias("group")))
        changed = new.where(F.col("was") != F.col("group")).limit(1).count()
        labels = new.select("id", "group")
        if not changed:
            return labels


def groups(df: DataFrame, key: str, text: str, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``key, group_id, n_links``: one row for each record; alone in its group where nothing is similar."""
    records, links = class_links(df, key, text, words, similarity)
    links = checkpointed(links.select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b")))
    found = components(links).withColumnRenamed("id", "lead")
    sizes = records.select("lead", "copies").distinct()
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    partners = ends.join(sizes.select(F.col("lead").alias("b"), "copies"), "b").groupBy(F.col("a").alias("lead")).agg(F.sum("copies").alias("others"))
    grouped = records.join(found, "lead", "left").join(partners, "lead", "left")
    known = grouped.select(
        F.col("id"), F.coalesce("group", "lead").alias("group_id"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links")
    ).groupBy("id").agg(F.min("group_id").alias("group_id"), F.max("n_links").alias("n_links"))
    every = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
    return every.join(known, "id", "left").select(
        F.col("id").alias(key), F.coalesce("group_id", "id").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )
