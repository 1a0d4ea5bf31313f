"""Freely typed names mapped to the entries of a reference list.

The reference entries stand in a BK-tree under the Levenshtein distance; the triangle inequality prunes
subtrees, and a search gives every entry within the threshold. A list beyond ``SHARD_ENTRIES`` is cut
into shards by hash, each with a tree of its own, and the nearest of all shards wins.

Up to ``MAX_BROADCAST_BYTES``, which are measured, the entries go to the executors as one broadcast;
rows stay where they are, so a name that holds a third of the rows costs nothing extra, and each worker
remembers the names it has resolved. A larger list stays in shards in the shared folder: the different values
are held against each shard, a task loads one shard at a time, and the shards' winners are merged by value.

Steps for a value: notes, legal forms, articles, case, accents and digits in place of letters are
levelled; then the whole name is searched by growing radius; for a lone stem or a name cut short, the
stem or the beginning is searched; swaps of neighbours count as one edit. A tie between entries is broken by the legal form, else it means none.

Defined results: missing values have no row; a value that means no entry has the empty string; entries
with a null id or a blank name are left out; repeated rows give one row (field, id, entry).
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.nulls import is_missing
from docloom.llm.split import file_system
from docloom.session import hot_left_join, scratch_path, shuffle_width

# Documented bounds: entries per tree, and the bytes of names that may be broadcast.
SHARD_ENTRIES = 20_000
MAX_BROADCAST_BYTES = 64_000_000
REMEMBERED = 200_000
# Legal forms, long and short, in levelled spelling.
LEGAL = {
    "ltd": "ltd", "limited": "ltd", "plc": "plc", "public limited company": "plc", "corp": "corp", "corporation": "corp", "ag": "ag",
    "aktiengesellschaft": "ag", "bv": "bv", "b v": "bv", "besloten vennootschap": "bv", "llc": "llc", "l l c": "llc", "limited liability company": "llc",
    "inc": "inc", "incorporated": "inc", "gmbh": "gmbh", "gesellschaft mbh": "gmbh", "gesellschaft mit beschrankter haftung": "gmbh", "co": "co",
    "company": "co", "sa": "sa", "s a": "sa", "societe anonyme": "sa", "sociedad anonima": "sa", "nv": "nv", "n v": "nv", "se": "se", "p l c": "plc",
}
_DIGITS = str.maketrans("01345$", "oleass")
_ASIDE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_NOTE = re.compile(r"(?:\s[-–—/|]\s*[\w ]+|/\s?[\w ]+)\s*$")


def level(name: str) -> tuple[list[str], str]:
    """The words of a name in levelled spelling, and its legal form (or the empty string)."""
    text = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower().strip()
    text = _ASIDE.sub(" ", text).strip() or text
    while (cut := _NOTE.sub("", text)) != text and cut:
        text = cut
    text = re.sub(r"[^\w&]|_", " ", text.replace("&", " and ").replace("ß", "ss"))
    words = [w.translate(_DIGITS) if re.search(r"[a-z]", w) else w for w in text.split()]
    if words[-1:] == ["the"] and len(words) > 1:
        words.pop()
    form = ""
    for size in (4, 3, 2, 1):
        if len(words) > size and (found := LEGAL.get(" ".join(words[-size:]))):
            words, form = words[:-size], found
            break
    if words[:1] == ["the"] and len(words) > 1:
        words = words[1:]
    if words[-1:] == ["the"] and len(words) > 1:
        words.pop()
    return words, form


def distance(a: str, b: str) -> int:
    """Levenshtein distance by bit-parallel columns."""
    if not a or not b:
        return len(a) + len(b)
    return _column(_bits(a), len(a), b)


def swaps(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` edits part two names, a swap of neighbours being one edit."""
    if abs(len(a) - len(b)) > most:
        return False
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return False
    return row[-1] <= most


def _bits(a: str) -> dict[str, int]:
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    return where


def _column(where: dict[str, int], n: int, b: str) -> int:
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    get = where.get
    for c in b:
        eq = get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | 1) & full
        down = down << 1 & full
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal
    return score


class BKTree:
    """Keys under a true metric; nodes are ``[key, {distance: node}]``."""

    def __init__(self, keys: Iterator[str]) -> None:
        self.root: list | None = None
        for key in keys:
            if self.root is None:
                self.root = [key, {}]
                continue
            node = self.root
            while (d := distance(key, node[0])) and d in node[1]:
                node = node[1][d]
            if d:
                node[1][d] = [key, {}]

    def within(self, key: str, radius: int) -> list[tuple[int, str]]:
        """Every key within the radius, with its distance."""
        found: list[tuple[int, str]] = []
        if self.root is None or not key:
            return found
        where, n, stack = _bits(key), len(key), [self.root]
        while stack:
            word, below = stack.pop()
            d = _column(where, n, word)
            if d <= radius:
                found.append((d, word))
            stack += [node for step, node in below.items() if d - radius <= step <= d + radius]
        return found


Winner = tuple[int, set[tuple[str, str]]] | None


def pick(ids: set[tuple[str, str]], form: str) -> str:
    """The entry meant by a value with a legal form: the only one, or the only one of that form; else none."""
    if len({i for i, _ in ids}) > 1 and form:
        ids = {x for x in ids if x[1] == form}
    return next(iter(ids))[0] if len({i for i, _ in ids}) == 1 else ""


class Resolver:
    """Reference entries, ready to be searched. ``entries``: id, name, aliases split by ``|``."""

    def __init__(self, entries: list[tuple[str, str, str | None]]) -> None:
        self.names: dict[str, set[tuple[str, str]]] = {}
        self.stems: dict[str, set[tuple[str, str]]] = {}
        for ident, name, aliases in entries:
            for k, spelled in enumerate([name, *(aliases or "").split("|")]):
                words, form = level(spelled or "")
                if ident is None or not words:
                    continue
                self.names.setdefault("".join(words), set()).add((ident, form))
                if k == 0 and len(words) > 1:
                    self.stems.setdefault(words[0], set()).add((ident, form))
        self.order = sorted(self.names)
        # A longer name is further from every key than any radius.
        self.longest = max(map(len, self.order), default=0) + 8
        self.trees = [BKTree(iter(part)) for part in self._shards(self.names)]
        self.stem_trees = [BKTree(iter(part)) for part in self._shards(self.stems)]
        self.seen: dict[tuple[str, ...], str] = {}
        self.typed: dict[str, str] = {}

    @staticmethod
    def _shards(keys: dict[str, set]) -> list[list[str]]:
        n = -(-len(keys) // SHARD_ENTRIES) or 1
        parts: list[list[str]] = [[] for _ in range(n)]
        for key in sorted(keys, key=lambda k: (crc32(k.encode()), k)):
            parts[crc32(key.encode()) % n].append(key)
        return parts

    @staticmethod
    def radius(key: str) -> int:
        return 0 if len(key) < 5 else 1 if len(key) < 8 else 2

    def _nearest(self, trees: list[BKTree], table: dict[str, set], key: str, radius: int, edits: int = 0) -> Winner:
        """The entries nearest to a key over all trees; None where nothing is near enough.

        With ``edits``, a swap of neighbours counts as one edit: the tree is searched to twice as many
        plain edits, which holds all such names, and the rest are dropped.
        """
        near = [x for tree in trees for x in tree.within(key, radius)]
        if edits:
            near = [(d, k) for d, k in near if swaps(key, k, edits)]
        if not near:
            return None
        best = min(d for d, _ in near)
        return best, set().union(*(table[k] for d, k in near if d == best))

    def resolve(self, value: str) -> str:
        """The entry of a value; remembered by the value as typed and by its levelled words."""
        if (known := self.typed.get(value)) is not None:
            return known
        if len(self.typed) >= REMEMBERED:
            self.typed.clear()
            self.seen.clear()
        words, form = level(value)
        if sum(map(len, words)) > self.longest:
            return ""
        key = (*words, form)
        if (known := self.seen.get(key)) is None:
            found = self.winner(words)
            known = self.seen[key] = pick(found[2], form) if found else ""
        self.typed[value] = known
        return known

    def winner(self, words: list[str]) -> tuple[int, int, set[tuple[str, str]]] | None:
        """Number of the first step that finds entries, their distance, and all entries found there."""
        if not words or sum(map(len, words)) > self.longest:
            return None
        return next(((step, *found) for step, found in self._steps(words) if found), None)

    def _steps(self, words: list[str]) -> Iterator[tuple[int, Winner]]:
        joined = "".join(words)
        turned = dict.fromkeys(["".join(words[i:] + words[:i]) for i in range(len(words))])
        if len(words) == 1 and joined.startswith("the") and len(joined) > 8:
            turned[joined[3:]] = None
        for n, key in enumerate(turned):
            yield n, self._nearest(self.trees, self.names, key, 0)
        # A name cut short: the only entry that begins so, with more than the stem given.
        begun = []
        for at in range(bisect_left(self.order, joined), len(self.order)):
            if not self.order[at].startswith(joined):
                break
            begun.append(self.order[at])
        if len(words) > 1 and begun and len(joined) >= 6:
            yield 1_000, (0, set().union(*(self.names[k] for k in begun)))
        if radius := self.radius(joined):
            yield 1_001, self._nearest(self.trees, self.names, joined, radius)
        if len(words) == 1:
            for n, reach in enumerate((0, radius)):
                yield 1_002 + n, self._nearest(self.stem_trees, self.stems, joined, reach)
        if radius:
            for n, key in enumerate(turned):
                yield 1_004 + n, self._nearest(self.trees, self.names, key, 2 * radius, radius)
            if len(words) == 1:
                yield 2_000, self._nearest(self.stem_trees, self.stems, joined, 2 * radius, radius)


Entries = list[tuple[str, str, str | None]]


def listed(df: DataFrame, key: str, name: str, aliases: str | None = None) -> DataFrame:
    """A reference list in the common form: ``k, n, a``."""
    return df.select(F.col(key).cast("string").alias("k"), F.col(name).alias("n"), (F.col(aliases) if aliases else F.lit(None).cast("string")).alias("a")).distinct()


def _size(entries: DataFrame) -> int:
    return entries.agg(F.sum(F.octet_length("n") + F.coalesce(F.octet_length("a"), F.lit(0)) + 64)).first()[0] or 0


_resolvers: dict[tuple, Resolver] = {}


def _resolver(entries: Entries) -> Resolver:
    """A worker keeps its last few resolvers, with what they remember, from task to task."""
    key = tuple(entries)
    if key not in _resolvers:
        if len(_resolvers) > 3:
            _resolvers.clear()
        _resolvers[key] = Resolver(entries)
    return _resolvers[key]


def _values(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])
    return df.select(F.col(key).cast("string").alias("id"), F.inline(F.filter(pairs, lambda x: ~is_missing(x["value"]))))


def resolved(df: DataFrame, key: str, lists: dict[str, DataFrame], most_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``field, id, account_id, value`` of each non-missing value of the columns named in ``lists``, held against their lists.

    Lists are in the form of :func:`listed`; one that several columns share is given as the same object.
    """
    long = _values(df, key, list(lists))
    names = {field: next(f for f in lists if lists[f] is lists[field]) for field in lists}
    own = {name: lists[name] for name in dict.fromkeys(names.values())}
    if sum(_size(entries) for entries in own.values()) > most_bytes:
        return _against_shards(long, names, own)
    sent = df.sparkSession.sparkContext.broadcast({name: [(r.k, r.n, r.a) for r in entries.sort("k", "n", "a").collect()] for name, entries in own.items()})

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = {name: _resolver(entries) for name, entries in sent.value.items()}
        for batch in batches:
            batch["account_id"] = [made[names[f]].resolve(v) for f, v in zip(batch["field"], batch["value"], strict=True)]
            yield batch[["field", "id", "account_id", "value"]]

    return long.mapInPandas(each, "field string, id string, account_id string, value string")


def _against_shards(long: DataFrame, names: dict[str, str], lists: dict[str, DataFrame]) -> DataFrame:
    """The same over lists that are too large to send: every different value against every shard, the winners merged.

    Values and shards are the two sides of a search of a stated query set against all entries, in blocks; a task holds
    the entries of one shard at a time.
    """
    spark = long.sparkSession
    folder, counts = scratch_path(spark, "entries"), {}
    for name, entries in lists.items():
        counts[name] = max(1, -(-entries.count() // SHARD_ENTRIES))
        shard = F.pmod(F.xxhash64("k"), F.lit(counts[name])).cast("int")
        entries.withColumn("shard", shard).repartition("shard").write.partitionBy("shard").parquet(f"{folder}/{name}")
    listed_as = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    n_shards = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    values = long.select(F.element_at(listed_as, F.col("field")).alias("name"), "value").distinct()
    asked = values.withColumn("shard", F.explode(F.sequence(F.lit(0), F.element_at(n_shards, F.col("name")) - 1)))
    # By shard, so that a task meets few of them, and in blocks of values, so that none meets all values.
    block = F.pmod(F.xxhash64("value"), F.lit(shuffle_width(spark)))
    asked = asked.repartition("name", "shard", block).sortWithinPartitions("name", "shard")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import dataset

        at, resolver = None, None
        for batch in batches:
            rows = []
            for name, value, shard in zip(batch["name"], batch["value"], batch["shard"], strict=True):
                if (name, shard) != at:
                    system, path = file_system(f"{folder}/{name}/shard={shard}")
                    there = system.get_file_info(path).type.name != "NotFound"
                    entries = dataset.dataset(path, filesystem=system, format="parquet").to_table(columns=["k", "n", "a"]).to_pylist() if there else []
                    at, resolver = (name, shard), Resolver(sorted(((r["k"], r["n"], r["a"]) for r in entries if r["k"]), key=str))
                if found := resolver.winner(level(value)[0]):
                    rows.append((name, value, found[0], found[1], [{"k": k, "form": f} for k, f in sorted(found[2])]))
            yield pd.DataFrame(rows, columns=["name", "value", "step", "distance", "ids"])

    won = asked.mapInPandas(search, "name string, value string, step int, distance int, ids array<struct<k:string,form:string>>")
    best = won.groupBy("name", "value").agg(F.min(F.struct("step", "distance")).alias("best"), F.collect_list(F.struct("step", "distance", "ids")).alias("all"))
    ids = F.flatten(F.transform(F.filter("all", lambda x: (x["step"] == F.col("best.step")) & (x["distance"] == F.col("best.distance"))), lambda x: x["ids"]))

    def chosen(values: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([pick({(x["k"], x["form"]) for x in near}, level(v)[1]) for v, near in zip(values, ids, strict=True)], dtype=object)

    merged = best.select("name", "value", F.pandas_udf(chosen, "string")("value", ids).alias("account_id"))
    keyed = long.withColumn("name", F.element_at(listed_as, F.col("field")))
    return hot_left_join(keyed, merged, ["name", "value"], F.xxhash64("id")).select("field", "id", F.coalesce("account_id", F.lit("")).alias("account_id"), "value")
