"""Passages of evaluation items inside training documents, by an FM-index per shard.

A shard is a run of documents within one task, of about ``SHARD_WORDS`` words. Its text is the sequence of
their words; words that occur in no item are gaps, each unlike any other, and so are the ends of documents.
The suffix array is built by doubling, only where suffixes are still tied; the Burrows-Wheeler transform
stands in a wavelet matrix; all phrases of an item (its runs of ``least`` words) are searched backwards
together, one word of every phrase at a time, and the ranges that survive are located through sampled
suffix positions. Occurrences of neighbouring phrases are merged to spans.

Documents are not shuffled: a shard is built where its documents are read. The phrases travel to the
executors as one broadcast; the item table is a stated query set whose size is checked.

Defined results: null and empty texts hold nothing; items with fewer than ``least`` words, or null, leak
nowhere; repeated documents each have their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import words_of

LEAST = 12
SHARD_WORDS = 400_000
SAMPLE = 8
MAX_ITEM_BYTES = 256_000_000


class Wavelet:
    """A wavelet matrix over numbers below ``2 ** bits``: how often a number occurs before a position."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.levels, self.bits = [], bits
        for k in reversed(range(bits)):
            bit = ((values >> k) & 1).astype(bool)
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((ones, len(values) - int(ones[-1])))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``, for arrays of both."""
        low, high = np.zeros_like(at), at
        for k, (ones, zeros) in zip(reversed(range(self.bits)), self.levels, strict=True):
            up = ((symbol >> k) & 1).astype(bool)
            low_ones, high_ones = ones[low], ones[high]
            low = np.where(up, zeros + low_ones, low - low_ones)
            high = np.where(up, zeros + high_ones, high - high_ones)
        return high - low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by prefix doubling; only suffixes that are still tied are sorted again.

    The last symbol must be unlike every other.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    change = np.flatnonzero(np.diff(text[order])) + 1
    starts = np.concatenate([[0], change])
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    step = 1
    tied = np.repeat(np.diff(np.append(starts, n)) > 1, np.diff(np.append(starts, n)))
    where = np.flatnonzero(tied)
    while len(where):
        suffix = order[where]
        following = rank[suffix + step]
        again = np.lexsort((following, rank[suffix]))
        suffix, following, group = suffix[again], following[again], rank[suffix[again]]
        order[where] = suffix
        new = np.append(True, (np.diff(group) != 0) | (np.diff(following) != 0))
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(suffix)))
        rank[suffix] = np.repeat(where[first], count)
        where = where[np.repeat(count > 1, count)]
        step *= 2
    return order


class FMIndex:
    """The index of one shard: symbols below ``n_symbols`` can be searched, ``n_symbols`` is a gap."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = SAMPLE) -> None:
        gap = text >= n_symbols
        apart = text.astype(np.int64)
        apart[gap] = n_symbols + np.arange(int(gap.sum()))
        order = suffix_array(apart)
        before = text[order - 1]
        self.last = np.where(before >= n_symbols, n_symbols, before).astype(np.int64)
        self.last[order == 0] = n_symbols
        self.tree = Wavelet(self.last, max(1, int(n_symbols).bit_length()))
        counts = np.bincount(np.minimum(text, n_symbols), minlength=n_symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        kept = (order % sample == 0) | (self.last == n_symbols)
        self.kept, self.position = kept, np.where(kept, order, 0)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of symbols, the range of suffixes that begin with it."""
        n = len(self.last)
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), n, np.int64)
        alive = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, k]
            a = self.first[symbol] + self.tree.rank(symbol, low[alive])
            b = self.first[symbol] + self.tree.rank(symbol, high[alive])
            low[alive], high[alive] = a, b
            alive = alive[a < b]
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, walking back to the nearest sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.kept[at])
        while len(walking):
            symbol = self.last[at[walking]]
            at[walking] = self.first[symbol] + self.tree.rank(symbol, at[walking])
            steps[walking] += 1
            walking = walking[~self.kept[at[walking]]]
        return self.position[at] + steps


def phrases_of(items: list[tuple[object, str | None]], least: int) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary of the items, distinct phrases as symbols, and which item holds which phrase."""
    split = [(key, words_of(text)) for key, text in items]
    known: dict[str, int] = {}
    for _, words in split:
        if len(words) >= least:
            for word in words:
                known.setdefault(word, len(known))
    rows: dict[tuple[int, ...], int] = {}
    owner, phrase = [], []
    for i, (_, words) in enumerate(split):
        numbers = [known.get(w, -1) for w in words]
        for k in range(len(words) - least + 1):
            owner.append(i)
            phrase.append(rows.setdefault(tuple(numbers[k : k + least]), len(rows)))
    return known, np.array(list(rows), np.int64).reshape(-1, least), np.array(owner, np.int64), np.array(phrase, np.int64)


def _shard_hits(texts: list[str | None], known: dict[str, int], phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, phrase number and first word of every occurrence in the shard."""
    gap = len(known)
    get = known.get
    parts, ends, n = [], [], 0
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter((get(w, gap) for w in words), np.int64, len(words)))
        parts.append(np.array([gap], np.int64))
        n += len(words) + 1
        ends.append(n)
    none = np.empty(0, np.int64)
    if not parts or not len(phrases):
        return none, none, none
    index = FMIndex(np.concatenate(parts), gap)
    low, high = index.search(phrases)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return none, none, none
    width = (high - low)[hit]
    rows = np.repeat(low[hit] - np.cumsum(width) + width, width) + np.arange(int(width.sum()))
    position = index.locate(rows)
    limits = np.array(ends, np.int64)
    document = np.searchsorted(limits, position, "right")
    return document, np.repeat(hit, width), position - np.where(document > 0, limits[document - 1], 0)


def leaks(documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, least: int = LEAST) -> DataFrame:
    """``key, item_key, first_word, n_words``: the spans of each document that stand in an item.

    A span is a maximal union of overlapping occurrences of phrases of one item. Where both keys have one name,
    the item's gets the ending ``_item``.
    """
    rows = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > MAX_ITEM_BYTES:
        raise ValueError(f"{size} bytes of items are not broadcast; search them in several sets")
    listed = [(r.k, r.t) for r in rows.where("k is not null and t is not null").distinct().sort("k", "t").collect()]
    known, phrases, owner, phrase = phrases_of(listed, least)
    by_phrase = np.argsort(phrase, kind="stable")
    limits = np.searchsorted(phrase[by_phrase], np.arange(len(phrases) + 1))
    sent = documents.sparkSession.sparkContext.broadcast((known, phrases, owner[by_phrase], limits, [k for k, _ in listed]))
    kinds = (dict(documents.dtypes)[key], dict(items.dtypes)[item_key])
    item_key = item_key if item_key != key else f"{item_key}_item"

    def one(keys: list, texts: list[str | None]) -> pd.DataFrame:
        known, phrases, owner, limits, names = sent.value
        document, hit, first = _shard_hits(texts, known, phrases)
        counts = (limits[1:] - limits[:-1])[hit]
        at = np.repeat(np.arange(len(hit)), counts)
        item = owner[np.repeat(limits[hit] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))] if len(hit) else hit
        order = np.lexsort((first[at], item, document[at]))
        d, i, f = document[at][order], item[order], first[at][order]
        new = np.append(True, (np.diff(d) != 0) | (np.diff(i) != 0) | (np.diff(f) > least))[: len(d)]
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(d)) - 1 if len(begin) else begin
        return pd.DataFrame(
            {key: [keys[x] for x in d[begin]], item_key: [names[x] for x in i[begin]], "first_word": f[begin], "n_words": f[end] - f[begin] + least}
        )

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list = []
        texts: list[str | None] = []
        size = 0
        for batch in batches:
            for k, t in zip(batch["k"], batch["t"], strict=True):
                keys.append(k)
                texts.append(t)
                size += len(t) if t else 1
                if size > 6 * SHARD_WORDS:
                    yield one(keys, texts)
                    keys, texts, size = [], [], 0
        if keys:
            yield one(keys, texts)

    found = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null")
    return found.mapInPandas(each, f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, first_word bigint, n_words bigint")
