"""Words of texts as numbers: maximal runs of letters and digits of the lower-cased text."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")
#: Letters and digits of ASCII in lower case, all else blank.
_BLANKED = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else 32 for c in range(256))
_KEEP = 500_000
_known: dict[str, int] = {}


def words_of(text: str | None) -> list[str]:
    if text and text.isascii():
        return text.encode().translate(_BLANKED).decode().split()
    return _WORD.findall(text.lower()) if text else []


def word_numbers(words: list[str]) -> np.ndarray:
    """A 64-bit number for each word; a worker remembers the numbers of up to ``_KEEP`` words."""
    known = _known
    if len(known) > _KEEP:
        known.clear()
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        number = xxhash.xxh3_64_intdigest
        for word in words:
            if word not in known:
                known[word] = number(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` consecutive words, in order."""
    if len(numbers) < size:
        return np.empty(0, np.uint64)
    out = mix(numbers[: len(numbers) - size + 1] + np.uint64(1))
    for k in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + numbers[k : len(numbers) - size + 1 + k])
    return out
