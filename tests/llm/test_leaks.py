import random

import numpy as np

from docloom.llm.leaks import FMIndex, leaks, suffix_array
from docloom.llm.words import words_of


def test_index_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        symbols = int(rng.integers(1, 6))
        text = np.append(rng.integers(0, symbols + 1, rng.integers(1, 200)), symbols)
        apart = text.astype(np.int64)
        apart[apart >= symbols] = symbols + np.arange((apart >= symbols).sum())
        assert suffix_array(apart).tolist() == sorted(range(len(apart)), key=lambda i: apart[i:].tolist())
        index = FMIndex(text, symbols, 4)
        phrases = rng.integers(0, symbols, (20, int(rng.integers(1, 5))))
        for phrase, low, high in zip(phrases, *index.search(phrases), strict=True):
            want = [i for i in range(len(text) - len(phrase) + 1) if (text[i : i + len(phrase)] == phrase).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_spans(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(20))) for k in range(6)] + [(7, "too short"), (8, None), (None, "x " * 20)]
    docs = []
    for k in range(60):
        words = [rng.choice([*vocabulary, "other", "thing"]) for _ in range(rng.randrange(0, 80))]
        if k % 3 == 0:
            take = items[k % 6][1].split()
            a = rng.randrange(0, 6)
            words += take[a : a + rng.randrange(8, 15)]
        docs.append((k, "; ".join(words).upper() if k % 2 else " ".join(words)))
    docs += [(100, None), (101, ""), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "id long, text string")
    got = leaks(df, "id", "text", spark.createDataFrame(items, "id long, t string"), "id", "t").toPandas()
    want = set()
    for d, text in docs:
        words = words_of(text)
        for i, item in items[:6]:
            phrases = {tuple(item.split()[k : k + 12]) for k in range(9)}
            at = [k for k in range(len(words) - 11) if tuple(words[k : k + 12]) in phrases]
            start = None
            for p, q in zip(at, [*at[1:], None], strict=False):
                start = p if start is None else start
                if q is None or q - p > 12:
                    want.add((d, i, start, p - start + 12))
                    start = None
    assert set(zip(got.id, got.id_item, got.first_word, got.n_words, strict=True)) == want and want
    assert leaks(df.limit(0), "id", "text", spark.createDataFrame(items, "k long, t string"), "k", "t").count() == 0
    assert leaks(df, "id", "text", spark.createDataFrame([], "k long, t string"), "k", "t").count() == 0
