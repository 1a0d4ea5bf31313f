import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import split
from docloom.llm.pack import packed, sum_of_squares
from docloom.llm.split import pieces_of, split_files, split_rows


def check(text, limit, overlap):
    pieces = pieces_of(text, limit, overlap)
    if len(text) <= limit:
        assert pieces == []
        return pieces
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    assert all(0 < e - b <= limit for b, e in pieces)
    for (b, e), (c, f) in zip(pieces, pieces[1:], strict=False):
        assert b < c <= e < f and e - c <= overlap + overlap // 4 + 1
    return pieces


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n\r\té😀́", max_size=1_500), st.integers(30, 200), st.integers(0, 12))
def test_pieces_cover_the_text(text, limit, overlap):
    check(text, limit, overlap)


def test_natural_boundaries():
    text = "\n\n".join("This is a sentence of some length. " * 8 for _ in range(12))
    pieces = check(text, 1_000, 50)
    assert all(text[:e].endswith("\n\n") for _, e in pieces[:-1])
    flat = "word " * 3_000
    assert all(flat[:e].endswith(" ") for _, e in check(flat, 6_000, 200)[:-1])
    check("x" * 30_000, 6_000, 200)


def test_files_are_cut_by_byte_ranges(spark, tmp_path):
    rng = random.Random(5)
    texts = {}
    for name, n in {"a": 9_000, "b": 3_000, "blank": 0, "empty": 0, "short": 10}.items():
        texts[name] = "".join(rng.choice(["wörd ", "Ünd 😀. Next ", "líne\n", "par\n\n"]) for _ in range(n))
    texts["blank"] = "one. " * 900 + "\n" * 9_000 + "é" * 9_000 + "e\u0301" * 3_000
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    out = split_files(spark, [str(tmp_path / n) for n in texts], 300, 20, range_bytes=5_000, halo_bytes=16).toPandas()
    rows = spark.createDataFrame([(n, t) for n, t in texts.items()], "path string, first string")
    again = split_rows(rows, "path", "first", 300, 20, range_bytes=5_000).toPandas()
    for name, text in texts.items():
        got = out[out.path == str(tmp_path / name)].sort_values("chunk_index")
        same = again[again.path == name].sort_values("chunk_index")
        assert got.piece.tolist() == same.piece.tolist()
        if len(text) <= 300:
            assert not len(got)
            continue
        starts, ends = got.start_pos.tolist(), got.end_pos.tolist()
        assert got.chunk_index.tolist() == list(range(len(got))) and starts[0] == 0 and ends[-1] == len(text)
        assert all(text[b:e] == p and 0 < len(p) <= 300 for b, e, p in zip(starts, ends, got.piece, strict=True))
        assert all(b < c <= e < f and e - c <= 26 for b, e, c, f in zip(starts, ends, starts[1:], ends[1:], strict=False))
        assert all(text[e - 1].isspace() or text[e - 1] in ".!?" for e in ends[:-1]) or name == "blank"
    assert not any(p.startswith("\u0301") for p in out.piece)


def test_rows(spark):
    df = spark.createDataFrame([(1, "a. B " * 3_000, "x"), (2, None, "x"), (3, "", "x"), (4, "y" * 6_000, "x")], "k int, t string, piece string")
    got = split_rows(df, "k", "t").toPandas()
    assert set(got.k) == {1} and got.chunk_index.tolist() == [0, 1, 2]
    assert split_rows(df.limit(0), "k", "t").count() == 0


def brute(sizes, capacity):
    """The same rule, every gap tried by its sum of squares."""
    bins, out = [], []
    for w in sizes:
        best = None
        for choice in [*range(len(bins)), None]:
            after = [*bins]
            if choice is None:
                after.append(capacity - w)
            elif bins[choice] < w:
                continue
            else:
                after[choice] -= w
            count = np.bincount([g for g in after if g > 0], minlength=1)
            cost = int((count**2).sum())
            rank = (cost, choice is None, after[choice] + w if choice is not None else 0)
            if best is None or rank < best[0]:
                best = (rank, after)
        bins = best[1]
        out.append(sorted(bins))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sum_of_squares_rule(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 31, 60)
    got = sum_of_squares(sizes, 30)
    for k in range(1, 61):
        fill = np.bincount(got[:k], weights=sizes[:k])
        assert fill.max() <= 30
        assert sorted((30 - fill).astype(int).tolist()) == brute(sizes, 30)[k - 1]


def test_containers(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice("alpha beta gamma delta epsilon".split()) for _ in range(rng.randrange(1, 900)))) for k in range(600)]
    rows += [(900, None), (901, ""), (902, "word " * 9_000), (5, rows[5][1])]
    out = packed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", shard_docs=300).toPandas()
    assert out[out.doc_id.isin([900, 901])].container.isna().all()
    full = out[out.container.notna()]
    fill = full.groupby("container").n_tokens.sum()
    assert fill.max() <= 2_048 and fill.mean() > 0.95 * 2_048
    long = out[out.doc_id == 902].sort_values("piece")
    assert long.n_tokens.iloc[:-1].eq(2_048).all() and long.first_token.tolist() == [2_048 * k for k in range(len(long))]
    assert (out.groupby("doc_id").size().drop(902) == 1).drop(5).all() and (out.doc_id == 5).sum() == 2
    assert packed(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0


def test_shards_leave_little_open_and_do_not_depend_on_the_layout(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(k if k % 3 else None, " ".join(["word"] * rng.randrange(1, 90))) for k in range(3_000)], "container long, text string")
    out = [packed(x, "container", "text", shard_docs=700).toDF("k", "piece", "first", "n", "box").toPandas() for x in (df.repartition(1), df.repartition(7))]
    order = ["k", "n", "piece", "box"]
    assert out[0].sort_values(order)[order].reset_index(drop=True).equals(out[1].sort_values(order)[order].reset_index(drop=True))
    fill = out[0].groupby("box").n.sum()
    assert fill.max() <= 2_048 and len(out[0]) == 3_000 and fill.sum() > 0.98 * 2_048 * len(fill) and out[0].box.str.startswith("1-").any()
