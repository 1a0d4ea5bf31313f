"""Queues, kept tables, list evaluation, search with both parts, and smaller column functions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docloom.functions import records
from docloom.functions import text as T
from docloom.operators import chunking, embedding, evaluation, filters, quality, redaction, retrieval
from docloom.plans.pipeline import upsert_index
from docloom.session import children, rename
from docloom.streaming.queues import BatchQueue, kept_table, rate, seconds_left


def value(spark, column, text=None):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("v")).first().v


def test_fences(spark):
    table = "a | b | c\n1 | 2 | 3"
    text = f"Intro line.\r\nMore.\n\n\n\n{table}\n\nx   y   z\np   q   r   \n\n=== TABLE_1 ===\nq\n\n```\n{table}\n```\n\nend"
    want = f"Intro line.\nMore.\n\n```\n{table}\n```\n\n```\nx   y   z\np   q   r\n```\n\n```\n=== TABLE_1 ===\nq\n```\n\n```\n{table}\n```\n\nend"
    assert value(spark, T.fenced_markdown(F.col("t")), text) == want
    assert value(spark, T.fenced_markdown(F.col("t"))) is None


@pytest.mark.parametrize(("text", "want"), [("x" * 50, "x" * 40), ("a" * 34 + ". " + "b" * 30, "a" * 34 + ". "), ("a" * 20 + ". " + "b" * 40, "a" * 20 + ". " + "b" * 18), ("a" * 35 + "\n" + "b" * 9, "a" * 35 + "\n"), ("a" * 33 + "! " + "b? " + "c" * 9, "a" * 33 + "! "), ("short", "short"), ("", ""), (None, None)])
def test_cut_tokens(spark, text, want):
    assert value(spark, T.cut_tokens(F.col("t"), 10), text) == want


def test_error_kinds_and_retries(spark):
    kinds = [value(spark, T.error_kind(F.col("t")), e) for e in ("Timeout after 3 s", "no text: empty file", "unsupported file type", "BadZipFile: x", None)]
    assert kinds == ["timeout", "no_text_extracted", "unsupported_type", "other", None]
    assert retrieval.passing(ValueError("HTTP 429")) and not retrieval.passing(ValueError("429: malformed vector")) and not retrieval.passing(ValueError("x"))
    assert retrieval.criteria_filter(vendor="A", week_number=0, client="") == {"vendor": "A"}
    assert retrieval.business_context({"vendor": {"$eq": "A"}, "year": {"$gt": 3}, "client": "B", "x": "y"}) == {"vendor": "A", "client": "B"} and retrieval.business_context({}) is None
    with pytest.raises(ValueError):
        retrieval.criteria_filter(colour="red")
    assert all("cloud (vendor: A)" in t for k in embedding.TEMPLATES for t in embedding.TemplateRewriter({"vendor": "A"}).rewrite("cloud", k))


def test_queue(spark, tmp_path):
    queue = BatchQueue(spark, str(tmp_path / "q"))
    assert queue.create(spark.range(25).select(F.col("id").alias("k")), "k", 10) == 3 and queue.complete()
    assert sorted(r.k for r in queue.rows(2).collect()) == list(range(10, 20)) and queue.next_batch() == 1
    queue.mark(1, "processing")
    queue.mark(1, "processed", 2)
    queue.mark(2, "failed")
    again = BatchQueue(spark, str(tmp_path / "q"))
    assert again.next_batch() == 3
    row = again.status().first()
    assert (row.n_batches, row.n_processed, row.n_failed, row.n_open, row.n_rows, row.n_rows_done, row.n_rows_failed, row.progress_percent) == (3, 1, 1, 1, 25, 8, 12, 80.0)
    with pytest.raises(ValueError):
        queue.mark(1, "lost")
    again.clear()
    assert not queue.complete() and value(spark, rate(F.lit(30), F.lit(60))) == 30.0 and value(spark, seconds_left(F.lit(5), F.lit(20), F.lit(10))) == 30.0


def test_kept_table(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(len(made))

    path = str(tmp_path / "t")
    assert [kept_table(spark, path, make).count() for _ in range(2)] == [1, 1] and kept_table(spark, path, make, hours=-1).count() == 2


def test_index_is_whole_after_a_break(spark, tmp_path):
    path = str(tmp_path / "ix")
    rows = lambda *r: spark.createDataFrame(list(r), "path string, chunk string")
    upsert_index(spark, path, rows(("a", "1"), ("a", "2"), ("b", "1")))
    upsert_index(spark, path, rows(("a", "9")))
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("a", "9"), ("b", "1")}
    rename(spark, path, f"{path}.old")
    upsert_index(spark, path, rows(("c", "1")))
    assert {r.path for r in spark.read.parquet(path).collect()} == {"a", "b", "c"} and children(spark, f"{path}.old") == []


def test_hybrid_against_brute_force(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta".split()
    rows = [(k, [rng.random() for _ in range(rng.choice([3, 3, 4]))] if k % 7 else None, " ".join(rng.choice(words) for _ in range(5)) if k % 5 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "k long, v array<double>, t string")
    asked = df.where("k % 9 = 0")

    def score(a, b):
        dense = sum(x * y for x, y in zip(a[1], b[1], strict=True)) if a[1] and b[1] and len(a[1]) == len(b[1]) else 0.0
        one, two = Counter((a[2] or "").split()), Counter((b[2] or "").split())
        return 0.3 * dense + 0.7 * sum(n * two[w] for w, n in one.items())

    for found in (retrieval.hybrid_topk(df, asked, "k", "v", "t", 4, 0.3), retrieval.hybrid_topk(df.repartition(5), asked, "k", "v", "t", 4, 0.3)):
        got = {(r.query_id, r["rank"]): (r.k, round(r.score, 6)) for r in found.collect()}
        for a in rows[::9]:
            best = sorted(((-round(score(a, b), 9), b[0]) for b in rows))[:4]
            assert [got[a[0], i + 1] for i in range(4)] == [(k, round(-s, 6)) for s, k in best]
    assert retrieval.hybrid_topk(df.limit(0), asked, "k", "v", "t", 4).count() == 0
    wide = retrieval.dense_topk(df, asked, "k", "v", 2).collect()
    size = {k: len(v) for k, v, _ in rows if v}
    assert all(size[r.query_id] == size[r.k] for r in wide) and {size[r.query_id] for r in wide} == {3, 4}
    terms = retrieval.term_topk(df, "k", "t", asked, "k", "t", 3).collect()
    text = {k: Counter((t or "").split()) for k, _, t in rows}
    assert all(r.score == sum(n * text[r.key][w] for w, n in text[r.query_id].items()) for r in terms) and terms


def test_places_of_values(spark):
    rng = random.Random(2)
    rows = [("hot" if k % 3 else f"g{k % 5}", rng.randrange(40) if k % 11 else None) for k in range(700)] + [("one", 5), ("none", None), (None, 3)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    got = {r.g: r for r in quality.index_percentiles(df, "g", "v").collect()}
    held = {}
    for g, v in rows:
        if v is not None and g is not None:
            held.setdefault(g, []).append(v)
    assert set(got) == set(held)
    for g, values in held.items():
        values.sort()
        assert (got[g].n, got[g].min_value, got[g].max_value) == (len(values), values[0], values[-1])
        assert [got[g].p50, got[g].p90, got[g].p99] == [values[int(len(values) * q)] for q in (0.5, 0.9, 0.99)]
    stats = {r.g: r for r in quality.score_stats(df, "g", "v").collect()}
    assert stats["one"].median_score == 5 and stats["one"].std_score == 0 and stats["none"].n_scores == 0 and stats["none"].median_score is None
    samples = quality.field_coverage(spark.createDataFrame([(str(k % 50), None) for k in range(200)], "a string, b string"), ["a", "b"]).collect()
    assert {r.field: (r.n_filled, r.samples) for r in samples} == {"a": (200, ["0", "1", "10"]), "b": (0, None)}
    assert quality.index_percentiles(df.limit(0), "g", "v").count() == 0


def test_list_reports(spark):
    frame = lambda rows: spark.createDataFrame(rows, "query_id string, rank int, key long, score double, vendor string")
    left = frame([("q", 1, 1, 0.9, "Acme Ltd"), ("q", 2, 2, 0.5, None), ("q", 3, 3, 0.4, "Zed"), ("r", 1, 1, 0.1, "")])
    right = frame([("q", 1, 2, 0.9, "x"), ("q", 2, 7, 0.8, "y")])
    got = {r.query_id: (r.n_common, round(r.of_left, 2), round(r.of_union, 2)) for r in evaluation.overlap_percent(left, right, "key").collect()}
    assert got == {"q": (1, 33.33, 25.0), "r": (0, 0.0, 0.0)}
    wanted = spark.createDataFrame([("q", ["acme", ""])], "query_id string, vendors array<string>")
    assert {r.query_id: r.n_vendor for r in evaluation.expected_matches(left, wanted, {"vendor": "vendors"}).collect()} == {"q": 1, "r": 0}
    metrics = evaluation.query_metrics(left.unionByName(frame([("s", None, None, None, None)])), F.lit("a"))
    assert evaluation.session_summary(metrics).first()[0] == 3 and round(evaluation.session_summary(metrics).first().empty_percent, 1) == 33.3
    assert evaluation.session_summary(metrics.limit(0)).first().n_queries == 0


def test_redacted_metadata_and_spans(spark):
    df = spark.createDataFrame([("Acme (EU)", "Deal of ACME (eu) now", "acme (eu).pdf"), (None, "Deal", "f"), ("", "Deal", "f")], "client string, deal string, name string")
    got = [tuple(r) for r in redaction.redact_metadata(df, "name", "client", ["deal"]).select("client", "deal", "name").collect()]
    assert got == [("<<CLIENT>>", "Deal of <<CLIENT>> now", "<<CLIENT>>.pdf"), (None, "Deal", "f"), ("", "Deal", "f")]
    spans = spark.createDataFrame([("k", 0, 40, 49, "ORG"), ("k", 1, 0, 9, "ORG"), ("k", 1, 30, 33, "PERSON")], "key string, window_no int, start long, stop long, kind string")
    assert [[tuple(s) for s in r.spans] for r in redaction.global_spans(spans, 50, 10).collect()] == [[(40, 49, "ORG"), (70, 73, "PERSON")]]
    names = spark.createDataFrame([("Acme Bank Holding",), ("acme",), ("Acmed",), ("",), ("Bank",)], "s string")
    clients = spark.createDataFrame([("Acme Bank",), ("Acme",), (None,)], "c string")
    found = {r.s: r.matched_client for r in redaction.organisation_clients(names, clients, "s", "c").collect()}
    assert found == {"Acme Bank Holding": "Acme Bank", "acme": "Acme Bank", "Bank": "Acme Bank"}


def test_stored_fields_of_a_bare_table(spark):
    row = records.stored_fields(spark.createDataFrame([("x" * 300, " nan ", "2020-01-01", ["e"])], "file_name string, deal_reason string, contract_end string, errs array<string>"), errors="errs").first()
    assert len(row) == 34 and (len(row.file_name), row.deal_reason, row.final_amount, row.has_parsing_errors, row.contract_end_ts, row.contract_start_ts) == (200, "", 0.0, True, 1_577_836_800, None)


def test_samples_and_pages(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(30)], "g int, k long")
    one, two = (sorted(tuple(r) for r in filters.sample_per_group(x, "g", "k", 2, 7).collect()) for x in (df, df.repartition(5)))
    assert one == two and len(one) == 6 and [r.k for r in filters.page(df, ["k"], 10, 3).collect()] == [10, 11, 12]


def test_wide_headings_and_tables():
    assert [n for n, _ in chunking.sections("a\nContact us\nb", headings=chunking.WIDE_HEADINGS)] == ["main", "contact"]
    assert chunking.segments("one\n| a | b |\n|---|---|\n| 1 | 2 |\n\n\n| 3 | 4 |\n\ntwo") == [("text", "one"), ("table", "=== a_b ===\na | b\n----------\n1 | 2\n3 | 4"), ("text", "two")]
    assert chunking.segments("| a | b |\ntext") == [("text", "| a | b |\ntext")]
    rules = chunking.ChunkRules(lossless=True, least=1)
    assert chunking.chunks_of("Overview\n" + "One two three four five. Short end.", rules)[0][2].endswith("Short end.")
