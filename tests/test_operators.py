
import hashlib

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.dates import epoch_seconds, year_of
from docloom.functions.nulls import clean_number, clean_text, money
from docloom.functions.paths import company_name, path_fields
from docloom.operators import enrich, filters, quality, redaction, retrieval, tables
from docloom.plans.texts import stored_text


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", list: "array<string>"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("c")).first().c


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("10/23/17 15:09", 1508771340), ("10/23/2017 15:09", 1508771340), ("2017-10-23", 1508716800), ("2017-10-23T15:09:00.000+0000", 1508771340),
        ("2017-10-23T15:09:00Z", 1508771340), ("2017-10-23T17:09:00+02:00", 1508771340), ("2017-10-23 15:09", 1508771340), ("1/2/69", -31449600), ("13/1/2020", None), ("nan", None), ("", None), (None, None),
    ],
)
def test_epoch_seconds(spark, value, want):
    assert one(spark, epoch_seconds(F.col("v")), v=value) == want


def test_small_functions(spark):
    assert one(spark, year_of(F.col("v")), v="2019-10-03 22:02:41") == 2019
    assert one(spark, clean_text(F.col("v")), v=" None ") == ""
    assert one(spark, clean_number(F.col("v")), v="x") == 0.0
    assert [one(spark, money(F.col("v")), v=v) for v in ("$1,200.50", "0", "nan", None, "0.0")] == [1200.5, None, None, None, 0.0]
    assert one(spark, company_name(F.col("v")), v="ZOOM_video-Communications") == "Zoom Video Communications"
    assert one(spark, T.without_html(F.col("v")), v="<p>a&nbsp;b</p>&amp;c") == "a b&c"
    assert one(spark, T.normal_markdown(F.col("v")), v="a  \r\n\r\n\r\n\r\nb") == "a\n\nb"
    assert one(spark, T.first_kind(F.col("v"), T.ERROR_KINDS, "other"), v="Download failed") == "download_failed"
    for text in ("abc" * 5, "é" * 20, "a€b" * 10, "😀" * 9, "ab😀é€" * 6):
        for most in (10, 11, 12, 13):
            got = one(spark, T.cut_bytes(F.col("v"), most), v=text)
            want = next(text[:k] for k in range(len(text), -1, -1) if len(text[:k].encode()) <= most)
            assert got == want


def test_stored_text_is_cut_where_the_index_cuts(spark, tmp_path):
    texts = ["a" * 4_097, "é" * 18_944, "é" * 18_945, "x" + "é" * 18_944, "ab" + "😀" * 9_472, "b" * 50_000, "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text_md5 for r in stored_text(spark, str(tmp_path)).collect()}
    whole = ["a" * 4_097, "é" * 18_944, "é" * 18_944, "x" + "é" * 18_943, "ab" + "😀" * 9_471, "b" * 37_888, "", None]
    assert got == {k: None if t is None else hashlib.md5(t.encode()).hexdigest() for k, t in enumerate(whole)}


def test_path_fields(spark):
    df = spark.createDataFrame([("/Root/2024 Deal Docs/Week1-01012024/Atlan/Zoom_Video/Deal-55317-Atlan/a.pdf",), ("a.pdf",), (None,)], "path string")
    rows = path_fields(df, "path").collect()
    assert (rows[0].year, rows[0].week_number, rows[0].week_date, rows[0].vendor, rows[0].client, rows[0].deal_number) == ("2024", 1, "01/01/2024", "Atlan", "Zoom Video", "55317")
    assert rows[0].confidence == pytest.approx(1.1)
    assert rows[1].confidence == rows[2].confidence == 0.0


def test_filter_language_and_reasons(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", None), (3, None, 7.0)], "k int, s string, x double")
    keep = lambda spec: [r.k for r in df.where(filters.compile_filter(spec)).sort("k").collect()]
    assert keep({}) == [1, 2, 3]
    assert keep({"x": {"$gte": 5, "$lt": 7}}) == [1]
    assert keep({"$or": [{"s": "b"}, {"x": {"$gt": 6}}]}) == [2, 3]
    assert keep({"s": {"$in": ["a", "b"]}, "k": {"$ne": 1}}) == [2]
    assert keep({"s": {"$exists": False}}) == [3]
    files = spark.createDataFrame(
        [("a.PNG", "p/a.PNG", None, 10, None, "2020-01-01"), ("b", "x/b.pdf", None, None, None, "2020-01-01"), ("c.pdf", "c.pdf", ".pdf", 999_999, 0.95, "soon"), ("d.pdf", "d.pdf", "PDF", 999_999, 0.95, "2020-01-01")],
        "name string, path string, file_type string, size long, size_mb double, modified_time string",
    )
    rule = filters.CatalogFilter(min_size_kb=1, modified_after="2019-01-01")
    assert [r.reject_reason for r in filters.with_reasons(files, rule).sort("name").collect()] == ["file_type", "min_size", "modified_missing", None]
    assert filters.seeded_sample(files, "name", 2, 1).collect() == filters.seeded_sample(files.repartition(3), "name", 2, 1).collect()


def test_match_files_by_each_method(spark):
    mapping = spark.createDataFrame(
        [(1, "a.pdf", "x/y/a.pdf", "A"), (2, "b.pdf", "q/r/other.pdf", "B"), (3, "c.pdf", "deep/down/z/c2.pdf", "C"), (4, "d.pdf", "m/d.pdf", "D"), (5, "e", "n/e.bin", "E"), (6, "f-old.pdf", "o/f.pdf", "F"), (7, "a.pdf", "again/a.pdf", "G")],
        "seq long, file_name string, relative_path string, ref string",
    )
    files = spark.createDataFrame([("a.pdf", "1/a.pdf"), ("x.pdf", "q/r/other.pdf"), ("c2.pdf", "z/c2.pdf"), ("d_v2.pdf", "2/d_v2.pdf"), ("e.doc", "3/e.doc"), ("f.pdf", "4/f.pdf"), ("no.pdf", "5/no.pdf")], "name string, path string")
    got = {r.name: (r.method, r.ref) for r in enrich.match_files(files, mapping).collect()}
    assert got == {
        "a.pdf": ("exact_name", "A"), "x.pdf": ("exact_path", "B"), "c2.pdf": ("path_ending", "C"), "d_v2.pdf": ("version_name", "D"), "e.doc": ("bare_name", "E"),
        "f.pdf": ("base_name", "F"), "no.pdf": (None, None),
    }


def test_joins(spark):
    versions = spark.createDataFrame([("cv1", "d1", "deal1"), ("cv2", "d2", None), ("cv3", None, "nan")], "cv_id string, document_id string, deal_id string")
    listing = spark.createDataFrame([("ContentVersion/cv1",), ("ContentVersions/VersionData/cv1/a.pdf",), ("Attachments/Body/d2",), ("Deal__cs/0EM1/deal1/.hidden",)], "path string")
    assert {r.cv_id: r.stored_path for r in enrich.resolve_paths(versions, listing).collect()} == {"cv1": "ContentVersion/cv1", "cv2": "Attachments/Body/d2", "cv3": None}
    left = spark.createDataFrame([("k", "old"), ("m", "kept")], "name string, v string")
    right = spark.createDataFrame([("k", "")], "name string, v string")
    assert sorted((r.name, r.v) for r in enrich.overlay(left, right, "name", ["v"]).collect()) == [("k", ""), ("m", "kept")]
    chunks = spark.createDataFrame([("d", 0, "s1", "a"), ("d", 1, "s1", "b"), ("d", 3, "s2", "c")], "k string, i int, s string, t string")
    assert enrich.reconstruct(chunks, "k", "i", "t", F.col("s")).first().full_text == "=== s1 ===\na\nb\n=== s2 ===\nc"
    assert enrich.chunk_gaps(chunks, "k", "i").first().has_gap
    assert enrich.ordered_distinct(chunks, F.col("s"), "t", "i").count() == 2


def test_quality(spark):
    df = spark.createDataFrame([("a", 0, 1.5, True), ("none", 3, float("nan"), False), (None, None, 0.0, None)], "s string, n int, x double, b boolean")
    got = {r.field: (r.n_filled, r.n_empty, r.samples) for r in quality.field_coverage(df, ["s", "n", "x", "b"]).collect()}
    assert got == {"s": (1, 2, ["a"]), "n": (1, 2, ["3"]), "x": (1, 2, ["1.5"]), "b": (1, 2, ["true"])}
    values = spark.createDataFrame([("g", float(v)) for v in range(100)], "g string, v double")
    row = quality.index_percentiles(values, "g", "v").first()
    assert (row.p50, row.p90, row.p99) == (50.0, 90.0, 99.0)
    assert quality.score_stats(values.limit(1), "g", "v").first().std_score == 0.0


def test_redaction(spark):
    text = "Mail a.b@x.com and c@y.org, call (555) 123-4567 or 555-987-6543, visit 123 Main Street, Suite 100. Ratio 0.5900001234."
    row = redaction.redact_contacts(spark.createDataFrame([(text,), (None,)], "t string"), "t").collect()
    assert (row[0].n_email, row[0].n_phone, row[0].n_address) == (2, 2, 1)
    assert "0.5900001234" in row[0].redacted and row[1].redacted is None
    registry = spark.createDataFrame([("c1", "The Acme & Sons Holdings Inc.", "Retail", "ACM|Acme Boys"), ("c2", "Zed Corp", None, None)], "client_id string, client_name string, industry_label string, aliases string")
    docs = spark.createDataFrame([("THE ACME & SONS Holdings Inc. met acm_x and Acme and Sons Group Authority", "c1"), ("Zed and ZedCorp", "c2"), ("free", None), (None, "c1")], "t string, c string")
    got = [(r.client_redacted, r.n_client) for r in redaction.redact_clients(docs, "t", "c", registry).collect()]
    assert got[1] == ("<<CLIENT: Client Organization>> and <<CLIENT: Client Organization>>", 2)
    assert "acm" not in got[0][0].lower().replace("acme and sons group authority", "") and got[2] == ("free", 0) and got[3] == (None, 0)
    fails = redaction.failures(F.col("t"), F.col("k"), F.col("n"))
    rows = spark.createDataFrame([("a@b.co 555-987-6543 Zed-x", "", "zed"), ("555-987-6543 Zedx", ".csv", "zed")], "t string, k string, n string").select(fails.alias("f")).collect()
    assert [r.f for r in rows] == [["email", "phone", "client"], []]


def test_spans_and_windows(spark):
    text = "".join(chr(97 + k % 26) for k in range(1234))
    parts = one(spark, redaction.windows(F.col("v"), 500, 50), v=text)
    assert all(text[p.offset : p.offset + 500] == p.part for p in parts) and parts[-1].offset + len(parts[-1].part) == len(text)
    df = spark.createDataFrame([("ab John cd Acme <<EMAIL>> x", [(3, 7, "person"), (5, 7, "org"), (11, 15, "org"), (18, 23, "org")])], "t string, s array<struct<start:bigint,stop:bigint,kind:string>>")
    merged = redaction.merge_spans(F.col("s"))
    out = df.select(redaction.apply_spans(F.col("t"), merged, {"person": "<<PERSON>>", "org": "<<ORG>>"}).alias("c")).first().c
    assert out == "ab <<PERSON>> cd <<ORG>> <<EMAIL>> x"


def test_tables(spark):
    rows = [["Name", "Name", "Price"], ["A", "A", "$ 10"], [None, "", None], ["B", None, "5"]]
    df = spark.createDataFrame([(rows,)], "r array<array<string>>")
    got = df.select(tables.table_text(F.col("r"), F.lit("P"), F.lit(2)).alias("t"), tables.table_words(F.col("r")).alias("w"), tables.has_currency(F.col("r")).alias("c"), tables.page_text(F.lit(" hi "), F.array("r"), F.lit(1)).alias("p")).first()
    assert got.t == "=== P (Page 2) ===\nName |  | Price\n" + "-" * 15 + "\nA |  | $ 10\nB |  | 5"
    assert (got.w, got.c) == (9, True)
    assert got.p.startswith("hi\n\n=== TABLE_P1_1 (Page 1) ===")
    cells = spark.createDataFrame([([(0, 0, 1, 2, "h"), (1, 0, 1, 1, "a"), (1, 1, 1, 1, "b")],)], "c array<struct<row:int,col:int,row_span:int,col_span:int,text:string>>")
    assert cells.select(tables.spread_spans(F.col("c"), F.lit(2), F.lit(2)).alias("g")).first().g == [["h", "h"], ["a", "b"]]


def test_retrieval(spark):
    base = spark.createDataFrame([(i, [float(i % 5), 1.0, float(-i)]) for i in range(40)] + [(99, None), (98, [1.0])], "k long, v array<float>")
    asked = base.where("k < 3")
    got = retrieval.dense_topk(base, asked, "k", "v", 3).collect()
    for row in got:
        scores = sorted(((-(float(i % 5) * (row.query_id % 5) + 1 + i * row.query_id), i) for i in range(40)))
        assert (-scores[row["rank"] - 1][0], scores[row["rank"] - 1][1]) == (row.score, row.k)
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "z")], "query_id int, rank int, k string")
    b = spark.createDataFrame([(1, 1, "y"), (1, 2, "x"), (1, 3, "w")], "query_id int, rank int, k string")
    row = retrieval.compare_lists(a, b, "k").first()
    assert (row.jaccard, row.n_both, row.rank_correlation) == (0.5, 2, -1.0)
    first = spark.createDataFrame([(1, "x", 1.0)], "query_id int, key string, score double")
    second = spark.createDataFrame([(1, "x", 2.0), (1, "y", 1.5)], "query_id int, key string, score double")
    assert [(r.key, r.score) for r in retrieval.merge_results(first, second, 5).sort("rank").collect()] == [("x", 2.0), ("y", 1.5)]
    assert retrieval.with_fallback(first, second, 4).count() == 2
    index = spark.createDataFrame([("d1", 0, "a"), ("d1", 1, "b"), ("d2", 0, "c")], "d string, i int, t string")
    assert retrieval.replace_documents(index, index.where("d = 'd1' and i = 0"), "d").count() == 2
    changed = retrieval.update_metadata(index.withColumnRenamed("d", "id"), spark.createDataFrame([("d2", "new")], "id string, t string"), "id", ["t"])
    assert {r.t for r in changed.collect()} == {"a", "b", "new"}
    assert retrieval.vector_faults(base, "v", 3).first().asDict() == {"n_vectors": 42, "n_wrong_size": 2, "n_zero": 0, "n_not_a_number": 0}


def test_sources_and_sinks(spark, tmp_path):
    from docloom.sources.files import FolderSource, id_names, read_catalog, read_export
    from docloom.sources.sinks import no_special_numbers, upsert, write_report, write_table
    from docloom.streaming.feeds import batched, discover, latest_status, pending

    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, body in (("a.txt", "hello"), ("sub/b.PDF", "x" * 3_000), (".hid.txt", "n"), ("c.exe", "n")):
        (tmp_path / "in" / name).write_text(body)
    source = FolderSource(spark, str(tmp_path / "in"))
    assert sorted((r.name, r.file_type, r.size) for r in source.list_documents().collect()) == [("a.txt", ".txt", 5), ("b.PDF", ".pdf", 3000)]
    assert source.hashes().count() == 2 and source.info().count() == 2
    assert sorted(r.batch_no for r in source.batches(1).collect()) == [0, 1]
    (tmp_path / "m.csv").write_bytes("﻿18 Digit ID,Account Name\n1,\"Acme, \nInc\"\n".encode())
    assert [tuple(r) for r in id_names(read_export(spark, str(tmp_path / "m.csv"))).collect()] == [("1", "Acme, \nInc", None)]
    (tmp_path / "c.json").write_text('{"documents": [{"file_info": {"path": "p", "size": 3}, "deal_metadata": {"deal_id": "d"}}, {"file_info": {"path": "q"}}]}')
    assert [r.file_info.path for r in read_catalog(spark, str(tmp_path / "c.json")).collect()] == ["p", "q"]
    df = spark.createDataFrame([(1, float("nan"), ["x", "y"]), (2, 1.234, None)], "k int, v double, a array<string>")
    assert [r.v for r in no_special_numbers(df).sort("k").collect()] == [None, 1.234]
    write_table(df, str(tmp_path / "t"), ["k"])
    write_report(df, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).where("k = 1").first().a == "x; y"
    out = str(tmp_path / "sent")

    def send(rows, out=out):
        import json
        import os
        import uuid

        os.makedirs(out, exist_ok=True)
        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            json.dump([r["k"] for r in rows], f)

    upsert(df, send, 1)
    assert len(list((tmp_path / "sent").iterdir())) == 2
    (tmp_path / "feed").mkdir()
    for k in range(2):
        (tmp_path / "feed" / f"{k}.json").write_text(f'{{"id": "{k}"}}\n')
        discover(spark, str(tmp_path / "feed"), "id string", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == k + 1
    log = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, False)], "id string, at int, done boolean")
    status = latest_status(log, "id", "at")
    assert [r.id for r in pending(log.select("id").distinct(), status, "id", F.col("done")).collect()] == ["b"]
    assert sorted(r.batch_no for r in batched(log, "at", 2).collect()) == [1, 1, 2]


