import io
import zipfile
from email.message import EmailMessage

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom import cli
from docloom.functions import records
from docloom.operators.embedding import HashEmbedder, breakpoints, embedded, sampled_pages, semantic_chunks
from docloom.sources import parsers
from docloom.sources.bundle import ExportBundle

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
A = "http://schemas.openxmlformats.org/drawingml/2006/main"


def packed(**files):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, body in files.items():
            z.writestr(name.replace("__", "/"), body)
    return data.getvalue()


def docx():
    para = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    cell = lambda t: f"<w:tc>{para(t)}</w:tc>"
    rows = "".join(f"<w:tr>{cell(a)}{cell(b)}</w:tr>" for a, b in (("Item", "Price"), ("Pen", "$1"), ("Ink", "$2")))
    return packed(**{"word/document.xml": f'<w:document xmlns:w="{W}"><w:body>{para("Opening words.")}<w:tbl>{rows}</w:tbl>{para("Closing.")}</w:body></w:document>'})


def xlsx():
    row = lambda n, cells: f'<row r="{n}">' + "".join(f'<c r="{c}{n}"{t}>{v}</c>' for c, t, v in cells) + "</row>"
    sheet = row(1, [("A", ' t="s"', "<v>0</v>"), ("C", ' t="inlineStr"', "<is><t>Total</t></is>")]) + row(2, [("A", "", "<v>5</v>"), ("C", "", "<v>7.5</v>")])
    return packed(**{
        "xl/workbook.xml": f'<workbook xmlns="{S}" xmlns:r="{R}"><sheets><sheet name="Costs" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{S}"><si><t>Name</t></si></sst>', "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{S}"><sheetData>{sheet}</sheetData></worksheet>',
    })


def pptx():
    slide = lambda *ts: f'<p xmlns:a="{A}">' + "".join(f"<a:p><a:t>{t}</a:t></a:p>" for t in ts) + "</p>"
    return packed(**{"ppt/slides/slide10.xml": slide("last"), "ppt/slides/slide2.xml": slide("one", "two")})


def eml():
    m = EmailMessage()
    m["From"], m["To"], m["Subject"] = "a@x.test", "b@x.test", "Offer"
    m.set_content("Take it.")
    m.add_attachment(b"x", maintype="application", subtype="pdf", filename="o.pdf")
    return m.as_bytes()


def test_parsers(spark):
    rows = [
        ("a.docx", docx()), ("a.xlsx", xlsx()), ("a.pptx", pptx()), ("a.eml", eml()), ("a.html", b"<p>one<br>two &amp; three</p><script>x</script>"), ("a.csv", b"h,k\n1,2\n"), ("a.txt", "é".encode("cp1252")),
        ("a.pdf", b"%PDF"), ("b.docx", b"no zip"), ("c.txt", b""), ("d.csv", ("h;k\n" + "1;2\n" * 1_200).encode()), ("e.txt", None),
    ]
    got = {r.path: r for r in parsers.parse_contents(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got["a.docx"].text == "Opening words.\n\n=== TABLE_1 ===\nItem | Price\n------------\nPen | $1\nInk | $2\n\nClosing." and got["a.docx"].n_tables == 1
    assert got["a.xlsx"].text == "=== Costs ===\nName |  | Total\n---------------\n5 |  | 7.5"
    assert got["a.pptx"].text == "=== Slide 2 ===\none\ntwo\n\n=== Slide 10 ===\nlast"
    assert "Subject: Offer" in got["a.eml"].text and "Attachments: o.pdf" in got["a.eml"].text and got["a.eml"].text.endswith("Take it.")
    assert got["a.html"].text == "one\ntwo & three" and got["a.txt"].text == "é"
    assert got["a.csv"].text == "=== Sheet1 ===\nh | k\n----------\n1 | 2"
    assert got["d.csv"].text.count("1 | 2") == 1_200
    cut = parsers.parse_contents(spark.createDataFrame(rows, "path string, content binary"), limits=parsers.MODES["balanced"])
    assert cut.where("path = 'd.csv'").first().text.endswith("... and 200 more rows")
    assert got["a.pdf"].error.startswith("no text") and "BadZipFile" in got["b.docx"].error and got["c.txt"].error == got["e.txt"].error == "no text: empty file"


def test_bundle(spark, tmp_path):
    (tmp_path / "ContentVersions/VersionData/v1").mkdir(parents=True)
    (tmp_path / "ContentVersions/VersionData/v1/a.pdf").write_text("x")
    table = lambda header, *rows: spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{h}` string" for h in header))
    versions = table(["Id", "ContentDocumentId", "IsLatest", "Title", "PathOnClient", "FileType", "Deal__c"], ["v1", "d1", "true", "A", "a.pdf", "PDF", "a0W1"], ["v2", "d2", "1", "B", None, "WORD_X", "nan"], ["v3", "d3", "false", "C", "c.pdf", "PDF", "a0W1"], ["v4", "d4", "yes", "D", "d.exe", "X", None], ["v5", "d5", "true", "E", "e.txt", None, None])
    deals = table(["Id", "Name", "Client__c", "Primary_Deal_Vendor__c", "Total_Proposed_Amount__c", "Total_Final_Amount__c"], ["a0W1", "Deal-12345", "001000000000001AAA", "x" * 18, "100000", "90000"])
    links = table(["Id", "ContentDocumentId", "LinkedEntityId"], ["1", "d2", "005x"], ["2", "d2", "a0W9"], ["3", "d2", "a0W1"])
    clients = table(["18 Digit ID", "Account Name"], ["001000000000001AAB", "Acme"])
    bundle = ExportBundle(versions, deals, links, clients)
    got = {r.cv_id: r for r in bundle.documents().collect()}
    assert set(got) == {"v1", "v2", "v5"}
    assert (got["v1"].mapping_status, got["v1"].deal_number, got["v1"].client_name, got["v1"].vendor_name, got["v1"].savings_percentage) == ("mapped", "12345", "Acme", "Vendor-xxxxxxxx", 10.0)
    assert (got["v2"].deal_id, got["v2"].mapping_status, got["v2"].file_type) == ("a0W9", "mapped_no_metadata", ".docx")
    assert (got["v5"].mapping_status, got["v5"].client_name) == ("unmapped", "Unknown Client")
    for name, df in (("v", versions), ("d", deals)):
        df.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    read = ExportBundle.read(spark, str(tmp_path / "v.csv"), str(tmp_path / "d.csv"), root=str(tmp_path))
    assert {r.cv_id: r.stored_path for r in read.documents().collect()}["v1"] == "ContentVersions/VersionData/v1/a.pdf"


def test_models(spark):
    model = HashEmbedder(64)
    v = model.embed(["the same words", "words the same", ""])
    assert np.allclose(v[0], v[1]) and not v[2].any()
    df = spark.createDataFrame([(1, "some words"), (2, None), (3, " ")], "k int, t string")
    assert [r.vector is None for r in embedded(df, "t", model).sort("k").collect()] == [False, True, True]
    parts = ["cats and dogs run fast"] * 5 + ["prices rise in the market now"] * 5
    assert breakpoints(parts, model, 80) == [" ".join(parts[:5]), " ".join(parts[5:])]
    assert semantic_chunks(df, "k", "t", model).count() == 0
    pages = lambda n: spark.range(1).select(sampled_pages(F.lit(n)).alias("p")).first().p
    assert pages(1) == [1] and pages(0) == [] and pages(90) == [*range(1, 11), *range(43, 48), *range(86, 91)]


def test_records(spark):
    df = spark.createDataFrame([((1, ("x",)), " None ", 2.5, "2020-01-01", "t" * 40_000)], "a struct<b:int,c:struct<d:string>>, file_name string, x double, contract_start string, text string")
    assert records.with_nested(df, "a.c.d", F.lit("y")).first().a.c.d == "y"
    row = records.stored(df).first()
    assert (row.file_name, len(row.text), row.contract_start_ts) == ("", 37_888, 1_577_836_800)
    assert records.backfill_seconds(df.withColumn("contract_start_ts", F.lit(None).cast("long")), ["contract_start"]).first().contract_start_ts == 1_577_836_800
    assert records.missing_fields(df, ["a", "zz"]) == (["zz"], ["contract_start", "file_name", "text", "x"])
    assert df.where(records.mentions([" None "], ["file_name", "text"])).count() == 1 and records.without(df, F.col("x") > 2).count() == 0
    assert df.select(records.chunk_key(F.lit("p"), F.lit(3)).alias("k")).first().k.endswith("-chunk-0003")
    assert df.select(records.size_class(F.col("x")).alias("k"), records.parser_label(F.lit(".docx"), "b").alias("l")).first() == ("medium", "word")


@pytest.mark.parametrize("strategy", ["business_aware", "semantic"])
def test_command_line(spark, tmp_path, strategy):
    root = tmp_path / "files" / "2024 Deal Docs" / "Week1-01012024" / "Atlan" / "Zoom" / "Deal-1-Atlan"
    root.mkdir(parents=True)
    (root / "quote.txt").write_text("The price of each licence is fixed for three years. Write to ann@x.test about it now. " * 30)
    (root / "contract.txt").write_text("The contract ends after two years unless both sides renew it in writing. " * 30)
    (root / "bad.docx").write_text("no zip")
    (root / "pic.png").write_bytes(b"x")

    def go(*args):
        return cli.run(spark, cli.parser().parse_args([str(a) for a in args]))

    go("discover", "--path", tmp_path / "files", "--output", tmp_path / "cat", "--min-size-kb", 0, "--hash")
    done = go("process", "--input", tmp_path / "cat", "--path", tmp_path / "files", "--index", tmp_path / "ix", "--enable-redaction", "--chunking-strategy", strategy).collect()
    assert {r.processed: r.n_files for r in done} == {True: 2, False: 1}
    first = spark.read.parquet(str(tmp_path / "ix")).count()
    go("process", "--input", tmp_path / "cat", "--path", tmp_path / "files", "--index", tmp_path / "ix", "--enable-redaction", "--chunking-strategy", strategy, "--filter-type", "quote/proposal")
    index = spark.read.parquet(str(tmp_path / "ix"))
    assert index.count() == first and index.where(F.col("chunk").contains("ann@x.test")).count() == 0
    for mode in ("traditional", "rewritten", "combined", "fallback"):
        rows = go("search", "--index", tmp_path / "ix", "--query", "when does the contract end", "--mode", mode).collect()
        assert rows[0]["rank"] == 1 and len({r.path for r in rows}) == len(rows)
    assert "contract" in go("search", "--index", tmp_path / "ix", "--query", "contract ends after two years").first().path
    (tmp_path / "q.txt").write_text("contract end\nlicence price\n")
    row = go("compare", "--left", tmp_path / "ix", "--right", tmp_path / "ix", "--queries", tmp_path / "q.txt", "--output", tmp_path / "cmp").first()
    assert (row.n_queries, row.mean_jaccard) == (2, 1.0)


def test_numbered_rows(spark):
    from docloom.session import numbered
    from docloom.streaming.feeds import batched

    rows = spark.range(1_000).repartition(7).select((F.col("id") * 3).alias("k"))
    assert sorted((x.k, x.at) for x in numbered(rows, "k", "at").collect()) == [(3 * i, i) for i in range(1_000)]
    assert {(x.batch_no, x["count"]) for x in batched(rows, "k", 300).groupBy("batch_no").count().collect()} == {(1, 300), (2, 300), (3, 300), (4, 100)}
