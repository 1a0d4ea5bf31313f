"""Old and portable formats, from files built here byte by byte."""

import datetime as dt
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from docloom.sources import ole, parsers, pdf
from docloom.sources.files import export_faults, read_catalog, read_export


def compound(streams):
    """A compound file with 512-byte sectors; streams shorter than 4,096 bytes go to the small stream."""
    entries = [["Root Entry", 5, None, b""]]
    folders = {}
    for path, data in streams.items():
        *above, name = path.split("/")
        for k in range(len(above)):
            folders.setdefault("/".join(above[: k + 1]), len(folders))
        entries.append([name, 2, "/".join(above), data])
    number = {}
    for path in folders:
        *above, name = path.split("/")
        number[path] = len(entries)
        entries.append([name, 1, "/".join(above), b""])
    children = {}
    for i, (_, kind, above, _) in enumerate(entries):
        if i:
            children.setdefault(number.get(above, 0) if above else 0, []).append(i)
    fat, sectors, mini, minifat = [], [], b"", []

    def put(data):
        start, n = len(sectors), -(-len(data) // 512)
        for k in range(n):
            sectors.append(data[512 * k : 512 * k + 512].ljust(512, b"\0"))
            fat.append(len(sectors) if k + 1 < n else ole.END)
        return start if n else ole.END

    places = []
    for _, kind, _, data in entries:
        if kind == 2 and len(data) < 4_096:
            start, n = len(minifat), -(-len(data) // 64)
            minifat += [start + k + 1 if k + 1 < n else ole.END for k in range(n)]
            mini += data.ljust(64 * n, b"\0")
            places.append((start if n else ole.END, len(data)))
        else:
            places.append((put(data), len(data)) if kind == 2 else (ole.END, 0))
    places[0] = (put(mini), len(mini))
    table = put(struct.pack(f"<{len(minifat)}I", *minifat))
    rows = b""
    for i, (name, kind, _, _) in enumerate(entries):
        raw = name.encode("utf-16-le")
        own, siblings = children.get(i, []), next((c for c in children.values() if i in c), [])
        after = siblings[siblings.index(i) + 1] if i in siblings and siblings.index(i) + 1 < len(siblings) else ole.FREE
        rows += raw.ljust(64, b"\0") + struct.pack("<HBB3I", len(raw) + 2, kind, 1, ole.FREE, after, own[0] if own else ole.FREE) + b"\0" * 36 + struct.pack("<2I", *places[i]) + b"\0" * 4
    directory = put(rows)
    n = -(-(len(fat) + 1) // 128)
    first = len(sectors)
    fat += [0xFFFFFFFD] * n
    packed = struct.pack(f"<{len(fat)}I", *fat).ljust(512 * n, b"\xff")
    sectors += [packed[512 * k : 512 * k + 512] for k in range(n)]
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<5H", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10
    head += struct.pack("<8I", n, directory, 0, 4_096, table, 1 if minifat else 0, ole.END, 0)
    return head + struct.pack("<109I", *[first + k if k < n else ole.FREE for k in range(109)]) + b"".join(sectors)


def msg():
    wide = lambda s: s.encode("utf-16-le")
    ticks = int((dt.datetime(2024, 5, 6, 7, 8, tzinfo=dt.timezone.utc) - dt.datetime(1601, 1, 1, tzinfo=dt.timezone.utc)).total_seconds()) * 10_000_000
    return compound({
        "__substg1.0_0037001F": wide("Öffer"), "__substg1.0_1000001F": wide("Hello,\r\n" + "words " * 1_200), "__substg1.0_0C1A001F": wide("Ann Lee"), "__substg1.0_0C1F001F": wide("a@x.test"),
        "__substg1.0_0E04001E": b"Bob", "__properties_version1.0": b"\0" * 32 + struct.pack("<IIQ", 0x00390040, 6, ticks), "__attach_version1.0_#00000000/__substg1.0_3707001F": wide("o.pdf"), "__attach_version1.0_#00000001/__substg1.0_3701": b"x",
    })


def test_stored_mail():
    text, _ = parsers.stored_mail(msg())
    assert text.startswith("From: Ann Lee <a@x.test>\nTo: Bob\nSubject: Öffer\nDate: 2024-05-06 07:08:00+00:00\nAttachments: o.pdf; unnamed\n\nHello,\nwords")
    assert text.count("words") == 1_200
    got = parsers.mail_summary(msg())
    assert (got["email_sender"], got["email_has_attachments"], len(got["email_body_preview"])) == ("Ann Lee", True, 150)


def test_old_word():
    one, two = "Costs \x13 HYPERLINK x \x14here\x15.\r".encode("cp1252"), "A\x07B\x07\x07Ünd 😀".encode("utf-16-le")
    main = bytearray(0x400)
    struct.pack_into("<H", main, 10, 0x200)
    n1, n2 = len(one), len(two) // 2
    at = len(main)
    main += one + two
    plc = struct.pack("<3I", 0, n1, n1 + n2) + struct.pack("<HIH", 0, at * 2 | 0x40000000, 0) + struct.pack("<HIH", 0, at + n1, 0)
    clx = b"\x01\x02\x00zz" + b"\x02" + struct.pack("<I", len(plc)) + plc
    struct.pack_into("<2I", main, 0x1A2, 0, len(clx))
    assert ole.document_text(compound({"WordDocument": bytes(main).ljust(5_000, b"\0"), "1Table": clx})) == "Costs here.\nA | B\nÜnd 😀"


def record(kind, body):
    return struct.pack("<2H", kind, len(body)) + body


def test_old_workbook():
    text = lambda s: struct.pack("<HB", len(s), 0) + s.encode("latin-1")
    sst = record(0xFC, struct.pack("<2I", 3, 3) + text("Name") + text("Total") + struct.pack("<HB", 6, 0) + b"ab") + record(0x3C, b"\x01" + "cdé€".encode("utf-16-le"))
    cell = lambda kind, r, c, body: record(kind, struct.pack("<3H", r, c, 0) + body)
    rows = cell(0xFD, 0, 0, struct.pack("<I", 0)) + cell(0xFD, 0, 1, struct.pack("<I", 1)) + cell(0xFD, 1, 0, struct.pack("<I", 2)) + cell(0x203, 1, 1, struct.pack("<d", 2.5))
    rows += cell(0x27E, 2, 0, struct.pack("<I", (1_250 << 2) | 3)) + cell(0x06, 2, 1, struct.pack("<d", 7.0) + b"\0" * 8) + record(0xBD, struct.pack("<2H", 3, 0) + struct.pack("<HI", 0, 5 << 2 | 2) * 2 + b"\1\0")
    rows += cell(0x06, 4, 0, b"\0" * 6 + b"\xff\xff" + b"\0" * 8) + record(0x207, struct.pack("<HB", 2, 0) + b"ok")
    bof, eof = record(0x809, b"\0" * 16), record(0x0A, b"")
    sheet = lambda at: record(0x85, struct.pack("<IH", at, 0) + b"\x05\x00Costs")
    head = len(bof + sheet(0) + sst + eof)
    data = compound({"Workbook": bof + sheet(head) + sst + eof + bof + rows + eof})
    assert ole.workbook_sheets(data) == [("Costs", [["Name", "Total"], ["abcdé€", "2.5"], ["12.5", "7"], ["5", "5"], ["ok", ""]])]
    assert parsers.old_workbook(data)[0].startswith("=== Costs ===\nName | Total\n")


def test_old_slides():
    atom = lambda kind, body, v=0: struct.pack("<2HI", v, kind, len(body)) + body
    show = atom(0x3E8, atom(0xFF0, atom(0xFA0, "Títle\rtwo".encode("utf-16-le")) + atom(0xFA8, b"plain"), 0xF), 0xF) + atom(0x1, b"zz")
    assert ole.slide_text(compound({"PowerPoint Document": show})) == "Títle\ntwo\nplain"


def test_damaged_compound_files():
    with pytest.raises(ValueError):
        ole.Compound(b"no")
    for size in (512, 600, 6_000, 12_000):
        try:
            ole.Compound(msg()[:size])
        except (ValueError, struct.error):
            pass


def made_pdf(*contents, fonts="", extra=""):
    parts = [b"%PDF-1.5\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj\n2 0 obj <</Type /Pages /Kids [" + b" ".join(b"%d 0 R" % (10 + i) for i in range(len(contents))) + b"] /Resources <</Font <</F1 5 0 R " + fonts.encode() + b">>>> >> endobj\n5 0 obj <</Type/Font/Subtype/Type1/Encoding/WinAnsiEncoding>> endobj\n" + extra.encode("latin-1")]
    for i, body in enumerate(contents):
        packed = zlib.compress(body)
        parts.append(b"%d 0 obj <</Type/Page/Parent 2 0 R/Contents %d 0 R>> endobj\n%d 0 obj <</Length %d/Filter/FlateDecode>> stream\n" % (10 + i, 100 + i, 100 + i, len(packed)) + packed + b"\nendstream endobj\n")
    return b"".join(parts) + b"trailer <</Root 1 0 R>>\n%%EOF"


def test_pdf_text_and_tables():
    one = b"BT /F1 10 Tf 50 700 Td (First \\(line\\) caf\\351) Tj 0 -14 Td [(Sec) 20 (ond) -250 (line)] TJ ET"
    two = b"BT /F1 10 Tf 1 0 0 1 50 600 Tm (Item) Tj 1 0 0 1 200 600 Tm (Price) Tj 1 0 0 1 50 585 Tm (Pen) Tj 1 0 0 1 200 585 Tm <2431> Tj 1 0 0 1 50 570 Tm (Ink) Tj 1 0 0 1 200 570 Tm ($2) Tj 0 -20 TD (Closing) ' ET"
    text, tables = parsers.portable(made_pdf(one, two, b"BT ET"))
    assert text.startswith("=== Page 1 ===\nFirst (line) café\nSecond line\n\n=== Page 2 ===\n") and tables == 1
    assert "=== TABLE_1 ===\nItem | Price\n------------\nPen | $1\nInk | $2\n" in text and text.rstrip().endswith("Closing")


def test_pdf_unicode_maps():
    cmap = "begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <00D6> <0002> <D83DDE00> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange 1 beginbfrange <0020> <0021> [<0078> <0079>] endbfrange"
    extra = f"6 0 obj <</Type/Font/Subtype/Type0/ToUnicode 7 0 R>> endobj\n7 0 obj <</Length {len(cmap)}>> stream\n{cmap}\nendstream endobj\n8 0 obj <</Type/Font/Subtype/Type1/Encoding <</Differences [1 /fi /eacute /A /uni20AC]>> >> endobj\n"
    body = b"BT /F2 12 Tf 10 50 Td <000100020010001100120020> Tj ET BT /F3 12 Tf 10 20 Td (\\001\\002\\003\\004) Tj ET"
    assert parsers.portable(made_pdf(body, fonts="/F2 6 0 R /F3 8 0 R", extra=extra))[0] == "=== Page 1 ===\nÖ😀abcx\nfiéA€"


def test_pdf_faults():
    assert parsers.portable(b"%PDF-1.4 nothing")[0] == ""
    for bad in (b"none", made_pdf(b"BT ET").replace(b"trailer <<", b"trailer <</Encrypt 9 0 R")):
        with pytest.raises(ValueError):
            parsers.portable(bad)
    packed = zlib.compress(b"3 0 4 19 <</Type/Catalog>> <</Type/Page>>")
    doc = pdf.Document(b"%%PDF\n9 0 obj <</Type/ObjStm/N 2/First 8/Length %d/Filter/FlateDecode>> stream\n" % len(packed) + packed + b"\nendstream endobj")
    assert doc.objects[3]["Type"] == "Catalog" and doc.objects[4] == {"Type": "Page"}
    assert pdf._unpredicted(bytes([2, 1, 2, 2, 1, 1]), {"Predictor": 12, "Columns": 2}) == bytes([1, 2, 2, 3])


def test_exports_in_any_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿Id, Name \n1,"Zoë\nLee"\n2,x,extra\n3\n'.encode())
    (tmp_path / "b.csv").write_bytes("Id,Name\n1,Zoë €\n".encode("cp1252"))
    read = read_export(spark, str(tmp_path / "a.csv"))
    assert read.columns == ["Id", "Name", "_corrupt"]
    assert [(r.Id, r.Name) for r in read.sort("Id").collect()] == [("1", "Zoë\nLee"), ("2", "x"), ("3", None)]
    assert export_faults(read).first() == (3, 2)
    assert read_export(spark, str(tmp_path / "b.csv")).first().Name == "Zoë €"


def test_catalogs_with_and_without_a_head(spark, tmp_path):
    one = '{"file_info": {"path": "p", "size": 3}}'
    (tmp_path / "a.json").write_text(f'{{"documents": [{one}, {one}]}}')
    (tmp_path / "b.json").write_text(f"[{one}, {one}, {one}]")
    for name, n in (("a", 2), ("b", 3)):
        rows = read_catalog(spark, str(tmp_path / f"{name}.json"))
        assert rows.count() == n and rows.select(F.col("file_info.path")).distinct().first()[0] == "p"
