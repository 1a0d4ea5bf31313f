"""Contents of files to text, by extension; what the standard library can read, with room for more.

``register`` adds a parser for an extension (images need a recogniser of their own). A file
without a parser, or one that cannot be read, gives a row with an error and no text; it never stops a job. Files are read
whole unless ``limits`` are asked for; the modes of :data:`MODES` are named sets of them.
"""

from __future__ import annotations

import csv
import html
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from email import message_from_bytes, policy
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from docloom.sources import ole, pdf


@dataclass(frozen=True)
class Limits:
    """Rows of a table, pages of a file and characters of a cell that are kept at most; None keeps all."""

    rows: int | None = None
    pages: int | None = None
    cell: int | None = None


# Named limits, from everything to samples.
MODES = {"full": Limits(), "conservative": Limits(10_000, 1_000, 5_000), "balanced": Limits(1_000, 200, 1_000), "aggressive": Limits(200, 50, 200)}
_limits = Limits()
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"

Parsed = tuple[str, int]  # the text and the number of tables in it


def decode(data: bytes) -> str:
    """Text by byte order mark, as UTF-8, else as Windows Latin."""
    for code in ("utf-8-sig", "cp1252"):
        try:
            return data.decode("utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else code)
        except UnicodeDecodeError:
            continue
    return data.decode("latin-1")


def use_limits(limits: Limits) -> None:
    """Set the limits of this process; a task does so before it parses."""
    global _limits
    _limits = limits


def table(rows: list[list[str]], name: str) -> str:
    """The titled form: repeated neighbours blanked; beyond the limit of rows a note of how many more there are."""
    limits = _limits
    rows = [r for r in rows if any(c.strip() for c in r)]
    if not rows:
        return ""
    kept = rows if limits.rows is None else rows[: limits.rows + 1]
    lines = [" | ".join("" if k and c == r[k - 1] else c.strip()[: limits.cell] for k, c in enumerate(r)) for r in kept]
    more = len(rows) - len(kept)
    note = [f"... and {more} more rows"] if more > 0 else []
    return "\n".join([f"=== {name} ===", lines[0], "-" * max(10, min(100, len(lines[0]))), *lines[1:], *note])


def plain(data: bytes) -> Parsed:
    return decode(data), 0


def markup(data: bytes) -> Parsed:
    bare = re.sub(r"(?is)<(script|style)\b.*?</\1>", " ", decode(data))
    bare = re.sub(r"(?i)<(?:br|/p|/div|/tr|/li|/h\d)\b[^>]*>", "\n", bare)
    return re.sub(r"[ \t\xa0]+", " ", html.unescape(re.sub(r"<[^>]+>", "", bare))).strip(), 0


def separated(data: bytes) -> Parsed:
    text = decode(data)
    try:
        dialect = csv.Sniffer().sniff(text[:4_096], ",;\t|")
    except csv.Error:
        dialect = csv.excel
    body = table(list(csv.reader(io.StringIO(text), dialect)), "Sheet1")
    return body, int(bool(body))


def word(data: bytes) -> Parsed:
    """Paragraphs and tables of a word document in their order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    said = lambda node: "".join("\n" if x.tag == f"{_W}br" else "\t" if x.tag == f"{_W}tab" else x.text or "" for x in node.iter() if x.tag in (f"{_W}t", f"{_W}br", f"{_W}tab"))
    parts, tables = [], 0
    for node in body if body is not None else ():
        if node.tag == f"{_W}p":
            parts.append(said(node))
        elif node.tag == f"{_W}tbl":
            rows = [["\n".join(map(said, cell.iter(f"{_W}p"))).replace("\n", " ") for cell in row.iter(f"{_W}tc")] for row in node.iter(f"{_W}tr")]
            if made := table(rows, f"TABLE_{tables + 1}"):
                tables += 1
                parts += ["", made, ""]
    return "\n".join(parts).strip(), tables


def workbook(data: bytes) -> Parsed:
    """Each sheet of a workbook as a table under its name."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        strings: list[str] = []
        if "xl/sharedStrings.xml" in names:
            strings = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        parts = []
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"):
            target = links[sheet.get(f"{_R}id")].lstrip("/")
            rows = []
            for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_S}row"):
                cells: list[str] = []
                for c in row.iter(f"{_S}c"):
                    at = 0
                    for letter in re.match(r"[A-Z]*", c.get("r", ""))[0]:
                        at = at * 26 + ord(letter) - 64
                    cells += [""] * (at - 1 - len(cells))
                    value = c.find(f"{_S}v")
                    raw = value.text or "" if value is not None else "".join(t.text or "" for t in c.iter(f"{_S}t"))
                    cells.append(strings[int(raw)] if c.get("t") == "s" and raw else raw)
                rows.append(cells)
            if made := table(rows, sheet.get("name", "Sheet")):
                parts.append(made)
    return "\n\n".join(parts), len(parts)


def slides(data: bytes) -> Parsed:
    """The text of each slide under its number, a line for each paragraph."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        found = sorted((int(m[1]), m[0]) for n in z.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
        parts = []
        for number, name in found:
            lines = ["".join(t.text or "" for t in p.iter(f"{_A}t")) for p in ElementTree.fromstring(z.read(name)).iter(f"{_A}p")]
            parts.append("\n".join([f"=== Slide {number} ===", *(x for x in lines if x.strip())]))
    return "\n\n".join(parts), 0


def mail(data: bytes) -> Parsed:
    """Head lines and body of an internet mail; attachments are named, not read."""
    message = message_from_bytes(data, policy=policy.default)
    body = message.get_body(("plain", "html"))
    text = body.get_content() if body is not None else ""
    if body is not None and body.get_content_subtype() == "html":
        text = markup(text.encode())[0]
    head = [f"{k}: {message[k]}" for k in ("From", "To", "Subject", "Date") if message[k]]
    named = [a.get_filename() or "unnamed" for a in message.iter_attachments()]
    return "\n".join([*head, *(["Attachments: " + "; ".join(named)] if named else []), "", text.strip()]), 0


def stored_mail(data: bytes) -> Parsed:
    """Head lines and body of a mail as a mail program stores it."""
    m = ole.mail_fields(data)
    sender = f"{m['sender']} <{m['address']}>" if m["address"] and m["address"] != m["sender"] else m["sender"]
    head = [f"{k}: {v}" for k, v in (("From", sender), ("To", m["to"]), ("Subject", m["subject"]), ("Date", m["date"])) if v]
    body = m["body"] or (markup(m["html"].encode())[0] if m["html"] else "")
    named = ["Attachments: " + "; ".join(m["attachments"])] if m["attachments"] else []
    return "\n".join([*head, *named, "", body.replace("\r\n", "\n").strip()]), 0


def mail_summary(data: bytes) -> dict[str, object]:
    """What a catalog holds of a stored mail, at the lengths it holds."""
    m = ole.mail_fields(data)
    return {"email_sender": m["sender"][:200], "email_recipients": m["to"][:300], "email_subject": m["subject"][:200], "email_date": m["date"], "email_has_attachments": bool(m["attachments"]), "email_body_preview": m["body"][:150]}


def old_workbook(data: bytes) -> Parsed:
    made = [t for name, rows in ole.workbook_sheets(data) if (t := table(rows, name))]
    return "\n\n".join(made), len(made)


def portable(data: bytes) -> Parsed:
    return pdf.parsed(data, table, _limits.pages)


PARSERS: dict[str, tuple[str, Callable[[bytes], Parsed]]] = {
    ".txt": ("plain", plain), ".md": ("plain", plain), ".html": ("markup", markup), ".htm": ("markup", markup), ".csv": ("separated", separated),
    ".docx": ("word", word), ".xlsx": ("workbook", workbook), ".pptx": ("slides", slides), ".eml": ("mail", mail),
    ".pdf": ("portable", portable), ".msg": ("stored_mail", stored_mail), ".doc": ("old_word", lambda data: (ole.document_text(data), 0)), ".xls": ("old_workbook", old_workbook),
    ".ppt": ("old_slides", lambda data: (ole.slide_text(data), 0)),
}


def register(extension: str, name: str, parser: Callable[[bytes], Parsed]) -> None:
    PARSERS[extension.lower()] = (name, parser)


def parse_contents(contents: DataFrame, kinds: dict[str, tuple[str, Callable[[bytes], Parsed]]] | None = None, limits: Limits = Limits()) -> DataFrame:
    """``path, text, n_tables, parser, error`` of rows ``path, content``; no shuffle, a file at a time."""
    known = dict(kinds or PARSERS)

    def one(path: str, data: bytes | None) -> tuple:
        use_limits(limits)
        name, parser = known.get("." + path.rsplit(".", 1)[-1].lower(), (None, None))
        if parser is None:
            return path, None, 0, None, "unsupported file type"
        if not data:
            return path, None, 0, name, "no text: empty file"
        try:
            text, tables = parser(bytes(data))
        except Exception as e:
            return path, None, 0, name, f"{type(e).__name__}: {e}"[:500]
        return (path, text, tables, name, None) if text.strip() else (path, None, tables, name, "no text extracted")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(p, c) for p, c in zip(batch["path"], batch["content"], strict=True)], columns=["path", "text", "n_tables", "parser", "error"])

    return contents.select("path", "content").mapInPandas(each, "path string, text string, n_tables int, parser string, error string")
