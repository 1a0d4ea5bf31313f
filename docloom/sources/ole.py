"""Compound files (the container of old office formats) and what is in them: mails, documents, workbooks, slides.

Written from the published file formats; nothing but the standard library is used.
"""

from __future__ import annotations

import datetime as dt
import re
import struct

END, FREE = 0xFFFFFFFE, 0xFFFFFFFF


class Compound:
    """The streams of a compound file by path, names joined by ``/``."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
            raise ValueError("not a compound file")
        self.data = data
        self.size = 1 << struct.unpack_from("<H", data, 30)[0]
        self.small = 1 << struct.unpack_from("<H", data, 32)[0]
        directory, _, self.cutoff, mini, _, more, _ = struct.unpack_from("<7I", data, 48)
        sectors = [s for s in struct.unpack_from("<109I", data, 76) if s < END]
        while more < END:
            part = struct.unpack(f"<{self.size // 4}I", data[self._at(more) : self._at(more) + self.size].ljust(self.size, b"\xff"))
            sectors += [s for s in part[:-1] if s < END]
            more = part[-1]
        self.fat = [x for s in sectors for x in struct.unpack(f"<{self.size // 4}I", data[self._at(s) : self._at(s) + self.size].ljust(self.size, b"\xff"))]
        raw = self._chain(directory)
        self.entries = [raw[i : i + 128] for i in range(0, len(raw) - 127, 128)]
        table = self._chain(mini) if mini < END else b""
        self.minifat = struct.unpack(f"<{len(table) // 4}I", table[: len(table) // 4 * 4])
        if not self.entries:
            raise ValueError("no directory in the compound file")
        root = self.entries[0]
        self.ministream = self._chain(struct.unpack_from("<I", root, 116)[0])
        self.streams: dict[str, bytes] = {}
        self._walk(struct.unpack_from("<I", root, 76)[0], "", set())

    def _at(self, sector: int) -> int:
        return (sector + 1) * self.size

    def _chain(self, sector: int) -> bytes:
        parts, seen = [], set()
        while sector < END and sector not in seen and sector < len(self.fat):
            seen.add(sector)
            parts.append(self.data[self._at(sector) : self._at(sector) + self.size])
            sector = self.fat[sector]
        return b"".join(parts)

    def _walk(self, number: int, path: str, seen: set[int]) -> None:
        stack = [(number, path)]
        while stack:
            number, path = stack.pop()
            if number >= len(self.entries) or number in seen:
                continue
            seen.add(number)
            entry = self.entries[number]
            length = struct.unpack_from("<H", entry, 64)[0]
            name = path + entry[: max(0, length - 2)].decode("utf-16-le", "replace")
            left, right, child = struct.unpack_from("<3I", entry, 68)
            start, size = struct.unpack_from("<2I", entry, 116)
            stack += [(left, path), (right, path)]
            if entry[66] == 1:
                stack.append((child, name + "/"))
            elif entry[66] == 2:
                self.streams[name] = self._stream(start, size)

    def _stream(self, start: int, size: int) -> bytes:
        if size >= self.cutoff:
            return self._chain(start)[:size]
        parts, sector, seen = [], start, set()
        while sector < END and sector not in seen and sector < len(self.minifat):
            seen.add(sector)
            parts.append(self.ministream[sector * self.small : (sector + 1) * self.small])
            sector = self.minifat[sector]
        return b"".join(parts)[:size]


def mail_fields(data: bytes) -> dict[str, object]:
    """``sender, address, to, subject, date, body, html, attachments`` of a stored mail."""
    streams = Compound(data).streams

    def value(tag: str, path: str = "") -> str:
        if (wide := streams.get(f"{path}__substg1.0_{tag}001F")) is not None:
            return wide.decode("utf-16-le", "replace").rstrip("\0")
        for kind in ("001E", "0102"):
            if (narrow := streams.get(f"{path}__substg1.0_{tag}{kind}")) is not None:
                try:
                    return narrow.decode("utf-8").rstrip("\0")
                except UnicodeDecodeError:
                    return narrow.decode("cp1252", "replace").rstrip("\0")
        return ""

    date = None
    properties = streams.get("__properties_version1.0", b"")
    for at in range(32, len(properties) - 15, 16):
        tag = struct.unpack_from("<I", properties, at)[0]
        if tag in (0x00390040, 0x0E060040) and date is None:
            ticks = struct.unpack_from("<Q", properties, at + 8)[0]
            date = dt.datetime(1601, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=ticks // 10)
    folders = sorted({n.split("/")[0] for n in streams if n.startswith("__attach_version1.0")})
    return {
        "sender": value("0C1A"), "address": value("5D01") or value("0C1F"), "to": value("0E04"), "subject": value("0037"), "date": date, "body": value("1000"), "html": value("1013"),
        "attachments": [value("3707", f"{f}/") or value("3704", f"{f}/") or "unnamed" for f in folders],
    }


_FIELD = re.compile("\x13[^\x13\x14\x15]*\x14?|\x15")


def document_text(data: bytes) -> str:
    """The text of an old word processor document, by its piece table; cells are parted by pipes."""
    streams = Compound(data).streams
    main = streams["WordDocument"]
    table = streams["1Table" if struct.unpack_from("<H", main, 10)[0] & 0x200 else "0Table"]
    start, size = struct.unpack_from("<2I", main, 0x1A2)
    clx, at = table[start : start + size], 0
    while at < len(clx) and clx[at] == 1:
        at += 3 + struct.unpack_from("<H", clx, at + 1)[0]
    length = struct.unpack_from("<I", clx, at + 1)[0]
    plc = clx[at + 5 : at + 5 + length]
    n = (length - 4) // 12
    ends = struct.unpack_from(f"<{n + 1}I", plc, 0)
    parts = []
    for k in range(n):
        place = struct.unpack_from("<I", plc, 4 * (n + 1) + 8 * k + 2)[0]
        count = ends[k + 1] - ends[k]
        if place & 0x40000000:
            place = (place & 0x3FFFFFFF) // 2
            parts.append(main[place : place + count].decode("cp1252", "replace"))
        else:
            parts.append(main[place : place + 2 * count].decode("utf-16-le", "replace"))
    text = _FIELD.sub("", "".join(parts)).replace("\x07\r", "\n").replace("\x07\x07", "\n").replace("\x07", " | ")
    return re.sub("[\x00-\x08\x0e-\x1f]", "", text.replace("\r", "\n").replace("\x0b", "\n").replace("\x0c", "\n")).strip()


def _strings(blocks: list[bytes]) -> list[str]:
    """The shared strings of a workbook; a string may go on in the next block, which begins with a new width flag."""
    total = struct.unpack_from("<I", blocks[0], 4)[0]
    block, at, out = 0, 8, []

    def take(n: int) -> bytes:
        nonlocal block, at
        got = b""
        while len(got) < n and block < len(blocks):
            part = blocks[block][at : at + n - len(got)]
            got, at = got + part, at + len(part)
            if at >= len(blocks[block]) and len(got) < n:
                block, at = block + 1, 0
        return got

    while len(out) < total and block < len(blocks):
        head = take(3)
        if len(head) < 3:
            break
        left, flags = struct.unpack("<HB", head)
        runs = struct.unpack("<H", take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", take(4))[0] if flags & 4 else 0
        wide, said = flags & 1, ""
        while left and block < len(blocks):
            if at >= len(blocks[block]):
                block, at = block + 1, 1
                if block < len(blocks):
                    wide = blocks[block][0] & 1
                continue
            room = (len(blocks[block]) - at) // (2 if wide else 1)
            n = min(left, max(room, 1))
            part = blocks[block][at : at + n * (2 if wide else 1)]
            said += part.decode("utf-16-le" if wide else "latin-1", "replace")
            at, left = at + len(part), left - n
        take(4 * runs + extra)
        out.append(said)
    return out


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def _packed(raw: int) -> float:
    value = float((raw >> 2) - (1 << 30) if raw & 0x80000000 else raw >> 2) if raw & 2 else struct.unpack("<d", b"\0\0\0\0" + struct.pack("<I", raw & 0xFFFFFFFC))[0]
    return value / 100 if raw & 1 else value


def workbook_sheets(data: bytes) -> list[tuple[str, list[list[str]]]]:
    """Name and rows of each sheet of an old workbook."""
    streams = Compound(data).streams
    book = streams.get("Workbook") or streams["Book"]
    records, at = [], 0
    while at + 4 <= len(book):
        kind, size = struct.unpack_from("<2H", book, at)
        records.append((at, kind, book[at + 4 : at + 4 + size]))
        at += 4 + size
    sheets, strings = [], []
    for k, (_, kind, body) in enumerate(records):
        if kind == 0x85:
            n, wide = body[6], body[7] & 1
            sheets.append((struct.unpack_from("<I", body, 0)[0], body[8 : 8 + n * (2 if wide else 1)].decode("utf-16-le" if wide else "latin-1")))
        elif kind == 0xFC:
            blocks = [body]
            while k + len(blocks) < len(records) and records[k + len(blocks)][1] == 0x3C:
                blocks.append(records[k + len(blocks)][2])
            strings = _strings(blocks)
    out = []
    for start, name in sheets:
        cells: dict[tuple[int, int], str] = {}
        formula = None
        for _, kind, body in [r for r in records if r[0] >= start]:
            if kind == 0x0A:
                break
            row, column = struct.unpack_from("<2H", body) if len(body) >= 4 else (0, 0)
            if kind == 0xFD:
                number = struct.unpack_from("<I", body, 6)[0]
                cells[row, column] = strings[number] if number < len(strings) else ""
            elif kind == 0x203:
                cells[row, column] = _number(struct.unpack_from("<d", body, 6)[0])
            elif kind == 0x27E:
                cells[row, column] = _number(_packed(struct.unpack_from("<I", body, 6)[0]))
            elif kind == 0xBD:
                for i in range((len(body) - 6) // 6):
                    cells[row, column + i] = _number(_packed(struct.unpack_from("<I", body, 6 + 6 * i)[0]))
            elif kind == 0x204:
                n, wide = struct.unpack_from("<HB", body, 6)
                cells[row, column] = body[9 : 9 + n * (2 if wide & 1 else 1)].decode("utf-16-le" if wide & 1 else "latin-1", "replace")
            elif kind == 0x06:
                formula = (row, column)
                if body[12:14] != b"\xff\xff":
                    cells[row, column] = _number(struct.unpack_from("<d", body, 6)[0])
            elif kind == 0x207 and formula:
                n, wide = struct.unpack_from("<HB", body)
                cells[formula] = body[3 : 3 + n * (2 if wide & 1 else 1)].decode("utf-16-le" if wide & 1 else "latin-1", "replace")
        wide = max((c for _, c in cells), default=-1) + 1
        rows = sorted({r for r, _ in cells})
        out.append((name, [[cells.get((r, c), "") for c in range(wide)] for r in rows]))
    return out


def slide_text(data: bytes) -> str:
    """The lines of text of an old presentation, in the order they are stored."""
    show = Compound(data).streams["PowerPoint Document"]
    lines: list[str] = []
    stack = [(0, len(show))]
    while stack:
        at, end = stack.pop()
        if at + 8 > end:
            continue
        version, kind, size = struct.unpack_from("<2HI", show, at)
        stop = min(end, at + 8 + size)
        stack.append((stop, end))
        if version & 0xF == 0xF:
            stack.append((at + 8, stop))
        elif kind in (0x0FA0, 0x0FA8):
            said = show[at + 8 : stop].decode("utf-16-le" if kind == 0x0FA0 else "latin-1", "replace")
            lines += [x.strip() for x in re.split("[\r\x0b]", said) if x.strip()]
    return "\n".join(lines)
