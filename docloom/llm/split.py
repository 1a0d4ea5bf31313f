"""Oversized texts cut into pieces at natural boundaries, with an overlap.

Texts lie in files, as byte segments; a segment is worked on in byte ranges, each by a task of its own, and no task
ever holds a whole segment that is longer than two ranges:

1. at each seam between two ranges a cut is chosen from the boundaries around it, in a halo that both neighbours
   read, so that both choose the same; a range reaches from its own cut to that of the next one;
2. each range is read, its boundaries (ends of paragraphs, lines, sentences, words) are detected with a halo
   before it, and its characters and pieces are counted;
3. running sums of the counts over the ranges of a segment give the offset and the number of each range's first piece;
4. each range is read again, and its pieces are emitted at their offsets.

Only the counts of ranges are shuffled. :func:`split_files` does this for files, which are read through the file system of
their path; :func:`split_rows` first writes the long texts of a column, many to a file, to the shared folder, as a table of
texts cannot be read by byte.

Defined results: null, empty and short texts (up to the limit) give no pieces; a text without any
boundary is cut at the limit, but not inside a combining sequence or between ``\\r`` and ``\\n``; the pieces of
a text cover it without a gap; repeated rows give repeated pieces, each text with a number of its own; bytes that are no UTF-8
are read as replacement characters.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.session import scratch_path

LIMIT, OVERLAP = 6_000, 200
RANGE_BYTES, HALO_BYTES = 1 << 20, 1_024
# Levels of boundaries, strongest first; a boundary is the offset of the first character after it.
_LEVELS = (
    re.compile(r"(?:\r?\n[ \t]*){2,}|\f"),
    re.compile(r"\r?\n"),
    re.compile(r"(?<=[.!?…。！？])[\"'”’»)\]]*[ \t　]+(?=[^\sa-zß-ÿ])|(?<=[。！？])"),
    re.compile(r"[ \t]+"),
)
WORD_STEP = 32


def boundaries(text: str, first: int, last: int, base: int) -> list[np.ndarray]:
    """Boundary offsets (plus ``base``) with ``first < offset <= last``, an array for each level.

    Of the word ends, only the last in each ``WORD_STEP`` characters is kept, which keeps the table short.
    """
    out = []
    for k, pattern in enumerate(_LEVELS):
        at = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
        at = at[(at > first) & (at <= last)] + base
        if k == 3 and len(at) > 1:
            at = at[np.append(at[1:] // WORD_STEP != at[:-1] // WORD_STEP, True)]
        out.append(at)
    return out


def table_of(text: str, lead: int = 0) -> list[np.ndarray]:
    """The boundary table of a text; the first ``lead`` characters are a halo and have negative offsets."""
    return boundaries(text, -1, len(text), -lead)


def _latest(at: np.ndarray, low: int, high: int) -> int | None:
    i = int(np.searchsorted(at, high, "right")) - 1
    return int(at[i]) if i >= 0 and at[i] >= low else None


def _begin(table: list[np.ndarray], end: int, overlap: int) -> int:
    """Where the piece after a cut begins: the boundary nearest to ``overlap`` characters before it."""
    aim = end - overlap
    near = [e for at in table for e in (_latest(at, aim - overlap // 4, aim), _latest(at, aim, aim + overlap // 4)) if e is not None]
    return min(near, key=lambda e: abs(e - aim)) if near and overlap else aim


def cuts(size: int, table: list[np.ndarray], limit: int = LIMIT, overlap: int = OVERLAP, keep_together: tuple = (), start: int = 0, more: bool = False) -> list[tuple[int, int]]:
    """Piece offsets ``(start, end)`` from ``start`` to ``size``, chosen on the table alone.

    A piece ends at the strongest boundary in its last half, the latest of that strength. The next starts
    at the word nearest to ``overlap`` characters before that end. ``keep_together`` gives offsets that are no place for
    a forced cut. Where ``more`` text follows, the last piece is longer than what the next repeats of it.
    """
    pieces = []
    while size - start > limit:
        low = start + max(limit // 2, overlap + 1)
        high = max(low, min(start + limit, size - 2 * overlap)) if more else start + limit
        end = next((e for at in table if (e := _latest(at, low, high)) is not None), None)
        if end is None:
            end = high
            while end > low and end in keep_together:
                end -= 1
        pieces.append((start, end))
        begin = _begin(table, end, overlap)
        start = max(begin, start + 1) if begin < end or not overlap else end
    pieces.append((start, size))
    return pieces


def _joined(text: str) -> frozenset[int]:
    """Offsets before a combining mark, a joiner or the second half of a line end."""
    return frozenset(
        i for i, c in enumerate(text) if i and (unicodedata.combining(c) or c in "‍️" or text[i - 1] == "‍" or (c == "\n" and text[i - 1] == "\r"))
    )


def pieces_of(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP, lead: int = 0, more: bool = False) -> list[tuple[int, int]]:
    """The pieces of a text. Its first ``lead`` characters belong to the text before, and the first piece begins among them."""
    if not text or (not lead and not more and len(text) <= limit):
        return []
    table = table_of(text, lead)
    together = _joined(text) if not text.isascii() or "\r" in text else ()
    start = max(-lead, _begin(table, 0, overlap)) if lead and overlap else 0
    return cuts(len(text) - lead, table, limit, overlap, frozenset(x - lead for x in together), start, more)


# --- byte ranges -------------------------------------------------------------------------------------


def _uri(path: str) -> str:
    if "://" in path:
        return path
    return "file://" + path.removeprefix("file:")


def file_system(path: str):
    """The file system of a path, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(_uri(path))


class _Reader:
    """Byte ranges of files on any file system that their paths name; the last file stays open."""

    def __init__(self) -> None:
        self.path, self.file = None, None

    def read(self, path: str, first: int, last: int) -> bytes:
        if path != self.path:
            self.close()
            system, at = file_system(path)
            self.path, self.file = path, system.open_input_file(at)
        return self.file.read_at(max(0, last - first), first)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path = self.file = None


def _begins(data: bytes) -> int:
    """Bytes at the start that belong to a character before."""
    return next((i for i in range(min(4, len(data))) if data[i] & 0xC0 != 0x80), 0)


def _lead(read: _Reader, path: str, low: int, at: int, halo: int) -> str:
    """The text before a byte: a halo, or more where that is blank, so that a run of blanks is seen from its start."""
    while True:
        first = max(low, at - halo)
        data = read.read(path, first, at)
        text = data[_begins(data) if first > low else 0 :].decode("utf-8", "replace")
        if first == low or text.strip():
            return text
        halo *= 4


def _seam(read: _Reader, path: str, low: int, seam: int, high: int, limit: int, halo: int) -> int:
    """The byte of the cut near a seam: the strongest boundary between a half and a whole limit behind it."""
    data = read.read(path, seam, min(high, seam + 4 * limit + 4))
    skip = _begins(data)
    body, lead = data[skip:].decode("utf-8", "replace"), _lead(read, path, low, seam + skip, halo)
    table = table_of(lead + body, len(lead))
    found = next((int(at[i]) for at in table if (i := int(np.searchsorted(at, limit // 2))) < len(at) and at[i] <= limit), None)
    if found is None:
        found, together = limit, {x - len(lead) for x in _joined(lead + body)}
        while found > limit // 2 and found in together:
            found -= 1
    return seam + skip + len(body[:found].encode("utf-8", "surrogatepass"))


def split_segments(segments: DataFrame, key: str, limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = RANGE_BYTES, halo_bytes: int = HALO_BYTES) -> DataFrame:
    """``key, chunk_index, start_pos, end_pos, piece`` of byte segments ``key, path, first, last`` of UTF-8 files.

    Positions count code points from the start of the segment. Segments of up to ``limit`` characters have no piece.
    """
    if range_bytes < 16 * limit:
        range_bytes = 16 * limit
    spark, kind = segments.sparkSession, dict(segments.dtypes)[key]
    # The last range of a segment takes the rest, so that none is shorter than a range.
    n = F.greatest(F.lit(1), F.floor((F.col("last") - F.col("first")) / range_bytes)).cast("int")
    each = segments.select(F.col(key).alias("_key"), "path", "first", "last", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("range_no"))

    def body(read: _Reader, row, start: int, stop: int) -> tuple[str, int]:
        lead = ""
        if row.range_no:
            lead = _lead(read, row.path, row.first, start, max(halo_bytes, 8 * overlap))
        return lead + read.read(row.path, start, stop).decode("utf-8", "replace"), len(lead)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = _Reader()
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                seam = lambda k, r=row: _seam(read, r.path, r.first, r.first + k * range_bytes, r.last, limit, halo_bytes)
                start = seam(row.range_no) if row.range_no else row.first
                stop = seam(row.range_no + 1) if row.range_no + 1 < row.n else row.last
                text, lead = body(read, row, start, stop)
                rows.append((start, stop, len(text) - lead, len(pieces_of(text, limit, overlap, lead, row.range_no + 1 < row.n))))
            out = pd.DataFrame(rows, columns=["start", "stop", "chars", "pieces"])
            yield pd.concat([batch[["_key", "path", "first", "n", "range_no"]], out], axis=1)
        read.close()

    counted = each.select("_key", "path", "first", "last", "n", "range_no").mapInPandas(scan, f"_key {kind}, path string, first bigint, n int, range_no int, start bigint, stop bigint, chars bigint, pieces int")
    counted.write.parquet(table := scratch_path(spark, "ranges"))
    before = Window.partitionBy("path", "first").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = {name: F.coalesce(F.sum(c).over(before), F.lit(0)).cast(k) for name, c, k in (("base", "chars", "bigint"), ("number", "pieces", "int"))}
    placed = spark.read.parquet(table).where("pieces > 0").withColumns(sums)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = _Reader()
        for batch in batches:
            for at, row in enumerate(batch.itertuples(index=False)):
                text, lead = body(read, row, row.start, row.stop)
                found = pieces_of(text, limit, overlap, lead, row.range_no + 1 < row.n)
                yield pd.DataFrame({
                    key: [batch["_key"].iloc[at]] * len(found), "chunk_index": [row.number + i for i in range(len(found))], "start_pos": [row.base + b for b, _ in found],
                    "end_pos": [row.base + e for _, e in found], "piece": [text[lead + b : lead + e] for b, e in found],
                })
        read.close()

    return placed.mapInPandas(emit, f"`{key}` {kind}, chunk_index int, start_pos bigint, end_pos bigint, piece string")


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = 8 << 20, halo_bytes: int = HALO_BYTES) -> DataFrame:
    """Pieces of UTF-8 files: ``path, chunk_index, start_pos, end_pos, piece``; sizes are looked up by the tasks."""

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [system.get_file_info(at).size for system, at in map(file_system, batch["path"])]
            yield pd.DataFrame({"name": batch["path"], "path": batch["path"], "first": 0, "last": sizes})

    listed = spark.createDataFrame([(p,) for p in paths], "path string").mapInPandas(sized, "name string, path string, first bigint, last bigint")
    return split_segments(listed.where("last > 0"), "name", limit, overlap, range_bytes, halo_bytes).withColumnRenamed("name", "path")


def written_texts(df: DataFrame, key: str, text: str, limit: int = LIMIT) -> DataFrame:
    """The texts beyond the limit, written to the shared folder, one file a task: segments ``_key, path, first, last``.

    A file is named by a number of its own, so a task that runs twice leaves a file that nothing points to.
    """
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    folder = scratch_path(spark, "texts")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = f"{folder}/{uuid.uuid4().hex}"
        system, at = file_system(path)
        file, size = None, 0
        for batch in batches:
            ends = []
            for said in batch["text"]:
                if file is None:
                    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    file = system.open_output_stream(at)
                data = said.encode("utf-8", "replace")
                file.write(data)
                size += len(data)
                ends.append(size)
            if file is not None:
                file.flush()
            yield pd.DataFrame({"_key": batch["_key"], "path": path, "first": [ends[0] - len(batch["text"].iloc[0].encode("utf-8", "replace")), *ends[:-1]] if ends else [], "last": ends})
        if file is not None:
            file.close()

    long = df.where(F.length(text) > limit).select(F.col(key).alias("_key"), F.col(text).alias("text"))
    long.mapInPandas(each, f"_key {kind}, path string, first bigint, last bigint").write.parquet(table := scratch_path(spark, "segments"))
    return spark.read.parquet(table)


def split_rows(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``key, chunk_index, start_pos, end_pos, piece`` of each text beyond the limit."""
    return split_segments(written_texts(df, key, text, limit), "_key", limit, overlap, range_bytes).withColumnRenamed("_key", key)
