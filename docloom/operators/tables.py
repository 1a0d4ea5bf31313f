"""Tables inside documents, as arrays of rows of cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_merged(row: Column) -> Column:
    """Each cell that equals the one to its left blanked, as merged cells repeat their text."""
    return F.transform(row, lambda x, i: F.when((i > 0) & x.eqNullSafe(F.get(row, i - 1)), F.lit("")).otherwise(x))


def table_text(rows: Column, name: Column, page: Column | None = None) -> Column:
    """The titled form of a table: title, header, dashes of 10 to 100, rows; the empty string for no filled row."""
    filled = F.filter(rows, lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    lines = F.transform(filled, lambda r: F.array_join(F.transform(without_merged(r), lambda c: F.trim(F.coalesce(c, F.lit("")))), " | "))
    head = F.get(lines, F.lit(0))
    title = F.concat(F.lit("=== "), name, F.lit(" ===")) if page is None else F.concat(F.lit("=== "), name, F.lit(" (Page "), page.cast("string"), F.lit(") ==="))
    rule = F.repeat(F.lit("-"), F.greatest(F.least(F.length(head), F.lit(100)), F.lit(10)))
    body = F.concat(F.array(title, head, rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))))
    return F.when(F.size(filled) > 0, F.array_join(body, "\n")).otherwise("")


def table_words(rows: Column) -> Column:
    """Words in all cells."""
    cells = F.filter(F.flatten(rows), lambda c: F.coalesce(c, F.lit("")) != "")
    return F.aggregate(cells, F.lit(0), lambda n, c: n + F.regexp_count(c, F.lit(r"\S+")))


def has_currency(rows: Column) -> Column:
    return F.exists(F.flatten(rows), lambda c: F.coalesce(c, F.lit("")).rlike(r"[$€£¥]\s?\d|\b(?:USD|EUR|GBP)\b"))


def page_text(text: Column, tables: Column, page: Column) -> Column:
    """Page text with its tables below it, named by page and number."""
    named = F.transform(tables, lambda t, i: table_text(t, F.concat(F.lit("TABLE_P"), page.cast("string"), F.lit("_"), (i + 1).cast("string")), page))
    shown = F.transform(F.filter(named, lambda t: t != ""), lambda t: F.concat(F.lit("\n"), t))
    own = F.when(F.trim(text) != "", F.array(F.trim(text))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(own, shown), "\n")


def spread_spans(cells: Column, n_rows: Column, n_cols: Column) -> Column:
    """A grid from cells ``row, col, row_span, col_span, text``: a spanning cell's text in each place it covers."""
    covers = lambda c, i, j: (c["row"] <= i) & (i < c["row"] + c["row_span"]) & (c["col"] <= j) & (j < c["col"] + c["col_span"])

    def at(i: Column, j: Column) -> Column:
        return F.coalesce(F.get(F.filter(cells, lambda c: covers(c, i, j)), F.lit(0))["text"], F.lit(""))

    return F.transform(F.sequence(F.lit(0), n_rows - 1), lambda i: F.transform(F.sequence(F.lit(0), n_cols - 1), lambda j: at(i, j)))
