"""Rule-based redaction: contact patterns in the JVM, client names by their aliases in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of contact data, placeholders, legal endings.
EMAIL = r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"(?<!\d)(?<!\d\.)(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}(?:\s*(?:x|ext\.?)\s*\d{1,5})?\b"
ADDRESS = (
    r"(?i)\b\d+\s+[A-Za-z0-9\s]+(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Drive|Dr|Lane|Ln|Court|Ct|Place|Pl|Way|Circle|Cir|Parkway|Pkwy)"
    r"(?:\s+(?:Suite|Ste|Unit|Apt|Apartment|Room|Rm|Floor|Fl|#)\s*\d+)?\b"
)
LEGAL = ("Inc", "LLC", "Ltd", "Limited", "Corp", "Corporation", "Co", "Company", "PLC", "LP", "LLP", "PC")
TAIL_ENDINGS = ("Inc", "Incorporated", "LLC", "Ltd", "Limited", "Corp", "Corporation", "Company", "Authority")
DROPPED = ("The", "Group", "Holdings")
SPREADSHEETS = (".xlsx", ".xls", ".csv")
STEPS = (("email", EMAIL, "<<EMAIL>>"), ("phone", PHONE, "<<PHONE>>"), ("address", ADDRESS, "<<ADDRESS>>"))


def redact_contacts(df: DataFrame, text: str) -> DataFrame:
    """Adds ``redacted`` and ``n_email, n_phone, n_address``: each step works on what the one before left.

    A step is one pass of its pattern; what it replaced is counted by its placeholders, less those that stood before.
    """
    df = df.withColumn("redacted", F.col(text))
    for name, pattern, mark in STEPS:
        marks = lambda c, mark=mark: F.regexp_count(c, F.lit(mark))
        df = df.withColumn("_before", F.col("redacted")).withColumn("redacted", F.regexp_replace("_before", pattern, mark))
        df = df.withColumn(f"n_{name}", F.coalesce(marks("redacted") - marks("_before"), F.lit(0))).drop("_before")
    return df


def client_variants(name: Column, aliases: Column) -> Column:
    """Spellings of a client: the name, without legal ending, with ``&`` or ``and``, without filler words, closed up, and its aliases.

    Distinct but for case, longest first.
    """
    name = F.trim(name)
    swap = [F.when(name.contains("&"), F.replace(name, F.lit("&"), F.lit("and"))), F.when(F.lower(name).contains("and"), F.replace(name, F.lit("and"), F.lit("&")))]
    bare = [F.trim(F.regexp_replace(name, rf"(?i)\s+{x}\.?$", "")) for x in LEGAL]
    less = [F.trim(F.regexp_replace(name, rf"(?i)\b{x}\b\s*", "")) for x in DROPPED]
    listed = F.transform(F.split(F.coalesce(aliases, F.lit("")), r"\|"), lambda a: F.trim(a))
    every = F.concat(F.array(name, F.lower(F.regexp_replace(name, r"\s+", " ")), *bare, *swap, *less, F.regexp_replace(name, r"\s+", "")), listed)
    low = F.array_distinct(F.transform(F.filter(every, lambda v: F.coalesce(v, F.lit("")) != ""), lambda v: F.lower(v)))
    by_size = F.array_sort(F.transform(low, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
    return F.transform(by_size, lambda x: x["v"])


def client_token(industry: Column) -> Column:
    label = F.when(F.trim(F.coalesce(industry, F.lit(""))) == "", "Client Organization").otherwise(F.trim(industry))
    return F.concat(F.lit("<<CLIENT: "), label, F.lit(">>"))


def collapse_tail(text: Column) -> Column:
    """Drops what is left of a company's name after its placeholder: up to ten capitalised words and a legal ending."""
    tail = rf"(<<CLIENT: [^>]*>>)\s+(?:and\s+)?(?:[A-Z][A-Za-z0-9&'.-]*\s+){{0,10}}(?:{'|'.join(TAIL_ENDINGS)})\b(?:\s+Inc\b)?"
    return F.regexp_replace(text, tail, "$1")


def redact_clients(df: DataFrame, text: str, client: str, registry: DataFrame) -> DataFrame:
    """Adds ``client_redacted`` and ``n_client``: the spellings of a row's own client replaced by its token.

    ``registry`` has ``client_id, client_name, industry_label, aliases``. Rows are joined to their client's
    pattern, one alternation with the longest spelling first; rows without a known client stay as they are.
    """
    listed = registry.select(F.col("client_id").alias("_cid"), client_variants(F.col("client_name"), F.col("aliases")).alias("_names"), client_token(F.col("industry_label")).alias("_token"))
    joined = df.join(listed, F.col(client) == F.col("_cid"), "left")
    compiled: dict[tuple[str, ...], re.Pattern] = {}

    def each(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, names, tokens in batches:
            out = []
            for t, n, token in zip(texts, names, tokens, strict=True):
                if t is None or n is None or token is None:
                    out.append((t, 0))
                    continue
                key = tuple(n)
                if key not in compiled:
                    if len(compiled) > 10_000:
                        compiled.clear()
                    compiled[key] = re.compile(rf"(?<![A-Za-z0-9])(?:{'|'.join(map(re.escape, key))})(?![A-Za-z0-9])", re.I)
                out.append(compiled[key].subn(lambda _, token=token: token, t))
            yield pd.DataFrame(out, columns=["text", "n"])

    made = F.pandas_udf(each, "text string, n int")(text, "_names", "_token")
    return joined.withColumn("_r", made).withColumns({"client_redacted": collapse_tail(F.col("_r.text")), "n_client": F.col("_r.n")}).drop("_r", "_cid", "_names", "_token")


def failures(text: Column, file_type: Column | None = None, client_name: Column | None = None) -> Column:
    """What a redacted text still holds: ``email``, ``phone`` (not in spreadsheets), ``client`` name."""
    sheet = F.lower(F.coalesce(file_type, F.lit(""))).isin(*SPREADSHEETS) if file_type is not None else F.lit(False)
    left = [F.when(text.rlike(EMAIL), "email"), F.when(~sheet & text.rlike(PHONE), "phone")]
    if client_name is not None:
        low, name = F.lower(text), F.lower(F.trim(client_name))
        parts = F.split(F.concat(F.lit(" "), low, F.lit(" ")), F.concat(F.lit("\\Q"), name, F.lit("\\E")))
        closed = F.exists(
            F.sequence(F.lit(0), F.greatest(F.size(parts) - 2, F.lit(0))),
            lambda i: ~F.right(F.get(parts, i), F.lit(1)).rlike("[a-z0-9]") & ~F.left(F.get(parts, i + 1), F.lit(1)).rlike("[a-z0-9]"),
        )
        left.append(F.when((name != "") & (F.size(parts) > 1) & closed, "client"))
    return F.array_compact(F.array(*left))


def windows(text: Column, size: int = 50_000, overlap: int = 300) -> Column:
    """Overlapping windows ``window_no, offset, part`` of a long text."""
    step = size - overlap
    count = F.greatest(F.ceil((F.length(text) - overlap) / step).cast("int"), F.lit(1))
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(i.alias("window_no"), (i * step).cast("bigint").alias("offset"), F.substring(text, i * step + 1, F.lit(size)).alias("part")),
    )


def merge_spans(spans: Column) -> Column:
    """Spans ``start, stop, kind`` in order, of those that overlap or touch the longest kept."""

    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = x["stop"] - x["start"] > last["stop"] - last["start"]
        head = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        clash = (F.size(done) > 0) & (x["start"] <= last["stop"])
        return F.when(clash & longer, F.concat(head, F.array(x))).when(clash, done).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.filter(spans, lambda x: F.lit(False)), add)


def apply_spans(text: Column, spans: Column, tokens: dict[str, str]) -> Column:
    """The text with its (merged) spans replaced by the token of their kind; placeholders that stand are not touched."""
    def inside(s: Column) -> Column:
        back = F.greatest(s["start"] - 80, F.lit(0))
        return F.substring(text, (back + 1).cast("int"), (s["start"] - back + 1).cast("int")).rlike("<<[^>]*$")

    free = F.filter(spans, lambda s: ~inside(s))
    ordered = F.reverse(F.array_sort(free))
    named = F.create_map(*[F.lit(x) for pair in tokens.items() for x in pair])

    def put(done: Column, s: Column) -> Column:
        return F.concat(F.left(done, s["start"].cast("int")), F.try_element_at(named, s["kind"]), F.substring(done, (s["stop"] + 1).cast("int"), F.length(done)))

    return F.aggregate(ordered, text, put)


def redact_metadata(df: DataFrame, name: str, client: str, fields: list[str]) -> DataFrame:
    """Metadata of a redacted document: the client's name becomes its placeholder, and goes from the other fields too, but for case."""
    mark = F.lit("<<CLIENT>>")
    known = F.trim(F.coalesce(F.col(client), F.lit(""))) != ""
    quoted = F.concat(F.lit("(?i)\\Q"), F.trim(F.col(client)), F.lit("\\E"))
    out = {f: F.when(known, F.regexp_replace(F.col(f), quoted, mark)).otherwise(F.col(f)) for f in fields}
    return df.withColumns(out | {client: F.when(known, mark).otherwise(F.col(client)), name: F.when(known, F.regexp_replace(F.col(name), quoted, mark)).otherwise(F.col(name))})


def organisation_clients(spans: DataFrame, clients: DataFrame, span: str, name: str) -> DataFrame:
    """Organisation spans joined to the clients whose name holds them, or that they hold, whole word by whole word.

    A containment in words is an equality of the first word of the one that is held with a word of the other, so the
    join is by word and each pair is then compared once; the longest name wins.
    """
    words = lambda c: F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), " ")
    left = spans.select("*", words(F.col(span)).alias("_w")).withColumn("_key", F.explode(F.array_distinct("_w")))
    right = clients.select(F.col(name).alias("_name"), words(F.col(name)).alias("_n")).where("_name is not null").withColumn("_key", F.explode(F.array_distinct("_n")))
    padded = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    pairs = left.join(right.where("_key <> ''"), "_key").where(padded(F.col("_w")).contains(padded(F.col("_n"))) | padded(F.col("_n")).contains(padded(F.col("_w"))))
    return pairs.groupBy(*spans.columns).agg(F.max_by("_name", F.struct(F.length("_name"), "_name")).alias("matched_client"))


def global_spans(found: DataFrame, size: int = 50_000, overlap: int = 300) -> DataFrame:
    """Spans ``key, window_no, start, stop, kind`` of windows as spans of whole texts, merged: ``key, spans``.

    A span that two windows share is one; see :func:`merge_spans`.
    """
    at = F.col("window_no").cast("bigint") * (size - overlap)
    spans = F.struct((F.col("start") + at).alias("start"), (F.col("stop") + at).alias("stop"), "kind")
    return found.groupBy("key").agg(F.array_distinct(F.collect_list(spans)).alias("spans")).select("key", merge_spans(F.col("spans")).alias("spans"))
