"""Measures and labels of texts, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
# Patterns of entities.
AMOUNTS = (r"(?i)\$[\d,]+(?:\.\d{2})?", r"(?i)\d+(?:\.\d+)?%", r"(?i)\d+(?:,\d{3})*(?:\.\d{2})?\s*(?:dollars?|USD)")
DATES = (
    r"(?i)\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
    rf"(?i)\b(?:{_MONTHS})\s+\d{{1,2}},?\s+\d{{4}}\b",
    rf"(?i)\b\d{{1,2}}\s+(?:{_MONTHS})\s+\d{{4}}\b",
)
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b(?:\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b"
DOLLARS = r"\$[\d,]+(?:\.\d{2})?|\d+(?:,\d{3})*(?:\.\d{2})?\s*(?:dollars|usd|million|billion|k\b)"
PERCENTS = r"\d+(?:\.\d+)?%"
ANY_DATE = r"\b(?:\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}[/-]\d{1,2}[/-]\d{1,2}|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{1,2},?\s+\d{4})\b"
# Words that tell what a text is about.
CONTRACT_TERMS = (
    "effective date", "expiration date", "termination", "renewal", "confidentiality", "non-disclosure", "intellectual property", "liability",
    "indemnification", "force majeure",
)
PRICING_WORDS = (
    "price", "pricing", "cost", "fee", "rate", "discount", "tier", "subscription", "license", "per user", "per seat", "annual", "monthly",
    "yearly", "term", "usd", "amount", "total",
)
CONTRACT_WORDS = (
    "agreement", "contract", "term", "renewal", "termination", "sla", "liability", "indemnity", "warranty", "guarantee", "clause",
    "provision", "obligation", "compliance", "effective date",
)
FINANCE_WORDS = ("savings", "roi", "tco", "budget", "spend", "investment", "benchmark", "fmv", "fair market value", "negotiated", "proposal")
CHUNK_TYPES = (
    ("financial", ("$", "cost", "price", "fee", "payment", "invoice")),
    ("legal", ("agreement", "contract", "terms", "conditions", "liability")),
    ("schedule", ("date", "schedule", "timeline", "deadline", "milestone")),
    ("contact", ("contact", "phone", "email", "address")),
    ("technical", ("specification", "requirement", "technical", "system")),
)
NAME_TYPES = (
    ("FMV Report", ("fmv-report", "fmv_report", "fair market value report", "valuation report")),
    ("Quote/Proposal", ("quote", "proposal", "rfp", "bid", "pricing")),
    ("Contract/SoW/MSA", ("contract", "sow", "msa", "agreement", "statement of work", "master service")),
    ("FMV Report", ("fmv", "fair-market", "fair_market", "market-value", "market_value", "pricing analysis")),
    ("Product Literature", ("product", "datasheet", "brochure", "spec", "technical", "literature", "marketing")),
    ("Email", ("email", "msg", "correspondence", "communication")),
)
QUERY_KINDS = (
    ("pricing_proposal", ("cost", "price", "pricing", "quote", "budget", "fee", "license", "subscription")),
    ("vendor_contract", ("contract", "agreement", "terms", "sow", "statement of work", "vendor")),
    ("technical_specification", ("technical", "specification", "architecture", "implementation", "integration")),
    ("compliance_security", ("compliance", "security", "audit", "risk", "policy", "regulation")),
    ("vendor_comparison", ("compare", "comparison", "versus", "vs", "evaluate", "evaluation", "best")),
)
TYPE_KINDS = (
    ("vendor_contract", ("contract", "sow")),
    ("pricing_proposal", ("quote", "proposal")),
    ("technical_specification", ("technical", "specification")),
    ("compliance_security", ("compliance", "security")),
)
ERROR_KINDS = (
    ("timeout", ("timeout",)),
    ("download_failed", ("download", "file not found")),
    ("no_text_extracted", ("no text", "empty")),
    ("unsupported_type", ("unsupported",)),
    ("index_error", ("index", "upsert")),
)


def _contains_any(text: Column, words: tuple[str, ...]) -> Column:
    found = text.contains(words[0])
    for word in words[1:]:
        found = found | text.contains(word)
    return found


def first_kind(text: Column, kinds: tuple[tuple[str, tuple[str, ...]], ...], default: str | None) -> Column:
    """The first kind of which a word is contained in the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    label: Column | None = None
    for kind, words in kinds:
        label = F.when(_contains_any(low, words), kind) if label is None else label.when(_contains_any(low, words), kind)
    return label.otherwise(F.lit(default))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def line_count(text: Column) -> Column:
    return F.coalesce(F.size(F.split(text, "\n")), F.lit(0))


def matches(text: Column, patterns: tuple[str, ...]) -> Column:
    """The distinct matches of all patterns, in order of pattern and place."""
    return F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in patterns]))


def keyword_count(text: Column, words: tuple[str, ...]) -> Column:
    """Occurrences of whole words and phrases, of which none overlaps another; one pass for the whole list."""
    longest_first = sorted(words, key=len, reverse=True)
    return F.regexp_count(F.lower(text), F.lit(rf"\b(?:{'|'.join(longest_first)})\b"))


def contained_terms(text: Column, words: tuple[str, ...] = CONTRACT_TERMS) -> Column:
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(low.contains(w), w) for w in words]))


def file_class(name: Column) -> Column:
    """``document_type, confidence, method`` by the words in a file name: 0.6 where one fits, else 0.2."""
    kind = first_kind(name, NAME_TYPES, None)
    return F.struct(
        F.coalesce(kind, F.lit("Quote/Proposal")).alias("document_type"),
        F.when(kind.isNotNull(), 0.6).otherwise(0.2).alias("confidence"),
        F.when(kind.isNotNull(), "pattern").otherwise("default").alias("method"),
    )


def normal_label(value: Column, labels: tuple[str, ...]) -> Column:
    """A listed label: the same, the same but for case, or the first that contains the value or is in it; else null."""
    low = F.lower(F.trim(value))
    label = F.when(low == "", F.lit(None).cast("string"))
    for name in labels:
        label = label.when(low == name.lower(), name)
    for name in labels:
        label = label.when(low.contains(name.lower()) | F.lit(name.lower()).contains(low), name)
    return label


def query_kind(query: Column, document_type: Column) -> Column:
    """How to expand a query: by the document type asked for, else by its words."""
    wanted = F.when(document_type.isNotNull(), first_kind(document_type, TYPE_KINDS, None))
    return F.coalesce(wanted, first_kind(query, QUERY_KINDS, "general"))


def context_suffix(**values: Column) -> Column:
    """`` (name: value, …)`` of the non-empty values; the empty string for none."""
    said = F.array_compact(F.array(*[F.when(v != "", F.concat(F.lit(f"{k}: "), v)) for k, v in values.items()]))
    return F.when(F.size(said) > 0, F.concat(F.lit(" ("), F.array_join(said, ", "), F.lit(")"))).otherwise("")


def repeated_line_ratio(text: Column) -> Column:
    lines = F.split(text, "\n")
    return F.lit(1.0) - F.size(F.array_distinct(lines)) / F.size(lines)


def non_ascii_percent(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"[^\x00-\x7F]")) * 100.0 / F.length(text)).otherwise(0.0)


def broken_hyphens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\w+-\s*\n\s*\w+"))


def wide_gaps(text: Column) -> Column:
    return F.regexp_count(text, F.lit(" {3,}"))


def table_marks(text: Column) -> Column:
    return F.regexp_count(text, F.lit("=== .+ ==="))


def without_html(text: Column) -> Column:
    """Tags dropped, the commonest entities read."""
    bare = F.regexp_replace(text, "<[^>]+>", "")
    return F.replace(F.replace(bare, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))


def document_key(deal: Column, file: Column, key: Column) -> Column:
    """``deal::file``, with either part alone, else the key with a prefix, else ``unknown``."""
    deal, file, key = (F.coalesce(F.trim(c), F.lit("")) for c in (deal, file, key))
    return F.when((deal != "") | (file != ""), F.concat_ws("::", deal, file)).when(key != "", F.concat(F.lit("sf_"), key)).otherwise("unknown")


def cut_bytes(text: Column, most: int = 37_888) -> Column:
    """The longest beginning of at most ``most`` bytes of UTF-8 that splits no character."""
    head = F.left(text, F.lit(most))
    raw = F.substring(F.encode(head, "UTF-8"), 1, most)
    # A cut character leaves one to three bytes behind; they are dropped by their lead bits.
    hexed = F.right(F.hex(raw), F.lit(6))
    byte = lambda i: F.conv(F.substring(hexed, 1 + 2 * i, 2), 16, 10).cast("int")
    rest = F.when(byte(2) >= 0xC0, 1).when(byte(1) >= 0xE0, 2).when(byte(0) >= 0xF0, 3).otherwise(0)
    return F.when(F.octet_length(text) <= most, text).otherwise(F.decode(F.substring(raw, F.lit(1), F.lit(most) - rest), "UTF-8"))


def normal_markdown(text: Column) -> Column:
    """One kind of line end, no blanks at line ends, at most one blank line in a row."""
    lines = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "[ \t]+\n", "\n")
    return F.trim(F.regexp_replace(lines, "\n{3,}", "\n\n"))


def fenced_markdown(text: Column) -> Column:
    """Normal markdown in which blocks that look like tables stand between fences.

    A block is what stands between blank lines. It is a table if it has two or more lines, no fence of its own, and either a
    table's title or, on six lines of ten and at least two, two pipes or two runs of blanks.
    """
    def fence(block: Column) -> Column:
        lines = F.split(block, "\n")
        many = lambda pattern: F.size(F.filter(lines, lambda x: F.regexp_count(x, F.lit(pattern)) >= 2))
        enough = F.greatest(F.lit(2), F.floor(F.size(lines) * 0.6))
        table = (F.size(lines) >= 2) & ~block.contains("```") & (block.contains("TABLE_P") | block.contains("=== TABLE") | (many(r"\|") >= enough) | (many(r"\s{2,}") >= enough))
        return F.when(table, F.concat(F.lit("```\n"), block, F.lit("\n```"))).otherwise(block)

    return F.array_join(F.transform(F.split(normal_markdown(text), "\n\n"), fence), "\n\n")


# Patterns and words that answers about prices need.
SIGNALS = {
    "n_amounts": r"\$\s*\d[\d,]*(?:\.\d{1,4})?|\bUSD\s*\d[\d,]*(?:\.\d{1,4})?", "n_percents": r"\b\d{1,3}(?:\.\d+)?\s*%", "n_years": r"\b(?:19|20)\d{2}\b", "n_numbers": r"\b\d[\d,]*(?:\.\d+)?\b",
    "n_amount_lines": r"(?m)^.*(?:\$|USD).*$",
}
TREND_WORDS = (
    "increase", "decrease", "growth", "baseline", "forecast", "trend", "yoy", "cpi", "inflation", "renewal", "uplift", "escalat", "annual", "year", "month", "pricing", "price", "rate", "fee",
    "credit", "discount", "subtotal", "total", "unit", "per user", "per seat", "per month", "per year",
)


def pricing_signals(text: Column) -> dict[str, Column]:
    """Counts of what answers about prices need: amounts, lines with amounts, percents, years, numbers, and how many trend words occur."""
    counts = {name: F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)) for name, pattern in SIGNALS.items()}
    words = sum((F.coalesce(F.lower(text).contains(w), F.lit(False)).cast("int") for w in TREND_WORDS), F.lit(0))
    return {**counts, "n_trend_words": words}


# Ends that a text is cut back to, in order of preference.
CUT_ENDS = (". ", "! ", "? ", "\n\n", "\n")


def cut_tokens(text: Column, most: int) -> Column:
    """A beginning of at most ``4 * most`` characters, cut back to the end of a sentence or line that loses less than a fifth."""
    size = 4 * most
    head = F.left(text, F.lit(size))
    out = head
    for end in reversed(CUT_ENDS):
        # The last place of an end: what is behind it in the reversed text.
        back = F.locate(end[::-1], F.reverse(head))
        stop = F.lit(size) - back + 1
        out = F.when((back > 0) & (stop - len(end) > 0.8 * size), F.left(head, stop)).otherwise(out)
    return F.when(F.length(text) <= size, text).otherwise(out)


def error_kind(error: Column) -> Column:
    """The kind of an error by the words of its message; null where there is none."""
    found = F.lower(error)
    kind = F.when(error.isNull(), F.lit(None).cast("string"))
    for name, words in ERROR_KINDS:
        for word in words:
            kind = kind.when(found.contains(word), name)
    return kind.otherwise("other")
