"""Small helpers on records: nested fields, keys, labels, schema checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.dates import epoch_seconds
from docloom.functions.nulls import clean_number, clean_text
from docloom.functions.text import cut_bytes

# Longest stored text of each field.
CAPS = {"file_name": 200, "contract_term": 100, "client": 100, "vendor_name": 100, "negotiated_by": 50, "deal_status": 50, "parser": 50}
PARSER_LABELS = {
    ".xlsx": "workbook", ".xls": "workbook", ".csv": "workbook", ".docx": "word", ".doc": "old_word", ".msg": "mail", ".pptx": "slides", ".txt": "direct_text",
}


# The fields that an index stores, in groups by kind, with the longest text of each (None: as it is).
STORED_TEXTS = {
    "file_name": 200, "file_type": None, "deal_creation_date": None, "deal_id": None, "salesforce_deal_id": None, "salesforce_client_id": None, "salesforce_vendor_id": None, "savings_achieved": 200,
    "contract_term": 100, "contract_start": None, "contract_end": None, "client_name": 100, "vendor_name": 100, "deal_status": None, "deal_reason": 50, "report_type": 100, "project_type": 50,
    "competition": 10, "npi_analyst": 50, "dual_multi_sourcing": 10, "time_pressure": 20, "advisor_network_used": 10, "text": 37_000,
}
STORED_NUMBERS = ("final_amount", "savings_1yr", "savings_3yr", "fixed_savings", "savings_target_full_term")
STORED_DATES = ("deal_creation_date", "contract_start", "contract_end")


def stored_fields(df: DataFrame, names: dict[str, str] | None = None, errors: str | None = None) -> DataFrame:
    """All 31 fields that an index stores, and three dates also as seconds where they can be read.

    ``names`` maps a field to the column that holds it, where that has another name; a field without a column is empty, zero or false.
    ``errors`` is an array column of parsing errors.
    """
    have = set(df.columns)
    source = lambda f: (names or {}).get(f, f)
    text = lambda f: clean_text(F.col(f"`{source(f)}`").cast("string")) if source(f) in have else F.lit("")
    number = lambda f: clean_number(F.col(f"`{source(f)}`")) if source(f) in have else F.lit(0.0)
    out = [(F.left(text(f), F.lit(cap)) if cap else text(f)).alias(f) for f, cap in STORED_TEXTS.items()]
    out += [number(f).alias(f) for f in STORED_NUMBERS]
    out.append(number("chunk_index").cast("int").alias("chunk_index"))
    out.append((F.coalesce(F.size(errors) > 0, F.lit(False)) if errors else F.lit(False)).alias("has_parsing_errors"))
    flag = source("email_has_attachments")
    out.append((F.coalesce(F.col(f"`{flag}`").cast("boolean"), F.lit(False)) if flag in have else F.lit(False)).alias("email_has_attachments"))
    out += [(epoch_seconds(F.col(f"`{source(f)}`").cast("string")) if source(f) in have else F.lit(None).cast("long")).alias(f"{f}_ts") for f in STORED_DATES]
    return df.select(*out)


def with_nested(df: DataFrame, path: str, value: Column) -> DataFrame:
    """A field of a struct, given by a dotted path, replaced; a null struct on the way stays null."""
    first, _, rest = path.partition(".")
    return df.withColumn(first, F.col(first).withField(rest, value)) if rest else df.withColumn(first, value)


def chunk_key(path: Column, index: Column) -> Column:
    """A chunk id that does not show the path."""
    return F.concat(F.md5(path), F.lit("-chunk-"), F.lpad(index.cast("string"), 4, "0"))


def parser_label(file_type: Column, backend: str) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in PARSER_LABELS.items() for x in pair])
    image = F.when(file_type.isin(".png", ".jpg", ".jpeg"), f"image_{backend}").when(file_type == ".pdf", backend)
    return F.coalesce(image, F.try_element_at(kinds, file_type), F.lit("unknown"))


def size_class(size_mb: Column) -> Column:
    return F.when(size_mb < 1, "small").when(size_mb < 10, "medium").when(size_mb >= 10, "large")


def missing_fields(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """Expected columns that a table lacks, and columns that were not expected."""
    return sorted(set(expected) - set(df.columns)), sorted(set(df.columns) - set(expected))


def mentions(spellings: list[str], columns: list[str]) -> Column:
    """Rows that hold one of several spellings of a value in one of several columns."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c).isin(spellings), F.lit(False)) for c in columns])


def stored(df: DataFrame, text: str = "text") -> DataFrame:
    """The projection that an index stores: text trimmed and cut, numbers without nulls, dates also as seconds."""
    out = []
    for name, kind in df.dtypes:
        if name == text:
            out.append(cut_bytes(clean_text(F.col(name))).alias(name))
        elif kind == "string":
            clean = clean_text(F.col(f"`{name}`"))
            out.append((F.left(clean, F.lit(CAPS[name])) if name in CAPS else clean).alias(name))
        elif kind in ("double", "float"):
            out.append(clean_number(F.col(f"`{name}`")).alias(name))
        else:
            out.append(F.col(f"`{name}`"))
    dates = [c for c in ("deal_start_date", "contract_start", "contract_end") if c in df.columns]
    return df.select(*out, *[epoch_seconds(F.col(c)).alias(f"{c}_ts") for c in dates])


def backfill_seconds(df: DataFrame, dates: list[str]) -> DataFrame:
    """Fills ``<date>_ts`` only where it is missing."""
    return df.withColumns({f"{c}_ts": F.coalesce(f"{c}_ts", epoch_seconds(F.col(c))) for c in dates})


def without(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not meet a condition; a condition that is null is not met."""
    return df.where(~F.coalesce(condition, F.lit(False)))
