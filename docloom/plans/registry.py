"""All queries of the core, by name, and their equivalents in SQL."""

from __future__ import annotations

from docloom.plans import dirty_data, evaluated, more, records, reports, texts, vectors

_PARTS = (dirty_data, texts, records, vectors, more, evaluated, reports)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}

# Columns whose type in SQL is wider than here.
_NARROW = {
    "text_counts": ("INTEGER", "n_words n_chars n_lines n_bytes"),
    "text_entities": ("INTEGER", "n_amounts n_dates n_emails n_phones"),
    "text_depth": ("BIGINT", "sum_words sum_pricing sum_contract sum_finance sum_dollars sum_percents sum_dates sum_density"),
    "text_diagnostics": ("INTEGER", "n_broken_hyphens n_wide_gaps n_table_marks"),
    "email_redaction": ("INTEGER", "n_email"),
    "largest_files": ("INTEGER", "place"),
    "parser_outcomes": ("BIGINT", "n_replacements"),
    "top_by_source": ("INTEGER", "rank"),
    "dense_top": ("INTEGER", "rank"),
    "cosine_top": ("INTEGER", "rank"),
    "term_top": ("INTEGER", "rank"),
}
for _name, (_kind, _columns) in _NARROW.items():
    ORACLE[_name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS {_kind}) AS {c}' for c in _columns.split())}) FROM ({ORACLE[_name]})"
