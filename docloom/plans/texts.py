"""Queries over texts and names: counts, entities, labels, redaction, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.paths import effective_type, path_fields, path_warnings, safe_name
from docloom.operators import chunking, redaction
from docloom.plans.data import table
from docloom.session import spread



def text_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return docs.select("doc_id", T.word_count(F.col("text")).alias("n_words"), F.length("text").alias("n_chars"), T.line_count(F.col("text")).alias("n_lines"), F.octet_length("text").alias("n_bytes"))


def text_entities(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return spread(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", F.size(T.matches(t, T.AMOUNTS)).alias("n_amounts"), F.size(T.matches(t, T.DATES)).alias("n_dates"), F.size(T.matches(t, (T.EMAIL,))).alias("n_emails"),
        F.size(T.matches(t, (T.PHONE,))).alias("n_phones"), F.array_join(T.contained_terms(t), "|").alias("contract_terms"),
    )


def text_depth(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("text")
    measured = spread(table(spark, d, "documents").select("source", "text")).select(
        F.coalesce("source", F.lit("none")).alias("source"), T.word_count(F.col("text")).alias("words"),
        T.keyword_count(F.col("text"), T.PRICING_WORDS).alias("pricing"), T.keyword_count(F.col("text"), T.CONTRACT_WORDS).alias("contract"),
        T.keyword_count(F.col("text"), T.FINANCE_WORDS).alias("finance"), F.regexp_count(low, F.lit(T.DOLLARS)).alias("dollars"),
        F.regexp_count("text", F.lit(T.PERCENTS)).alias("percents"), F.regexp_count(low, F.lit(T.ANY_DATE)).alias("dates"),
    )
    names = ("words", "pricing", "contract", "finance", "dollars", "percents", "dates")
    density = F.sum(F.col("pricing") + F.col("contract") + F.col("finance") + 2 * F.col("dollars"))
    return measured.groupBy("source").agg(F.count("*").alias("n_docs"), *[F.sum(n).alias(f"sum_{n}") for n in names], density.alias("sum_density"))


def text_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return spread(table(spark, d, "parsed_content").select("content_id", "text")).where(F.length(t) > 0).select(
        "content_id", F.round(T.repeated_line_ratio(t), 4).alias("repeated_lines"), F.round(T.non_ascii_percent(t), 2).alias("non_ascii_percent"),
        T.broken_hyphens(t).alias("n_broken_hyphens"), T.wide_gaps(t).alias("n_wide_gaps"), T.table_marks(t).alias("n_table_marks"),
    )


def chunk_types(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results").where(F.col("text").isNotNull())
    return rows.groupBy(T.first_kind(F.col("text"), T.CHUNK_TYPES, "general").alias("chunk_type"), "content_source").agg(F.count("*").alias("n_chunks"))


def file_classes(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalog_files")
    return files.select("load_seq", T.file_class(F.col("name")).alias("c")).select("load_seq", "c.document_type", "c.confidence", "c.method")


def document_labels(spark: SparkSession, d: str) -> DataFrame:
    labels = ("FMV Report", "Quote/Proposal", "Contract/SoW/MSA", "Product Literature", "Email")
    names = table(spark, d, "catalog_files").select(F.col("document_type").alias("raw_label"))
    return names.groupBy("raw_label", T.normal_label(F.col("raw_label"), labels).alias("label")).agg(F.count("*").alias("n_files"))


def query_kinds(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "eval_items")
    return items.select("item_id", T.query_kind(F.col("item_text"), F.col("expected_document_type")).alias("query_kind"))


def context_suffixes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results")
    return rows.select("load_seq", T.context_suffix(vendor=F.col("vendor"), client=F.col("client"), deal=F.col("deal_name")).alias("suffix"))


def document_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results")
    return rows.groupBy(T.document_key(F.col("deal_name"), F.col("file_name"), F.col("id")).alias("document_key")).agg(F.count("*").alias("n_rows"))


def stored_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut to the bytes that an index takes."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.md5(T.cut_bytes(F.col("text"))).alias("text_md5"))


def path_metadata(spark: SparkSession, d: str) -> DataFrame:
    found = path_fields(table(spark, d, "catalog_files").select("load_seq", "path"), "path")
    return found.select("load_seq", "year", "week_number", "week_date", "vendor", "client", "deal_number", "deal_name", F.round("confidence", 1).alias("confidence"))


def path_problems(spark: SparkSession, d: str) -> DataFrame:
    found = path_fields(table(spark, d, "catalog_files").select("load_seq", "path"), "path")
    return found.select(F.explode(path_warnings()).alias("warning")).groupBy("warning").agg(F.count("*").alias("n_files"))


def file_names(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalog_files")
    return files.select("load_seq", safe_name(F.col("name")).alias("safe_name"), effective_type(F.col("file_type"), F.col("name"), F.col("path")).alias("ext"))


def contact_redaction(spark: SparkSession, d: str) -> DataFrame:
    """Contacts replaced in every document, counted by source; flagship query."""
    done = redaction.redact_contacts(spread(table(spark, d, "documents").select("source", "text")), "text")
    totals = [F.sum(f"n_{k}").alias(f"n_{k}") for k in ("email", "phone", "address")]
    left = redaction.failures(F.col("redacted"))
    return done.groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count("*").alias("n_docs"), *totals, F.count_if(F.size(left) > 0).alias("n_failed"))


def email_redaction(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(redaction.EMAIL)), F.lit(0)).alias("n_email"), F.md5(F.regexp_replace("text", redaction.EMAIL, "<<EMAIL>>")).alias("text_md5"))


def client_redaction(spark: SparkSession, d: str) -> DataFrame:
    registry = table(spark, d, "client_registry").withColumnRenamed("salesforce_client_id", "client_id")
    docs = spread(table(spark, d, "documents").select("doc_id", F.trim("client_id").alias("client"), "text"))
    done = redaction.redact_clients(docs, "text", "client", registry)
    return done.select("doc_id", "n_client", F.md5("client_redacted").alias("text_md5"))


def business_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_rows(spread(table(spark, d, "parsed_content").select("content_id", "text")), "content_id", "text")


def text_windows(spark: SparkSession, d: str) -> DataFrame:
    w = redaction.windows(F.col("text"), 5_000, 300)
    rows = table(spark, d, "parsed_content").where(F.length("text") > 0).select("content_id", F.inline(w))
    return rows.select("content_id", "window_no", "offset", F.md5("part").alias("part_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        text_counts, text_entities, text_depth, text_diagnostics, chunk_types, file_classes, document_labels, query_kinds, context_suffixes, document_keys,
        stored_text, path_metadata, path_problems, file_names, contact_redaction, email_redaction, client_redaction, business_chunks, text_windows,
    )
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _kind_sql(expr: str, kinds, default: str | None) -> str:
    low = f"lower(coalesce({expr}, ''))"
    whens = " ".join(f"WHEN {' OR '.join(f'contains({low}, {_q(w)})' for w in words)} THEN {_q(kind)}" for kind, words in kinds)
    return f"CASE {whens} ELSE {'NULL' if default is None else _q(default)} END"


def _distinct_sql(patterns) -> str:
    return "len(list_distinct(" + "||".join(f"regexp_extract_all(text, {_q(p)})" for p in patterns) + "))"


def _words_sql(words) -> str:
    return "(" + "+".join(f"len(regexp_extract_all(lower(text), {_q(chr(92) + 'b' + w + chr(92) + 'b')}))" for w in words) + ")"


def _count_sql(pattern: str, of: str = "text") -> str:
    return f"len(regexp_extract_all({of}, {_q(pattern)}))"


_terms = ", ".join(f"CASE WHEN contains(lower(text), {_q(t)}) THEN {_q(t)} END" for t in T.CONTRACT_TERMS)
_depth = {"words": _count_sql(r"\S+"), "pricing": _words_sql(T.PRICING_WORDS), "contract": _words_sql(T.CONTRACT_WORDS), "finance": _words_sql(T.FINANCE_WORDS), "dollars": _count_sql(T.DOLLARS, "lower(text)"), "percents": _count_sql(T.PERCENTS), "dates": _count_sql(T.ANY_DATE, "lower(text)")}
_labels = ("FMV Report", "Quote/Proposal", "Contract/SoW/MSA", "Product Literature", "Email")
_low = "lower(trim(document_type))"
_label_sql = (
    "CASE " + " ".join(f"WHEN {_low} = {_q(n.lower())} THEN {_q(n)}" for n in _labels) + f" WHEN {_low} = '' THEN NULL "
    + " ".join(f"WHEN contains({_low}, {_q(n.lower())}) OR contains({_q(n.lower())}, {_low}) THEN {_q(n)}" for n in _labels) + " END"
)
_suffix = ", ".join(f"CASE WHEN {c} <> '' THEN '{n}: ' || {c} END" for n, c in (("vendor", "vendor"), ("client", "client"), ("deal", "deal_name")))
_split = "string_split('/' || ltrim(path, '/'), '/')"
_part = f"CASE WHEN regexp_matches({_split}[2], '(?i)(\\d{{4}})\\s*deal\\s*docs?') THEN list_concat([''], {_split}) ELSE {_split} END"
_company = (
    "CASE WHEN coalesce({p}, '') = '' THEN NULL WHEN contains(lower(trim(translate({p}, '_-', '  '))), 'p&g') OR contains(lower(trim(translate({p}, '_-', '  '))), 'pg') THEN 'Procter & Gamble' "
    "ELSE nullif(array_to_string(list_transform(string_split(regexp_replace(trim(translate({p}, '_-', '  ')), '\\s+', ' ', 'g'), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' '), '') END"
)
_paths = f"""
WITH s AS (SELECT load_seq, {_part} AS p FROM catalog_files),
f AS (SELECT load_seq, len(p) AS size, nullif(regexp_extract(coalesce(p[3], ''), '(?i)(\\d{{4}})\\s*deal\\s*docs?', 1), '') AS year,
  try_cast(nullif(regexp_extract(coalesce(p[4], ''), '(?i)week(\\d+)-(\\d{{2}})(\\d{{2}})(\\d{{4}})', 1), '') AS INT) AS week_number,
  nullif(regexp_replace(regexp_extract(coalesce(p[4], ''), '(?i)week\\d+-(\\d{{8}})', 1), '(\\d\\d)(\\d\\d)(\\d{{4}})', '\\1/\\2/\\3'), '') AS week_date,
  {_company.format(p='p[5]')} AS vendor, {_company.format(p='p[6]')} AS client,
  nullif(regexp_extract(coalesce(p[7], ''), '(?i)deal[_\\-]?(\\d+)', 1), '') AS deal_number,
  CASE WHEN regexp_matches(coalesce(p[7], ''), '(?i)deal[_\\-]?\\d+') THEN p[7] END AS deal_name FROM s),
g AS (SELECT *, ((CASE WHEN year IS NULL THEN 0 ELSE 2 END) + (CASE WHEN week_number IS NULL THEN 0 ELSE 2 END) + (CASE WHEN vendor IS NULL THEN 0 ELSE 2 END)
  + (CASE WHEN client IS NULL THEN 0 ELSE 2 END) + (CASE WHEN deal_number IS NULL THEN 0 ELSE 2 END)
  + (CASE WHEN contains(lower(deal_name), lower(vendor)) THEN 1 ELSE 0 END)) / 10.0 AS confidence FROM f)
"""
_tail = "CASE WHEN contains({c}, '.') THEN '.' || lower(trim(string_split(trim({c}), '.')[-1])) END"

# Contacts step by step. DuckDB's patterns have no look-behind: what may stand before a telephone number is matched and put back.
_AHEAD = r"(^|^\.|[^\d.]|[^\d]\.)"
_PHONE = _AHEAD + redaction.PHONE.removeprefix(r"(?<!\d)(?<!\d\.)")
_contacts = f"""WITH a AS (SELECT source, text, regexp_replace(text, {_q(redaction.EMAIL)}, '<<EMAIL>>', 'g') AS t1 FROM documents),
    b AS (SELECT *, regexp_replace(t1, {_q(_PHONE)}, '\\1<<PHONE>>', 'g') AS t2 FROM a), c AS (SELECT *, regexp_replace(t2, {_q(redaction.ADDRESS)}, '<<ADDRESS>>', 'g') AS t3 FROM b)"""


# Spellings of clients as one pattern each. Look-around is matched and put back; a second pass takes names that shared the blank between them.
_bare = ", ".join(f"trim(regexp_replace(n, '(?i)\\s+{x}\\.?$', ''))" for x in redaction.LEGAL)
_less = ", ".join(f"trim(regexp_replace(n, '(?i)\\b{x}\\b\\s*', '', 'g'))" for x in redaction.DROPPED)
_endings = "|".join(redaction.TAIL_ENDINGS)
_clients = f"""WITH c AS (SELECT salesforce_client_id AS cid, trim(client_name) AS n, aliases, '<<CLIENT: ' || CASE WHEN trim(coalesce(industry_label, '')) = '' THEN 'Client Organization' ELSE trim(industry_label) END || '>>' AS token FROM client_registry),
    f AS (SELECT cid, token, list_concat([n, regexp_replace(n, '\\s+', ' ', 'g'), {_bare}, {_less}, regexp_replace(n, '\\s+', '', 'g'), CASE WHEN contains(n, '&') THEN replace(n, '&', 'and') END,
      CASE WHEN contains(lower(n), 'and') THEN replace(n, 'and', '&') END], list_transform(string_split(coalesce(aliases, ''), '|'), lambda a: trim(a))) AS forms FROM c),
    l AS (SELECT cid, token, unnest(list_distinct(list_transform(list_filter(forms, lambda x: coalesce(x, '') <> ''), lambda x: lower(x)))) AS form FROM f),
    p AS (SELECT cid, token, '(?i)(^|[^A-Za-z0-9])(?:' || string_agg(regexp_escape(form), '|' ORDER BY length(form) DESC, form) || ')($|[^A-Za-z0-9])' AS pattern FROM l GROUP BY ALL),
    d AS (SELECT doc_id, text, token, pattern FROM documents LEFT JOIN p ON cid = trim(client_id)), a AS (SELECT *, regexp_replace(text, pattern, '\\1' || token || '\\2', 'g') AS t1 FROM d),
    b AS (SELECT *, regexp_replace(t1, pattern, '\\1' || token || '\\2', 'g') AS t2 FROM a), e AS (SELECT *, CASE WHEN token IS NULL THEN text ELSE t2 END AS said FROM b)"""
_times = "(length({t}) - length(replace({t}, token, ''))) // length(token)"


ORACLE = {
    "client_redaction": _clients + f""" SELECT doc_id, coalesce({_times.format(t='t2')} - {_times.format(t='text')}, 0)::INTEGER AS n_client,
        md5(regexp_replace(said, '(<<CLIENT: [^>]*>>)\\s+(?:and\\s+)?(?:[A-Z][A-Za-z0-9&''.-]*\\s+){{0,10}}(?:{_endings})\\b(?:\\s+Inc\\b)?', '\\1', 'g')) AS text_md5 FROM e""",
    "contact_redaction": _contacts + f""" SELECT coalesce(source, 'none') AS source, count(*) AS n_docs, sum(coalesce(len(regexp_extract_all(text, {_q(redaction.EMAIL)})), 0))::BIGINT AS n_email,
        sum(coalesce(len(regexp_extract_all(t1, {_q(_PHONE)})), 0))::BIGINT AS n_phone, sum(coalesce(len(regexp_extract_all(t2, {_q(redaction.ADDRESS)})), 0))::BIGINT AS n_address,
        count(*) FILTER (regexp_matches(t3, {_q(redaction.EMAIL)}) OR regexp_matches(t3, {_q(_PHONE)})) AS n_failed FROM c GROUP BY 1""",
    "stored_text": "SELECT doc_id, md5(left(text, 37888)) AS text_md5 FROM documents WHERE strlen(text) = length(text) OR strlen(text) <= 37888 OR text IS NULL UNION ALL "
    "SELECT doc_id, md5(list_aggregate(list_filter(list_transform(range(1, 37889), lambda i: left(text, i)), lambda t: strlen(t) <= 37888), 'max')) FROM documents WHERE strlen(text) > length(text) AND strlen(text) > 37888",
    "text_counts": r"SELECT doc_id, coalesce(len(regexp_extract_all(text, '\S+')), 0) AS n_words, length(text) AS n_chars, coalesce(len(string_split(text, chr(10))), 0) AS n_lines, strlen(text) AS n_bytes FROM documents",
    "text_entities": f"SELECT doc_id, {_distinct_sql(T.AMOUNTS)} AS n_amounts, {_distinct_sql(T.DATES)} AS n_dates, {_distinct_sql((T.EMAIL,))} AS n_emails, {_distinct_sql((T.PHONE,))} AS n_phones, concat_ws('|', {_terms}) AS contract_terms FROM documents",
    "text_depth": "SELECT coalesce(source, 'none') AS source, count(*) AS n_docs, " + ", ".join(f"sum({s}) AS sum_{n}" for n, s in _depth.items())
    + f", sum({_depth['pricing']} + {_depth['contract']} + {_depth['finance']} + 2 * {_depth['dollars']}) AS sum_density FROM documents GROUP BY 1",
    "text_diagnostics": rf"""SELECT content_id, round(1.0 - len(list_distinct(string_split(text, chr(10)))) / len(string_split(text, chr(10))), 4) AS repeated_lines,
        round({_count_sql('[^\\x00-\\x7F]')} * 100.0 / length(text), 2) AS non_ascii_percent, {_count_sql(r'\w+-\s*\n\s*\w+')} AS n_broken_hyphens,
        {_count_sql(' {3,}')} AS n_wide_gaps, {_count_sql('=== .+ ===')} AS n_table_marks FROM parsed_content WHERE length(text) > 0""",
    "chunk_types": f"SELECT {_kind_sql('text', T.CHUNK_TYPES, 'general')} AS chunk_type, content_source, count(*) AS n_chunks FROM search_results WHERE text IS NOT NULL GROUP BY ALL",
    "file_classes": f"SELECT load_seq, coalesce(k, 'Quote/Proposal') AS document_type, CASE WHEN k IS NULL THEN 0.2::DOUBLE ELSE 0.6::DOUBLE END AS confidence, CASE WHEN k IS NULL THEN 'default' ELSE 'pattern' END AS method FROM (SELECT load_seq, {_kind_sql('name', T.NAME_TYPES, None)} AS k FROM catalog_files)",
    "document_labels": f"SELECT document_type AS raw_label, {_label_sql} AS label, count(*) AS n_files FROM catalog_files GROUP BY ALL",
    "query_kinds": f"SELECT item_id, coalesce(CASE WHEN expected_document_type IS NOT NULL THEN {_kind_sql('expected_document_type', T.TYPE_KINDS, None)} END, {_kind_sql('item_text', T.QUERY_KINDS, 'general')}) AS query_kind FROM eval_items",
    "context_suffixes": f"SELECT load_seq, CASE WHEN concat_ws(', ', {_suffix}) = '' THEN '' ELSE ' (' || concat_ws(', ', {_suffix}) || ')' END AS suffix FROM search_results",
    "document_keys": "SELECT CASE WHEN trim(coalesce(deal_name, '')) <> '' OR trim(coalesce(file_name, '')) <> '' THEN trim(coalesce(deal_name, '')) || '::' || trim(coalesce(file_name, '')) WHEN trim(coalesce(id, '')) <> '' THEN 'sf_' || trim(id) ELSE 'unknown' END AS document_key, count(*) AS n_rows FROM search_results GROUP BY 1",
    "path_metadata": _paths + "SELECT load_seq, year, week_number, week_date, vendor, client, deal_number, deal_name, round(confidence, 1)::DOUBLE AS confidence FROM g",
    "path_problems": _paths + """SELECT warning, count(*) AS n_files FROM (SELECT unnest([
        CASE WHEN year IS NULL OR vendor IS NULL OR client IS NULL THEN 'missing: ' || concat_ws(', ', CASE WHEN year IS NULL THEN 'year' END, CASE WHEN vendor IS NULL THEN 'vendor' END, CASE WHEN client IS NULL THEN 'client' END) END,
        CASE WHEN week_date IS NOT NULL AND try_strptime(week_date, '%m/%d/%Y') IS NULL THEN 'date' END,
        CASE WHEN confidence < 0.5 THEN 'low confidence' END,
        CASE WHEN try_cast(year AS INT) < 2020 THEN 'unusual year' END,
        CASE WHEN NOT week_number BETWEEN 1 AND 53 THEN 'week number' END]) AS warning FROM g) WHERE warning IS NOT NULL GROUP BY 1""",
    "file_names": "SELECT load_seq, left(regexp_replace(regexp_replace(trim(name), '[^a-zA-Z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), 120) AS safe_name, "
    "coalesce(CASE WHEN trim(coalesce(file_type, '')) <> '' THEN CASE WHEN starts_with(trim(file_type), '.') THEN lower(trim(file_type)) ELSE '.' || lower(trim(file_type)) END END, "
    + _tail.format(c="name") + ", " + _tail.format(c="path") + ", '') AS ext FROM catalog_files",
    "email_redaction": f"SELECT doc_id, coalesce({_count_sql(redaction.EMAIL)}, 0) AS n_email, md5(regexp_replace(text, {_q(redaction.EMAIL)}, '<<EMAIL>>', 'g')) AS text_md5 FROM documents",
    "text_windows": """SELECT content_id, i::INT AS window_no, (i * 4700)::BIGINT AS "offset", md5(substr(text, i * 4700 + 1, 5000)) AS part_md5
        FROM (SELECT content_id, text, unnest(range(greatest(ceil((length(text) - 300) / 4700.0)::INT, 1))) AS i FROM parsed_content WHERE length(text) > 0)""",
}
