"""Queries over catalog, deals and search results: filters, joins, coverage, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.dates import epoch_seconds, year_of
from docloom.functions.nulls import clean_number, clean_text, is_missing, money
from docloom.functions.paths import effective_type
from docloom.operators import enrich, filters, quality, retrieval
from docloom.plans.data import table

RULE = filters.CatalogFilter(exclude_types=(".png", ".jpg"), min_size_kb=50, max_size_mb=8, modified_after="2019-01-01", modified_before="2025-06-30")


def clean_fields(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results")
    return rows.select("load_seq", clean_text(F.col("deal_status")).alias("deal_status"), F.left(clean_text(F.col("vendor_name")), F.lit(100)).alias("vendor_name"), clean_number(F.col("contract_term")).alias("term"), clean_number(F.col("final_amount")).alias("final_amount"))


def date_seconds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results")
    return rows.select("load_seq", *[epoch_seconds(F.col(c)).alias(f"{c}_ts") for c in ("deal_start_date", "contract_start", "contract_end")])


def deal_amounts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "deals")
    return rows.select("load_seq", money(F.col("total_proposed_amount__c")).alias("proposed"), money(F.col("total_final_amount__c")).alias("final"))


def catalog_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.with_reasons(table(spark, d, "catalog_files"), RULE)
    return rows.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n_files"))


def catalog_kept(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.with_reasons(table(spark, d, "catalog_files"), RULE)
    return rows.where(F.col("reject_reason").isNull()).select("load_seq", "name", "size_mb")


def filtered_results(spark: SparkSession, d: str) -> DataFrame:
    spec = {"$and": [{"pinecone_score": {"$gte": 0.5, "$lt": 0.9}}, {"$or": [{"content_source": "deal_narrative"}, {"file_type": {"$in": [".pdf", ".docx"]}}]}], "chunk_index": {"$lte": 2}}
    return table(spark, d, "search_results").where(filters.compile_filter(spec)).select("load_seq", "id", "chunk_index", "pinecone_score")


def latest_files(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "catalog_files").select("salesforce_content_version_id", "discovered_at", "load_seq", "name", "size")
    return filters.latest_rows(rows, ["salesforce_content_version_id"], ["discovered_at", "load_seq"]).drop("discovered_at")


def live_deals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "deals").select("id", "exported_at", "load_seq", "name", "status__c", "is_deleted")
    last = filters.latest_rows(rows, ["id"], ["exported_at", "load_seq"])
    return filters.live_rows(last, prefix=("id", "a0W")).select("id", "name", "status__c")


def largest_files(spark: SparkSession, d: str) -> DataFrame:
    return filters.balanced_top(table(spark, d, "catalog_files"), "file_type", "size", "path", 5)


def sampled_deals(spark: SparkSession, d: str) -> DataFrame:
    return filters.seeded_sample(table(spark, d, "deals"), "id", 25, 42)


def sampled_files(spark: SparkSession, d: str) -> DataFrame:
    """Two files of each sampled deal."""
    files = table(spark, d, "catalog_files").where(~is_missing(F.col("salesforce_deal_id"))).select(F.trim("salesforce_deal_id").alias("id"), "load_seq")
    drawn = files.join(sampled_deals(spark, d), "id", "left_semi")
    return filters.sample_per_group(drawn, "id", "load_seq", 2, 42)


def paged_files(spark: SparkSession, d: str) -> DataFrame:
    """The third page of the catalog listing."""
    return filters.page(table(spark, d, "catalog_files").select("load_seq", "path"), ["path", "load_seq"], 100, 50)


def _last_deals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "deals").select("id", "exported_at", "load_seq", "name", "client__c", "primary_deal_vendor__c", "total_proposed_amount__c", "total_final_amount__c")
    return filters.latest_rows(rows, ["id"], ["exported_at", "load_seq"])


def file_deals(spark: SparkSession, d: str) -> DataFrame:
    """Files with their deal, client and vendor names and how they were mapped."""
    deals = _last_deals(spark, d).withColumnRenamed("name", "deal_name")
    files = table(spark, d, "catalog_files").select("load_seq", "salesforce_deal_id")
    mapped = enrich.map_to_deals(files, "salesforce_deal_id", deals, "id", ["deal_name", "client__c", "primary_deal_vendor__c"])
    clients = table(spark, d, "client_registry").select(F.col("salesforce_client_id").alias("client__c"), "client_name")
    vendors = table(spark, d, "vendor_mapping").select(F.col("id").alias("primary_deal_vendor__c"), F.col("account_name").alias("vendor_name"))
    named = mapped.join(clients, "client__c", "left").join(vendors, "primary_deal_vendor__c", "left")
    return named.select("load_seq", "deal_name", "client_name", "vendor_name", "mapping_status", enrich.friendly_id("Client", F.col("client__c")).alias("client_label"))


def mapping_rates(spark: SparkSession, d: str) -> DataFrame:
    return file_deals(spark, d).groupBy("mapping_status").agg(F.count("*").alias("n_files"), F.countDistinct("deal_name").alias("n_deals"))


def deal_savings(spark: SparkSession, d: str) -> DataFrame:
    return _last_deals(spark, d).select("id", enrich.savings_percent(F.col("total_proposed_amount__c"), F.col("total_final_amount__c")).alias("percent_saved"))


def first_files(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalog_files").where(~is_missing(F.col("salesforce_deal_id")))
    return enrich.first_link(files.withColumn("deal", F.trim("salesforce_deal_id")), "deal", "salesforce_content_version_id", "load_seq")


def matched_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of search results matched to the catalog, by the first method that finds one."""
    files = table(spark, d, "search_results").where(F.col("document_path").isNotNull()).select(F.col("file_name").alias("name"), F.col("document_path").alias("path")).distinct()
    catalog = table(spark, d, "catalog_files").select(F.col("load_seq").alias("seq"), F.col("name").alias("file_name"), F.col("path").alias("relative_path"), F.col("salesforce_content_version_id").alias("ref"))
    return enrich.match_files(files, catalog).groupBy(F.coalesce("method", F.lit("none")).alias("method")).agg(F.count("*").alias("n_files"), F.countDistinct("ref").alias("n_refs"))


def vendor_backfill(spark: SparkSession, d: str) -> DataFrame:
    vendors = table(spark, d, "vendor_mapping")
    rows = table(spark, d, "search_results").select("load_seq", "vendor_id", "vendor_name")
    filled = enrich.backfill(rows, "vendor_name", F.trim("vendor_id"), vendors, "id", "account_name")
    return filled.select("load_seq", "vendor_name", "vendor_name_source")


def short_id_clients(spark: SparkSession, d: str) -> DataFrame:
    clients = table(spark, d, "client_registry").select(F.col("account_id").alias("k"), "client_name")
    rows = table(spark, d, "search_results").select(enrich.short_key(F.col("client_id")).alias("k"))
    return rows.join(clients, "k").groupBy("client_name").agg(F.count("*").alias("n_rows"))


def deal_overlay(spark: SparkSession, d: str) -> DataFrame:
    """First exports with the values of last exports put over them by name."""
    rows = table(spark, d, "deals").select("id", "name", "status__c", "total_final_amount__c", "load_seq", "exported_at")
    first = rows.groupBy("id").agg(F.min_by(F.struct("name", "status__c", "total_final_amount__c"), F.struct("exported_at", "load_seq")).alias("f")).select("id", "f.*")
    last = filters.latest_rows(rows, ["id"], ["exported_at", "load_seq"]).select("name", "status__c", "total_final_amount__c").groupBy("name").agg(F.max("status__c").alias("status__c"), F.max("total_final_amount__c").alias("total_final_amount__c"))
    return enrich.overlay(first, last, "name", ["status__c", "total_final_amount__c"])


def missing_refs(spark: SparkSession, d: str) -> DataFrame:
    """Deals named by files only, by results only, or by both, for each status of the mapping."""
    files = table(spark, d, "catalog_files").where(~is_missing(F.col("salesforce_deal_id"))).select(F.lit("all").alias("g"), F.trim("salesforce_deal_id").alias("deal"))
    results = table(spark, d, "search_results").where(~is_missing(F.col("deal_id"))).select(F.lit("all").alias("g"), F.trim("deal_id").alias("deal"))
    return enrich.overlap_counts(files, results, "deal", "g").drop("g")


def gapped_files(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results").where(F.col("document_path").isNotNull())
    return enrich.chunk_gaps(rows, "document_path", "chunk_index")


def rebuilt_files(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results").where(F.col("document_path").isNotNull() & F.col("text").isNotNull())
    once = rows.groupBy("document_path", "chunk_index").agg(F.min_by(F.struct("text", "metadata"), "load_seq").alias("c")).select("document_path", "chunk_index", "c.text", "c.metadata")
    whole = enrich.reconstruct(once, "document_path", "chunk_index", "text", F.get_json_object("metadata", "$.section_name"))
    return whole.select("document_path", "n_chunks", F.md5("full_text").alias("text_md5"))


COVERED = ["deal_id", "client_id", "vendor_id", "vendor", "client", "vendor_name", "deal_status", "contract_term", "contract_start", "contract_end", "proposed_amount", "final_amount", "chunk_index", "parser", "extraction_confidence"]


def coverage(spark: SparkSession, d: str) -> DataFrame:
    found = quality.field_coverage(table(spark, d, "search_results"), COVERED)
    return found.select("field", "n_filled", "n_empty", F.round("percent", 2).alias("percent"))


def coverage_samples(spark: SparkSession, d: str) -> DataFrame:
    found = quality.field_coverage(table(spark, d, "search_results"), ["deal_status", "contract_term", "parser", "vendor"])
    return found.select("field", F.array_join("samples", "|").alias("samples"))


def vendor_presence(spark: SparkSession, d: str) -> DataFrame:
    return quality.presence_pairs(table(spark, d, "search_results"), "vendor_id", "vendor_name")


AUDITED = ["deal_id", "vendor_name", "client", "deal_status", "current_narrative", "customer_comments", "contract_start", "contract_end", "deal_start_date", "proposed_amount", "final_amount"]


def field_audit(spark: SparkSession, d: str) -> DataFrame:
    return quality.audit(table(spark, d, "search_results"), AUDITED, ("deal_id", "vendor_name"), ("current_narrative", "customer_comments"), ("contract_start", "contract_end", "deal_start_date"), ("proposed_amount", "final_amount"))


def type_counts(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalog_files")
    kind = F.nullif(effective_type(F.col("file_type"), F.col("name"), F.col("path")), F.lit(""))
    return quality.distribution(files, kind, "file_type")


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.distribution(table(spark, d, "catalog_files"), F.col("document_type"), "document_type")


def year_counts(spark: SparkSession, d: str) -> DataFrame:
    year = F.coalesce(year_of(F.col("modified_time")).cast("string"), F.lit("no_date"))
    return table(spark, d, "catalog_files").groupBy(year.alias("year")).agg(F.count("*").alias("n_files"))


def year_range(spark: SparkSession, d: str) -> DataFrame:
    years = table(spark, d, "catalog_files").select(year_of(F.col("modified_time")).alias("y"))
    return years.agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.count_if(F.col("y") < 2000).alias("n_before_2000"), F.count_if(F.col("y") >= 2000).alias("n_since_2000"))


def file_sizes(spark: SparkSession, d: str) -> DataFrame:
    return quality.size_stats(table(spark, d, "catalog_files"), "size_mb")


def length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("source", F.coalesce("source", F.lit("none")))
    return quality.index_percentiles(docs, "source", "n_chars")


def parser_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results").withColumn("parser", F.coalesce("parser", F.lit("none")))
    found = quality.score_stats(rows, "parser", "pinecone_score")
    return found.select("parser", "n_scores", "min_score", "max_score", *[F.round(c, 6).alias(c) for c in ("mean_score", "median_score", "std_score")])


def parser_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Redaction outcomes for each model: totals, successes, failures, replacements."""
    rows = table(spark, d, "redaction_results")
    total = F.sum(sum((F.coalesce(c, F.lit(0)) for c in ("client_replacements", "email_replacements", "phone_replacements", "address_replacements", "person_replacements")), F.lit(0)))
    return rows.groupBy(F.coalesce("model_used", F.lit("none")).alias("model")).agg(F.count("*").alias("n_rows"), F.count_if("success").alias("n_success"), F.count_if(~F.coalesce("success", F.lit(False))).alias("n_failed"), F.count_if("validation_passed").alias("n_valid"), total.alias("n_replacements"))


def deal_file_sets(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "catalog_files").where(~is_missing(F.col("salesforce_deal_id")) & F.lower("name").endswith(".pdf"))
    return files.groupBy(F.trim("salesforce_deal_id").alias("deal")).agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))


def best_results(spark: SparkSession, d: str) -> DataFrame:
    """Search results without repeats: the best of each path, or of each file name where the path is blank."""
    rows = table(spark, d, "search_results")
    key = F.coalesce(retrieval.result_key(F.col("document_path"), F.col("file_name")), F.lit("none"))
    return retrieval.best_per_key(rows, key, "pinecone_score", "load_seq", ["id"])


def top_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "search_results").where("pinecone_score is not null").select("content_source", "load_seq", "pinecone_score")
    return retrieval.ranked(rows, ["content_source"], "pinecone_score", "load_seq", 20)


def source_confidence(spark: SparkSession, d: str) -> DataFrame:
    best = top_by_source(spark, d).where("rank <= 10").groupBy("content_source").agg(F.count("*").alias("n"), F.avg("pinecone_score").alias("m"))
    return best.select("content_source", F.round(retrieval.confidence(F.col("n"), F.col("m")), 6).alias("confidence"))


QUERIES = {
    f.__name__: f
    for f in (
        clean_fields, date_seconds, deal_amounts, catalog_reasons, catalog_kept, filtered_results, latest_files, live_deals, largest_files, sampled_deals, sampled_files, paged_files, file_deals,
        mapping_rates, deal_savings, first_files, matched_files, vendor_backfill, short_id_clients, deal_overlay, missing_refs, gapped_files, rebuilt_files, coverage,
        coverage_samples, vendor_presence, field_audit, type_counts, label_counts, year_counts, year_range, file_sizes, length_percentiles, parser_scores,
        parser_outcomes, deal_file_sets, best_results, top_by_source, source_confidence,
    )
}

_NULLS = "('', 'none', 'nan', 'null')"
_MISS = "('', 'none', 'nan', 'null', 'n/a')"
_AUDIT = "('', 'none', 'nan', 'null', 'undefined', 'n/a')"


def _clean(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN {_NULLS} THEN '' ELSE trim({c}) END"


def _money(c: str) -> str:
    bare = f"regexp_replace(trim({c}), '[$,\\s]', '', 'g')"
    return f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN {_MISS} OR {bare} = '0' THEN NULL ELSE try_cast({bare} AS DOUBLE) END"


def _seconds(c: str) -> str:
    s = f"(CASE WHEN {c} IS NULL OR lower(trim({c})) IN {_NULLS} THEN NULL ELSE trim({c}) END)"
    plain = f"regexp_replace(regexp_replace(regexp_replace({s}, '\\.\\d+(Z|[+-]\\d{{2}}:?\\d{{2}})$', '\\1'), 'Z$', '+00:00'), '([+-]\\d{{2}})(\\d{{2}})$', '\\1:\\2')"
    iso = "'^\\d{4}-\\d{2}-\\d{2}([T ]\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,6})?)?([+-]\\d{2}:\\d{2})?)?$'"
    off = f"(CASE WHEN length({plain}) > 10 THEN coalesce(try_cast(nullif(regexp_extract({plain}, '([+-]\\d{{2}}):\\d{{2}}$', 1), '') AS INT) * 3600 + CASE WHEN regexp_matches({plain}, '-\\d{{2}}:\\d{{2}}$') THEN -1 ELSE 1 END * try_cast(nullif(regexp_extract({plain}, '[+-]\\d{{2}}:(\\d{{2}})$', 1), '') AS INT) * 60, 0) ELSE 0 END)"
    naive = f"(CASE WHEN length({plain}) > 10 THEN regexp_replace({plain}, '[+-]\\d{{2}}:\\d{{2}}$', '') ELSE {plain} END)"
    us = "(" + ", ".join(f"try_strptime({s}, '{f}')" for f in ("%m/%d/%y %H:%M", "%m/%d/%Y %H:%M", "%m/%d/%y", "%m/%d/%Y")) + ")"
    return f"coalesce(CASE WHEN regexp_matches({plain}, {iso}) THEN epoch_us(try_cast({naive} AS TIMESTAMP)) // 1000000 - {off} END, epoch_us(coalesce{us}) // 1000000)"


_ext = "coalesce(CASE WHEN trim(coalesce(file_type, '')) <> '' THEN CASE WHEN starts_with(trim(file_type), '.') THEN lower(trim(file_type)) ELSE '.' || lower(trim(file_type)) END END, CASE WHEN contains(name, '.') THEN '.' || lower(trim(string_split(trim(name), '.')[-1])) END, CASE WHEN contains(path, '.') THEN '.' || lower(trim(string_split(trim(path), '.')[-1])) END, '')"
_size = "coalesce(size_mb, size / 1048576.0)"
_ts = _seconds("modified_time")
_REASONS = f"""WITH r AS (SELECT *, CASE WHEN {_ext} IN ('.png', '.jpg') THEN 'file_type' WHEN {_size} IS NULL OR {_size} * 1024 < 50 THEN 'min_size' WHEN {_size} > 8 THEN 'max_size'
  WHEN {_ts} IS NULL THEN 'modified_missing' WHEN {_ts} < epoch_us(TIMESTAMP '2019-01-01') // 1000000 THEN 'modified_after' WHEN {_ts} > epoch_us(TIMESTAMP '2025-06-30') // 1000000 THEN 'modified_before' END AS reason FROM catalog_files) """
_LAST = "SELECT * FROM deals QUALIFY row_number() OVER (PARTITION BY id ORDER BY exported_at DESC, load_seq DESC) = 1"
_FILE_DEALS = f"""WITH last AS ({_LAST}), fd AS (SELECT f.load_seq, d.name AS deal_name, c.client_name, v.account_name AS vendor_name,
  CASE WHEN f.ref IS NULL THEN 'unmapped' WHEN d.id IS NULL THEN 'mapped_no_metadata' ELSE 'mapped' END AS mapping_status,
  CASE WHEN d.client__c IS NULL OR lower(trim(d.client__c)) IN {_MISS} THEN 'Unknown Client' ELSE 'Client-' || right(trim(d.client__c), 8) END AS client_label
  FROM (SELECT load_seq, CASE WHEN lower(trim(salesforce_deal_id)) IN {_MISS} THEN NULL ELSE trim(salesforce_deal_id) END AS ref FROM catalog_files) f
  LEFT JOIN last d ON d.id = f.ref LEFT JOIN client_registry c ON c.salesforce_client_id = d.client__c LEFT JOIN vendor_mapping v ON v.id = d.primary_deal_vendor__c) """


def _filled(c: str) -> str:
    if c in ("proposed_amount", "final_amount", "extraction_confidence"):
        return f"coalesce({c} <> 0 AND NOT isnan({c}), false)"
    if c == "chunk_index":
        return f"coalesce({c} <> 0, false)"
    return f"({c} IS NOT NULL AND lower(trim({c})) NOT IN {_NULLS})"


def _audit(c: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    low = f"lower(trim({v}))"
    empty = f"({v} IS NULL OR {low} IN {_AUDIT})"
    req = f"count(*) FILTER ({empty})" if c in ("deal_id", "vendor_name") else "0"
    long = f"count(*) FILTER (length({v}) > 500)" if c in ("current_narrative", "customer_comments") else "0"
    odd = f"count(*) FILTER ({low} NOT IN ('', 'nan', 'none') AND NOT (regexp_matches(trim({v}), '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}') OR regexp_matches(trim({v}), '^\\d{{4}}-\\d{{2}}-\\d{{2}}')))" if c in ("contract_start", "contract_end", "deal_start_date") else "0"
    nil = f"count(*) FILTER (coalesce({c}, 0) = 0)" if c in ("proposed_amount", "final_amount") else "0"
    return f"SELECT '{c}' AS field, count(*) FILTER ({low} = 'nan') AS n_nan_text, count(*) FILTER ({low} IN ('none', 'null')) AS n_none_text, {req} AS n_required_empty, {long} AS n_long, {odd} AS n_odd_date, {nil} AS n_zero_amount, count(*) FILTER (regexp_matches({v}, '[^\\x00-\\x7F]')) AS n_non_ascii, count(*) FILTER (NOT {empty}) AS n_filled FROM search_results"


_year = "CASE WHEN regexp_matches(left(modified_time, 19), '^\\d{4}-\\d{1,2}-\\d{1,2}([T ]\\d{1,2}:\\d{1,2}:\\d{1,2})?$') THEN year(try_cast(regexp_extract(left(modified_time, 19), '^(\\d{4}-\\d{1,2}-\\d{1,2})', 1) AS DATE)) END"

_DRAWN = "SELECT id FROM (SELECT DISTINCT id FROM deals WHERE id IS NOT NULL) ORDER BY md5('42:' || id), id LIMIT 25"
ORACLE = {
    "sampled_deals": _DRAWN,
    "sampled_files": f"""WITH d AS ({_DRAWN}), f AS (SELECT trim(salesforce_deal_id) AS id, load_seq FROM catalog_files WHERE salesforce_deal_id IS NOT NULL AND lower(trim(salesforce_deal_id)) NOT IN {_MISS})
        SELECT id, load_seq FROM f SEMI JOIN d USING (id) QUALIFY row_number() OVER (PARTITION BY id ORDER BY md5('42:' || load_seq::VARCHAR), load_seq) <= 2""",
    "paged_files": "SELECT load_seq, path FROM catalog_files ORDER BY path, load_seq LIMIT 50 OFFSET 100",
    "clean_fields": f"SELECT load_seq, {_clean('deal_status')} AS deal_status, left({_clean('vendor_name')}, 100) AS vendor_name, coalesce(try_cast(contract_term AS DOUBLE), 0.0) AS term, coalesce(final_amount, 0.0) AS final_amount FROM (SELECT * REPLACE (CASE WHEN isnan(try_cast(contract_term AS DOUBLE)) THEN NULL ELSE contract_term END AS contract_term) FROM search_results)",
    "date_seconds": "SELECT load_seq, " + ", ".join(f"{_seconds(c)} AS {c}_ts" for c in ("deal_start_date", "contract_start", "contract_end")) + " FROM search_results",
    "deal_amounts": f"SELECT load_seq, {_money('total_proposed_amount__c')} AS proposed, {_money('total_final_amount__c')} AS final FROM deals",
    "catalog_reasons": _REASONS + "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n_files FROM r GROUP BY 1",
    "catalog_kept": _REASONS + "SELECT load_seq, name, size_mb FROM r WHERE reason IS NULL",
    "filtered_results": "SELECT load_seq, id, chunk_index, pinecone_score FROM search_results WHERE pinecone_score >= 0.5 AND pinecone_score < 0.9 AND (content_source = 'deal_narrative' OR file_type IN ('.pdf', '.docx')) AND chunk_index <= 2",
    "latest_files": "SELECT salesforce_content_version_id, load_seq, name, size FROM catalog_files QUALIFY row_number() OVER (PARTITION BY salesforce_content_version_id ORDER BY discovered_at DESC, load_seq DESC) = 1",
    "live_deals": f"SELECT id, name, status__c FROM ({_LAST}) WHERE lower(trim(coalesce(is_deleted, ''))) NOT IN ('true', '1', 'yes') AND starts_with(id, 'a0W')",
    "largest_files": "SELECT kind, size, path, place FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY size DESC, path) AS place FROM (SELECT CASE WHEN trim(coalesce(file_type, '')) = '' THEN '' WHEN starts_with(trim(file_type), '.') THEN lower(trim(file_type)) ELSE '.' || lower(trim(file_type)) END AS kind, max(struct_pack(size := size, path := path)).size AS size, max(struct_pack(size := size, path := path)).path AS path FROM catalog_files GROUP BY 1, lower(path))) WHERE place <= 5",
    "file_deals": _FILE_DEALS + "SELECT * FROM fd",
    "mapping_rates": _FILE_DEALS + "SELECT mapping_status, count(*) AS n_files, count(DISTINCT deal_name) AS n_deals FROM fd GROUP BY 1",
    "deal_savings": f"SELECT id, CASE WHEN p > 0 AND f <> 0 THEN round((p - f) / p * 100, 2) END AS percent_saved FROM (SELECT id, {_money('total_proposed_amount__c')} AS p, {_money('total_final_amount__c')} AS f FROM ({_LAST}))",
    "first_files": f"SELECT trim(salesforce_deal_id) AS deal, min_by(salesforce_content_version_id, load_seq) AS salesforce_content_version_id FROM catalog_files WHERE salesforce_deal_id IS NOT NULL AND lower(trim(salesforce_deal_id)) NOT IN {_MISS} AND salesforce_content_version_id IS NOT NULL GROUP BY 1",
    "matched_files": rf"""WITH f AS (SELECT DISTINCT file_name AS name, document_path AS path FROM search_results WHERE document_path IS NOT NULL),
        c AS (SELECT load_seq AS seq, name AS fn, path AS rp, salesforce_content_version_id AS ref FROM catalog_files),
        e AS (SELECT *, regexp_replace(name, '\.[^./]*$', '') AS stem, regexp_extract(name, '\.[^./]*$') AS ext FROM f),
        h AS (SELECT path, 'exact_name' AS method, 1 AS rank, seq, ref FROM e JOIN c ON fn = name
          UNION ALL SELECT path, 'exact_path', 2, seq, ref FROM e JOIN c ON rp = path
          UNION ALL SELECT path, 'path_ending', 3, seq, ref FROM e JOIN c ON ends_with(rp, path)
          UNION ALL SELECT path, 'version_name', 4, seq, ref FROM e JOIN c ON fn = regexp_replace(stem, '({"|".join(enrich.VERSION_ENDINGS)})$', '') || ext
          UNION ALL SELECT path, 'bare_name', 5, seq, ref FROM e JOIN c ON fn = stem
          UNION ALL SELECT path, 'base_name', 6, seq, ref FROM e JOIN c ON string_split(rp, '/')[-1] = string_split(path, '/')[-1]),
        b AS (SELECT path, min_by(method, rank::BIGINT * 1000000000 + seq) AS method, min_by(ref, rank::BIGINT * 1000000000 + seq) AS ref FROM h GROUP BY 1)
        SELECT coalesce(method, 'none') AS method, count(*) AS n_files, count(DISTINCT ref) AS n_refs FROM f LEFT JOIN b USING (path) GROUP BY 1""",
    "vendor_backfill": f"SELECT r.load_seq, CASE WHEN r.vendor_name IS NOT NULL AND lower(trim(r.vendor_name)) NOT IN {_MISS} THEN r.vendor_name ELSE v.account_name END AS vendor_name, CASE WHEN r.vendor_name IS NOT NULL AND lower(trim(r.vendor_name)) NOT IN {_MISS} THEN 'kept' WHEN v.account_name IS NOT NULL THEN 'filled' ELSE 'missing' END AS vendor_name_source FROM search_results r LEFT JOIN vendor_mapping v ON v.id = trim(r.vendor_id)",
    "short_id_clients": "SELECT c.client_name, count(*) AS n_rows FROM search_results r JOIN client_registry c ON c.account_id = substr(trim(r.client_id), 1, 15) GROUP BY 1",
    "deal_overlay": f"WITH f AS (SELECT * FROM deals QUALIFY row_number() OVER (PARTITION BY id ORDER BY exported_at, load_seq) = 1), l AS (SELECT name, max(status__c) AS s, max(total_final_amount__c) AS t FROM ({_LAST}) GROUP BY 1) SELECT f.id, f.name, CASE WHEN l.name IS NOT NULL THEN l.s ELSE f.status__c END AS status__c, CASE WHEN l.name IS NOT NULL THEN l.t ELSE f.total_final_amount__c END AS total_final_amount__c FROM f LEFT JOIN l ON l.name = f.name",
    "missing_refs": f"WITH a AS (SELECT DISTINCT trim(salesforce_deal_id) AS k FROM catalog_files WHERE lower(trim(salesforce_deal_id)) NOT IN {_MISS}), b AS (SELECT DISTINCT trim(deal_id) AS k FROM search_results WHERE lower(trim(deal_id)) NOT IN {_MISS}) SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS n_both, count(*) FILTER (b.k IS NULL) AS n_left_only, count(*) FILTER (a.k IS NULL) AS n_right_only FROM a FULL JOIN b ON a.k = b.k",
    "gapped_files": "SELECT document_path, count(DISTINCT chunk_index) AS n_chunks, min(chunk_index) AS first_index, max(chunk_index) AS last_index, count(DISTINCT chunk_index) <> max(chunk_index) - min(chunk_index) + 1 AS has_gap FROM search_results WHERE document_path IS NOT NULL GROUP BY 1",
    "rebuilt_files": """WITH o AS (SELECT document_path, chunk_index, text, json_extract_string(metadata, '$.section_name') AS s FROM search_results WHERE document_path IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_path, chunk_index ORDER BY load_seq) = 1),
        p AS (SELECT *, lag(s) OVER (PARTITION BY document_path ORDER BY chunk_index) AS b FROM o)
        SELECT document_path, count(*) AS n_chunks, md5(string_agg(CASE WHEN s IS NOT NULL AND s IS DISTINCT FROM b THEN '=== ' || s || ' ===' || chr(10) || text ELSE text END, chr(10) ORDER BY chunk_index)) AS text_md5 FROM p GROUP BY 1""",
    "coverage": " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({_filled(c)}) AS n_filled, count(*) FILTER (NOT {_filled(c)}) AS n_empty, round(count(*) FILTER ({_filled(c)}) * 100.0 / count(*), 2)::DOUBLE AS percent FROM search_results" for c in COVERED),
    "coverage_samples": " UNION ALL ".join(f"SELECT '{c}' AS field, array_to_string((list_sort(list_distinct(list(left({c}, 50)) FILTER ({_filled(c)}))))[1:3], '|') AS samples FROM search_results" for c in ("deal_status", "contract_term", "parser", "vendor")),
    "vendor_presence": f"SELECT CASE WHEN i AND n THEN 'both' WHEN i THEN 'id_only' WHEN n THEN 'name_only' ELSE 'neither' END AS presence, count(*) AS n_rows FROM (SELECT vendor_id IS NOT NULL AND lower(trim(vendor_id)) NOT IN {_MISS} AS i, vendor_name IS NOT NULL AND lower(trim(vendor_name)) NOT IN {_MISS} AS n FROM search_results) GROUP BY 1",
    "field_audit": " UNION ALL ".join(_audit(c) for c in AUDITED),
    "type_counts": f"SELECT coalesce(nullif({_ext}, ''), 'Unknown') AS file_type, count(*) AS n_rows FROM catalog_files GROUP BY 1",
    "label_counts": "SELECT coalesce(document_type, 'Unknown') AS document_type, count(*) AS n_rows FROM catalog_files GROUP BY 1",
    "year_counts": f"SELECT coalesce(CAST({_year} AS VARCHAR), 'no_date') AS year, count(*) AS n_files FROM catalog_files GROUP BY 1",
    "year_range": f"SELECT min(y)::INT AS first_year, max(y)::INT AS last_year, count(*) FILTER (y < 2000) AS n_before_2000, count(*) FILTER (y >= 2000) AS n_since_2000 FROM (SELECT {_year} AS y FROM catalog_files)",
    "file_sizes": "SELECT round(coalesce(sum(size_mb), 0), 2) AS total_size, round(coalesce(avg(size_mb), 0), 2) AS mean_size, round(coalesce(min(size_mb), 0), 2) AS min_size, round(coalesce(max(size_mb), 0), 2) AS max_size, count(*) FILTER (size_mb > 10) AS n_over_10, count(*) FILTER (size_mb > 50) AS n_over_50 FROM catalog_files WHERE coalesce(size_mb, 0) <> 0",
    "length_percentiles": "WITH l AS (SELECT coalesce(source, 'none') AS source, list_sort(list(n_chars)) AS v FROM documents WHERE n_chars IS NOT NULL GROUP BY 1) SELECT source, len(v) AS n, v[1] AS min_value, v[-1] AS max_value, v[floor(len(v) * 0.5)::INT + 1] AS p50, v[floor(len(v) * 0.9)::INT + 1] AS p90, v[floor(len(v) * 0.99)::INT + 1] AS p99 FROM l",
    "parser_scores": "SELECT coalesce(parser, 'none') AS parser, count(pinecone_score) AS n_scores, min(pinecone_score) AS min_score, max(pinecone_score) AS max_score, round(avg(pinecone_score), 6) AS mean_score, round(median(pinecone_score), 6) AS median_score, round(coalesce(stddev_samp(pinecone_score), 0), 6) AS std_score FROM search_results GROUP BY 1",
    "parser_outcomes": "SELECT coalesce(model_used, 'none') AS model, count(*) AS n_rows, count(*) FILTER (success) AS n_success, count(*) FILTER (NOT coalesce(success, false)) AS n_failed, count(*) FILTER (validation_passed) AS n_valid, sum(coalesce(client_replacements, 0) + coalesce(email_replacements, 0) + coalesce(phone_replacements, 0) + coalesce(address_replacements, 0) + coalesce(person_replacements, 0)) AS n_replacements FROM redaction_results GROUP BY 1",
    "deal_file_sets": f"SELECT trim(salesforce_deal_id) AS deal, array_to_string(list_sort(list_distinct(list(name))), '|') AS names FROM catalog_files WHERE salesforce_deal_id IS NOT NULL AND lower(trim(salesforce_deal_id)) NOT IN {_MISS} AND ends_with(lower(name), '.pdf') GROUP BY 1",
    "best_results": "SELECT result_key, pinecone_score, load_seq, id FROM (SELECT *, coalesce(nullif(trim(document_path), ''), file_name, 'none') AS result_key FROM search_results) QUALIFY row_number() OVER (PARTITION BY result_key ORDER BY pinecone_score DESC, load_seq) = 1",
    "top_by_source": "SELECT content_source, load_seq, pinecone_score, row_number() OVER (PARTITION BY content_source ORDER BY pinecone_score DESC, load_seq) AS rank FROM search_results WHERE pinecone_score IS NOT NULL QUALIFY rank <= 20",
    "source_confidence": "WITH t AS (SELECT content_source, pinecone_score FROM search_results WHERE pinecone_score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY content_source ORDER BY pinecone_score DESC, load_seq) <= 10) SELECT content_source, round(least(1.0, least(count(*) / 10.0, 1.0) * 0.3 + avg(pinecone_score) * 0.7), 6)::DOUBLE AS confidence FROM t GROUP BY 1",
}
