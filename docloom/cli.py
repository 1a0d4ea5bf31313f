"""Command line: ``python -m docloom.cli discover|process|search|compare``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.chunking import ChunkRules
from docloom.operators.embedding import HashEmbedder, TemplateRewriter
from docloom.operators.filters import CatalogFilter
from docloom.plans import pipeline
from docloom.session import ship
from docloom.sources.bundle import ExportBundle
from docloom.sources.files import FolderSource, read_export
from docloom.sources.sinks import write_report, write_table


def _types(value: str | None) -> tuple[str, ...]:
    return tuple(v.strip() for v in (value or "").split(",") if v.strip())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docloom")
    commands = top.add_subparsers(dest="command", required=True)
    d = commands.add_parser("discover")
    d.add_argument("--source", choices=("local", "export"), default="local")
    d.add_argument("--path", required=True)
    d.add_argument("--output", required=True)
    for name in ("versions-csv", "deals-csv", "links-csv", "client-csv", "vendor-csv"):
        d.add_argument(f"--{name}")
    d.add_argument("--max-docs", type=int)
    d.add_argument("--min-size-kb", type=float, default=10.0)
    d.add_argument("--require-deal-association", action="store_true")
    d.add_argument("--hash", action="store_true")
    p = commands.add_parser("process")
    p.add_argument("--input", required=True)
    p.add_argument("--path", required=True)
    p.add_argument("--index", required=True)
    p.add_argument("--namespace", default="documents")
    p.add_argument("--reprocess", action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--filter-type")
    p.add_argument("--filter-file-type")
    p.add_argument("--exclude-file-type", default=".png")
    p.add_argument("--filter-vendor")
    p.add_argument("--filter-client")
    for name in ("modified-after", "modified-before", "deal-created-after", "deal-created-before"):
        p.add_argument(f"--{name}")
    p.add_argument("--min-size-kb", type=float)
    p.add_argument("--max-size-mb", type=float)
    p.add_argument("--chunking-strategy", choices=("business_aware", "semantic"), default="business_aware")
    p.add_argument("--enable-redaction", action="store_true")
    p.add_argument("--client-redaction-csv")
    s = commands.add_parser("search")
    s.add_argument("--index", required=True)
    s.add_argument("--query", required=True)
    s.add_argument("--top-k", type=int, default=20)
    s.add_argument("--alpha", type=float, default=0.6)
    s.add_argument("--mode", choices=("traditional", "rewritten", "combined", "fallback"), default="traditional")
    c = commands.add_parser("compare")
    c.add_argument("--left", required=True)
    c.add_argument("--right", required=True)
    c.add_argument("--queries", required=True, help="a text file with a query on each line")
    c.add_argument("--top-k", type=int, default=20)
    c.add_argument("--alpha", type=float, default=0.6)
    c.add_argument("--output")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Runs a command and returns what it reports."""
    ship(spark)
    model = HashEmbedder()
    if args.command == "discover":
        if args.source == "export":
            bundle = ExportBundle.read(spark, args.versions_csv, args.deals_csv, args.links_csv, args.client_csv, args.vendor_csv, args.path)
            catalog = bundle.documents()
            if args.require_deal_association:
                catalog = catalog.where("mapping_status <> 'unmapped'")
        else:
            catalog = pipeline.discover(FolderSource(spark, args.path, floor_kb=args.min_size_kb), args.hash)
        if args.max_docs:
            catalog = catalog.limit(args.max_docs)
        write_table(catalog, args.output)
        return spark.read.parquet(args.output).groupBy("file_type").agg(F.count("*").alias("n_files"))
    if args.command == "process":
        rule = CatalogFilter(
            args.reprocess, _types(args.filter_file_type), _types(args.exclude_file_type), args.min_size_kb, args.max_size_mb, args.modified_after, args.modified_before,
            args.deal_created_after, args.deal_created_before,
        )
        rules = pipeline.ProcessRules(rule, args.filter_vendor, args.filter_client, args.filter_type, args.limit, ChunkRules(), args.chunking_strategy, args.enable_redaction, args.namespace)
        registry = read_export(spark, args.client_redaction_csv) if args.client_redaction_csv else None
        if registry is not None:
            registry = registry.withColumnRenamed(registry.columns[0], "client_id")
        index, status = pipeline.process(spark.read.parquet(args.input), FolderSource(spark, args.path).contents(), rules, model, registry)
        pipeline.upsert_index(spark, args.index, index)
        write_table(status, f"{args.index}.status")
        return spark.read.parquet(f"{args.index}.status").groupBy("processed", "error").agg(F.count("*").alias("n_files"), F.sum("chunks_created").alias("n_chunks"))
    if args.command == "search":
        found = pipeline.search(spark.read.parquet(args.index), args.query, model, args.top_k, None, args.alpha, args.mode, TemplateRewriter())
        return found.select("rank", "score", "path", "chunk_index", "chunk")
    with open(args.queries, encoding="utf-8") as f:
        queries = [line.strip() for line in f if line.strip()]
    found = pipeline.compare(spark.read.parquet(args.left), spark.read.parquet(args.right), queries, model, args.top_k, args.alpha)
    if args.output:
        write_report(found, args.output, "json")
    return pipeline.summarised(found)


def main() -> None:
    args = parser().parse_args()
    run(SparkSession.builder.getOrCreate(), args).show(100, truncate=80)


if __name__ == "__main__":
    main()
