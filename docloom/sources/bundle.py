"""An export bundle: versions, documents, links, deals and names in CSVs, brought together as documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.nulls import is_true, money, present
from docloom.functions.paths import extension
from docloom.operators.enrich import first_link, friendly_id, map_to_deals, resolve_paths, savings_percent, short_key
from docloom.operators.filters import latest_rows
from docloom.sources.files import SUPPORTED, id_names, pick, read_export

# Names of file types in an export and their extensions.
TYPE_NAMES = {
    "PDF": ".pdf", "WORD": ".doc", "WORD_X": ".docx", "EXCEL": ".xls", "EXCEL_X": ".xlsx", "POWER_POINT": ".ppt", "POWER_POINT_X": ".pptx",
    "CSV": ".csv", "TEXT": ".txt", "PNG": ".png", "JPG": ".jpg", "JPEG": ".jpeg", "OUTLOOK": ".msg", "HTML": ".html",
}


@dataclass
class ExportBundle:
    """The tables of a bundle, all columns text; ``links``, ``clients`` and ``vendors`` may be absent."""

    versions: DataFrame
    deals: DataFrame
    links: DataFrame | None = None
    clients: DataFrame | None = None
    vendors: DataFrame | None = None
    listing: DataFrame | None = None

    @staticmethod
    def read(spark: SparkSession, versions: str, deals: str, links: str | None = None, clients: str | None = None, vendors: str | None = None, root: str | None = None) -> ExportBundle:
        """``root`` is the folder of the stored files; their paths are listed relative to it."""
        load = lambda path: read_export(spark, path) if path else None
        listing = None
        if root:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
            at = F.locate(root.removeprefix("file://").rstrip("/") + "/", F.col("path")) + len(root.removeprefix("file://").rstrip("/")) + 1
            listing = found.select(F.substring("path", at, F.lit(10_000)).alias("path"))
        return ExportBundle(load(versions), load(deals), load(links), load(clients), load(vendors), listing)

    def latest_versions(self) -> DataFrame:
        """Versions that are the latest, not deleted and of a supported type."""
        v = self.versions
        named = pick(v, "FileExtension")
        kinds = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
        of_name = F.when(pick(v, "PathOnClient").contains("."), extension(F.substring_index(pick(v, "PathOnClient"), ".", -1)))
        kind = F.coalesce(of_name, F.nullif(extension(named), F.lit("")), F.try_element_at(kinds, F.upper(pick(v, "FileType"))), F.lit(""))
        latest = pick(v, "IsLatest").isNull() | is_true(pick(v, "IsLatest"))
        return v.where(latest & ~is_true(pick(v, "IsDeleted"))).select(
            F.trim(pick(v, "Id")).alias("cv_id"), F.trim(pick(v, "ContentDocumentId")).alias("document_id"), F.trim(present(pick(v, "Deal__c"))).alias("direct_deal"),
            F.coalesce(present(pick(v, "PathOnClient")), pick(v, "Title")).alias("name"), kind.alias("file_type"), pick(v, "ContentSize").try_cast("bigint").alias("size"),
            F.coalesce(present(pick(v, "ContentModifiedDate")), present(pick(v, "CreatedDate"))).alias("modified_time"),
        ).where(F.col("file_type").isin(*SUPPORTED))

    def documents(self, prefix: str = "a0W") -> DataFrame:
        """A row for each version with its deal, client and vendor, how it was mapped, and where its file is stored."""
        rows = self.latest_versions()
        rows = rows.withColumn("deal_id", F.when(F.startswith("direct_deal", F.lit(prefix)), F.col("direct_deal")))
        if self.links is not None:
            links = self.links.withColumn("_seq", F.monotonically_increasing_id()).select(
                F.trim(pick(self.links, "ContentDocumentId")).alias("document_id"), F.trim(pick(self.links, "LinkedEntityId")).alias("linked_deal"), "_seq"
            )
            first = first_link(links.where(F.startswith("linked_deal", F.lit(prefix))), "document_id", "linked_deal", "_seq")
            rows = rows.join(first, "document_id", "left").withColumn("deal_id", F.coalesce("deal_id", "linked_deal")).drop("linked_deal")
        d = self.deals
        deals = d.select(
            F.trim(pick(d, "Id")).alias("_id"), pick(d, "Name").alias("deal_name"), pick(d, "Subject__c").alias("deal_subject"), pick(d, "Status__c").alias("deal_status"),
            pick(d, "Client__c").alias("client_id"), pick(d, "Primary_Deal_Vendor__c").alias("vendor_id"), money(pick(d, "Total_Proposed_Amount__c")).alias("proposed_amount"),
            money(pick(d, "Total_Final_Amount__c")).alias("final_amount"), savings_percent(pick(d, "Total_Proposed_Amount__c"), pick(d, "Total_Final_Amount__c")).alias("savings_percentage"),
            F.coalesce(pick(d, "ExportedAt", "LastModifiedDate", "CreatedDate"), F.lit("")).alias("_at"), F.monotonically_increasing_id().alias("_seq"),
        )
        # Of a deal that was exported again, the latest row stands; where times do not tell, the one that is listed last.
        deals = latest_rows(deals, ["_id"], ["_at", "_seq"]).drop("_at", "_seq")
        rows = map_to_deals(rows, "deal_id", deals, "_id", [c for c in deals.columns if c != "_id"])
        for side, names in (("client", self.clients), ("vendor", self.vendors)):
            rows = rows.withColumn(f"{side}_name", friendly_id(side.capitalize(), F.col(f"{side}_id")))
            if names is not None:
                known = id_names(names).select(short_key(F.col("id")).alias("_k"), F.col("name").alias("_n")).where("_k is not null").groupBy("_k").agg(F.min("_n").alias("_n"))
                rows = rows.join(known, short_key(F.col(f"{side}_id")) == F.col("_k"), "left").withColumn(f"{side}_name", F.coalesce("_n", f"{side}_name")).drop("_k", "_n")
        if self.listing is not None:
            rows = rows.join(resolve_paths(rows.select("cv_id", "document_id", "deal_id"), self.listing).select("cv_id", "stored_path"), "cv_id", "left")
        return rows.drop("direct_deal").withColumn("deal_number", F.regexp_replace("deal_name", "^Deal-", ""))
