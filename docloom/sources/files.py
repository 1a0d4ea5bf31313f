"""Sources: folders of files, CSV export bundles, nested JSON catalogs. All give DataFrames."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docloom.functions.paths import extension
from docloom.session import numbered

# Extensions of documents that are taken.
SUPPORTED = (".pdf", ".docx", ".doc", ".xlsx", ".xls", ".csv", ".pptx", ".ppt", ".msg", ".txt", ".md", ".png", ".jpg", ".jpeg")


class FileSource(ABC):
    """A place that documents come from."""

    @abstractmethod
    def list_documents(self) -> DataFrame:
        """``path, name, size, size_mb, file_type, modified_time``: one row for each supported visible file."""

    @abstractmethod
    def contents(self) -> DataFrame:
        """``path, content`` of the files."""

    def exists(self, path: str) -> bool:
        return self.list_documents().where(F.col("path") == path).limit(1).count() > 0

    def reachable(self) -> bool:
        """Whether the place can be listed at all."""
        try:
            self.list_documents().limit(1).count()
        except Exception:
            return False
        return True

    def info(self) -> DataFrame:
        """``file_type, n_files, total_size``."""
        return self.list_documents().groupBy("file_type").agg(F.count("*").alias("n_files"), F.sum("size").alias("total_size"))

    def hashes(self) -> DataFrame:
        """``path, content_hash`` (SHA-256, hex)."""
        return self.contents().select("path", F.sha2("content", 256).alias("content_hash"))

    def batches(self, size: int) -> DataFrame:
        """The listing with ``batch_no``, each batch of ``size`` files in order of path."""
        rows = numbered(self.list_documents(), "path", "_row")
        return rows.withColumn("batch_no", F.floor(F.col("_row") / size)).drop("_row")


class FolderSource(FileSource):
    """A folder and all below it, read by Spark's binary file source; content is read only where asked for."""

    def __init__(self, spark: SparkSession, root: str, types: tuple[str, ...] = SUPPORTED, floor_kb: float = 0.0) -> None:
        self.spark, self.root, self.types, self.floor = spark, root.rstrip("/"), types, floor_kb * 1024

    def _files(self) -> DataFrame:
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.root)
        name = F.substring_index("path", "/", -1)
        kind = F.when(name.contains("."), extension(F.substring_index(name, ".", -1))).otherwise("")
        hidden = F.col("path").rlike(r"/\.[^/]*(?:/|$)")
        return found.withColumns({"name": name, "file_type": kind}).where(~hidden & F.col("file_type").isin(*self.types) & (F.col("length") >= self.floor))

    def list_documents(self) -> DataFrame:
        return self._files().select(
            "path", "name", F.col("length").alias("size"), F.round(F.col("length") / 1_048_576, 2).alias("size_mb"), "file_type",
            F.col("modificationTime").alias("modified_time"),
        )

    def contents(self) -> DataFrame:
        return self._files().select("path", "content")


def read_export(spark: SparkSession, path: str, encoding: str | None = None, lines: bool = False) -> DataFrame:
    """A CSV of an export, all columns text: quoted line ends are kept, a byte order mark and blanks in headers are not.

    Without ``encoding`` a file is read as UTF-8, or where its bytes are none, as Windows Latin. A row with too many or too few fields
    stays, what is too much cut and what is missing null, and is told by ``_corrupt``, the row as it stood; see :func:`export_faults`.
    ``lines`` says that no field holds a line end: then a file is read by many tasks.
    """
    if encoding is None:
        encoding = "utf-8" if _is_utf8(spark, path) else "windows-1252"
    # Spark reads Latin 1, which differs from Windows Latin in the places of control characters.
    windows, encoding = encoding.lower() in ("windows-1252", "cp1252"), "iso-8859-1" if encoding.lower() in ("windows-1252", "cp1252") else encoding
    options = {"header": True, "multiLine": not lines, "escape": '"', "encoding": encoding}
    names = spark.read.options(**options).csv(path).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    raw = spark.read.schema(f"{schema}, _corrupt string").options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt").csv(path)
    if windows:
        other = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
        raw = raw.select(*[F.translate(F.col(f"`{c}`"), "".join(a for a, _ in other), "".join(b for _, b in other)).alias(c) for c in raw.columns])
    return raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns])


def _is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether all bytes of the files are UTF-8; looked at by the tasks, line by line."""
    lines = spark.read.format("text").load(path).select(F.col("value").cast("binary").alias("b"))
    return lines.where(~F.is_valid_utf8(F.col("b").cast("string"))).limit(1).count() == 0


def export_faults(export: DataFrame) -> DataFrame:
    """One row: how many rows an export has, and how many of them have another number of fields than its header."""
    kept = export.cache()
    return kept.agg(F.count("*").alias("n_rows"), F.count("_corrupt").alias("n_faulty"))


def pick(df: DataFrame, *names: str) -> Column:
    """The first of several possible columns that a table has; null where it has none."""
    have = {c.lower(): c for c in df.columns}
    for name in names:
        if name.lower() in have:
            return F.col(f"`{have[name.lower()]}`")
    return F.lit(None).cast("string")


def id_names(df: DataFrame) -> DataFrame:
    """``id, name`` of a mapping export in either of its layouts."""
    return df.select(pick(df, "18 Digit ID", "Id").alias("id"), pick(df, "Account Name", "Name").alias("name"), pick(df, "Account ID", "Id").alias("account_id"))


CATALOG = (
    "documents array<struct<source_metadata:struct<source_type:string,source_id:string,source_path:string>,"
    "file_info:struct<path:string,name:string,size:bigint,size_mb:double,file_type:string,modified_time:string,content_hash:string>,"
    "business_metadata:struct<deal_creation_date:string,week_number:int,week_date:string,vendor:string,client:string,deal_number:string,deal_name:string,extraction_confidence:double,path_components:array<string>>,"
    "deal_metadata:map<string,string>,llm_classification:struct<document_type:string,confidence:double,reasoning:string,classification_method:string>,"
    "processing_status:struct<processed:boolean,processing_date:string,content_parser:string,chunks_created:int,processing_errors:array<string>>>>"
)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of a nested JSON catalog, its groups as structs; a list of documents at the top is read as well."""
    item = CATALOG.removeprefix("documents array<").removesuffix(">")
    both = StructType.fromDDL(f"{CATALOG}, {item.removeprefix('struct<').removesuffix('>')}")
    read = spark.read.schema(both).option("multiLine", "true").json(path)
    names = [f.name for f in both.fields if f.name != "documents"]
    return read.select(F.inline(F.when(F.col("documents").isNotNull(), F.col("documents")).otherwise(F.array(F.struct(*names)))))
