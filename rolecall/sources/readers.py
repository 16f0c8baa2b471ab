"""Scans of raw JSON, Parquet, batches, catalog tables and landed files."""

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The raw listing record and the envelope around it.
LISTING_SCHEMA = (
    "keyword string, title string, url string, company string, location string, work_type string, "
    "salary string, tags array<string>, posted string, scraped_at string, crawled_at string"
)
RAW_SCHEMA = (
    "source string, batch_date string, total bigint, keywords array<string>, "
    f"jobs array<struct<{LISTING_SCHEMA.replace(' ', ':').replace(',:', ',')}>>, {LISTING_SCHEMA}"
)


def raw_json_scan(
    spark: SparkSession, path: str, schema: str | StructType = RAW_SCHEMA, multi_line: bool = True, lineage: bool = True
) -> DataFrame:
    """Raw JSON files (envelopes, arrays, or with ``multi_line=False`` JSON lines,
    which can be split among tasks). The schema is given, so there is no extra
    inference pass over the files."""
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return with_file_lineage(df) if lineage else df


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Source file and ingest time per row, straight after a file scan."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingested_at"))


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet scan. How many tasks it has is set by ``spark.sql.files.maxPartitionBytes``
    and ``spark.sql.files.minPartitionNum``."""
    return spark.read.parquet(path)


def batch_partition_scan(
    spark: SparkSession, base: str, batch_date: str, sources=None, merge_schema: bool = False, schema=None
) -> DataFrame:
    """One batch of all (or the named) sources of a table whose folders are
    ``source=…/batch_date=…``. Only that batch's folders are listed, however many
    batches the table holds. With ``schema`` no footer is read beforehand;
    ``merge_schema`` reads all of the batch's footers, for files that differ.
    ``batch_date`` comes back as text, whatever type the folder names suggest."""
    pattern = f"{base.rstrip('/')}/source=*/batch_date={batch_date}"
    reader = spark.read.option("basePath", base).option("mergeSchema", merge_schema)
    df = (reader.schema(schema) if schema is not None else reader).parquet(pattern)
    if sources is not None:
        df = df.where(F.col("source").isin(*sources))
    return df.withColumn("batch_date", F.date_format("batch_date", "yyyy-MM-dd"))


def catalog_table_scan(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None when it is missing or has no rows."""
    if not spark.catalog.tableExists(table):
        return None
    df = spark.table(table)
    return None if df.isEmpty() else df


def inline_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small literal DataFrame, for run records and lookups."""
    return spark.createDataFrame(rows, ddl)


def sql_over_lake(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """SQL over DataFrames, which the text names in braces: ``FROM {silver}``."""
    return spark.sql(sql, **tables)


def landed_files(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """Path, length and content hash of every landed file with that suffix (case
    ignored). Content is hashed where it is read and not carried on."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.filter(F.lower("path").endswith(suffix)).select(
        "path", "length", F.sha2("content", 256).alias("content_hash")
    )


def landed_metadata(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """Path, length and modification time of the same files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.filter(F.lower("path").endswith(suffix)).select("path", "length", F.col("modificationTime").alias("modified"))


def landed_contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, modified, content_hash, content) of these files, read once. Files that
    vanish or break while they are read, or whose content is not as long as listed, are left
    out; one that is gone before is an error."""
    plain = [re.sub(r"([\\{}\[\]*?,])", r"\\\1", p) for p in paths]  # names are not patterns
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    whole = F.octet_length("content") == F.col("length")
    return reader.load(plain).filter(whole).select(
        "path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("content_hash"), "content"
    )


def changed_objects(current: DataFrame, manifest: DataFrame, key: str = "path", content_hash: str = "content_hash") -> DataFrame:
    """Objects that are new, or whose content differs from the manifest's."""
    seen = manifest.select(key, content_hash)
    return current.join(seen, [key, content_hash], "left_anti")


def landing_summary(current: DataFrame, manifest: DataFrame, key: str = "path", content_hash: str = "content_hash") -> DataFrame:
    """One row: objects to copy and objects skipped as unchanged. A manifest may name
    an object several times."""
    seen = manifest.select(key, content_hash).distinct().withColumn("_seen", F.lit(True))
    joined = current.join(seen, [key, content_hash], "left_outer")
    return joined.agg(
        F.count_if(F.col("_seen").isNull()).alias("copied"), F.count_if(F.col("_seen").isNotNull()).alias("skipped")
    )


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Name and row count of Parquet tables by path. The counts are pushed into the scan
    and answered by the files' footers; no row group is read.

    Only Spark's newer Parquet source takes aggregates; it is chosen in a session of its
    own, which shares everything but these settings.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = [
        own.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, path in sorted(paths.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def _parquet_location(spark: SparkSession, table: str) -> str | None:
    """Where a catalog table's Parquet files are; None for views and other formats."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return said.get("Location") if said.get("Provider", "").lower() == "parquet" else None


def table_inventory(spark: SparkSession, namespace: str | None = None, prefix: str = "") -> DataFrame:
    """Name and row count of each table of a namespace, in one plan. Parquet tables are
    counted from their footers, views and others in a pass each."""
    names = [
        t.name for t in spark.catalog.listTables(namespace)
        if t.name.startswith(prefix) and not (namespace and t.isTemporary)
    ]
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    full = {n: f"{namespace}.{n}" if namespace else n for n in sorted(names)}
    places = {n: _parquet_location(spark, table) for n, table in full.items()}
    stored = {n: path for n, path in places.items() if path is not None}
    parts = [
        spark.table(full[n]).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in full if n not in stored
    ]
    if stored:
        parts.append(footer_counts(spark, stored))
    return reduce(DataFrame.unionByName, parts)
