"""End-to-end jobs: raw to Bronze, Bronze to Silver, Silver to Gold.

The ``*_silver`` functions build plans; the ``run_*`` functions also check and
write. Checks come before the write they guard.
"""

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rolecall.operators.dedupe import keep_best_listing
from rolecall.operators.filters import nonblank_keys, with_reject_reasons
from rolecall.operators.quality import (
    QualityError, bronze_suite, require_columns, require_rows, require_sources, rule_aggregates, rule_results,
)
from rolecall.operators.schema import flatten_envelope, normalise_listings
from rolecall.sources.readers import batch_partition_scan, catalog_table_scan, landed_contents, landed_metadata, raw_json_scan
from rolecall.sources.sinks import append_partitioned, path_exists, publish_nonempty, quarantine, replace_batches, replace_mart, stage, table_at, upsert_into, upsert_keyed
from rolecall.storage import drop_dir, move_into, names_in, shared_dir

from . import marts

# The columns each layer needs.
SILVER_REQUIRED = ("title", "url", "source")
GOLD_REQUIRED = ("title", "url", "source", "company", "location_std", "min_salary", "max_salary", "currency")


def local_silver(bronze: DataFrame, tie_breakers=None) -> DataFrame:
    """Silver keyed by url: posted salaries, unaccented city names."""
    return keep_best_listing(normalise_listings(bronze, "posted", "ascii"), ("url",), tie_breakers)


def cloud_silver(bronze: DataFrame, batch_date: str | None = None, tie_breakers=None) -> DataFrame:
    """Silver keyed by source and url: trimmed keys, accented city names too,
    rows without title or url dropped."""
    rows = nonblank_keys(normalise_listings(bronze, "posted", "accented", trim_keys=True))
    best = keep_best_listing(rows, ("source", "url"), tie_breakers)
    return best.withColumn("batch_date", F.lit(batch_date)) if batch_date else best


def run_bronze(spark: SparkSession, raw_path: str, bronze_path: str, quarantine_path: str, crawled_date: str, **read) -> DataFrame:
    """Raw JSON to validated Bronze and quarantine; returns the rule results.

    The rules are observed while the judged rows are stored, so they cost no pass
    of their own.
    """
    rules, seen = bronze_suite(), Observation("bronze_rules")
    raw = flatten_envelope(raw_json_scan(spark, raw_path, **read))
    # raw JSON is read and judged once; both outputs come from the stored rows
    path = shared_dir(spark, "bronze")
    with_reject_reasons(raw).observe(seen, *rule_aggregates(rules)).write.parquet(path)
    rows = spark.read.parquet(path)
    clean = F.size("reject_reasons") == 0
    append_partitioned(rows.filter(clean).drop("reject_reasons"), bronze_path, crawled_date=crawled_date)
    quarantine(rows.filter(~clean), quarantine_path)
    drop_dir(spark, path)
    counts = seen.get
    ddl = ", ".join(f"{name} bigint" for name in counts)
    return rule_results(spark.createDataFrame([tuple(counts.values())], ddl), rules)


MANIFEST = "path string, length bigint, modified timestamp, content_hash string"


def run_landing(
    spark: SparkSession, landing_path: str, store_path: str, manifest_path: str, suffix: str = ".json", files_at_once: int = 10_000,
) -> DataFrame:
    """Copy the landed files that are new or changed into the store and note them in the
    manifest; returns one row: copied, skipped and failed.

    Path, length and modification time decide first, so the content of files that the
    manifest knows is not read. What is left is read and hashed once, in blocks of about
    ``files_at_once`` files, whose names come to the driver; where only the time is new
    and the content is not, the file counts as skipped and its new time is noted.

    The store keeps one row per version of a file (path, length, modified, content_hash,
    content), since Spark writes tables, not named objects. A file that vanishes, grows
    while it is read, or cannot be read counts as failed, is not noted, and is taken by
    the next run; it stops no other file. The files of the store are written beside it
    and moved there before the manifest's: a job lost in between copies its files again,
    and readers of the store take each (path, content_hash) once.
    """
    known = spark.read.schema(MANIFEST).parquet(manifest_path) if path_exists(spark, manifest_path) else spark.createDataFrame([], MANIFEST)
    run = shared_dir(spark, "landing")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{run}/{name}")
        return spark.read.schema(df.schema).parquet(f"{run}/{name}")

    # one listing of the source for all that follows
    found = kept(landed_metadata(spark, landing_path, suffix), "found")
    fresh = kept(found.join(known.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti"), "fresh")
    files, candidates = found.count(), fresh.count()
    blocks = -(-candidates // files_at_once)
    copied, same, failed = 0, 0, []
    for block in range(blocks):
        names = [r["path"] for r in fresh.where(F.pmod(F.xxhash64("path"), F.lit(blocks)) == block).select("path").collect()]
        new, old = _land(spark, names, known, store_path, manifest_path, failed)
        copied, same = copied + new, same + old
    drop_dir(spark, run)
    counts = (copied, files - candidates + same, candidates - copied - same)
    return spark.createDataFrame([counts], "copied bigint, skipped bigint, failed bigint")


#: Files that fail one by one before a run stops: then it is not the files.
MOST_UNREADABLE = 100


def _land(
    spark: SparkSession, names: list[str], known: DataFrame, store_path: str, manifest_path: str, failed: list[str],
) -> tuple[int, int]:
    """Copies these files; (copied, unchanged). Where the block as a whole fails, its
    halves are tried, down to the file that cannot be read."""
    if not names:
        return 0, 0
    run = shared_dir(spark, "landing")
    try:
        own = spark.createDataFrame([(n,) for n in names], "path string")
        known.join(own, "path", "left_semi").select("path", "content_hash").distinct().withColumn("_held", F.lit(True)).write.parquet(f"{run}/held")
        held = spark.read.schema("path string, content_hash string, _held boolean").parquet(f"{run}/held")
        read = landed_contents(spark, names).join(held, ["path", "content_hash"], "left")
        is_new = F.col("_held").isNull()
        read.withColumns({"is_new": is_new, "content": F.when(is_new, F.col("content"))}).drop("_held").write.partitionBy("is_new").parquet(f"{run}/files")
        noted = spark.read.schema(f"{MANIFEST}, is_new boolean").parquet(f"{run}/files")
        noted.select(*[c.split()[0] for c in MANIFEST.split(", ")]).write.parquet(f"{run}/noted")
        counts = noted.groupBy("is_new").count().collect()
    except (PySparkException, Py4JJavaError) as error:
        if isinstance(error, AnalysisException) and error.getCondition() != "PATH_NOT_FOUND":
            raise
        drop_dir(spark, run)
        if len(names) == 1:
            failed += names
            if len(failed) > MOST_UNREADABLE:
                raise
            return 0, 0
        halves = [_land(spark, part, known, store_path, manifest_path, failed) for part in (names[::2], names[1::2])]
        return halves[0][0] + halves[1][0], halves[0][1] + halves[1][1]
    for folder, target in (("files/is_new=true", store_path), ("noted", manifest_path)):
        for name in names_in(spark, f"{run}/{folder}"):
            if name.startswith("part-"):
                move_into(spark, f"{run}/{folder}/{name}", target)
    drop_dir(spark, run)
    number = {r["is_new"]: r["count"] for r in counts}
    return number.get(True, 0), number.get(False, 0)


def run_local_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, processed_at=None, crawled_date: str | None = None, buckets: int = 32,
) -> bool:
    """All of Bronze, or what one crawl brought, to the Silver table, upserted by url; a
    listing's source stays as first seen. ``processed_at`` stamps the rows.

    Silver is a keyed table (``sinks.upsert_keyed``): only the buckets that the urls fall
    into are read and written, and rows that are stored already with equal values (their
    stamp included) are left out. False when Bronze has no rows."""
    bronze = spark.read.parquet(bronze_path)
    if crawled_date is not None:
        bronze = bronze.filter(F.col("crawled_date") == crawled_date)
    silver = stamped(local_silver(bronze), "processed_at", processed_at)
    return upsert_keyed(silver, silver_path, ["url"], ["source"], ["source"], buckets, only_changed=True) is not None


def stamped(df: DataFrame, column: str, time) -> DataFrame:
    """Adds a time that the caller gives (a timestamp or its text); None adds nothing."""
    return df if time is None else df.withColumn(column, F.lit(time).cast("timestamp"))


def _load_batch(spark: SparkSession, path: str, batch_date: str, empty_code: str) -> DataFrame:
    """One batch, which must be there and hold rows."""
    try:
        batch = batch_partition_scan(spark, path, batch_date)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise QualityError(f"{empty_code}: batch_date={batch_date}") from None
        raise
    return require_rows(batch, f"{empty_code}: batch_date={batch_date}")


def run_cloud_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, batch_date: str, sources, require_all_sources: bool = True,
    processed_at=None,
) -> dict[str, int]:
    """One batch of Bronze to Silver partitions; returns rows in, out and removed.
    The stored result of the checks is published as it lies: no second shuffle."""
    bronze = _load_batch(spark, bronze_path, batch_date, "SILVER_EMPTY_INPUT")
    require_columns(bronze, SILVER_REQUIRED, "SILVER_REQUIRED_COLUMNS_MISSING")
    require_sources(bronze, sources, require_all_sources, "SILVER_SOURCE_MISSING")
    wanted = bronze.filter(F.col("source").isin(*sources))
    path = shared_dir(spark, "silver")
    built = stamped(cloud_silver(wanted, batch_date), "processed_at", processed_at)
    built.write.parquet(path)
    silver = spark.read.schema(built.schema).parquet(path)
    require_sources(silver, sources, require_all_sources, "SILVER_SOURCE_EMPTY_AFTER_TRANSFORM")
    # both counts come from the files' footers
    rows_in, rows_out = wanted.count(), silver.count()
    replace_batches(silver, silver_path, rebalance=False)
    drop_dir(spark, path)
    written = batch_partition_scan(spark, silver_path, batch_date, sources, schema=built.schema).count()
    if written != rows_out:
        raise QualityError(f"SILVER_ROW_COUNT_MISMATCH: transformed={rows_out} written={written}")
    return {"rows_in": rows_in, "rows_out": rows_out, "rows_removed": rows_in - rows_out}


def cloud_marts(silver: DataFrame, batch_date: str, created_at=None) -> dict[str, DataFrame]:
    prepared = marts.prepare(silver, batch_date)
    return {
        "job_market_overview": stamped(marts.job_market_overview(prepared, ("source", "url")), "created_at", created_at),
        "source_performance": marts.source_performance(prepared),
        "location_summary": marts.location_summary(prepared),
    }


def run_cloud_gold(
    spark: SparkSession, silver_path: str, gold_path: str, batch_date: str, sources, created_at=None
) -> dict[str, DataFrame]:
    """One batch of Silver to its three marts. The distinct jobs must equal the
    Silver rows; the overview and the source mart, stored before anything is published,
    answer that and the question for missing sources."""
    silver = _load_batch(spark, silver_path, batch_date, "GOLD_EMPTY_INPUT")
    require_columns(silver, GOLD_REQUIRED, "GOLD_REQUIRED_COLUMNS_MISSING")
    columns = [*GOLD_REQUIRED, *(c for c in ("batch_date",) if c in silver.columns)]
    built = cloud_marts(silver.select(*columns), batch_date, created_at)
    source_mart = stage(built["source_performance"], "source_performance")
    require_sources(source_mart, sources, True, "GOLD_SOURCE_MISSING")
    overview = marts.job_market_overview(marts.prepare(silver, batch_date), ("source", "url"), rows="silver_rows")
    overview = stage(stamped(overview, "created_at", created_at), "job_market_overview")
    totals = overview.select("silver_rows", "total_jobs").first()
    if totals["silver_rows"] != totals["total_jobs"]:
        raise QualityError(f"GOLD_INPUT_TOTAL_MISMATCH: input={totals['silver_rows']} jobs={totals['total_jobs']}")
    built = {
        "job_market_overview": overview.drop("silver_rows"), "source_performance": source_mart,
        "location_summary": stage(built["location_summary"], "location_summary"),
    }
    for name, mart in built.items():
        require_rows(mart, f"GOLD_MART_EMPTY: {name}")
    for name, mart in built.items():
        replace_mart(mart, f"{gold_path}/{name}", batch_date)
    return built


def run_local_gold(
    spark: SparkSession, silver_table: str, gold_path: str, report_date: str, listing_source: str, publish=None,
    database: str | None = None, created_at=None,
) -> dict[str, str]:
    """Silver table to eleven marts, each upserted by its keys; marts that are empty
    are skipped. With ``database`` each is a catalog table of its name there, too.
    ``publish(df, name)`` may also copy each to a serving database. ``created_at`` stamps
    the overview and the run's record. Returns the written path per mart; nothing when
    Silver is missing or empty. Silver's columns that the marts read are stored once."""
    silver = catalog_table_scan(spark, silver_table)
    if silver is None:
        return {}
    path = shared_dir(spark, "gold")
    prepared = marts.prepare(silver, report_date)
    prepared.select(*marts.READ_COLUMNS).write.parquet(path)
    prepared = spark.read.parquet(path)
    paths = {}
    for name, (mart, keys) in marts.gold_marts(prepared, prepared, report_date, listing_source).items():
        if name in ("mart_job_market_overview", "mart_pipeline_health"):
            mart = stamped(mart, "created_at", created_at)
        if upsert_into(mart, f"{gold_path}/{name}", keys, ["report_date"], partitions=[(report_date,)]):
            paths[name] = f"{gold_path}/{name}"
            if database is not None:
                table_at(spark, f"{database}.{name}", paths[name])
    drop_dir(spark, path)
    if publish is not None:
        # what was written is read back, so no mart is computed a second time
        day = F.col("report_date") == F.to_date(F.lit(report_date))
        publish_nonempty({n: spark.read.parquet(p).filter(day) for n, p in paths.items()}, publish)
    return paths
