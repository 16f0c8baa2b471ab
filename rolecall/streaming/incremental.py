"""New raw files into a Silver table, resumable and idempotent by key."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from rolecall.operators.dedupe import keep_best_listing
from rolecall.operators.filters import nonblank_keys, with_reject_reasons
from rolecall.operators.schema import SILVER_COLUMNS, flatten_envelope, normalise_listings
from rolecall.sources.readers import RAW_SCHEMA
from rolecall.sources.sinks import finish_swap, publish_merged, replace_batches, write_merged
from rolecall.storage import drop_dir, names_in, shared_dir

INCREMENT = "increment"
_KEY = ("source", "url")


def incremental_silver(
    spark: SparkSession, raw_path: str, silver_path: str, checkpoint: str, quarantine_path: str,
    schema: str = RAW_SCHEMA, multi_line: bool = True, max_files: int | None = None,
):
    """Process all raw files that have landed since the last run, then stop.

    Each micro-batch is validated, normalised and deduplicated by (source, url). Only
    listings that are new or differ from the last stored ones of their key are emitted;
    they are written as one increment: a partition of its own, which a replay replaces.
    A landing of known listings writes nothing, and nothing that is stored is rewritten.
    ``current_silver`` shows the last state of every key, and ``compact_silver`` folds the
    increments together from time to time. Rejected rows go to ``quarantine_path`` with
    their reasons, every time they land. Returns the finished query.

    The checkpoint holds the progress; the state is Silver itself. A micro-batch reads
    the increments before its own once, so a replay sees what the lost attempt saw.
    """
    finish_swap(spark, silver_path, [INCREMENT])
    reader = spark.readStream.schema(schema).option("multiLine", multi_line).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    judged = with_reject_reasons(flatten_envelope(reader.json(raw_path)))

    def apply(batch: DataFrame, batch_id: int) -> None:
        path = shared_dir(spark, "increment")
        batch.write.parquet(path)  # raw files are read and judged once
        rows = spark.read.schema(batch.schema).parquet(path)
        number = F.lit(batch_id).cast("bigint")
        clean = F.size("reject_reasons") == 0
        silver = new_or_changed(spark, rows.filter(clean), silver_path, batch_id)
        replace_batches(silver.withColumn(INCREMENT, number), silver_path, (INCREMENT,), rebalance=False)
        replace_batches(rows.filter(~clean).withColumn(INCREMENT, number), quarantine_path, (INCREMENT,), rebalance=False)
        drop_dir(spark, path)

    query = (
        judged.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def new_or_changed(spark: SparkSession, clean: DataFrame, silver_path: str, batch_id: int) -> DataFrame:
    """Silver rows of a micro-batch's clean listings: each key's best, where it differs
    from the last listing of its key in the increments before ``batch_id``."""
    rows = nonblank_keys(normalise_listings(clean, "posted", "accented", trim_keys=True))
    best = keep_best_listing(rows, _KEY)
    before = [n for n in names_in(spark, silver_path) if n.startswith(f"{INCREMENT}=") and int(n.split("=")[1]) < batch_id]
    if not before:
        return best
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in best.schema.fields]
    stored = spark.read.schema(", ".join([*columns, f"{INCREMENT} bigint"])).parquet(silver_path).filter(F.col(INCREMENT) < batch_id)
    held = stored.select(*[F.col(k).alias(f"_{k}") for k in _KEY], F.xxhash64(*SILVER_COLUMNS).alias("_held"), INCREMENT)
    last = held.groupBy(*[f"_{k}" for k in _KEY]).agg(F.max_by("_held", INCREMENT).alias("_held"))
    on = [F.col(k) == F.col(f"_{k}") for k in _KEY] + [F.xxhash64(*SILVER_COLUMNS) == F.col("_held")]
    return best.join(last, on, "left_anti")


def _increments(spark: SparkSession, silver_path: str) -> DataFrame:
    return spark.read.parquet(silver_path).withColumn(INCREMENT, F.col(INCREMENT).cast("bigint"))


def current_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The listings of every (source, url) from the last increment that holds it; a key
    is in as many increments as it had different listings. The rank is cut to one row
    before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.col(INCREMENT).desc()))
    return _increments(spark, silver_path).withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank", INCREMENT)


def compact_silver(spark: SparkSession, silver_path: str) -> None:
    """Fold all increments into the last one. Not to be run beside a writer.

    The folded rows are written whole beside the table before they replace the last
    increment (``finish_swap``), and older increments go only after that. A job lost at
    any point loses no row: the next compaction or run of the stream finishes the swap.
    """
    finish_swap(spark, silver_path, [INCREMENT])
    ids = sorted(r[INCREMENT] for r in _increments(spark, silver_path).select(INCREMENT).distinct().collect())
    if len(ids) < 2:
        return
    folded = current_silver(spark, silver_path).withColumn(INCREMENT, F.lit(ids[-1]).cast("bigint"))
    write_merged(folded, silver_path, [INCREMENT])
    publish_merged(spark, silver_path, lambda: finish_swap(spark, silver_path, [INCREMENT]))
    for old in ids[:-1]:
        drop_dir(spark, f"{silver_path}/{INCREMENT}={old}")
