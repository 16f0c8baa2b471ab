"""Writers that are safe to rerun, plus plain appends."""

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rolecall.operators.quality import require_rows
from rolecall.operators.upsert import insert_only, upsert
from rolecall.storage import drop_dir, has_path, move_into, names_in, put_mark, shared_dir


def append_partitioned(df: DataFrame, path: str, partition_by=("source",), crawled_date: str | None = None) -> None:
    """Append as Parquet; a rerun appends again. ``crawled_date`` stamps the rows."""
    if crawled_date is not None:
        df = df.withColumn("crawled_date", F.lit(crawled_date))
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def quarantine(df: DataFrame, path: str, partition_by=("source",)) -> None:
    """Append rejected rows (with their reasons); a NULL source has its own folder."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_batches(df: DataFrame, path: str, partition_by=("source", "batch_date"), rebalance: bool = True) -> None:
    """Replace exactly the partitions that ``df`` holds; others stay untouched.

    Rows are rebalanced by partition first: few files per partition, and one that
    holds most rows is split over many tasks instead of written by one. Spare that
    shuffle with ``rebalance=False`` where ``df`` holds only a few partitions.
    """
    (
        (df.hint("rebalance", *partition_by) if rebalance else df)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def replace_mart(df: DataFrame, path: str, batch_date: str) -> None:
    """Replace one batch of a mart table; a mart is small and has one partition."""
    replace_batches(df.withColumn("batch_date", F.lit(batch_date)), path, ("batch_date",), rebalance=False)


def create_table_like(df: DataFrame, table: str, partition_by: str | None = None, location: str | None = None) -> None:
    """Create an empty table with the DataFrame's schema unless it exists."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return
    if "." in table:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    writer = df.limit(0).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def table_at(spark: SparkSession, table: str, path: str) -> None:
    """A catalog table over a partitioned Parquet folder, with the folder's present partitions."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("probe int").parquet(path)  # looks the path up, reads nothing
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back: several later reads cost no
    second computation, and the result survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partition_filter(columns: list[str], values: list[tuple]):
    """A literal filter for these partitions; Spark prunes by it when it plans the scan."""
    return reduce(
        lambda a, b: a | b,
        [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, row, strict=True)]) for row in values],
    )


def _swap_name(path: str) -> str:
    return f"{path.rstrip('/')}._merged"


#: Stands in a folder of merged rows once they are all written.
MERGED_MARK = "_MERGED"


def write_merged(merged: DataFrame, path: str, partition_by: list[str], rebalance: bool = True) -> None:
    """Merged rows, whole and marked as such, beside the table that they will replace
    partitions of. What an earlier, unmarked attempt left is no result and goes."""
    spark, beside = merged.sparkSession, _swap_name(path)
    rows = merged.hint("rebalance", *partition_by) if rebalance else merged
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(beside)
    put_mark(spark, f"{beside}/{MERGED_MARK}")


def finish_swap(spark: SparkSession, path: str, partition_by: list[str], schema=None) -> bool:
    """Publish merged rows that stand complete beside the table, as the last step of an
    upsert or as what a lost job left to do. Their mark tells that they are: with it,
    replacing is repeated until it is through; without it, they are dropped. True when
    rows were published."""
    merged = _swap_name(path)
    if not has_path(spark, merged):
        return False
    whole = has_path(spark, f"{merged}/{MERGED_MARK}")
    if whole:
        # with a schema, folder names are not guessed to be numbers or dates
        rows = (spark.read.schema(schema) if schema is not None else spark.read).parquet(merged)
        replace_batches(rows, path, partition_by, rebalance=False)
    drop_dir(spark, merged)
    return whole


def publish_merged(spark: SparkSession, path: str, publish) -> None:
    """The last step of a write: ``publish()`` must have published the merged rows."""
    if not publish():
        raise RuntimeError(f"MERGED_ROWS_NOT_PUBLISHED: {path}")


def upsert_into(
    source: DataFrame, path: str, keys: list[str], partition_by: list[str], keep_columns: list[str] = (),
    partitions: list[tuple] | None = None,
) -> bool:
    """Upsert into a partitioned Parquet table and rewrite its touched partitions.
    False when the source is empty; nothing is written then.

    A row must not move between partitions, so every partition column has to be a
    key or a kept column. ``partitions`` names the values of ``partition_by`` that the
    source may hold (a mart has one date, a batch one batch date): the target's scan is
    then pruned to them by a literal filter. The source is staged, since the merge reads
    it more than once. Merged rows are written whole beside the table before they
    replace its partitions, so a job lost in between loses nothing: the next run, or
    ``finish_swap``, publishes them first. Rows that were merged and then not published
    are an error, never a success.
    """
    stray = [c for c in partition_by if c not in keys and c not in keep_columns]
    if stray:
        raise ValueError(f"partition columns must be keys or kept columns: {stray}")
    spark = source.sparkSession
    staged = shared_dir(spark, "upsert")
    source.write.parquet(staged)
    source = spark.read.schema(source.schema).parquet(staged)
    try:
        finish_swap(spark, path, partition_by, source.schema)
        if source.isEmpty():
            return False
        if not path_exists(spark, path):
            merged = source
        elif partitions is not None and _absent(spark, path, partition_by, partitions):
            # nothing to merge with: the staged source is published as it is
            replace_batches(_within(source, partition_by, partitions), path, partition_by, rebalance=False)
            return True
        else:
            target = spark.read.schema(source.schema).parquet(path).select(*source.columns)
            if partitions is not None:
                if not all(c in keys for c in partition_by):
                    raise ValueError("partitions can be named only where they are keys")
                target = target.filter(_partition_filter(partition_by, partitions))
                source = _within(source, partition_by, partitions)
            elif all(c in keys for c in partition_by):
                # other partitions are not written again, but Spark has to look into them
                touched = source.select(*partition_by).distinct().withColumnsRenamed({c: f"_p_{c}" for c in partition_by})
                on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_by])
                target = target.join(touched, on, "left_semi").select(*source.columns)
            merged = upsert(target, source, keys, keep_columns)
        write_merged(merged, path, partition_by)
        publish_merged(spark, path, lambda: finish_swap(spark, path, partition_by, source.schema))
    finally:
        drop_dir(spark, staged)
    return True


#: A keyed table has its number of buckets in the name of their column.
BUCKET = "bucket_of_"


def bucket_of(keys: list[str], buckets: int):
    """The bucket of a row: equal keys share one; rows with a NULL key are dealt by the
    keys that are there."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """How many buckets a keyed table has; None when it is not there."""
    found = {int(n[len(BUCKET) :].split("=")[0]) for n in names_in(spark, path) if n.startswith(BUCKET)}
    if len(found) > 1:
        raise ValueError(f"{path} mixes numbers of buckets: {sorted(found)}")
    return found.pop() if found else None


def finish_buckets(spark: SparkSession, path: str) -> bool:
    """As ``finish_swap``, for a keyed table: whole bucket folders are moved, so merged
    rows are written once. A bucket that was moved is gone from the merged rows, so
    going on after a loss moves the others."""
    merged = _swap_name(path)
    if not has_path(spark, merged):
        return False
    whole = has_path(spark, f"{merged}/{MERGED_MARK}")
    if whole:
        for name in names_in(spark, merged):
            if name.startswith(BUCKET):
                move_into(spark, f"{merged}/{name}", path)
    drop_dir(spark, merged)
    return whole


def read_keyed(spark: SparkSession, path: str, schema=None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a keyed table without their bucket column, or those of some buckets: a
    literal filter on the folders, so others are not opened."""
    column = f"{BUCKET}{buckets_of(spark, path)}"
    rows = (spark.read.schema(f"{_ddl(schema)}, {column} int") if schema is not None else spark.read).parquet(path)
    return (rows if buckets is None else rows.filter(F.col(column).isin(*buckets))).drop(column)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def upsert_keyed(
    source: DataFrame, path: str, keys: list[str], keep_columns: list[str] = (), partition_by: list[str] = (),
    buckets: int = 32, only_changed: bool = False,
) -> int | None:
    """Upsert into a keyed table: Parquet folders by a hash of the keys (then by
    ``partition_by``). Returns how many buckets were written; None for an empty source.

    Only the buckets that the source's keys fall into are read, merged and written: the
    target's scan is pruned to them by a literal filter, and their folders, written once
    beside the table, replace those of the table. So ten keys cost ten buckets at most,
    however large the table is; choose ``buckets`` (fixed when the table is made) so that
    one holds about as much as a few tasks can sort. Any column but the keys may change,
    and rows may move between folders of ``partition_by`` within their bucket unless the
    column is kept.

    ``only_changed`` leaves out source rows that the table holds already with equal
    values, so a rerun writes nothing. The source is staged; the bucket numbers (at most
    ``buckets``) come to the driver. A lost job is finished by the next run, as with
    ``upsert_into``.
    """
    spark, schema = source.sparkSession, source.schema
    folders = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        folders.append(shared_dir(spark, name))
        df.write.parquet(folders[-1])
        return spark.read.schema(schema).parquet(folders[-1])

    try:
        source = stored(source, "upsert")
        finish_buckets(spark, path)
        known = buckets_of(spark, path)
        number = known or buckets
        of_key = bucket_of(keys, number)
        given = _touched(source, of_key) if only_changed else None
        if known is not None and given:
            held = read_keyed(spark, path, schema, given)
            source = stored(_changed(source, held, keys, keep_columns), "changed")
        touched = _touched(source, of_key)
        if not touched:
            return 0 if given else None
        merged = source
        if known is not None:
            target = read_keyed(spark, path, schema, touched).select(*source.columns)
            merged = upsert(target, source, keys, keep_columns)
        column = f"{BUCKET}{number}"
        write_merged(merged.withColumn(column, of_key), path, [column, *partition_by])
        publish_merged(spark, path, lambda: finish_buckets(spark, path))
        return len(touched)
    finally:
        for folder in folders:
            drop_dir(spark, folder)


def _touched(source: DataFrame, of_key) -> list[int]:
    return sorted(r[0] for r in source.select(of_key.alias("b")).distinct().collect())


def _changed(source: DataFrame, target: DataFrame, keys: list[str], keep_columns) -> DataFrame:
    """Source rows without an equal row in the target; kept columns are not compared."""
    compared = [c for c in source.columns if c not in keep_columns]
    held = target.select(*[F.col(c).alias(f"_t_{c}") for c in compared])
    on = [F.col(k) == F.col(f"_t_{k}") for k in keys] + [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in compared if c not in keys]
    return source.join(held, reduce(lambda a, b: a & b, on), "left_anti")


def _within(source: DataFrame, partition_by: list[str], partitions: list[tuple]) -> DataFrame:
    """The source; a row of another partition is an error when it is read."""
    within = F.coalesce(_partition_filter(partition_by, partitions), F.lit(False))
    return source.filter(F.when(within, True).otherwise(F.raise_error(F.lit("UPSERT_OTHER_PARTITION")).cast("boolean")))


def _absent(spark: SparkSession, path: str, partition_by: list[str], partitions: list[tuple]) -> bool:
    """The table has no folder for its one named partition. One folder appears as a whole
    when a write commits; values that folder names would escape are not judged."""
    if len(partitions) != 1 or len(partition_by) != 1:
        return False
    value = str(partitions[0][0])
    return re.fullmatch("[A-Za-z0-9_-]+", value) is not None and not has_path(spark, f"{path}/{partition_by[0]}={value}")


def insert_only_into(source: DataFrame, path: str, keys: list[str], partition_by: list[str]) -> None:
    """Append the source rows whose key the table does not hold yet."""
    spark = source.sparkSession
    if not path_exists(spark, path):
        append_partitioned(source, path, partition_by)
        return
    target = spark.read.schema(source.schema).parquet(path).select(*source.columns)
    append_partitioned(insert_only(target, source, keys), path, partition_by)


def jdbc_options(url: str, table: str, batch_size: int = 10_000, partitions: int = 8, **extra: str) -> dict[str, str]:
    """Options of a JDBC publish: truncate (keeps the table's grants and indexes),
    batched inserts, and a bound on parallel connections."""
    return {
        "url": url, "dbtable": table, "truncate": "true",
        "batchsize": str(batch_size), "numPartitions": str(partitions), **extra,
    }


def jdbc_publish(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    """Overwrite one relational table; the driver's jar must be on the classpath.
    Create the schema beforehand, with the database's own tools."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode(mode).save()


def publish_nonempty(marts: dict[str, DataFrame], publish) -> list[str]:
    """Publish each mart that has rows through ``publish(df, name)``; an empty one
    is skipped, so its last good copy stays. Returns the published names. A mart is
    computed once: into the shared folder, from where it is asked and published."""
    published = []
    for name, df in marts.items():
        path = shared_dir(df.sparkSession, name)
        df.write.parquet(path)
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
        if not stored.isEmpty():
            publish(stored, name)
            published.append(name)
        drop_dir(df.sparkSession, path)
    return published


def batch_envelopes(
    df: DataFrame, batch=("source", "batch_date"), items: str = "jobs", target_records: int = 1000
) -> DataFrame:
    """Envelopes ``{source, batch_date, total, jobs[]}`` of about ``target_records``
    listings each; ``total`` counts the listings of the envelope.

    A batch of any size is spread over as many envelopes as it needs. Records are
    dealt to chunks by content hash and input partition in one shuffle, and a chunk that
    a mass of copies makes longer is cut in its content's order. So neither a big batch
    nor a mass of copies ends up in one row, no task gets more copies of a record than
    a task has read, and a retried task assigns every record as before.
    """
    batch = list(batch)
    fields = [c for c in df.columns if c not in batch]
    sizes = df.groupBy(*batch).agg(F.ceil(F.count(F.lit(1)) / F.lit(target_records)).alias("_chunks")).withColumnsRenamed(
        {c: f"_b_{c}" for c in batch}
    )
    on = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in batch]
    content = df.withColumns({"_part": F.spark_partition_id(), "_content": F.xxhash64(*fields)})
    # one row per batch: without the hint the records would be shuffled to meet them
    each = content.join(F.broadcast(sizes), on).withColumn("_chunk", F.pmod(F.xxhash64("_part", "_content"), F.col("_chunks")))
    place = F.row_number().over(Window.partitionBy(*batch, "_chunk").orderBy("_content"))
    most = max(1, target_records * 3 // 2)
    return (
        each.select(*batch, *fields, "_chunk", F.floor((place - 1) / F.lit(most)).alias("_cut"))
        .groupBy(*batch, "_chunk", "_cut")
        .agg(F.count(F.lit(1)).alias("total"), F.collect_list(F.struct(*fields)).alias(items))
        .drop("_chunk", "_cut")
    )


#: Raw JSON repeats its field names in every record; readers go by the files' suffix.
RAW_COMPRESSION = "gzip"


def write_envelopes(df: DataFrame, path: str, scraped_at: str | None = None, records: DataFrame | None = None) -> None:
    """Envelopes as gzipped JSON, one object per line, under one folder per batch. Empty
    input is an error; ``records``, from which the envelopes are built, is cheaper to ask."""
    require_rows(df if records is None else records, "NO_RECORDS")
    stamped = df.withColumn("scraped_at", F.lit(scraped_at)) if scraped_at else df
    # the columns stay in the objects too, as the folders copy them
    folders = stamped.withColumns({"p_source": F.col("source"), "p_batch_date": F.col("batch_date")})
    folders.hint("rebalance", "p_source", "p_batch_date").write.mode("overwrite").partitionBy("p_source", "p_batch_date").json(path, compression=RAW_COMPRESSION)
