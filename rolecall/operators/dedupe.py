"""Keep one row per key, by a total order."""

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType

#: A shuffle into so many parts (``spark.shuffle.sort.bypassMergeThreshold``) is written as rows
#: come. Into more, a task gathers its rows in memory first and spills what does not fit.
DEALT_PARTS = 200


def keep_first(df: DataFrame, keys, order: list, tie_breakers=None) -> DataFrame:
    """The first row of each key by ``order``, then by ``tie_breakers`` (default:
    every other orderable column), so that reruns and other partitionings agree.

    ``row_number() = 1`` is planned with a limit below the shuffle, which sorts what a
    task has read. Rows are rebalanced by key before that: a scan's task may hold more
    rows than it can sort in memory, and other rows of its keys than other tasks. Parts
    are small then and hold whole keys, so one row per key goes on; a key with a third
    of all rows is split over many parts, each of which sends one row. They are no more
    than ``DEALT_PARTS`` until Spark splits the large ones, so that this shuffle does not
    spill either, however many rows a scan's task reads.
    """
    if tie_breakers is None:
        tie_breakers = [
            f.name for f in df.schema.fields
            if f.name not in keys and not isinstance(f.dataType, (MapType, VariantType))
        ]
    total = list(order) + [F.col(c).asc_nulls_first() for c in tie_breakers]
    window = Window.partitionBy(*keys).orderBy(*total)
    # by a hash of the key, since parts dealt by the key itself are ranked as they lie, unsplit
    parts = min(DEALT_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.withColumn("_dealt", F.xxhash64(*keys)).hint("rebalance", parts, "_dealt").drop("_dealt")
    return dealt.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def salary_score() -> Column:
    return F.coalesce("max_salary", "min_salary", F.lit(0.0))


def keep_best_listing(df: DataFrame, keys=("url",), tie_breakers=None) -> DataFrame:
    """Highest salary first, then title ascending. NULL keys form one group."""
    order = [salary_score().desc_nulls_last(), F.col("title").asc_nulls_first()]
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c != "title"]
    return keep_first(df, list(keys), order, tie_breakers)


def keep_first_seen(df: DataFrame, sequence: list[str], url: str = "url", title: str = "title") -> DataFrame:
    """First row in ``sequence`` order per url, or per title when the url is blank."""
    key = F.coalesce(F.when(F.col(url) != "", F.col(url)), F.col(title))
    order = [F.col(c).asc_nulls_first() for c in sequence]
    return keep_first(df.withColumn("_key", key), ["_key"], order).drop("_key")
