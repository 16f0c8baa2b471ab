"""Distinct counts of any range of batches, from one small stored row per batch."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolecall.sources.sinks import replace_batches

#: 2**14 registers: a standard error of 0.8 %, and 16 KB at most per sketch.
LOG_REGISTERS = 14
_ERROR = 1.04 / (1 << LOG_REGISTERS) ** 0.5


def key_of(*columns: str) -> Column:
    """Several columns as one value, NULL where one of them is (as COUNT(DISTINCT a, b)
    leaves such rows out); lengths keep ('a', 'bc') and ('ab', 'c') apart."""
    parts = [F.col(c).cast("string") for c in columns]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def batch_sketches(df: DataFrame, distinct: dict[str, tuple], batch: str = "batch_date") -> DataFrame:
    """One row per batch: its rows, and per name of ``distinct`` a mergeable HLL sketch of
    those columns' values. Sketches are merged map-side, so a batch of any size sends a
    few kilobytes per task."""
    sketches = [F.hll_sketch_agg(key_of(*columns), LOG_REGISTERS).alias(name) for name, columns in distinct.items()]
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("row_count"), *sketches)


def write_sketches(sketches: DataFrame, path: str, batch: str = "batch_date") -> None:
    """Replace the rows of these batches; a rerun of a batch does not add to it."""
    replace_batches(sketches, path, (batch,), rebalance=False)


def distinct_in_range(spark: SparkSession, path: str, names: list[str], first: str, last: str, batch: str = "batch_date") -> DataFrame:
    """One row for the batches from ``first`` to ``last``: ``row_count`` and per name the
    estimated distinct values, from stored sketches alone; listings are not read."""
    stored = spark.read.parquet(path).filter(F.col(batch).cast("string").between(first, last))
    merged = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names]
    return stored.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), *merged)


def most_off(exact: Column) -> Column:
    """How far an estimate of this many may be: four standard errors (one estimate in some
    16,000 is further off), and one for rounding."""
    return F.ceil(exact * (4 * _ERROR)) + 1
