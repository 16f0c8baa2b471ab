"""Weighted rendezvous hashing of record keys, DataFrame functions only."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from rolecall.sources.sinks import stage


def _cost(key: Column, label: str, weight: float) -> Column:
    """-ln(u) / weight with u in (0, 1) from a 64-bit hash of key and shard label.

    The shard with the least cost wins; a shard wins in proportion to its weight.
    """
    bits = F.xxhash64(key.cast("string"), F.lit(label)).bitwiseAND(F.lit((1 << 53) - 1))
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(float(weight))


def rendezvous_shard(key: Column, weights: dict[int, float]) -> Column:
    """The shard of each key among ``weights`` (shard number -> weight above zero).

    Only the key and the set of shards decide. A shard that is added takes keys from
    all others and moves no key between them; a shard that leaves gives up only its
    own. Equal keys share a shard, and null is a key like any other.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("at least one shard, and weights above zero")
    costs = [
        F.struct(_cost(key, f"shard-{shard}", weight).alias("cost"), F.lit(int(shard)).alias("shard"))
        for shard, weight in sorted(weights.items())
    ]
    return F.array_min(F.array(*costs))["shard"]


def with_shards(
    df: DataFrame, key: str, weights: dict[int, float], grown_weight: float | None = None,
    shard: str = "shard", grown: str = "grown_shard",
) -> DataFrame:
    """Adds ``shard`` and, with ``grown_weight``, ``grown``: the shard once one more
    shard of that weight exists. A projection: no shuffle and no state. Columns that
    already have those names are replaced."""
    added = {shard: rendezvous_shard(F.col(key), weights)}
    if grown_weight is not None:
        added[grown] = rendezvous_shard(F.col(key), {**weights, max(weights) + 1: grown_weight})
    return df.withColumns(added)


def with_slots(df: DataFrame, shard: str = "shard", slot: str = "slot", rows_per_group: int = 100_000) -> DataFrame:
    """Numbers the rows of each shard 0, 1, 2, ... without a gap, over all columns of
    ``df``; a column that is called ``slot`` already is replaced.

    Equal rows are counted before the shuffle and numbered together, so no copy group
    is gathered. Distinct rows are hashed to groups of about ``rows_per_group`` rows;
    a row's slot is its place in its group plus the sizes of the groups before. Nulls
    are values like any other. ``df`` is written once and read three times.
    """
    columns = [c for c in df.columns if c != slot]
    kept = [f"c{i}" for i in range(len(columns))]  # whatever the columns are called
    of = kept[columns.index(shard)]
    rows = stage(df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(columns, kept, strict=True)]), "slots")
    groups = F.lit(1 + rows.count() // rows_per_group)
    group = F.pmod(F.xxhash64(*kept), groups).alias("group")
    counted = rows.groupBy(*kept).agg(F.count(F.lit(1)).alias("n")).select("*", group)
    sizes = rows.groupBy(of, group).agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(of).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(of).alias("shard"), F.col("group").alias("in"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(of, "group").orderBy(*kept).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    joined = placed.join(starts, F.col(of).eqNullSafe(F.col("shard")) & (F.col("group") == F.col("in")))
    first = F.col("start") + F.col("first")
    each = F.explode(F.sequence(first, first + F.col("n") - 1)).alias(slot)
    return joined.select(*[F.col(k).alias(c) for c, k in zip(columns, kept, strict=True)], each)
