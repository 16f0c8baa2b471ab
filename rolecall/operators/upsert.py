"""MERGE semantics as DataFrame joins, for tables without a row-level catalog."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F



def _any_null(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _same_key(left: str, right: str, keys) -> Column:
    """NULL-safe equality of prefixed key columns; still a hashable equi-join."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    keep_columns: list[str] = (),
    null_safe_keys: bool = False,
) -> DataFrame:
    """Target rows with a matching source row take its values (all but the keys
    and ``keep_columns``); source rows without a match are added.

    Keys compare with ``=``, so NULL keys never match unless ``null_safe_keys``.
    Two source rows for one target row raise an error when the plan runs, as in
    MERGE. The target is joined as the outer side: a small source is broadcast by
    its measured size, and a hot key of the target (NULL too, which matches nothing)
    can be split by AQE. The target is scanned whole once, and its keys once more for
    the rows to add.
    """
    keys = list(keys)
    columns = target.columns
    changed = [c for c in columns if c not in keys and c not in keep_columns]

    # one row per source key, with the number of rows it stands for
    news = [F.any_value(F.struct(*changed)).alias("_new")] if changed else []
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *news).withColumnsRenamed(
        {k: f"_s_{k}" for k in keys}
    )
    if null_safe_keys:
        on = _same_key("", "_s_", keys)
    else:
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    joined = target.join(per_key, on, "left_outer")

    duplicate = F.raise_error(F.lit("MERGE_DUPLICATE_SOURCE_KEY")).cast("boolean")
    checked = joined.filter(F.when(F.col("_n") > 1, duplicate).otherwise(F.lit(True)))
    merged = checked.select(*[
        F.when(F.col("_n").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in columns
    ])
    return merged.unionByName(insert_only(target, source, keys, null_safe_keys))


def insert_only(target: DataFrame, source: DataFrame, keys: list[str], null_safe_keys: bool = False) -> DataFrame:
    """Source rows whose key the target does not hold.

    The target's keys are first cut down to those the source has (a semi join
    that broadcasts a small source), then made distinct, so neither a large
    target nor a hot target key is shuffled into the final anti join. Rows with a
    NULL key match nothing and bypass it.
    """
    if null_safe_keys:
        held = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
        wanted = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys]).distinct()
        matched = held.join(wanted, _same_key("_t_", "_s_", keys), "left_semi").distinct()
        return source.join(matched, _same_key("", "_t_", keys), "left_anti").select(*target.columns)
    matched = target.select(*keys).join(source.select(*keys).distinct(), keys, "left_semi").distinct()
    unmatched = source.filter(~_any_null(keys)).join(matched, keys, "left_anti").select(*target.columns)
    return unmatched.unionByName(source.filter(_any_null(keys)).select(*target.columns))


def insert_only_merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows it does not hold; nothing is updated."""
    return target.unionByName(insert_only(target, source, keys))
