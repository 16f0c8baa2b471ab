"""Deterministic dedupe and MERGE semantics, against brute force."""

import re

import pytest
from pyspark.sql import functions as F

from rolecall.operators.dedupe import keep_best_listing, keep_first, keep_first_seen
from rolecall.operators.upsert import insert_only_merge, upsert

DDL = "url string, title string, min_salary double, max_salary double, note string"


def listings(spark, n=400):
    return spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("u"), F.col("id") % 7)).alias("url"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("t"), F.col("id") % 4)).alias("title"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 13).cast("double")).alias("min_salary"),
        F.when(F.col("id") % 2 != 0, (F.col("id") % 17).cast("double")).alias("max_salary"),
        F.col("id").cast("string").alias("note"),
    )


def brute_best(rows):
    best = {}
    low = lambda v: (v is not None, v)  # noqa: E731  NULL first
    for r in rows:
        score = r.max_salary if r.max_salary is not None else r.min_salary if r.min_salary is not None else 0.0
        order = (-score, low(r.title), low(r.min_salary), low(r.max_salary), low(r.note))
        if r.url not in best or order < best[r.url][0]:
            best[r.url] = (order, tuple(r))
    return sorted((v[1] for v in best.values()), key=repr)


def test_best_listing_against_brute_force(spark, rows_of):
    df = listings(spark)
    assert rows_of(keep_best_listing(df)) == brute_best(df.collect())


def test_dedupe_is_idempotent_and_partition_invariant(spark, rows_of):
    df = listings(spark)
    once = keep_best_listing(df)
    assert rows_of(keep_best_listing(once)) == rows_of(once)
    for partitions in (1, 13):
        assert rows_of(keep_best_listing(df.repartition(partitions, "note"))) == rows_of(once)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert rows_of(keep_best_listing(df)) == rows_of(once)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    plan = keep_best_listing(listings(spark))._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_rows_are_dealt_by_key_before_they_are_sorted(spark, rows_of):
    """A scan's task sorts nothing: the limit below the shuffle works on rebalanced parts,
    and parts of a hot key may be split, since the ranking shuffles once more."""
    plan = keep_best_listing(listings(spark))._jdf.queryExecution().executedPlan().toString()
    ranked, partial = plan.index("hashpartitioning(url"), plan.index("Partial")
    assert ranked < partial < plan.index("REBALANCE_PARTITIONS_BY_COL")
    nulls = listings(spark).withColumn("url", F.lit(None).cast("string"))
    assert rows_of(keep_best_listing(nulls)) == brute_best(nulls.collect())


def test_dealing_does_not_spill_with_many_shuffle_partitions(spark, rows_of):
    """Above 200 parts a scan's task gathers its rows in memory before it writes them."""
    df, before = listings(spark), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "400")
        once = keep_best_listing(df)
        plan = once._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"hashpartitioning\(_dealt#\d+L?, (\d+)\), REBALANCE_PARTITIONS_BY_COL", plan) == ["200"]
        assert re.findall(r"hashpartitioning\(url#\d+, (\d+)\)", plan) == ["400"]
        assert rows_of(once) == brute_best(df.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    plan = keep_best_listing(df)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(_dealt#\d+L?, (\d+)\)", plan) == [before]


def test_first_seen_falls_back_to_the_title(spark, rows_of):
    df = spark.createDataFrame(
        [(3, "", "A"), (1, "", "A"), (2, "u", "B"), (4, "u", "C"), (5, None, "A"), (6, None, "u")], "seq int, url string, title string"
    )
    assert rows_of(keep_first_seen(df, ["seq"]).select("seq")) == [(1,), (2,)]


def test_generic_keep_first(spark, rows_of):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (2, 1, "c")], "k int, v int, w string")
    assert rows_of(keep_first(df, ["k"], [F.col("v").desc()])) == [(1, 5, "a"), (2, 1, "c")]


TARGET = [("a", 1, "s1"), ("b", 2, "s1"), ("b", 3, "s2"), (None, 4, "s1"), ("c", 5, "s3")]
SOURCE = [("b", 20, "new"), ("d", 40, "new"), (None, 50, "new"), ("c", None, "new")]


def frames(spark, target=TARGET, source=SOURCE):
    ddl = "k string, v int, source string"
    return spark.createDataFrame(target, ddl), spark.createDataFrame(source, ddl)


def test_upsert(spark, rows_of):
    expected = [("a", 1, "s1"), ("b", 20, "new"), ("b", 20, "new"), ("c", None, "new"), ("d", 40, "new"), (None, 4, "s1"), (None, 50, "new")]
    assert rows_of(upsert(*frames(spark), ["k"])) == sorted(expected, key=repr)


def test_upsert_keeps_columns_and_matches_nulls_when_asked(spark, rows_of):
    kept = rows_of(upsert(*frames(spark), ["k"], keep_columns=["source"]))
    assert ("b", 20, "s1") in kept and ("b", 20, "s2") in kept and ("d", 40, "new") in kept
    safe = rows_of(upsert(*frames(spark), ["k"], null_safe_keys=True))
    assert (None, 50, "new") in safe and (None, 4, "s1") not in safe and len(safe) == 6


def test_upsert_twice_is_once(spark, rows_of):
    target, source = frames(spark, source=[r for r in SOURCE if r[0]])
    once = upsert(target, source, ["k"])
    assert rows_of(upsert(once, source, ["k"])) == rows_of(once)


def test_two_source_rows_for_one_target_row_fail(spark):
    target, source = frames(spark, source=[("b", 1, "x"), ("b", 2, "x")])
    with pytest.raises(Exception, match="MERGE_DUPLICATE_SOURCE_KEY"):
        upsert(target, source, ["k"]).collect()
    target, source = frames(spark, source=[("z", 1, "x"), ("z", 2, "x")])  # no target row: both are added
    assert upsert(target, source, ["k"]).filter("k = 'z'").count() == 2


def test_upsert_by_all_columns_only_inserts(spark, rows_of):
    target, source = frames(spark, source=[("a", 1, "s1"), ("n", 9, "s9")])
    keys = ["k", "v", "source"]
    assert rows_of(upsert(target, source, keys)) == rows_of(insert_only_merge(target, source, keys))
    assert insert_only_merge(target, source, keys).count() == 6


def test_joins_hash_on_the_keys(spark):
    for null_safe in (False, True):
        plan = upsert(*frames(spark), ["k"], null_safe_keys=null_safe)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
