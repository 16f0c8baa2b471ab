"""Readers, sinks, whole jobs and the incremental job."""

import json

import pytest
from pyspark.sql import functions as F

from rolecall.operators.quality import QualityError
from rolecall.plans import jobs, marts
from rolecall.sources import readers, sinks
from rolecall.storage import shared_dir
from rolecall.streaming.incremental import compact_silver, current_silver, incremental_silver

BATCH = "2026-09-30"


def listing(title, url, salary="20 - 35 triệu", tags=("SQL",), **other):
    return {"keyword": "data", "title": title, "url": url, "company": "ACME", "location": "Hà Nội", "work_type": "Remote",
            "salary": salary, "tags": list(tags), "posted": "today", **other}


def write_json(path, name, value):
    folder = path / name
    folder.parent.mkdir(parents=True, exist_ok=True)
    folder.write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


@pytest.fixture
def raw(tmp_path):
    """One envelope and one flat array, both over several lines, plus a stray file."""
    first = [listing("Data Engineer", "https://a.test/1"), listing("Cheap twin", "https://a.test/1", "1 - 2 triệu"), listing(None, "https://a.test/2")]
    second = [
        {"source": "topcv", **listing("Big data dev", "https://b.test/1", "1,500 - 3,000 USD")},
        {"source": "topcv", **listing("No address", "ftp://b.test/2")},
    ]
    write_json(tmp_path / "raw", f"itviec/{BATCH}/itviec_jobs.json", {"source": "itviec", "batch_date": BATCH, "scraped_at": "x", "total": 3, "jobs": first})
    write_json(tmp_path / "raw", f"topcv/{BATCH}/topcv_jobs.JSON", second)
    write_json(tmp_path / "raw", "topcv/readme.txt", "no")
    return tmp_path


def test_raw_to_bronze(spark, raw, rows_of):
    results = jobs.run_bronze(spark, f"{raw}/raw/*/*/*", f"{raw}/bronze", f"{raw}/quarantine", BATCH)
    found = {(r.rule, r.column): (r.evaluated, r.failed) for r in results.collect()}
    assert found["not_null", "title"] == (5, 1) and found["match_regex", "url"] == (5, 1)
    bronze, lost = spark.read.parquet(f"{raw}/bronze"), spark.read.parquet(f"{raw}/quarantine")
    assert rows_of(bronze.select("source", "title")) == [("itviec", "Cheap twin"), ("itviec", "Data Engineer"), ("topcv", "Big data dev")]
    assert rows_of(lost.select(F.array_join("reject_reasons", ","))) == [("title_missing",), ("url_not_http",)]
    assert bronze.filter(F.col("source_file").contains("itviec_jobs.json")).count() == 2
    assert bronze.filter(F.col("tags") == '["SQL"]').count() == 3
    assert bronze.select("crawled_date").distinct().count() == 1


def test_landed_files(spark, raw, rows_of):
    landed = readers.landed_files(spark, f"{raw}/raw")
    assert landed.count() == 2  # the suffix ignores case; other files stay out
    manifest = landed.withColumn("content_hash", F.when(F.col("path").contains("itviec"), F.col("content_hash")).otherwise("old"))
    assert [("topcv" in r.path) for r in readers.changed_objects(landed, manifest).collect()] == [True]
    assert tuple(readers.landing_summary(landed, manifest).first()) == (1, 1)


def bronze_rows(spark, n=60):
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "itviec").otherwise("topcv").alias("source"),
        F.concat(F.lit("  Data Engineer "), F.col("id") % 9).alias("title"),
        F.concat(F.lit("https://a.test/"), F.col("id") % 20).alias("url"),
        F.concat(F.col("id"), F.lit(" triệu")).alias("salary"),
        F.lit("Sài Gòn").alias("location"),
    )


def test_cloud_jobs_are_rerun_safe(spark, tmp_path, rows_of):
    days = ("2026-09-29", BATCH)
    for day in days:
        sinks.replace_batches(bronze_rows(spark).withColumn("batch_date", F.lit(day)), f"{tmp_path}/bronze")
    sources = ("itviec", "topcv")
    first = jobs.run_cloud_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", days[0], sources)
    other_day = rows_of(readers.batch_partition_scan(spark, f"{tmp_path}/silver", days[0]))
    for _ in range(2):
        counts = jobs.run_cloud_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", BATCH, sources)
        jobs.run_cloud_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", BATCH, sources)
    assert counts == first == {"rows_in": 60, "rows_out": 20, "rows_removed": 40}
    assert rows_of(readers.batch_partition_scan(spark, f"{tmp_path}/silver", days[0])) == other_day
    summary = spark.read.parquet(f"{tmp_path}/gold/location_summary").collect()
    assert {(r.location_std, r.source, r.job_count) for r in summary} == {("Ho Chi Minh", "itviec", 10), ("Ho Chi Minh", "topcv", 10)}
    assert spark.read.parquet(f"{tmp_path}/gold/job_market_overview").first().total_jobs == 20


def test_cloud_gates(spark, tmp_path):
    rows = bronze_rows(spark).withColumn("batch_date", F.lit(BATCH))
    sinks.replace_batches(rows.filter(F.col("source") == "itviec"), f"{tmp_path}/bronze")
    with pytest.raises(QualityError, match="SILVER_SOURCE_MISSING: topcv"):
        jobs.run_cloud_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", BATCH, ("itviec", "topcv"))
    jobs.run_cloud_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", BATCH, ("itviec", "topcv"), require_all_sources=False)
    doubled = readers.batch_partition_scan(spark, f"{tmp_path}/silver", BATCH)
    sinks.replace_batches(doubled.unionByName(doubled), f"{tmp_path}/doubled")
    with pytest.raises(QualityError, match="GOLD_INPUT_TOTAL_MISMATCH"):
        jobs.run_cloud_gold(spark, f"{tmp_path}/doubled", f"{tmp_path}/gold", BATCH, ("itviec",))
    assert not (tmp_path / "gold").exists()  # asked before publishing
    with pytest.raises(QualityError, match="SILVER_EMPTY_INPUT: batch_date=2020-01-01"):
        jobs.run_cloud_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", "2020-01-01", ("itviec",))
    with pytest.raises(QualityError, match="MISSING: title"):
        sinks.replace_batches(rows.drop("title"), f"{tmp_path}/untitled")
        jobs.run_cloud_silver(spark, f"{tmp_path}/untitled", f"{tmp_path}/silver", BATCH, ("itviec",))


def test_one_batch_scan_opens_one_batch(spark, tmp_path):
    for day in ("2026-09-28", BATCH):
        sinks.replace_batches(bronze_rows(spark).withColumn("batch_date", F.lit(day)), f"{tmp_path}/bronze")
    one = readers.batch_partition_scan(spark, f"{tmp_path}/bronze", BATCH, ["itviec"])
    assert one.count() == 30 and all(BATCH in f for f in one.inputFiles())
    assert dict(one.dtypes)["batch_date"] == "string"


def test_local_jobs(spark, tmp_path, rows_of):
    sinks.append_partitioned(bronze_rows(spark), f"{tmp_path}/bronze", crawled_date=BATCH)
    for _ in range(2):
        assert jobs.run_local_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")
    silver = spark.read.parquet(f"{tmp_path}/silver")
    assert silver.count() == 20 and silver.select("url").distinct().count() == 20
    assert jobs.run_local_gold(spark, "no_such_table", f"{tmp_path}/gold", BATCH, "itviec") == {}
    silver.createOrReplaceTempView("local_silver_rows")
    published = []
    for _ in range(2):
        paths = jobs.run_local_gold(
            spark, "local_silver_rows", f"{tmp_path}/gold", BATCH, "itviec", publish=lambda df, name: published.append((name, df.count()))
        )
    assert len(paths) == 10 and "mart_company_hiring_trend" not in paths  # no listing names a company
    assert published[:10] == published[10:] and len(published) == 20
    assert spark.read.parquet(paths["mart_skill_demand"]).count() == dict(published)["mart_skill_demand"]


def test_upsert_into_moves_nothing_between_partitions(spark, tmp_path):
    df = spark.createDataFrame([("a", "s1", 1)], "k string, s string, v int")
    with pytest.raises(ValueError):
        sinks.upsert_into(df, f"{tmp_path}/t", ["k"], ["s"])
    assert sinks.upsert_into(df, f"{tmp_path}/t", ["k"], ["s"], keep_columns=["s"])
    newer = spark.createDataFrame([("a", "s2", 2), ("b", "s2", 3)], "k string, s string, v int")
    assert sinks.upsert_into(newer, f"{tmp_path}/t", ["k"], ["s"], keep_columns=["s"])
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").select("k", "s", "v").collect())) == [("a", "s1", 2), ("b", "s2", 3)]
    assert not sinks.upsert_into(newer.limit(0), f"{tmp_path}/t", ["k"], ["s"], keep_columns=["s"])


def test_upsert_touches_only_named_partitions(spark, tmp_path):
    ddl = "k string, d string, v int"
    sinks.upsert_into(spark.createDataFrame([("a", "d1", 1), ("a", "d2", 2)], ddl), f"{tmp_path}/t", ["k", "d"], ["d"])
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=d1").iterdir()}
    sinks.upsert_into(spark.createDataFrame([("a", "d2", 20), ("b", "d2", 3)], ddl), f"{tmp_path}/t", ["k", "d"], ["d"])
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "d=d1").iterdir()}
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").select("k", "d", "v").collect())) == [("a", "d1", 1), ("a", "d2", 20), ("b", "d2", 3)]


def scans_of(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_upsert_prunes_the_named_partitions(spark, tmp_path, monkeypatch):
    ddl = "k string, d string, v int"
    path = f"{tmp_path}/t"
    sinks.upsert_into(spark.createDataFrame([("a", "01", 1), ("a", "02", 2)], ddl), path, ["k", "d"], ["d"])
    plans = []
    real = sinks.upsert

    def watched(target, source, keys, keep):
        merged = real(target, source, keys, keep)
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return merged

    monkeypatch.setattr(sinks, "upsert", watched)
    news = spark.createDataFrame([("a", "02", 20), ("b", "02", 3)], ddl)
    assert sinks.upsert_into(news, path, ["k", "d"], ["d"], partitions=[("02",)])
    target_scans = [line for line in plans[0].splitlines() if "FileScan parquet" in line and "/t]" in line]
    assert 1 <= len(target_scans) <= 2 and all("(d#" in x.split("PartitionFilters:")[1].split("]")[0] and "<=> 02" in x for x in target_scans)
    read = spark.read.schema(ddl).parquet(path)
    assert sorted(map(tuple, read.select("k", "d", "v").collect())) == [("a", "01", 1), ("a", "02", 20), ("b", "02", 3)]
    with pytest.raises(Exception, match="UPSERT_OTHER_PARTITION"):
        sinks.upsert_into(news, path, ["k", "d"], ["d"], partitions=[("01",)])


def test_a_lost_commit_is_finished(spark, tmp_path, monkeypatch):
    import shutil

    ddl = "k string, d string, v int"
    path, news = f"{tmp_path}/t", spark.createDataFrame([("a", "d1", 10), ("c", "d2", 3)], ddl)
    sinks.upsert_into(spark.createDataFrame([("a", "d1", 1), ("b", "d1", 2), ("b", "d2", 2)], ddl), path, ["k", "d"], ["d"])
    wanted = [("a", "d1", 10), ("b", "d1", 2), ("b", "d2", 2), ("c", "d2", 3)]

    def lost(*_, **__):
        shutil.rmtree(f"{path}/d=d1")  # the old rows are gone, the new ones not yet there
        raise RuntimeError("job lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "replace_batches", lost)
        with pytest.raises(RuntimeError):
            sinks.upsert_into(news, path, ["k", "d"], ["d"])
    assert sinks.upsert_into(news, path, ["k", "d"], ["d"])  # run again
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "d", "v").collect())) == wanted
    assert not (tmp_path / "t._merged").exists()


def test_gold_tables_are_in_the_catalog(spark, tmp_path):
    silver = jobs.local_silver(bronze_rows(spark))
    silver.write.mode("overwrite").saveAsTable("silver_of_catalog_test")
    for day in (BATCH, "2026-10-01"):
        jobs.run_local_gold(spark, "silver_of_catalog_test", f"{tmp_path}/gold", day, "itviec", database="gold_test", created_at="2026-09-30 01:02:03")
    rows = spark.sql("SELECT report_date, records_in, created_at FROM gold_test.mart_pipeline_health ORDER BY report_date").collect()
    assert [r.records_in for r in rows] == [20, 20] and str(rows[0].created_at) == "2026-09-30 01:02:03"
    names = {r.table_name for r in readers.table_inventory(spark, "gold_test").collect()}
    assert {"mart_pipeline_health", "mart_job_market_overview", "daily_alerts"} <= names
    spark.sql("DROP TABLE silver_of_catalog_test")


def test_insert_only_into(spark, tmp_path):
    ddl = "k string, d string"
    for _ in range(2):
        sinks.insert_only_into(spark.createDataFrame([("a", "d1"), ("b", "d1")], ddl), f"{tmp_path}/t", ["k", "d"], ["d"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_envelopes_split_hot_batches_and_copies(spark, rows_of):
    hot = spark.range(6000).select(
        F.when(F.col("id") < 5000, "itviec").otherwise("topcv").alias("source"), F.lit(BATCH).alias("batch_date"),
        F.when(F.col("id") < 2500, "copy").otherwise(F.col("id").cast("string")).alias("title"),
    )
    envelopes = sinks.batch_envelopes(hot, target_records=100)
    sizes = [r.total for r in envelopes.select("total").collect()]
    assert sum(sizes) == 6000 and max(sizes) < 200 and len(sizes) >= 50
    back = envelopes.select("source", "batch_date", F.explode("jobs.title").alias("title"))
    assert rows_of(back) == rows_of(hot)
    with pytest.raises(QualityError):
        sinks.write_envelopes(sinks.batch_envelopes(hot.limit(0)), shared_dir(spark, "none"))


def test_envelopes_shuffle_their_records_once(spark, tmp_path, rows_of):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, "itviec").alias("source"), F.lit(BATCH).alias("batch_date"), F.lit("same").alias("title"),
        F.array(F.lit("a")).alias("tags"),
    )
    plan = sinks.batch_envelopes(rows, target_records=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the batches' sizes, and the records
    envelopes = sinks.batch_envelopes(rows.coalesce(1), target_records=100)
    sizes = [r.total for r in envelopes.collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 150
    sinks.write_envelopes(envelopes, f"{tmp_path}/raw")
    assert list((tmp_path / "raw").rglob("*.json.gz")) and not list((tmp_path / "raw").rglob("*.json"))
    back = spark.read.json(f"{tmp_path}/raw").select("source", F.explode("jobs.title").alias("title"))
    assert rows_of(back) == rows_of(rows.select("source", "title"))


def test_quarantine_keeps_rows_without_source(spark, tmp_path):
    df = spark.createDataFrame([(None, "t"), ("itviec", "u")], "source string, title string")
    sinks.quarantine(df, f"{tmp_path}/q")
    assert sorted((r.source or "", r.title) for r in spark.read.parquet(f"{tmp_path}/q").collect()) == [("", "t"), ("itviec", "u")]


def test_jdbc_options():
    options = sinks.jdbc_options("jdbc:postgresql://db/warehouse", "analytics.mart", partitions=4, user="u")
    assert options["truncate"] == "true" and options["numPartitions"] == "4" and options["user"] == "u"
    assert options["dbtable"] == "analytics.mart"


def test_publish_skips_empty_marts(spark):
    seen = []
    one = spark.range(1)
    assert sinks.publish_nonempty({"a": one, "b": one.limit(0)}, lambda df, name: seen.append(name)) == ["a"] == seen


def test_skill_mart_reads_its_input_once(spark, tmp_path):
    bronze_rows(spark).write.parquet(f"{tmp_path}/b")
    silver = jobs.cloud_silver(spark.read.parquet(f"{tmp_path}/b"))
    plan = marts.skill_demand(marts.prepare(silver, BATCH))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_approximate_overview(spark):
    prepared = marts.prepare(jobs.cloud_silver(bronze_rows(spark)), BATCH)
    exact = marts.job_market_overview(prepared, ("source", "url")).first()
    close = marts.job_market_overview(prepared, ("source", "url"), approximate=True).first()
    assert exact.total_jobs == close.total_jobs == 20 and close.total_sources == 2


def test_incremental_job_resumes_and_upserts(spark, tmp_path, rows_of):
    def land(name, jobs_list, source="itviec"):
        write_json(tmp_path / "raw", name, {"source": source, "batch_date": BATCH, "total": len(jobs_list), "jobs": jobs_list})

    def run():
        query = incremental_silver(spark, f"{tmp_path}/raw", f"{tmp_path}/silver", f"{tmp_path}/progress", f"{tmp_path}/rejected", max_files=1)
        return sum(p["numInputRows"] for p in query.recentProgress)

    land("a.json", [listing("A", "https://a.test/1"), listing("A2", "https://a.test/2")])
    assert run() > 0
    land("b.json", [listing("A again", "https://a.test/1", "50 - 60 triệu"), listing(None, "https://a.test/9")])
    land("c.json", [listing("C", "https://a.test/1")], "topcv")
    run()
    assert run() == 0
    wanted = [
        ("itviec", "https://a.test/1", "A again", 60e6), ("itviec", "https://a.test/2", "A2", 35e6), ("topcv", "https://a.test/1", "C", 35e6),
    ]
    stored = lambda: rows_of(current_silver(spark, f"{tmp_path}/silver").select("source", "url", "title", "max_salary"))
    assert stored() == wanted
    rejected = spark.read.parquet(f"{tmp_path}/rejected").collect()
    assert [(r.url, r.reject_reasons) for r in rejected] == [("https://a.test/9", ["title_missing"])]
    # later increments leave the files of earlier ones alone
    first = {p: p.stat().st_mtime_ns for p in (tmp_path / "silver" / "increment=0").iterdir()}
    land("d.json", [listing("D", "https://a.test/4")])
    run()
    assert first == {p: p.stat().st_mtime_ns for p in (tmp_path / "silver" / "increment=0").iterdir()}
    before = stored()
    for _ in range(2):
        compact_silver(spark, f"{tmp_path}/silver")
        assert stored() == before
    assert [p.name for p in (tmp_path / "silver").glob("increment=*")] == ["increment=3"]


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two
    if base:
        assert one.startswith(base)


def test_a_small_staged_source_does_not_shuffle_the_target(spark, tmp_path):
    from rolecall.operators.upsert import upsert

    ddl = "k string, v int"
    spark.createDataFrame([("a", 1)], ddl).write.parquet(f"{tmp_path}/target")
    source = sinks.stage(spark.createDataFrame([("a", 2)], ddl))
    plan = upsert(spark.read.parquet(f"{tmp_path}/target"), source, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
