"""Publishing without loss, keyed tables, landing by metadata, stream state, footers and sketches."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from rolecall.plans import jobs, serving, sketches
from rolecall.sources import readers, sinks
from rolecall.streaming import incremental

DDL = "k string, d string, v int"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- publishing -----------------------------------------------------------

@pytest.fixture
def no_success_files(spark):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    yield
    conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_upserts_without_success_files(spark, tmp_path, no_success_files):
    for path, upsert in ((f"{tmp_path}/a", lambda df, p: sinks.upsert_into(df, p, ["k", "d"], ["d"])),
                         (f"{tmp_path}/b", lambda df, p: sinks.upsert_keyed(df, p, ["k", "d"], partition_by=["d"], buckets=4))):
        assert upsert(frame(spark, [("a", "x", 1), ("b", "y", 2)]), path)
        assert upsert(frame(spark, [("a", "x", 10), ("c", "x", 3)]), path)
        assert not any(n.startswith("_") for n in os.listdir(path))
        assert rows(spark.read.schema(DDL).parquet(path), "k", "d", "v") == [("a", "x", 10), ("b", "y", 2), ("c", "x", 3)]


@pytest.mark.parametrize("finish", ["finish_swap", "finish_buckets"])
def test_nothing_published_is_an_error(spark, tmp_path, monkeypatch, finish):
    monkeypatch.setattr(sinks, finish, lambda *_: False)
    with pytest.raises(RuntimeError, match="MERGED_ROWS_NOT_PUBLISHED"):
        if finish == "finish_swap":
            sinks.upsert_into(frame(spark, [("a", "x", 1)]), f"{tmp_path}/t", ["k", "d"], ["d"])
        else:
            sinks.upsert_keyed(frame(spark, [("a", "x", 1)]), f"{tmp_path}/t", ["k"])


def test_unmarked_rows_are_dropped(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame(spark, [("z", "x", 9)]).write.partitionBy("d").parquet(f"{path}._merged")  # a job lost while it wrote them
    assert sinks.upsert_into(frame(spark, [("a", "x", 1)]), path, ["k", "d"], ["d"])
    assert rows(spark.read.schema(DDL).parquet(path), "k") == [("a",)]


def test_an_absent_partition_is_written_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.upsert_into(frame(spark, [("a", "01", 1)]), path, ["k", "d"], ["d"])
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_merged", lambda *_: pytest.fail("nothing to merge with"))
        assert sinks.upsert_into(frame(spark, [("a", "02", 2), ("b", "02", 3)]), path, ["k", "d"], ["d"], partitions=[("02",)])
        with pytest.raises(Exception, match="UPSERT_OTHER_PARTITION"):
            sinks.upsert_into(frame(spark, [("a", "02", 2)]), path, ["k", "d"], ["d"], partitions=[("03",)])
    assert sinks.upsert_into(frame(spark, [("a", "02", 20)]), path, ["k", "d"], ["d"], partitions=[("02",)])
    assert sinks.upsert_into(frame(spark, [("a", "a/b", 4)]), path, ["k", "d"], ["d"], partitions=[("a/b",)])  # an escaped folder name
    assert sinks.upsert_into(frame(spark, [("c", "a/b", 5)]), path, ["k", "d"], ["d"], partitions=[("a/b",)])
    stored = rows(spark.read.schema(DDL).parquet(path), "k", "d", "v")
    assert stored == [("a", "01", 1), ("a", "02", 20), ("a", "a/b", 4), ("b", "02", 3), ("c", "a/b", 5)]


# ---- keyed tables ---------------------------------------------------------

def test_ten_keys_touch_their_buckets_only(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    everything = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("d"), F.lit(0).alias("v"))
    assert sinks.upsert_keyed(everything, path, ["k"], partition_by=["d"], buckets=64) == 64
    news = frame(spark, [(str(i), "x", i + 1) for i in range(8)] + [("new1", "y", 1), ("new2", "x", 2)])
    wanted = {r[0] for r in news.select(sinks.bucket_of(["k"], 64)).collect()}
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    plans, real = [], sinks.upsert
    monkeypatch.setattr(sinks, "upsert", lambda *a: plans.append(plan(real(*a))) or real(*a))
    assert sinks.upsert_keyed(news, path, ["k"], partition_by=["d"], buckets=7) == len(wanted) <= 10
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert {int(p.parts[-3].split("=")[1]) for p in changed} == wanted
    scans = [line for line in plans[0].splitlines() if "FileScan parquet" in line and f"{path}]" in line]
    assert scans and all("bucket_of_64" in s.split("PartitionFilters:")[1].split("]")[0] for s in scans)
    stored = sinks.read_keyed(spark, path)
    assert stored.columns == ["k", "v", "d"] and stored.count() == 2002
    assert rows(stored.filter("v > 0"), "k", "d", "v") == sorted([(str(i), "x", i + 1) for i in range(8)] + [("new1", "y", 1), ("new2", "x", 2)])


def test_keyed_merge_semantics(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert = lambda data, **o: sinks.upsert_keyed(frame(spark, data), path, ["k"], ["d"], ["d"], buckets=3, **o)
    assert upsert([]) is None
    upsert([("a", "x", 1), (None, "x", 2), ("b", None, 3)])
    assert upsert([("a", "y", 10), (None, "x", 2)]) > 0  # the kept column stays, NULL keys are added again
    assert rows(sinks.read_keyed(spark, path), "k", "d", "v") == sorted([("a", "x", 10), (None, "x", 2), (None, "x", 2), ("b", None, 3)], key=repr)
    assert upsert([("a", "z", 10)], only_changed=True) == 0 and upsert([], only_changed=True) is None
    assert upsert([("a", "z", 10), ("c", "z", 1)], only_changed=True) == 1
    with pytest.raises(Exception, match="MERGE_DUPLICATE_SOURCE_KEY"):
        upsert([("a", "x", 1), ("a", "x", 2)])
    assert upsert([("a", "x", 11)]) == 1


def test_a_lost_keyed_upsert_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.upsert_keyed(frame(spark, [(str(i), "x", 0) for i in range(40)]), path, ["k"], buckets=8)
    moved, real = [], sinks.move_into

    def lost(*args):
        if len(moved) == 3:
            shutil.rmtree(f"{path}/{args[1].split('/')[-1]}")  # gone, and the new one not yet there
            raise RuntimeError("job lost")
        moved.append(real(*args))

    news = frame(spark, [(str(i), "x", 1) for i in range(40)])
    with monkeypatch.context() as m:
        m.setattr(sinks, "move_into", lost)
        with pytest.raises(RuntimeError):
            sinks.upsert_keyed(news, path, ["k"])
    assert sinks.finish_buckets(spark, path) and not sinks.finish_buckets(spark, path)
    assert rows(sinks.read_keyed(spark, path), "k", "v") == sorted((str(i), 1) for i in range(40))


# ---- landing --------------------------------------------------------------

@pytest.fixture
def landing(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def write(name, text, at=None):
        (tmp_path / "in" / name).write_text(text)
        if at is not None:
            os.utime(tmp_path / "in" / name, (at, at))

    def run(**options):
        return tuple(jobs.run_landing(spark, f"{tmp_path}/in", f"{tmp_path}/store", f"{tmp_path}/manifest", **options).first())

    return write, run, tmp_path


def test_landing_by_metadata(spark, landing):
    write, run, path = landing
    for i in range(5):
        write(f"a{i}.json", f"text {i}", 1000 + i)
    write("odd [x]{1},b? *.JSON", "odd", 2000)
    write("other.txt", "no")
    assert run(files_at_once=2) == (6, 0, 0) and run() == (0, 6, 0)
    write("a0.json", "text 0", 5000)  # new time, old content
    write("a1.json", "changed", 5000)
    assert run() == (1, 5, 0) and run() == (0, 6, 0)
    stored = spark.read.parquet(f"{path}/store")
    assert stored.count() == 7 and stored.filter("content is null").count() == 0
    assert {bytes(r.content).decode() for r in stored.collect()} == {*(f"text {i}" for i in range(5)), "odd", "changed"}


def test_known_content_is_not_read(spark, landing):
    write, _, path = landing
    write("a.json", "x")
    first = plan(readers.landed_metadata(spark, f"{path}/in"))
    assert "content" not in first.split("ReadSchema")[1]


def test_failures_count_and_stop_nothing(spark, landing, monkeypatch):
    write, run, path = landing
    for i in range(6):
        write(f"a{i}.json", f"text {i}")
    real = readers.landed_metadata

    def with_a_ghost(*args):
        found = real(*args)
        ghost = found.limit(1).withColumn("path", F.lit(f"file:{path}/in/gone.json"))
        return found.unionByName(ghost)

    with monkeypatch.context() as m:
        m.setattr(jobs, "landed_metadata", with_a_ghost)  # listed, then deleted
        assert run() == (6, 0, 1)
    assert run() == (0, 6, 0)
    write("b.json", "longer")
    with monkeypatch.context() as m:  # grew after it was listed
        grown = lambda spark, paths: real_contents(spark, paths).filter("octet_length(content) <> length")
        real_contents = jobs.landed_contents
        m.setattr(jobs, "landed_contents", grown)
        assert run() == (0, 6, 1)
    assert run() == (1, 6, 0)
    monkeypatch.setattr(jobs, "landed_contents", lambda spark, paths: spark.sql("select no_such_column"))
    write("c.json", "c")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):  # a fault of ours is not a file's
        run()


# ---- the stream -----------------------------------------------------------

def stream(spark, path):
    def land(name, listings, source="itviec"):
        (path / "raw").mkdir(exist_ok=True)
        jobs_ = [{"title": t, "url": u, "salary": s, "location": "x", "tags": ["a"]} for t, u, s in listings]
        (path / "raw" / name).write_text(json.dumps({"source": source, "batch_date": "2026-09-30", "total": len(jobs_), "jobs": jobs_}))

    def run(**options):
        return incremental.incremental_silver(spark, f"{path}/raw", f"{path}/silver", f"{path}/progress", f"{path}/rejected", **options)

    def stored():
        return spark.read.parquet(f"{path}/silver").groupBy("increment").count().collect()

    return land, run, lambda: {r["increment"]: r["count"] for r in stored()}


def test_known_listings_write_no_row(spark, tmp_path):
    land, run, stored = stream(spark, tmp_path)
    first = [("A", "https://a/1", "1 - 2 USD"), ("B", "https://a/2", None), ("A low", "https://a/1", None), ("A", "https://a/1", "1 - 2 USD")]
    land("1.json", first)
    run()
    assert stored() == {0: 2}
    land("2.json", first[::-1])
    run()
    assert stored() == {0: 2}
    land("3.json", [("A", "https://a/1", "1 - 3 USD"), ("B", "https://a/2", None), (None, "https://a/3", None)])
    run()
    assert stored() == {0: 2, 2: 1}
    land("4.json", first[:1])  # back to what it was before: the last state counts
    run()
    assert stored() == {0: 2, 2: 1, 3: 1}
    now = incremental.current_silver(spark, f"{tmp_path}/silver")
    assert rows(now, "url", "title", "max_salary") == [("https://a/1", "A", 2.0), ("https://a/2", "B", None)]
    assert spark.read.parquet(f"{tmp_path}/rejected").count() == 1


def test_a_lost_run_resumes_with_its_state(spark, tmp_path, monkeypatch):
    land, run, stored = stream(spark, tmp_path)
    land("1.json", [("A", "https://a/1", None)])
    run()
    land("2.json", [("A", "https://a/1", None), ("B", "https://a/2", None)])
    with monkeypatch.context() as m:
        m.setattr(incremental, "replace_batches", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert stored() == {0: 1, 1: 1}
    assert rows(incremental.current_silver(spark, f"{tmp_path}/silver"), "url") == [("https://a/1",), ("https://a/2",)]


def test_hot_key_keeps_the_best_of_a_batch(spark, tmp_path):
    land, run, stored = stream(spark, tmp_path)
    land("1.json", [(f"T{i % 7}", "https://a/hot", f"{i % 90} - {i % 97} USD") for i in range(25_000)] + [("B", "https://a/2", None)])
    run()
    best = incremental.current_silver(spark, f"{tmp_path}/silver").filter("url like '%hot'").first()
    expected = jobs.cloud_silver(spark.createDataFrame(
        [("itviec", f"T{i % 7}", "https://a/hot", f"{i % 90} - {i % 97} USD", "x", '["a"]') for i in range(25_000)],
        "source string, title string, url string, salary string, location string, tags string",
    )).first()
    assert stored() == {0: 2} and (best.title, best.salary_raw) == (expected.title, expected.salary_raw)


def test_listings_keep_no_stream_state(spark, tmp_path):
    """Silver itself tells what is new: no row goes through a state store or Python."""
    land, run, stored = stream(spark, tmp_path)
    land("1.json", [("A", "https://a/1", None), (None, "https://a/2", None), (" ", "https://a/3", None), ("F", "ftp://a", None)])
    run()
    land("2.json", [("A", " https://a/1 ", None), ("A", "https://a/2", None), ("B", "https://a/2", "1 - 2 USD")])
    run()
    assert not (tmp_path / "progress" / "state").exists()
    assert stored() == {0: 1, 1: 1}
    rejected = spark.read.parquet(f"{tmp_path}/rejected")
    assert rows(rejected.selectExpr("array_join(reject_reasons, ',') as r", "increment"), "r", "increment") == [
        ("title_missing", 0), ("url_not_http", 0), ("url_not_http", 1)
    ]


@pytest.mark.parametrize("step", ["before the swap", "in the swap", "after it"])
def test_lost_compaction_loses_no_row(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/silver"
    for n in range(3):
        data = [("s", f"u{i}", n) for i in range(n, n + 4)]
        sinks.replace_batches(spark.createDataFrame(data, "source string, url string, v int").withColumn("increment", F.lit(n)), path, ("increment",))
    want = rows(incremental.current_silver(spark, path), "url", "v")

    def lost(*_, **__):
        if step == "in the swap":
            shutil.rmtree(f"{path}/increment=2")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        target = {"before the swap": (incremental, "publish_merged"), "in the swap": (sinks, "replace_batches"), "after it": (incremental, "drop_dir")}[step]
        m.setattr(*target, lost)
        with pytest.raises(RuntimeError):
            incremental.compact_silver(spark, path)
    incremental.compact_silver(spark, path)
    assert rows(incremental.current_silver(spark, path), "url", "v") == want
    assert [n for n in os.listdir(path) if n.startswith("increment")] == ["increment=2"]


# ---- footers, folders, sketches -------------------------------------------

def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(f"{tmp_path}/t")
    counted = readers.footer_counts(spark, {"t": f"{tmp_path}/t"})
    assert "PushedAggregation: [COUNT(*)]" in plan(counted) and rows(counted) == [("t", 1000)]
    spark.sql("CREATE NAMESPACE IF NOT EXISTS footers")
    spark.read.parquet(f"{tmp_path}/t").write.mode("overwrite").saveAsTable("footers.stored")
    spark.sql("CREATE OR REPLACE VIEW footers.seen AS SELECT * FROM footers.stored WHERE id < 10")
    inventory = readers.table_inventory(spark, "footers")
    assert rows(inventory) == [("seen", 10), ("stored", 1000)] and "PushedAggregation: [COUNT(*)]" in plan(inventory)
    spark.sql("DROP VIEW footers.seen")
    spark.sql("DROP TABLE footers.stored")


def test_the_latest_partition_is_one_folder(spark, tmp_path):
    assert serving.latest_partition(spark, f"{tmp_path}/none") is None
    data = frame(spark, [("a", "2026-01-02", 1), ("b", "2026-01-10", 2), ("c", None, 3)]).withColumn("report_date", F.col("d").cast("date")).drop("d")
    sinks.replace_batches(data, f"{tmp_path}/t", ("report_date",))
    latest = serving.latest_partition(spark, f"{tmp_path}/t")
    assert rows(latest, "k") == [("b",)] and len(latest.inputFiles()) >= 1
    filters = plan(latest).split("PartitionFilters:")[1].split("]")[0]
    assert "report_date" in filters and "2026-01-10" in filters and "max" not in plan(latest)


def test_sketches_are_close_and_merge(spark, tmp_path):
    df = spark.range(300_000).select(
        (F.col("id") % 5).cast("string").alias("batch_date"), (F.col("id") % 70_000).cast("string").alias("url"), F.lit("s").alias("source"),
        F.when(F.col("id") % 2 == 0, F.lit("c")).alias("company"),
    )
    made = sketches.batch_sketches(df, {"urls": ("url",), "jobs": ("source", "url"), "companies": ("company",)})
    for _ in range(2):
        sketches.write_sketches(made, f"{tmp_path}/s")
    for first, last in (("0", "4"), ("2", "2"), ("9", "9")):
        found = sketches.distinct_in_range(spark, f"{tmp_path}/s", ["urls", "jobs", "companies"], first, last).first()
        part = df.filter(F.col("batch_date").between(first, last))
        exact = part.select(F.count_distinct("url"), F.count_distinct("source", "url"), F.count_distinct("company"), F.count(F.lit(1))).first()
        assert found.row_count == exact[3]
        for estimate, true in zip((found.urls, found.jobs, found.companies), exact, strict=False):
            assert abs((estimate or 0) - true) <= 1 + 4 * 1.04 / 128 * true
    assert sketches.distinct_in_range(spark, f"{tmp_path}/s", ["urls"], "0", "4").first().urls > 68_000


def test_key_parts_stay_apart(spark):
    df = frame(spark, [("a", "bc", 1), ("ab", "c", 1), ("a", None, 1)])
    assert [r[0] for r in df.select(sketches.key_of("k", "d")).distinct().collect() if r[0] is not None].__len__() == 2
