"""Batch dates, payload contracts, key scans and checksums."""

import json
import random

from pyspark.sql import functions as F

from rolecall.functions import batch
from rolecall.operators import payload
from rolecall.functions.salary import with_salary


def test_batch_dates(spark):
    cases = {
        "2026-09-30": True, "2024-02-29": True, "2026-9-30": False, "30-09-2026": False, "2026-02-30": False, "": False,
        None: False, "2026-09-30\n": False, " 2026-09-30": False, "0000-01-01": False, "2023-02-29": False, "2026-13-01": False,
    }
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(batch.batch_date_valid(F.col("v"))).collect()] == list(cases.values())


def test_resolved_dates_and_keys(spark):
    df = spark.createDataFrame(
        [("2026-09-30", None, None), (None, "2026-10-01T01:00:00Z", "x"), (None, "2026-10-01T01:00:00Z", None), (None, None, "x")],
        "d string, t string, e string",
    )
    assert [r[0] for r in df.select(batch.resolve_batch_date(F.col("d"), F.col("t"), F.col("e"))).collect()] == [
        "2026-09-30", "2026-10-01", None, None,
    ]
    one = spark.range(1)
    args = F.lit("itviec"), F.lit("2026-09-25")
    assert one.select(batch.object_key(*args)).first()[0] == "raw/source=itviec/batch_date=2026-09-25/itviec_jobs.json"
    assert one.select(batch.object_key(*args, layout="plain")).first()[0] == "itviec/2026-09-25/itviec_jobs.json"


def test_record_verdicts(spark):
    cases = {
        '{"a": 1}': "ok", "{}": "empty_object", "[1]": "not_object", '"x"': "not_object", "5": "not_object", "null": "not_object",
        "{bad": "not_json", "": "not_json", '{"a":1} rest': "not_json", '{"a":1}]x': "not_json", '{"a":1}}': "not_json",
        '"k": 69}': "not_json", '{"a":1},{"b":2}': "not_json", '1,"w":2': "not_json", None: "not_json",
    }
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(payload.record_verdict(F.col("v"))).collect()] == list(cases.values())


def file_verdicts(spark, contents):
    rows = [(str(i), len(c), bytearray(c)) for i, c in enumerate(contents)]
    df = spark.createDataFrame(rows, "path string, length bigint, content binary")
    return [(r.verdict, r.record_count) for r in payload.payload_file_verdict(df).orderBy(F.col("path").cast("int")).collect()]


def test_file_verdicts(spark):
    good = [{"title": "A", "nested": {"k": [1]}}, {"title": "B, cookie: password"}]
    texts = [json.dumps(good), "﻿" + json.dumps(good), "{}", "[]", '["not-an-object"]', "[{}]", "[1", "", "5", "[null]"]
    expected = [
        ("ok", 2), ("ok", 2), ("not_array", None), ("empty_array", 0), ("bad_record", 1), ("bad_record", 1),
        ("invalid_json", None), ("empty_file", None), ("not_array", None), ("bad_record", 1),
    ]
    found = file_verdicts(spark, [t.encode() for t in texts] + [b"\xff\xfe["])
    assert [f[0] for f in found] == [e[0] for e in expected] + ["not_utf8"]
    assert [f[1] for f in found][:2] == [2, 2]
    secret = ["cookie", "cookies", "session_token", "password", "Authorization", "AWS-Secret-Access-Key"]
    nested = [json.dumps([{"title": "A", "meta": [{"deep": {k: "x"}}]}]).encode() for k in secret]
    assert {v for v, _ in file_verdicts(spark, nested)} == {"sensitive_key"}


def test_oversized_file_is_not_parsed(spark):
    df = spark.createDataFrame([("p", 101, bytearray(b"[1]"))], "path string, length bigint, content binary")
    assert payload.payload_file_verdict(df, max_bytes=100).first().verdict == "too_large"


def test_key_scan_and_path(spark):
    texts = [
        '{"a": [1, {"Session-Token": 2}], "password": 3}', '{"note": "the \\"password\\": none"}', '{"x": "cookie"}',
        '{"x\\"cookie\\"y": 1}', '{"p\\u0061ssword": 1}', "not json cookie:", '["cookie"]',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    hits = {r.i: (r.sensitive_keys, r.key_path) for r in payload.sensitive_key_scan(df, "t", with_path=True).collect()}
    assert set(hits) == {0, 3, 4}
    assert sorted(hits[0][0]) == ["Session-Token", "password"] and hits[0][1] == "$.a[1].Session-Token"
    assert hits[4] == (["password"], "$.password")
    inventory = {r.key: (r.records, r.sensitive) for r in payload.key_inventory(df, "t").collect()}
    assert inventory["Session-Token"] == (1, True) and inventory["password"] == (2, True)
    assert inventory["x"] == (1, False) and inventory["a"] == (1, False)


def test_checksum_ignores_order_and_layout_but_counts_copies(spark):
    def checksum(texts, partitions=1):
        df = spark.createDataFrame([("b", t) for t in texts], "batch string, t string").repartition(partitions)
        return payload.batch_checksum(df, "t", ["batch"]).first()

    base = checksum(['{"a": 1, "b": [1, 2]}', '{"c": 3}'])
    assert base.record_count == 2 and len(base.checksum) == 64
    assert checksum(['{"c":3}', '{"b":[1,2],"a":1}'], 3) == base
    assert checksum(['{"c":3}', '{"b":[2,1],"a":1}']).checksum != base.checksum
    assert checksum(['{"c":3}', '{"c":3}', '{"b":[1,2],"a":1}']).checksum != base.checksum
    assert checksum(['{"c":3} x', '{"b":[1,2],"a":1}']).checksum != base.checksum


def test_decisions(spark):
    incoming = spark.createDataFrame([("new", "1"), ("same", "2"), ("other", "3")], "batch string, checksum string")
    stored = spark.createDataFrame([("same", "2"), ("other", "9"), ("gone", "1")], "batch string, checksum string")

    def decide(**options):
        return {r.batch: r.status for r in payload.payload_decision(incoming, stored, ["batch"], **options).collect()}

    assert decide() == {"new": "UPLOADED", "same": "SKIPPED_IDENTICAL", "other": "CONFLICT"}
    assert decide(allow_new_version=True) == {"new": "UPLOADED", "same": "SKIPPED_IDENTICAL", "other": "UPLOADED"}


def test_repeated_escaped_and_broken_keys_are_seen(spark):
    texts = [
        '{"password":1,"password":2}', '{"password":1,"a":1,"a":2}', r'{"pass\u0077ord": 1}', 'not json {"Cookie" : 1', '{"a": "password: x"}',
        '[{"b": {"Session-Token": 1}}]', None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    hits = {r.i: (r.sensitive_keys, r.key_path) for r in payload.sensitive_key_scan(df, "json", with_path=True).collect()}
    assert set(hits) == {0, 1, 2, 3, 5}
    assert hits[0] == (["password", "password"], "$.password") and hits[2] == (["password"], "$.password")
    assert hits[3] == (["Cookie"], None) and hits[5][1] == "$[0].b.Session-Token"


def test_long_values_in_a_stored_table(spark, tmp_path):
    """Repeated groups must not recurse: 100,000 characters, read back from files."""
    long = "x\\\"y" * 25_000
    rows = [(json.dumps({"note": long, "password": 1}), "1," * 50_000 + "2 USD"), (long, long)]
    spark.createDataFrame(rows, "json string, salary string").write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert [r.sensitive_keys for r in payload.sensitive_key_scan(stored, "json").collect()] == [["password"]]
    assert payload.key_inventory(stored, "json").count() == 2
    files = stored.select(F.lit("p").alias("path"), F.length("json").cast("bigint").alias("length"), F.col("json").cast("binary").alias("content"))
    assert {r.verdict for r in payload.payload_file_verdict(files).collect()} == {"not_array", "invalid_json"}
    for dialect in ("posted", "folded"):
        assert with_salary(stored, "salary", dialect).count() == 2
        with_salary(stored, "salary", dialect).write.format("noop").mode("overwrite").save()


def test_numbers_out_of_range_differ(spark):
    sums = [payload.batch_checksum(spark.createDataFrame([("b", j)], "b string, j string"), "j", ["b"]).first().checksum
            for j in ('{"a": 1e400}', '{"a": 2e400}', '{"a": "Infinity"}', '{"a":1}', '{ "a": 1 }')]
    assert len(set(sums)) == 4 and sums[3] == sums[4]


def first_path_of(text):
    """Where the first sensitive key stands, from a parsed text walked in order."""

    def walk(path, value):
        if isinstance(value, tuple):
            for key, below in value[0]:
                if any(f in key.lower().replace("-", "_") for f in payload.SENSITIVE_KEY_FRAGMENTS):
                    return f"{path}.{key}"
                found = walk(f"{path}.{key}", below)
                if found:
                    return found
        elif isinstance(value, list):
            for n, below in enumerate(value):
                found = walk(f"{path}[{n}]", below)
                if found:
                    return found
        return None

    return walk("$", json.loads(text, object_pairs_hook=lambda pairs: (pairs,)))


def test_paths_as_walked(spark):
    rng = random.Random(3)
    keys = ["a", "b c", "x.y", "Pass-word", "password", "COOKIES", "q\"uote", "Session-Token", "é", "k"]

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 4:
            return rng.choice([1, -2.5, None, True, "", "password", 'say "cookie": {', "[1,{", "\\", "end\\"])
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(keys): value(depth - 1) for _ in range(rng.randrange(4))}

    texts = [json.dumps(value(5), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) for _ in range(400)]
    texts += ['{"a":1,"a":{"password":1}}', "[[[[{}]],[[{\"cookie\":[]}]]]]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    hits = payload.sensitive_key_scan(df, "t", with_path=True)
    assert "Python" not in hits._jdf.queryExecution().executedPlan().toString()
    found = {r.i: r.key_path for r in hits.collect()}
    assert found == {i: p for i, p in ((i, first_path_of(t)) for i, t in enumerate(texts)) if p}
    assert len(found) > 50
    broken = spark.createDataFrame([(0, '{"cookie": 1'), (1, '{"cookie": 1} x'), (2, '{"cookie": 1}, {"a": 2}'), (3, '1] , ["cookie"')], "i int, t string")
    assert {r.key_path for r in payload.sensitive_key_scan(broken, "t", with_path=True).collect()} == {None}


def test_one_parse_per_record(spark, tmp_path):
    spark.createDataFrame([('{"a":1}',)], "j string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for one in (payload.payload_contract(df.withColumn("b", F.lit("b")), "j", ["b"]), df.select(payload.record_verdict(F.col("j")))):
        plan = one._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1
        assert not any(w in plan for w in ("json_array_length", "lengthOfJsonArray", "json_object_keys", "jsonObjectKeys"))
