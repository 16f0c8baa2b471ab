"""Rules, summaries, filters and gates."""

import pytest
from pyspark.sql import functions as F

from rolecall.operators import filters, quality, schema

DDL = "title string, url string, source string, company string, salary string"
ROWS = [
    ("Data Engineer", "https://a.test/1", "itviec", "A", "1"), ("DE", "http://a.test/2", "topcv", "", None),
    (None, "https://a.test/3", "itviec", None, ""), ("Long enough", "ftp://a.test", "topcv", "B", "2"),
    ("No url", None, "itviec", "B", "2"), ("Twice", "https://a.test/1", None, "B", "2"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, DDL)


def test_clean_and_dirty_split_the_input(raw, rows_of):
    clean, dirty = filters.clean_rows(raw), filters.dirty_rows(raw)
    assert rows_of(clean.unionByName(dirty)) == rows_of(raw)
    assert clean.count() == 2
    flagged = filters.with_reject_reasons(raw)
    assert rows_of(flagged.filter(F.size("reject_reasons") == 0).drop("reject_reasons")) == rows_of(clean)
    assert {tuple(r.reject_reasons) for r in flagged.collect()} == {
        (), ("title_missing",), ("url_not_http",), ("url_missing",), ("source_missing",),
    }


def test_rules(raw):
    rules = quality.bronze_suite() + [quality.expect_unique("url"), quality.expect_in_set("source", ("itviec", "topcv"))]
    results = {(r.rule, r.column): r for r in quality.run_rules(raw, rules).collect()}
    assert results["not_null", "title"].failed == 1 and not results["not_null", "title"].passed
    matched = results["match_regex", "url"]
    assert (matched.evaluated, matched.failed, matched.passed) == (5, 1, False) and matched.ratio == 0.8
    assert results["length_between", "title"].failed == 1
    assert results["unique", "url"].failed == 1
    assert results["in_set", "source"].passed
    assert not quality.suite_success(quality.run_rules(raw, rules)).first().success


def test_rules_on_nothing(raw):
    empty = raw.limit(0)
    assert all(r.passed and r.evaluated == 0 for r in quality.run_rules(empty, quality.bronze_suite()).collect())
    summary = quality.clean_dirty_summary(empty).first()
    assert (summary.total, summary.clean_pct) == (0, None)


def test_summaries(raw):
    s = quality.clean_dirty_summary(raw).first()
    assert (s.total, s.clean, s.dirty, s.clean_pct, s.dirty_pct) == (6, 2, 4, 33.3, 66.7)
    m = quality.quality_metrics(raw).first()
    assert (m.valid_records, m.invalid_records, m.duplicate_url_count) == (2, 4, 1)
    assert (m.missing_title_count, m.missing_company_count, m.missing_salary_count) == (1, 2, 2)
    assert m.quality_score == pytest.approx(2 / 6)


def test_gates(raw):
    assert quality.require_columns(raw, ("title", "url")) is raw
    with pytest.raises(quality.QualityError, match="CODE: nothing"):
        quality.require_columns(raw, ("title", "nothing"), "CODE")
    with pytest.raises(quality.QualityError):
        quality.require_rows(raw.limit(0))
    quality.require_sources(raw, ("itviec", "topcv"))
    with pytest.raises(quality.QualityError, match="absent"):
        quality.require_sources(raw, ("itviec", "absent"))
    quality.require_sources(raw, ("itviec", "absent"), require_all=False)
    with pytest.raises(quality.QualityError):
        quality.require_sources(raw, ("absent",), require_all=False)
    counts = {r.source: (r.row_count, r.present) for r in quality.expected_sources(raw, ("itviec", "absent")).collect()}
    assert counts == {"itviec": (3, True), "absent": (0, False)}


def test_reconciliation(raw):
    r = quality.row_reconciliation(raw, raw, ["source", "url"]).first()
    assert (r.rows_before, r.rows_after, r.matches) == (6, 4, False)
    removed = quality.removed_rows(raw, filters.clean_rows(raw)).first()
    assert (removed.rows_in, removed.rows_out, removed.rows_removed) == (6, 2, 4)


def test_schema_guard_and_flatten(spark):
    partial = spark.createDataFrame([("t", ["a", "b"])], "title string, tags array<string>")
    full = schema.tags_to_json(schema.schema_guard(partial))
    assert set(full.columns) == set(schema.LISTING_COLUMNS) and full.first().tags == '["a","b"]'
    record = "array<struct<title:string,url:string,tags:array<string>>>"
    mixed = spark.createDataFrame(
        [
            ("itviec", 2, [("A", "u1", ["x"]), ("B", "u2", None)], None, None, None), ("itviec", 0, [], None, None, None),
            ("itviec", 5, None, None, None, None), ("topcv", None, None, "C", "u3", ["y"]),
        ],
        f"source string, total bigint, jobs {record}, title string, url string, tags array<string>",
    )
    out = schema.flatten_envelope(mixed).orderBy("title").collect()
    assert [(r.source, r.title, r.url, r.tags) for r in out] == [
        ("itviec", "A", "u1", '["x"]'), ("itviec", "B", "u2", None), ("topcv", "C", "u3", '["y"]'),
    ]
