"""Golden values of the two salary dialects."""

import pytest
from pyspark.sql import functions as F

from rolecall.functions import salary

FOLDED = [
    ("$1,500 - $3,000", 1500.0, 3000.0, "USD"),
    ("20,000,000 - 35,000,000 VND", 20e6, 35e6, "VND"),
    ("20 - 35 triệu", 20e6, 35e6, "VND"),
    ("Up to $2,000", None, 2000.0, "USD"),
    ("From $1,000", 1000.0, None, "USD"),
    ("Thỏa thuận", None, None, "UNKNOWN"),
    ("Login to view", None, None, "UNKNOWN"),
    (None, None, None, "UNKNOWN"),
    ("", None, None, "UNKNOWN"),
    ("35 - 20 triệu", 20e6, 35e6, "VND"),
    ("1.5 - 2 tr", 1.5e6, 2e6, "VND"),
    ("Lên đến 30 triệu", None, 30e6, "VND"),
    ("Từ 10 triệu", 10e6, None, "VND"),
    ("20 nghìn vnd", 20e3, 20e3, "VND"),
    ("15k", 15.0, 15.0, "UNKNOWN"),
    ("1.000.000,50 - 7 usd", 7.0, 7.0, "USD"),
    ("USD", None, None, "USD"),
    ("you'll love it $1", None, None, "UNKNOWN"),
    ("２０ triệu", 20e6, 20e6, "VND"),
    ("٢٠ vnd", 20.0, 20.0, "VND"),
]

POSTED = [
    ("1,500 - 3,000 USD", 1500.0, 3000.0, "USD"),
    ("$1,500 - $3,000", 1500.0, 1500.0, "USD"),
    ("1500 - 3000 USD", 150.0, 300.0, "USD"),
    ("20.5 - 30 tr", 205e6, 30e6, "VND"),
    ("1.5 - 2 triệu", 15e6, 2e6, "VND"),
    ("From $1,000", 1000.0, 1000.0, "USD"),
    ("Up to $2,000", None, 2000.0, "USD"),
    ("20 - 35 triệu", 20e6, 35e6, "VND"),
    ("15k", 15e3, 15e3, "VND"),
    ("0 - 0 USD", 0.0, None, "USD"),
    ("16,777,217 VND", 16777216.0, 16777216.0, "VND"),
    ("Thỏa thuận", None, None, "VND"),
    ("Login to view", None, None, "VND"),
    (None, None, None, "VND"),
    ("", None, None, "VND"),
    ("5 trịnh", 5.0, 5.0, "VND"),
]


@pytest.mark.parametrize("dialect,cases", [("folded", FOLDED), ("posted", POSTED)])
def test_salary_texts(spark, dialect, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, salary string")
    out = salary.with_salary(df, "salary", dialect).orderBy("i").collect()
    assert [(r.salary, r.min_salary, r.max_salary, r.currency) for r in out] == cases
    assert set(out[0].asDict()) == {"i", "salary", "min_salary", "max_salary", "currency"}


def test_number_tokens(spark):
    cases = [
        ("1,500", 1500.0), ("20,000,000", 20e6), ("20.000.000", 20e6), ("1.5", 1.5), ("1,5", 1.5), ("1.500", 1500.0),
        ("1,500.25", 1500.25), ("20.000.000,50", None), ("1234,567", 1234.567), ("42", 42.0), ("", None), (None, None),
        (" 7 ", 7.0), ("abc", None), ("1d", None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    out = df.orderBy("i").select("t", salary.number_token(F.col("t"))).collect()
    assert [tuple(r) for r in out] == cases


def test_unknown_dialect(spark):
    with pytest.raises(ValueError):
        salary.with_salary(spark.range(1).select(F.lit("1").alias("salary")), "salary", "other")


def test_range_and_alert_flags(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, "USD"), (2.0, 1.0, "USD"), (-1.0, None, "USD"), (None, None, "VND"), (1000.0, None, "USD"),
         (20e6, None, "VND"), (19e6, None, "VND"), (None, 5000.0, "USD")],
        "low double, high double, currency string",
    )
    low, high = F.col("low"), F.col("high")
    out = df.select(salary.salary_range_valid(low, high), F.coalesce(salary.is_high_salary(low, F.col("currency")), F.lit(False))).collect()
    assert [r[0] for r in out] == [True, False, False, True, True, True, True, True]
    assert [r[1] for r in out] == [False, False, False, False, True, True, False, False]


def test_a_filter_on_parsed_columns_does_not_parse_again(spark, tmp_path):
    spark.createDataFrame([("1 - 2 USD",)], "salary string").write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    for dialect, extractions in (("posted", 2), ("folded", 1)):
        parsed = salary.with_salary(stored, "salary", dialect)
        hits = parsed.filter(salary.is_high_salary(F.col("min_salary"), F.col("currency")))
        assert hits._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == extractions
