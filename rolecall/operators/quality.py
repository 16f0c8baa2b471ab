"""Data-quality rules, summaries and gates.

A rule is a pair of aggregates (evaluated rows, failed rows), so any number of
rules runs in one pass over the data.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rolecall.functions.salary import is_high_salary, salary_range_valid

from .filters import is_clean


class QualityError(RuntimeError):
    """A gate did not hold."""


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    evaluated: Column
    failed: Column
    mostly: float = 1.0


def expect_not_null(column: str) -> Rule:
    return Rule("not_null", column, F.count(F.lit(1)), F.count_if(F.col(column).isNull()))


def expect_match(column: str, pattern: str, mostly: float = 1.0) -> Rule:
    return Rule("match_regex", column, F.count(column), F.count_if(~F.col(column).rlike(pattern)), mostly)


def expect_length(column: str, least: int, most: int, mostly: float = 1.0) -> Rule:
    return Rule("length_between", column, F.count(column), F.count_if(~F.length(column).between(least, most)), mostly)


def expect_in_set(column: str, values, mostly: float = 1.0) -> Rule:
    return Rule("in_set", column, F.count(column), F.count_if(~F.col(column).isin(*values)), mostly)


def expect_at_least(column: str, least: float, mostly: float = 1.0) -> Rule:
    return Rule("at_least", column, F.count(column), F.count_if(F.col(column) < least), mostly)


def expect_unique(column: str) -> Rule:
    """Failed counts the surplus rows: non-NULL values minus distinct values."""
    return Rule("unique", column, F.count(column), F.count(column) - F.count_distinct(column))


def expect_ordered(low: str, high: str) -> Rule:
    """``high >= low`` wherever both are present."""
    both = F.col(low).isNotNull() & F.col(high).isNotNull()
    return Rule("pair_ordered", f"{low},{high}", F.count_if(both), F.count_if(F.col(high) < F.col(low)))


def bronze_suite() -> list[Rule]:
    # The thresholds of the raw-listing checkpoint.
    return [
        expect_not_null("title"),
        expect_not_null("url"),
        expect_not_null("source"),
        expect_match("url", r"^https?://.*", 0.95),
        expect_length("title", 5, 200, 0.98),
    ]


def rule_aggregates(rules: list[Rule]) -> list[Column]:
    """Two aggregates per rule, for ``agg`` or for ``observe`` during a write (where
    no distinct counts, hence no unique rules, are allowed)."""
    pairs = [(r.evaluated.alias(f"e{i}"), r.failed.alias(f"f{i}")) for i, r in enumerate(rules)]
    return [column for pair in pairs for column in pair]


def rule_results(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The one row of ``rule_aggregates`` as one row per rule: rule, column,
    evaluated, failed, ratio, threshold, passed. A rule with nothing to evaluate
    passes with a NULL ratio."""
    tidy = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
            F.col(f"e{i}").alias("evaluated"), F.col(f"f{i}").alias("failed"),
            F.lit(r.mostly).alias("threshold"),
        )
        for i, r in enumerate(rules)
    ])
    ratio = F.try_divide(F.col("evaluated") - F.col("failed"), F.col("evaluated"))
    return (
        counts.select(F.inline(tidy))
        .withColumn("ratio", ratio)
        .withColumn("passed", F.coalesce(F.col("ratio") >= F.col("threshold"), F.lit(True)))
        .select("rule", "column", "evaluated", "failed", "ratio", "threshold", "passed")
    )


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules in one pass over the data."""
    return rule_results(df.agg(*rule_aggregates(rules)), rules)


def suite_success(results: DataFrame) -> DataFrame:
    return results.agg(F.every("passed").alias("success"))


def clean_dirty_summary(df: DataFrame) -> DataFrame:
    """Totals and percentages of clean and dirty rows; NULL percentages on empty input."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(is_clean()).alias("clean"))
    return counts.withColumn("dirty", F.col("total") - F.col("clean")).withColumns({
        "clean_pct": F.round(F.try_divide(100.0 * F.col("clean"), F.col("total")), 1),
        "dirty_pct": F.round(F.try_divide(100.0 * F.col("dirty"), F.col("total")), 1),
    })


def quality_metrics(df: DataFrame) -> DataFrame:
    """One row of monitoring counts; ``quality_score`` is valid / total rows."""
    missing = lambda c: F.count_if(F.col(c).isNull() | (F.trim(c) == ""))
    return (
        df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(is_clean()).alias("valid_records"),
            F.count_if(~is_clean()).alias("invalid_records"),
            (F.count("url") - F.count_distinct("url")).alias("duplicate_url_count"),
            missing("title").alias("missing_title_count"),
            missing("company").alias("missing_company_count"),
            missing("salary").alias("missing_salary_count"),
        )
        .withColumn("quality_score", F.try_divide("valid_records", "total_records"))
    )


def gold_checks(overview: DataFrame, sources: DataFrame, alerts: DataFrame, health: DataFrame, thresholds: dict) -> DataFrame:
    """One row per mart check: check, checked rows, failed rows, passed."""
    def check(df: DataFrame, name: str, holds: Column, needs_rows: bool) -> DataFrame:
        counts = df.agg(
            F.count(F.lit(1)).alias("checked"), F.count_if(~F.coalesce(holds, F.lit(False))).alias("failed")
        )
        passed = F.col("failed") == 0
        if needs_rows:
            passed = passed & (F.col("checked") > 0)
        return counts.select(F.lit(name).alias("check"), "checked", "failed", passed.alias("passed"))

    parts = [
        check(overview, "overview_total_jobs_positive", F.col("total_jobs") > 0, True),
        check(sources, "source_job_count_positive", F.col("job_count") > 0, True),
        check(alerts, "alert_thresholds_hold", is_high_salary(F.col("min_salary"), F.col("currency"), thresholds), False),
        check(health, "run_status_known", F.col("status").isin("success", "failed"), True),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_salary_range_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("range_valid", salary_range_valid(F.col("min_salary"), F.col("max_salary")))


# ---- gates ----------------------------------------------------------------

def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("row_count"))


def expected_sources(df: DataFrame, expected, source: str = "source") -> DataFrame:
    """Row count and presence of each expected source (absent ones count 0)."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(s,) for s in expected], f"{source} string")
    counted = wanted.join(source_counts(df.filter(F.col(source).isin(*expected)), source), source, "left_outer")
    rows = F.coalesce("row_count", F.lit(0))
    return counted.select(source, rows.alias("row_count"), (rows > 0).alias("present"))


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns side by side in one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def row_reconciliation(before: DataFrame, after: DataFrame, distinct_keys=None) -> DataFrame:
    """Rows (or distinct non-NULL keys) on both sides and whether they agree.
    To be asked before publishing, not after."""
    counted = F.count_distinct(*distinct_keys) if distinct_keys else F.count(F.lit(1))
    both = one_row(before.agg(F.count(F.lit(1)).alias("rows_before")), after.agg(counted.alias("rows_after")))
    return both.withColumn("matches", F.col("rows_before") == F.col("rows_after"))


def removed_rows(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """How many rows a step removed as duplicate or invalid."""
    counts = row_reconciliation(raw, kept)
    return counts.select(
        F.col("rows_before").alias("rows_in"), F.col("rows_after").alias("rows_out"),
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
    )


def require_columns(df: DataFrame, columns, code: str = "REQUIRED_COLUMNS_MISSING") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{code}: {','.join(missing)}")
    return df


def require_rows(df: DataFrame, code: str = "EMPTY_INPUT") -> DataFrame:
    """Fails on an empty input; reads only until the first row is found."""
    if df.isEmpty():
        raise QualityError(code)
    return df


def require_sources(df: DataFrame, expected, require_all: bool = True, code: str = "SOURCE_MISSING") -> DataFrame:
    """Every expected source has rows (or at least one, when not ``require_all``)."""
    # at most len(expected) rows reach the driver
    missing = [r["source"] for r in expected_sources(df, expected).filter(~F.col("present")).collect()]
    if missing and (require_all or len(missing) == len(expected)):
        raise QualityError(f"{code}: {','.join(sorted(missing))}")
    return df
