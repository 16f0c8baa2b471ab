"""Row predicates. Each takes a DataFrame and returns the kept rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rolecall.functions.salary import ALERT_THRESHOLDS, is_high_salary

URL_PATTERN = r"^https?://.*"


def is_clean(required=("title", "url", "source"), url: str = "url") -> Column:
    """TRUE or FALSE, never NULL: required columns present and an http(s) url."""
    present = [F.col(c).isNotNull() for c in required]
    return F.coalesce(reduce(lambda a, b: a & b, present) & F.col(url).rlike(URL_PATTERN), F.lit(False))


def with_reject_reasons(df: DataFrame, required=("title", "url", "source"), url: str = "url") -> DataFrame:
    """One pass over the input: ``reject_reasons`` is empty exactly on clean rows."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c}_missing")) for c in required]
    checks.append(F.when(~F.col(url).rlike(URL_PATTERN), F.lit(f"{url}_not_http")))
    return df.withColumn("reject_reasons", F.array_compact(F.array(*checks)))


def clean_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_clean())


def dirty_rows(df: DataFrame) -> DataFrame:
    """Exactly the rows ``clean_rows`` leaves out."""
    return df.filter(~is_clean())


def nonblank_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are neither NULL nor blank."""
    return df.filter(reduce(lambda a, b: a & b, [F.length(F.trim(k)) > 0 for k in keys or ("title", "url")]))


def source_filter(df: DataFrame, source: str) -> DataFrame:
    return df.filter(F.col("source") == source)


def salary_present(df: DataFrame, either_end: bool = True) -> DataFrame:
    """Rows with a salary; ``either_end=False`` asks for the lower end."""
    low = F.col("min_salary").isNotNull()
    return df.filter(low | F.col("max_salary").isNotNull() if either_end else low)


def company_present(df: DataFrame) -> DataFrame:
    """Company not NULL; an empty text counts as present."""
    return df.filter(F.col("company").isNotNull())


def high_salary(df: DataFrame, thresholds: dict = ALERT_THRESHOLDS) -> DataFrame:
    return df.filter(is_high_salary(F.col("min_salary"), F.col("currency"), thresholds))


def report_date_is(df: DataFrame, report_date: str) -> DataFrame:
    return df.filter(F.col("report_date") == F.to_date(F.lit(report_date)))
