"""Queries that chat and dashboard clients ask of the marts."""

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolecall.operators.quality import one_row
from rolecall.storage import names_in


def latest_rows(df: DataFrame, date: str = "report_date") -> DataFrame:
    """Rows of the latest date, through a scalar subquery (one row, broadcast)."""
    return df.sparkSession.sql(
        f"SELECT * FROM {{t}} WHERE {date} = (SELECT max({date}) FROM {{t}})", t=df
    )


def latest_partition(spark: SparkSession, path: str, date: str = "report_date", schema=None) -> DataFrame | None:
    """Rows of the latest date of a table whose folders are ``<date>=...``; None when it
    has none. The date is the greatest folder name, so no row is read to find it, and the
    scan is pruned to its folder by a literal filter. Dates must sort as texts (ISO)."""
    days = [unquote(n.split("=", 1)[1]) for n in names_in(spark, path) if n.startswith(f"{date}=")]
    known = [d for d in days if d != "__HIVE_DEFAULT_PARTITION__"]
    if not known:
        return None
    rows = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    return rows.filter(F.col(date) == F.lit(max(known)).cast(rows.schema[date].dataType))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order: every column breaks remaining ties.
    Planned as take-ordered, so each task sends ``n`` rows."""
    return df.orderBy(*order, *[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)


def latest_listings(jobs: DataFrame, n: int = 5) -> DataFrame:
    return top_n(jobs, [F.col("report_date").desc_nulls_last(), F.col("url").asc_nulls_first()], n)


def listings_by_keyword(jobs: DataFrame, keyword: str | None = None, n: int = 5) -> DataFrame:
    """Latest listings of a search keyword; None asks for all of them."""
    return latest_listings(jobs if keyword is None else jobs.filter(F.col("keyword") == keyword), n)


def top_salary_alerts(alerts: DataFrame, n: int = 5) -> DataFrame:
    latest = latest_rows(alerts).select("title", "min_salary", "max_salary", "currency", "source", "url", "location_std")
    return top_n(latest, [F.col("min_salary").desc_nulls_last()], n)


def source_ranking(stats: DataFrame) -> DataFrame:
    """Sources of the latest date, the one with most jobs first."""
    return latest_rows(stats).select("source", "jobs_count").orderBy(F.desc("jobs_count"), "source")


def market_report(summary: DataFrame) -> DataFrame:
    return summary.select("location_std", "currency", "avg_min_salary", "avg_max_salary", "total_jobs")


def alert_gate(alerts: DataFrame, summary: DataFrame, report_date: str) -> DataFrame:
    """One row: alerts and jobs of a date, and the branch that follows from it."""
    day = F.col("report_date") == F.to_date(F.lit(report_date))
    counted = alerts.filter(day).agg(F.count(F.lit(1)).alias("alert_count"))
    totals = summary.filter(day).agg(F.coalesce(F.sum("total_jobs"), F.lit(0)).alias("total_jobs"))
    return one_row(counted, totals).withColumn(
        "branch", F.when(F.col("alert_count") > 0, "notify").otherwise("skip")
    )


def sample_distinct(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The first ``n`` distinct values, for diagnosis."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first()).limit(n)
