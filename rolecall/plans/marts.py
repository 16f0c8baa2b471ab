"""Analytical marts over Silver listings. ``report_date`` is always an argument."""

from pyspark.sql import DataFrame, functions as F

from rolecall.functions.salary import ALERT_THRESHOLDS, has_salary
from rolecall.functions.skills import SKILLS, matched_skills
from rolecall.functions.text import search_text
from rolecall.operators.filters import company_present, high_salary, salary_present, source_filter


def prepare(silver: DataFrame, report_date: str) -> DataFrame:
    """Silver with the mart's date and the salary flag."""
    return silver.withColumns({
        "report_date": F.to_date(F.lit(report_date)),
        "has_salary": has_salary(F.col("min_salary"), F.col("max_salary")),
    })


def _jobs_with_salary():
    return F.count_if("has_salary").alias("jobs_with_salary")


def _salary_averages():
    return [
        F.round(F.avg("min_salary"), 2).alias("avg_min_salary"),
        F.round(F.avg("max_salary"), 2).alias("avg_max_salary"),
        F.max("max_salary").alias("highest_salary"),
    ]


#: Fixed: the columns of prepared Silver that the marts read.
READ_COLUMNS = (
    "keyword", "title", "url", "source", "company", "location_std", "work_type", "salary_raw", "min_salary", "max_salary",
    "currency", "tags", "posted", "report_date", "has_salary",
)


def job_market_overview(
    prepared: DataFrame, job_keys=("url",), approximate: bool = False, rows: str | None = None
) -> DataFrame:
    """One row per date. ``job_keys=("source", "url")`` counts jobs per source, with
    a pair that holds a NULL not counted. ``approximate`` trades exact distinct
    counts (which multiply the rows before the shuffle) for sketches. ``rows`` names an
    added count of all rows, for a reconciliation."""
    counted = [F.count(F.lit(1)).alias(rows)] if rows else []
    if approximate:
        pair = F.when(~F.concat(*job_keys).isNull(), F.struct(*job_keys)) if len(job_keys) > 1 else F.col(job_keys[0])
        distinct = lambda *c: F.approx_count_distinct(pair if c == tuple(job_keys) else F.col(c[0]))
    else:
        distinct = F.count_distinct
    return prepared.groupBy("report_date").agg(
        distinct(*job_keys).alias("total_jobs"),
        distinct("company").alias("total_companies"),
        distinct("source").alias("total_sources"),
        distinct("location_std").alias("total_locations"),
        _jobs_with_salary(),
        *counted,
    )


def source_performance(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("source", "report_date").agg(
        F.count_distinct("url").alias("job_count"),
        F.count_distinct("company").alias("company_count"),
        _jobs_with_salary(),
    )


def salary_by_location(prepared: DataFrame) -> DataFrame:
    return salary_present(prepared).groupBy("location_std", "source", "currency", "report_date").agg(
        F.count_distinct("url").alias("job_count"), *_salary_averages()
    )


def location_summary(prepared: DataFrame) -> DataFrame:
    """As ``salary_by_location`` over all listings, with the number that have a salary."""
    return prepared.groupBy("location_std", "source", "currency", "report_date").agg(
        F.count_distinct("url").alias("job_count"), _jobs_with_salary(), *_salary_averages()
    )


def company_hiring_trend(prepared: DataFrame) -> DataFrame:
    return company_present(prepared).groupBy("company", "source", "location_std", "report_date").agg(
        F.count_distinct("url").alias("job_count"), F.max("max_salary").alias("highest_salary")
    )


def skill_rows(prepared: DataFrame, skills=SKILLS, whole_words: bool = False) -> DataFrame:
    """One row per listing and skill found in its title or tags, in one pass."""
    text = prepared.withColumn("_text", search_text(F.col("title"), F.col("tags")))
    labels = matched_skills(F.col("_text"), skills, whole_words)
    return text.select(F.explode(labels).alias("skill"), "source", "location_std", "url", "report_date")


def skill_demand(prepared: DataFrame, skills=SKILLS, whole_words: bool = False) -> DataFrame:
    return skill_rows(prepared, skills, whole_words).groupBy("skill", "source", "location_std", "report_date").agg(
        F.count_distinct("url").alias("job_count")
    )


# The column lists of the listing marts, here and below.
def high_salary_alerts(prepared: DataFrame, thresholds: dict = ALERT_THRESHOLDS) -> DataFrame:
    return high_salary(prepared, thresholds).select(
        "title", "company", "url", "source", "location_std", "salary_raw", "min_salary", "max_salary", "currency",
        "report_date",
    )


def pipeline_health(silver: DataFrame, report_date: str, name: str = "gold_aggregation", status: str = "success") -> DataFrame:
    """One row per run: how many Silver rows went in."""
    return silver.agg(F.count(F.lit(1)).alias("records_in")).select(
        F.lit(name).alias("pipeline_name"), F.lit(status).alias("status"), "records_in",
        F.to_date(F.lit(report_date)).alias("report_date"),
    )


# ---- marts with the older column lists ------------------------------------

def source_jobs(prepared: DataFrame, source: str) -> DataFrame:
    """Listings of one source in the serving column list."""
    return source_filter(prepared, source).select(
        "keyword", "title", "url", "company", F.col("location_std").alias("location"), "work_type",
        F.col("salary_raw").alias("salary"), "tags", "posted", "report_date",
    )


def market_summary(prepared: DataFrame) -> DataFrame:
    """Listings with a lower salary end; ``total_jobs`` counts rows with a url."""
    return salary_present(prepared, either_end=False).groupBy("location_std", "currency", "report_date").agg(
        F.count("url").alias("total_jobs"), *_salary_averages()
    )


def source_stats(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("source", "report_date").agg(F.count("url").alias("jobs_count"))


def daily_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select("title", "url", "min_salary", "max_salary", "currency", "source", "location_std", "report_date")


# Name -> (builder over prepared Silver, merge keys), built in this order.
def gold_marts(prepared: DataFrame, silver: DataFrame, report_date: str, listing_source: str) -> dict:
    alerts = high_salary_alerts(prepared)
    return {
        "mart_job_market_overview": (job_market_overview(prepared), ["report_date"]),
        "mart_source_performance": (source_performance(prepared), ["source", "report_date"]),
        "mart_salary_by_location": (salary_by_location(prepared), ["location_std", "source", "currency", "report_date"]),
        "mart_company_hiring_trend": (company_hiring_trend(prepared), ["company", "source", "location_std", "report_date"]),
        "mart_skill_demand": (skill_demand(prepared), ["skill", "source", "location_std", "report_date"]),
        "mart_high_salary_alerts": (alerts, ["url", "report_date"]),
        "mart_pipeline_health": (pipeline_health(silver, report_date), ["pipeline_name", "report_date"]),
        f"{listing_source}_jobs": (source_jobs(prepared, listing_source), ["url", "report_date"]),
        "market_summary": (market_summary(prepared), ["location_std", "currency", "report_date"]),
        "source_stats": (source_stats(prepared), ["source", "report_date"]),
        "daily_alerts": (daily_alerts(alerts), ["url", "report_date"]),
    }
