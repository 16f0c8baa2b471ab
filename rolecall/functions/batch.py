"""Batch dates and object keys."""

from pyspark.sql import Column, functions as F


def batch_date_valid(value: Column) -> Column:
    """Strictly ``YYYY-MM-DD`` and a day that exists; NULL is not valid."""
    shaped = value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & (value >= "0001")
    return F.coalesce(shaped & F.try_to_date(value, "yyyy-MM-dd").isNotNull(), F.lit(False))


def resolve_batch_date(batch_date: Column, scheduled_time: Column, execution_id: Column) -> Column:
    """The explicit date, else the day of a scheduled run that names its
    execution, else NULL (an invalid request)."""
    scheduled = F.when(execution_id.isNotNull(), F.split_part(scheduled_time, F.lit("T"), F.lit(1)))
    return F.coalesce(batch_date, scheduled)


def object_key(source: Column, batch_date: Column, layout: str = "partitioned") -> Column:
    """Deterministic key of a source's raw object for one batch."""
    if layout == "partitioned":
        return F.concat(
            F.lit("raw/source="), source, F.lit("/batch_date="), batch_date,
            F.lit("/"), source, F.lit("_jobs.json"),
        )
    if layout == "plain":
        return F.concat(source, F.lit("/"), batch_date, F.lit("/"), source, F.lit("_jobs.json"))
    raise ValueError(f"unknown layout {layout!r}")
