"""Schema completion, flattening, projection and batch stamps."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from rolecall.functions.salary import has_salary, with_salary
from rolecall.functions.location import with_location
from rolecall.functions.text import search_text

LISTING_COLUMNS = (
    "title", "url", "source", "keyword", "company", "location", "work_type", "salary", "tags", "posted",
)
SILVER_COLUMNS = (
    "title", "url", "source", "keyword", "company", "work_type", "salary_raw", "tags", "posted",
    "min_salary", "max_salary", "currency", "location_std",
)


def schema_guard(df: DataFrame, expected=LISTING_COLUMNS, data_type=StringType()) -> DataFrame:
    """Add each missing column as a typed NULL, in one projection. ``expected``
    is a sequence of names or a mapping of name to type."""
    types = expected if isinstance(expected, dict) else dict.fromkeys(expected, data_type)
    missing = [F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in df.columns]
    return df.select("*", *missing)


def flatten_envelope(df: DataFrame, items: str = "jobs", envelope_field: str = "source", marker: str = "total") -> DataFrame:
    """One row per listing from envelopes, flat rows, or a mix of both.

    An envelope row yields its array's records with the envelope's own source; an
    empty or missing array yields none. A row without an array and without the
    envelope's ``marker`` is itself a listing and passes through. Columns that do
    not belong to a listing or an envelope (file lineage) are kept.
    """
    if items not in df.columns:
        return tags_to_json(df)
    record = df.schema[items].dataType.elementType
    names = [f.name for f in record.fields]
    own = F.struct(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in record.fields
    ])
    is_flat = F.col(items).isNull()
    if marker in df.columns:
        is_flat = is_flat & F.col(marker).isNull()
    envelope_only = {items, marker, "keywords"}
    lineage = [c for c in df.columns if c not in names and c not in envelope_only and c != envelope_field]
    rows = df.withColumn("_item", F.explode(F.when(is_flat, F.array(own)).otherwise(F.col(items))))
    source = F.col(envelope_field)
    if envelope_field in names:
        source = F.coalesce(source, F.col(f"_item.{envelope_field}"))
    fields = [F.col(f"_item.{n}").alias(n) for n in names if n != envelope_field]
    return tags_to_json(rows.select(source.alias(envelope_field), *fields, *lineage))


def tags_to_json(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Array tags become JSON text; text tags and NULLs stay as they are."""
    if tags in df.columns and isinstance(df.schema[tags].dataType, ArrayType):
        return df.withColumn(tags, F.to_json(tags))
    return df


def silver_projection(df: DataFrame, trim_keys: bool = False, processed_at=None, keep=()) -> DataFrame:
    """The Silver column list in order; ``trim_keys`` cuts blanks of title and url,
    ``processed_at`` (a timestamp or its text) adds that column, and the columns named
    in ``keep`` follow."""
    def column(name: str):
        if name == "salary_raw":
            return F.col("salary").alias("salary_raw")
        if trim_keys and name in ("title", "url"):
            return F.trim(name).alias(name)
        return F.col(name)

    stamp = [] if processed_at is None else [F.lit(processed_at).cast("timestamp").alias("processed_at")]
    return df.select(*[column(c) for c in SILVER_COLUMNS], *stamp, *keep)


def batch_stamp(df: DataFrame, batch_date: str, clock: str | None = None) -> DataFrame:
    """Literal ``batch_date`` and ``report_date``; ``clock`` names an optional
    processing-time column."""
    stamped = df.withColumns({"batch_date": F.lit(batch_date), "report_date": F.to_date(F.lit(batch_date))})
    return stamped.withColumn(clock, F.current_timestamp()) if clock else stamped


def with_has_salary(df: DataFrame) -> DataFrame:
    return df.withColumn("has_salary", has_salary(F.col("min_salary"), F.col("max_salary")))


def with_search_text(df: DataFrame, out: str = "search_text") -> DataFrame:
    return df.withColumn(out, search_text(F.col("title"), F.col("tags")))


def drop_helper_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop helper or path-carried columns; absent names are ignored."""
    return df.drop(*names)


def normalise_listings(df: DataFrame, salary_dialect: str, location_dialect: str, trim_keys: bool = False, keep=()) -> DataFrame:
    """Raw listings to Silver columns (not yet deduplicated), and those in ``keep``."""
    guarded = tags_to_json(schema_guard(df))
    parsed = with_location(with_salary(guarded, "salary", salary_dialect), "location", location_dialect)
    return silver_projection(parsed, trim_keys, keep=keep)
