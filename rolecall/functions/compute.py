"""Costly columns that are evaluated once per row."""

from pyspark.sql import Column, DataFrame, functions as F


def add_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns as the output of a one-row generator.

    A filter on a projected column is pushed below the projection and repeats its
    expression there, once per mention; nested parsing steps multiply. Filters on a
    generator's output stay above it and read the value that is already there.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
