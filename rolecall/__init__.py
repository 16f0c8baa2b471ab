"""Listing-quality, normalisation, dedupe, upsert and mart operators for PySpark.

Every operator is a function over DataFrames (or a Column expression) that takes
its column names as arguments; dates are always arguments, never the clock.
"""
