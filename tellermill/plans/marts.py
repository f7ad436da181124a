"""Column subsets of the curated tables for the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tellermill import schema


def mart(table: str, df: DataFrame) -> DataFrame:
    """The columns the warehouse keeps, in its order; other tables go whole."""
    keep = schema.MART_COLUMNS.get(table)
    return df.select(*[c for c in keep if c in df.columns]) if keep else df
