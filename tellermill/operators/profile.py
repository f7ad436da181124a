"""Column profiles: each table is reduced in one pass over all its columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.functions.money import percent
from tellermill.functions.text import blank_to_null
from tellermill.operators.quantiles import long_values, quantiles

# Texts that count as null in the null profile.
NULL_TOKENS = ("", " ", "NULL", "null")

# The percentiles of the numeric profile.
PERCENTILES = {
    "p01": 0.01, "p05": 0.05, "p10": 0.10, "p25": 0.25, "p50": 0.50,
    "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99,
}

HIGH_CARDINALITY = 50

KEYS = ["table_name", "column_name"]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Every blank text becomes null."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank_to_null(F.col(c)) for c in texts})


def _per_column(df: DataFrame, measures: Mapping[str, Sequence[Column]], columns) -> DataFrame:
    """One row per column from a single aggregation over the table.

    ``measures`` maps an output name to one aggregate per column.
    """
    packed = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    *[m[i].alias(name) for name, m in measures.items()],
                )
                for i, c in enumerate(columns)
            ]
        ).alias("columns")
    )
    return packed.select(F.inline("columns"))


def null_profile(tables: Mapping[str, DataFrame], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Null counts of raw text columns that hold any, with the table's summary."""
    parts = []
    for name, df in tables.items():
        absent = [F.col(c).isNull() | F.col(c).isin(*tokens) for c in df.columns]
        part = _per_column(
            df,
            {"nulls": [F.count_if(a) for a in absent], "row_count": [F.count("*")] * len(absent)},
            df.columns,
        )
        parts.append(part.select(F.lit(name).alias("table_name"), "*"))
    # One row per column, so a table's window holds no more rows than it has columns.
    table = Window.partitionBy("table_name")
    profile = (
        union_all(parts)
        .filter(F.col("nulls") > 0)
        .withColumn("null_pct", percent(F.col("nulls"), F.col("row_count")))
        .withColumn("columns_with_nulls", F.count("*").over(table))
        .withColumn("max_null_pct", F.max("null_pct").over(table))
    )
    return profile.select(
        "table_name",
        "column_name",
        "nulls",
        (F.col("row_count") - F.col("nulls")).alias("non_nulls"),
        "null_pct",
        "columns_with_nulls",
        "max_null_pct",
    )


def _as_text(df: DataFrame, name: str) -> Column:
    """A column as text, equal values as equal text."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.DoubleType):
        value = value + F.lit(0.0)  # -0.0 is 0.0
    return value.cast("string").alias(name)


def _value_counts(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """(table_name, column_name, value as text, n) over the named columns.

    All tables share one aggregation; a frequent value is combined on the map side.
    """
    texts = [
        tables[t]
        .select(*[_as_text(tables[t], c) for c in columns[t]])
        .unpivot([], list(columns[t]), "column_name", "value")
        .select(F.lit(t).alias("table_name"), "*")
        for t in columns
    ]
    return union_all(texts).groupBy(*KEYS, "value").agg(F.count("*").alias("n"))


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Type, nulls, distinct values and an example for every column.

    One aggregation by column and value for all tables; a frequent value is combined on the
    map side, and no task holds the distinct values of a column.
    """
    spark = next(iter(tables.values())).sparkSession
    known = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema]
    columns = spark.createDataFrame(known, "table_name string, column_name string, data_type string")
    value, n = F.col("value"), F.col("n")
    figures = (
        _value_counts(tables, {t: df.columns for t, df in tables.items()})
        .groupBy(*KEYS)
        .agg(
            F.sum(F.when(value.isNotNull(), n).otherwise(0)).alias("non_null"),
            F.sum(F.when(value.isNull(), n).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.min("value").alias("example"),
        )
    )
    # A table without rows has no values to count, but its columns are listed.
    found = columns.join(figures, KEYS, "left").fillna(0, ["non_null", "nulls", "distinct_values"])
    return found.select(
        *KEYS,
        "data_type",
        "non_null",
        "nulls",
        percent(F.col("nulls"), F.col("non_null") + F.col("nulls")).alias("null_pct"),
        "distinct_values",
        "example",
    )


def _categories(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    return _value_counts(tables, columns).filter(F.col("value").isNotNull())


def value_shares(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Count and share of total of every category value."""
    counts = _categories(tables, columns)
    totals = counts.groupBy(*KEYS).agg(F.sum("n").alias("total"))
    return counts.join(totals, KEYS).select(
        *KEYS, "value", "n", percent(F.col("n"), F.col("total"), 4).alias("pct")
    )


def cardinality_alerts(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Sequence[str]],
    high: int = HIGH_CARDINALITY,
) -> DataFrame:
    """Distinct values per category column, with a warning for one or too many."""
    distinct = F.col("distinct_values")
    return (
        _categories(tables, columns)
        .groupBy(*KEYS)
        .agg(F.count("*").alias("distinct_values"))
        .withColumn(
            "alert",
            F.when(distinct == 1, "single value").when(distinct > high, "high cardinality").otherwise("ok"),
        )
    )


def numeric_values(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """(table_name, column_name, value) over the numeric columns of several tables."""
    return union_all(
        [
            long_values(tables[t], columns[t]).select(F.lit(t).alias("table_name"), "*")
            for t in columns
        ]
    )


def numeric_profile(values: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and nine exact percentiles per column."""
    cuts = quantiles(values, KEYS, PERCENTILES)
    basic = values.groupBy(*KEYS).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basic.join(cuts, KEYS)


def numeric_shape(values: DataFrame) -> DataFrame:
    """Range, quartile distance, variation and bias-corrected skew per column."""
    n, skew = F.col("n"), F.col("skew")
    # Third standardised moment to the sample estimate, undefined below three rows.
    corrected = F.when(n > 2, F.col("raw_skew") * F.sqrt(n * (n - 1)) / (n - 2))
    basic = values.groupBy(*KEYS).agg(
        F.count("value").alias("n"),
        (F.max("value") - F.min("value")).alias("value_range"),
        F.try_divide(F.stddev("value"), F.avg("value")).alias("variation"),
        F.skewness("value").alias("raw_skew"),
    )
    quartiles = quantiles(values, KEYS, {"q1": 0.25, "q3": 0.75})
    return (
        basic.join(quartiles, KEYS)
        .withColumn("skew", corrected)
        .select(
            *KEYS,
            "value_range",
            (F.col("q3") - F.col("q1")).alias("iqr"),
            "variation",
            "skew",
            F.coalesce(F.abs(skew) > 1, F.lit(False)).cast("int").alias("is_skewed"),
        )
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round measures whose last digits depend on the order of summation."""
    scale = 10**digits
    rule = "signum(`{0}`) * floor(abs(`{0}`) * {1} + 0.5D) / {1} + 0D"
    return df.withColumns({c: F.expr(rule.format(c, scale)) for c in columns})
