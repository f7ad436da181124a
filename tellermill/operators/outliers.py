"""Outlier flags and outlier summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellermill.functions.money import percent
from tellermill.functions.rules import flag
from tellermill.operators.quantiles import quantile_value, quantiles


def with_outlier_flag(
    df: DataFrame,
    column: str = "amount",
    p: float = 0.95,
    approximate: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """Flag values above a quantile of the whole column.

    The threshold is a scalar subquery: one row, planned lazily with the rest.
    ``source`` names a cheaper frame with the same column to take it from.
    """
    threshold = quantile_value(source or df, column, p, approximate)
    return df.withColumn(f"is_{column}_outlier", flag(F.col(column) > threshold))


def iqr_summary(values: DataFrame, factors: Sequence[float] = (1.5,)) -> DataFrame:
    """Quartiles, fences and what lies outside them, per table, column and factor.

    ``values`` has one row per (table_name, column_name, value). Every factor is
    served by the same quartiles.
    """
    keys = ["table_name", "column_name"]
    iqr = F.col("q3") - F.col("q1")
    fences = (
        quantiles(values, keys, {"q1": 0.25, "q3": 0.75})
        .withColumn("factor", F.explode(F.array(*[F.lit(float(f)) for f in factors])))
        .withColumns(
            {
                "iqr": iqr,
                "lower_bound": F.col("q1") - F.col("factor") * iqr,
                "upper_bound": F.col("q3") + F.col("factor") * iqr,
            }
        )
    )
    value = F.col("value")
    outside = (value < F.col("lower_bound")) | (value > F.col("upper_bound"))
    return (
        # Bounded: one row per profiled column and factor, whatever the tables hold.
        values.join(F.broadcast(fences), keys)
        .groupBy("factor", *keys, "q1", "q3", "iqr", "lower_bound", "upper_bound")
        .agg(
            F.count("*").alias("total_rows"),
            F.count_if(outside).alias("outliers"),
            F.count_if(outside & (value < 0)).alias("negative_outliers"),
            F.min(F.when(outside, value)).alias("min_outlier"),
            F.max(F.when(outside, value)).alias("max_outlier"),
            F.max("value").alias("max_value"),
        )
        .withColumn("outlier_pct", percent(F.col("outliers"), F.col("total_rows")))
    )
