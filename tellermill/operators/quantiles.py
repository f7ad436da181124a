"""Exact quantiles of columns too large for one task.

Spark's exact percentiles gather every distinct value of a group in one task.
Here the values are first counted in narrow logarithmic buckets (a few thousand
per group, combined on the map side). The counts tell which bucket holds each
wanted rank, and only the rows of those buckets are counted by value. Two scans
of the column replace one oversized aggregation buffer, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellermill.operators.nullsafe import same_keys

# Buckets per power of two: each covers about 0.27 % of its magnitude, so the
# distinct money amounts inside one are limited by the money grid.
STEPS = 256
# Shifts every logarithm of a double above zero, keeping the sign for the value's own.
OFFSET = 1 << 19


def value_bucket(c: Column) -> Column:
    """Bucket number of a double; never decreases as the value grows."""
    size = F.floor(F.log2(F.abs(c)) * STEPS) + OFFSET
    return (
        F.when(F.isnan(c), 2 * OFFSET + 1)
        .when(c == float("inf"), 2 * OFFSET)
        .when(c == float("-inf"), -2 * OFFSET)
        .when(c > 0, size)
        .when(c < 0, -size)
        .otherwise(0)
    )


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per value of the named columns: (*keep, column_name, value)."""
    values = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return values.unpivot(list(keep), list(columns), "column_name", "value")


def _wanted(probs: Mapping[str, float], method: str) -> Column:
    """Array of (name, upper, rank, weight): the 1-based ranks each quantile needs."""
    entry = "named_struct('name', '{}', 'upper', {}, 'rank', cast({} as bigint), 'weight', {})"
    wanted = []
    for name, p in probs.items():
        if method == "disc":
            wanted.append(entry.format(name, "false", f"greatest(ceil(total * {p}D), 1)", "0D"))
        else:
            at = f"((total - 1) * {p}D)"
            weight = f"{at} - floor({at})"
            wanted.append(entry.format(name, "false", f"floor({at}) + 1", weight))
            wanted.append(entry.format(name, "true", f"ceil({at}) + 1", weight))
    return F.expr(f"array({', '.join(wanted)})")


def _found(name: str, method: str) -> Column:
    """The value of one quantile from the rows picked for its ranks."""
    part = "max(case when name = '{}' and {} then {} end)"
    low = part.format(name, "not upper", "value")
    if method == "disc":
        return F.expr(low).alias(name)
    high, weight = part.format(name, "upper", "value"), part.format(name, "upper", "weight")
    return F.expr(f"{low} + ({high} - {low}) * {weight}").alias(name)


def quantiles(
    values: DataFrame,
    keys: Sequence[str],
    probs: Mapping[str, float],
    value: str = "value",
    method: str = "cont",
) -> DataFrame:
    """One row per group with a column per quantile.

    ``method`` is ``cont`` (interpolated) or ``disc`` (a value of the column:
    the first whose cumulative share reaches the probability). Nulls are ignored.
    """
    keys = list(keys)
    rows = (
        values.select(*keys, F.col(value).cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
        .withColumn("bucket", value_bucket(F.col("value")))
    )
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    targets = (
        rows.groupBy(*keys, "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
        .withColumn("total", F.sum("n").over(group))
        .withColumn("want", _wanted(probs, method))
        .withColumn(
            "want", F.expr("explode(filter(want, w -> w.rank <= upto and w.rank > upto - n))")
        )
        .select(*keys, "bucket", (F.col("upto") - F.col("n")).alias("below"), "want.*")
    )
    # Only rows of the wanted buckets, a few for each group, are counted by value.
    right = targets.withColumnsRenamed({k: f"_{k}" for k in [*keys, "bucket"]})
    counted = (
        rows.join(right, same_keys(keys, plain=["bucket"]), "left_semi")
        .groupBy(*keys, "bucket", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "bucket").orderBy("value")))
    )
    picked = counted.join(right, same_keys(keys, plain=["bucket"])).filter(
        "rank <= below + upto and rank > below + upto - n"
    )
    return picked.groupBy(*keys).agg(*[_found(name, method) for name in probs])


def quantile_value(df: DataFrame, column: str, p: float, approximate: bool = False) -> Column:
    """One quantile of a whole column as a scalar subquery, usable in any expression."""
    if approximate:
        return df.select(F.percentile_approx(column, p, 10_000)).scalar()
    return quantiles(df, [], {"q": p}, value=column, method="disc").select("q").scalar()
