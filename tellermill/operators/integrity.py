"""Key, domain and format checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellermill.functions.money import percent
from tellermill.functions.text import parse_yymmdd_time
from tellermill.operators.profile import union_all


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes that tell rows apart, null and text that looks like it included."""
    marks = [F.col(c).isNull() for c in df.columns]
    return [F.xxhash64(F.lit(k), *df.columns, *marks).alias(f"h{k}") for k in (0, 1)]


def duplicate_check(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Rows that share their key, and rows that are equal throughout (all copies).

    Each table is scanned once: rows become a key and 128 bits of hash, which is what is
    shuffled and counted, first by row and then by key.
    """
    n, total = F.col("n"), F.col("total")
    parts = []
    for name, df in tables.items():
        key = keys[name]
        by_row = df.groupBy(F.col(key).alias("key"), *_row_hashes(df)).agg(F.count("*").alias("n"))
        by_key = by_row.groupBy("key").agg(F.sum("n").alias("total"), F.sum(F.when(n > 1, n)).alias("copies"))
        none = F.lit(0).cast("bigint")
        parts.append(
            by_key.agg(
                F.coalesce(F.sum("total"), none).alias("total_rows"),
                F.coalesce(F.sum(F.when(total > 1, total)), none).alias("key_duplicates"),
                F.coalesce(F.sum("copies"), none).alias("row_duplicates"),
            ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*")
        )
    return union_all(parts)


def pk_uniqueness(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Rows against distinct key values."""
    parts = [
        tables[name]
        .groupBy(F.col(key).alias("key"))
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count("key").alias("distinct_values"),
        )
        .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*")
        for name, key in keys.items()
    ]
    extra = F.col("total_rows") - F.col("distinct_values")
    return union_all(parts).withColumns(
        {"duplicates": extra, "is_unique": (extra == 0).cast("int")}
    )


def fk_integrity(
    tables: Mapping[str, DataFrame],
    foreign_keys: Mapping[tuple[str, str], tuple[str, str]],
) -> DataFrame:
    """Distinct child keys, and how many have no parent."""
    parts = []
    for (child, column), (parent, parent_column) in foreign_keys.items():
        used = tables[child].select(F.col(column).alias("key")).filter("key is not null").distinct()
        known = (
            tables[parent]
            .select(F.col(parent_column).alias("key"), F.lit(1).alias("known"))
            .distinct()
        )
        parts.append(
            used.join(known, "key", "left")
            .agg(
                F.count("*").alias("key_values"),
                F.count_if(F.col("known").isNull()).alias("missing"),
            )
            .select(
                F.lit(child).alias("child_table"),
                F.lit(column).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                F.lit(parent_column).alias("parent_column"),
                "*",
            )
        )
    missing = F.col("missing")
    return union_all(parts).withColumns(
        {
            "orphan_pct": F.coalesce(percent(missing, F.col("key_values")), F.lit(0.0)),
            "is_ok": (missing == 0).cast("int"),
        }
    )


def with_orphan_flag(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """1 where the foreign key has no parent; a null key counts as having none."""
    known = parent.select(F.col(parent_column).alias(column), F.lit(1).alias("_known")).distinct()
    return (
        child.join(known, column, "left")
        .withColumn("is_orphan", F.col("_known").isNull().cast("int"))
        .drop("_known")
    )


def without_match(
    parent: DataFrame, key: str, child: DataFrame, child_key: str | None = None
) -> DataFrame:
    """Rows of ``parent`` that no row of ``child`` refers to.

    The child's keys are reduced to distinct values first, so a hot key joins as one row.
    """
    used = child.select(F.col(child_key or key).alias(key)).distinct()
    return parent.join(used, key, "left_anti")


def domain_check(
    tables: Mapping[str, DataFrame], domains: Mapping[tuple[str, str], Sequence[str]]
) -> DataFrame:
    """Values outside their expected vocabulary, with their frequency."""
    return union_all(
        [
            tables[t]
            .filter(~F.col(c).isin(*allowed))
            .groupBy(F.col(c).alias("value"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "*")
            for (t, c), allowed in domains.items()
        ]
    )


def date_format_check(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Raw date columns: how many values are bare digits, and how many do not parse."""
    parts = []
    for t, names in columns.items():
        for c in names:
            text = F.trim(F.col(c))
            filled = text.isNotNull() & (text != "")
            parts.append(
                tables[t]
                .agg(
                    F.count_if(filled).alias("filled"),
                    F.count_if(text.rlike("^[0-9]+$")).alias("digits_only"),
                    F.count_if(filled & parse_yymmdd_time(text).isNull()).alias("unparseable"),
                )
                .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "*")
            )
    return union_all(parts).withColumn(
        "needs_conversion", (F.col("digits_only") > 0).cast("int")
    )
