"""Delimited text and Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.functions.text import clean_names

# Separators considered by the detection, in order of preference.
SEPARATORS = (";", ",", "\t", "|")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ";"
) -> DataFrame:
    """Delimited text with a header row; every column is text.

    Without a schema the header names the columns. With one, columns are taken
    by position and the header must agree with it.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def detect_separator(spark: SparkSession, path: str, lines: int = 5) -> str:
    """Most frequent candidate in the first lines of a text file."""
    head = spark.read.text(path).limit(lines)
    value = F.col("value")
    counts = head.agg(
        *[
            F.coalesce(F.sum(F.length(value) - F.length(F.replace(value, F.lit(s)))), F.lit(0)).alias(f"s{i}")
            for i, s in enumerate(SEPARATORS)
        ]
    ).first()
    return SEPARATORS[max(range(len(SEPARATORS)), key=lambda i: (counts[i], -i))]


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    compression: str = "snappy",
) -> int:
    """Overwrite a Parquet folder and return the rows written.

    The rows are counted while they are written. Partitioned output is
    rebalanced on its folder columns first: adaptive execution then splits a
    large folder over many files and merges small ones.
    """
    seen = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("compression", compression).parquet(path)
    return seen.get["n"]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def peek(df: DataFrame, order: str, rows: int = 5) -> DataFrame:
    """First rows in the order of a key."""
    return df.orderBy(order).limit(rows)


def _share(key: Column, percent: float) -> Column:
    """True for a fixed share of key values, the same on every run and engine."""
    digest = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return digest % 10_000 < int(percent * 100)


def sample_by_key(df: DataFrame, key: str, percent: float = 5.0) -> DataFrame:
    """Sample by hash of a key: tables sampled on the same key stay consistent."""
    return df.filter(_share(F.col(key), percent))


def sample_rows(df: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    """Random sample, of small tables as of large ones."""
    return df.sample(fraction=fraction, seed=seed)


def sample_file(spark: SparkSession, source: str, target: str, fraction: float = 0.05) -> DataFrame:
    """Detect the separator, read, clean names, sample and write as text."""
    df = clean_names(read_csv(spark, source, sep=detect_separator(spark, source)), wide=True)
    sample = sample_rows(df, fraction)
    write_csv(sample, target)
    return sample


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, or below the warehouse where that is unset.

    Driver and executors share both.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
