"""Warehouse tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.functions.text import clean_sink_names

# Write settings for a MySQL warehouse.
MYSQL_OPTIONS = {
    "driver": "com.mysql.cj.jdbc.Driver",
    "createTableOptions": "ENGINE=InnoDB DEFAULT CHARSET=utf8mb4",
    "useSSL": "false",
    "allowPublicKeyRetrieval": "true",
    "rewriteBatchedStatements": "true",
    "connectTimeout": "60000",
    "socketTimeout": "60000",
}
BATCH_ROWS = 1000


def for_sink(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Database-friendly names and types.

    Decimals become doubles; ``types`` declares other target types by column. The schema
    never depends on the values, so a later load meets a table of the same types.
    """
    df = clean_sink_names(df)
    casts = {f.name: "double" for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    casts |= {c: t for c, t in (types or {}).items() if c in df.columns}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    connections: int = 16,
) -> None:
    """Write a table, keeping its definition on overwrite.

    ``connections`` bounds the tasks that write at the same time; more partitions are
    merged without a shuffle.
    """
    (
        df.write.mode(mode)
        .format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", BATCH_ROWS)
        .option("numPartitions", connections)
        .option("isolationLevel", "READ_UNCOMMITTED")
        .option("truncate", True)
        .options(**(options or {}))
        .save()
    )


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table, or a query in parentheses with an alias.

    ``split`` is (column, low, high, partitions): the range is read in that many
    parts, and rows outside it fall into the first and last one. Without it one
    task reads everything, which suits single figures.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.options(**(options or {}))
    if split:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        reader = reader.options(**dict(zip(names, split)))
    return reader.load()


def count_rows(
    spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None
) -> int:
    """Row count computed by the database."""
    query = f"(select count(*) as cnt from {table}) count_query"
    return int(read_table(spark, url, query, options).first()[0])


def reconcile(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Compare (table_name, row_count) of both sides; a missing table counts as not ok."""
    return (
        expected.withColumnRenamed("row_count", "expected")
        .join(found.withColumnRenamed("row_count", "found"), "table_name", "full")
        .withColumn("ok", F.coalesce(F.col("expected") == F.col("found"), F.lit(False)).cast("int"))
    )
