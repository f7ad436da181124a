"""Stored tables that take in batches: rows are replaced by key, only touched folders are written.

A table is a Parquet folder with one subfolder for each value of a partition expression.
Every row carries the number of the load that wrote it, so a load that broke off and runs
again first drops what it had written. A ledger lists the loads that are complete.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.operators.nullsafe import same_keys
from tellermill.sources.files import work_folder, write_parquet

PART, LOAD = "_part", "_load"
LEDGER = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("load", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("high_mark", T.LongType()),
    ]
)


def _folder(spark: SparkSession, path: str):
    """The file system of a path, which need not be the default one, and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a folder, none if there is no such folder yet."""
    files, target = _folder(spark, path)
    if not files.exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def saved(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _prefixed(df: DataFrame) -> DataFrame:
    return df.toDF(*(f"_{c}" for c in df.columns))


def _remove(spark: SparkSession, path: str) -> None:
    files, target = _folder(spark, path)
    files.delete(target, True)


@dataclass(frozen=True)
class StoredTable:
    """Rows of a schema below a path, known by their keys, in folders by `partition`.

    The partition expression gives a text, or null.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition: Column

    @property
    def _fields(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField(LOAD, T.LongType()), T.StructField(PART, T.StringType())])

    def _stored(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self._fields)

    def read(self) -> DataFrame:
        return self._stored().drop(LOAD, PART)

    def newest(self, rows: DataFrame, order: Sequence[str] = ()) -> DataFrame:
        """One row for each key, the last by `order` and then by its values; all rows that lack a key."""
        row = F.struct(*self.schema.names)
        keyed = reduce(Column.__and__, (F.col(k).isNotNull() for k in self.keys))
        values = [c for c in self.schema.names if c not in order]
        last = F.max_by(row, F.struct(*order, *values)).alias("row")
        known = rows.filter(keyed).groupBy(*(F.col(k).alias(f"_{k}") for k in self.keys)).agg(last)
        return known.select("row.*").unionByName(rows.filter(~keyed))

    def merge(self, rows: DataFrame, load: int, order: Sequence[str] = ()) -> int:
        """Take in the newest rows of a batch in place of stored ones with their keys."""
        return self.replace(self.newest(rows.select(*self.schema.names), order), None, load)

    def replace(self, rows: DataFrame, gone: DataFrame | None, load: int) -> int:
        """Put rows in place of all stored ones with the keys of `gone`, null keys included.

        Without `gone` these are the keys of the rows themselves, as far as they have all.

        Only folders that lose or get rows are read in full and written again; of the others
        the keys alone are read. A folder is replaced when all of its new rows are written.
        Rows that lack a key are never replaced, but a load that runs again writes its own
        anew. Returns the rows of the batch.
        """
        folder = work_folder(self.spark, "load")
        fresh = rows.select(*self.schema.names, F.lit(load).cast("long").alias(LOAD), self.partition.cast("string").alias(PART))
        seen = saved(fresh, f"{folder}/rows")
        if gone is None:
            gone = seen.filter(reduce(Column.__and__, (F.col(k).isNotNull() for k in self.keys)))
        gone = saved(_prefixed(gone.select(*self.keys).distinct()), f"{folder}/gone")
        old = self._stored()
        matched = old.join(gone, same_keys(list(self.keys)), "left_semi")
        lost = matched.unionByName(old.filter(F.col(LOAD) == load))
        touched = lost.select(PART).unionByName(seen.select(PART)).distinct()
        touched = saved(_prefixed(touched), f"{folder}/touched")
        # Few rows: Spark prunes the folders that it reads by them.
        kept = old.join(touched, same_keys([PART]), "left_semi").filter(F.col(LOAD) != load)
        kept = kept.join(gone, same_keys(list(self.keys)), "left_anti")
        # Only stored rows need a copy before their folders are overwritten.
        merged = saved(kept, f"{folder}/kept").unionByName(seen)
        writer = merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART).parquet(self.path)
        left = _prefixed(merged.select(PART).distinct()).withColumnRenamed(f"_{PART}", "_still")
        empty = touched.join(left, touched[f"_{PART}"].eqNullSafe(left["_still"]), "left_anti")
        for row in empty.toLocalIterator():  # folders, not rows
            value = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0]
            _remove(self.spark, f"{self.path}/{PART}={value}")
        return seen.count()


@dataclass(frozen=True)
class Ledger:
    """The complete loads below a path, and the highest mark that they have seen."""

    spark: SparkSession
    path: str

    def loads(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, LEDGER)

    def find(self, batch: str):
        return self.loads().filter(F.col("batch") == batch).first()

    def next_load(self) -> int:
        return 1 + (self.loads().agg(F.max("load")).first()[0] or 0)

    def high_mark(self) -> int | None:
        return self.loads().agg(F.max("high_mark")).first()[0]

    def record(self, batch: str, load: int, rows: int, mark: int | None) -> None:
        self.spark.createDataFrame([(batch, load, rows, mark)], LEDGER).coalesce(1).write.mode("append").parquet(self.path)

    def unseen(self, source: DataFrame, mark: str) -> DataFrame:
        """Rows of an append-only source above the highest mark, those without mark left out."""
        high = self.high_mark()
        column = F.col(mark).cast("long")
        return source.filter(column.isNotNull() if high is None else column > high)
