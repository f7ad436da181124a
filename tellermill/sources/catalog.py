"""Catalog entries over stored folders."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def register(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """External table over a Parquet folder, with its partitions discovered."""
    spark.sql(f"drop table if exists {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)


@dataclass
class Crawled:
    """What a crawl changed in the catalog."""

    created: bool = False
    added_columns: list[str] = field(default_factory=list)
    added_partitions: int = 0


def _merged(spark: SparkSession, path: str) -> T.StructType:
    """The columns of all files of a folder, whenever they were written."""
    return spark.read.option("mergeSchema", True).parquet(path).schema


def _partitions(spark: SparkSession, name: str, partitioned: bool) -> int:
    return spark.sql(f"show partitions {name}").count() if partitioned else 0


def crawl(spark: SparkSession, name: str, path: str, partitions: list[str] | None = None, statistics: bool = True) -> Crawled:
    """Bring a table's entry up to date with its folder.

    A new table is created with the columns of all files. Of a known one, columns and
    partitions that the folder has gained are added; older files read as null there. A column
    whose type differs is an error, as older files could not be read any more. Statistics of
    the columns are computed for the optimizer.
    """
    found, done = _merged(spark, path), Crawled()
    partitions = partitions or []
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found)
        folders = f"partitioned by ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
        spark.sql(f"create table {name} ({columns}) using parquet {folders} location '{path}'")
        done.created = True
    else:
        known = {f.name: f.dataType for f in spark.table(name).schema}
        changed = [f.name for f in found if f.name in known and f.name not in partitions and known[f.name] != f.dataType]
        if changed:
            raise ValueError(f"columns of {name} have changed their type: {changed}")
        new = [f for f in found if f.name not in known]
        if new:
            spark.sql(f"alter table {name} add columns ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
            done.added_columns = [f.name for f in new]
    before = 0 if done.created else _partitions(spark, name, bool(partitions))
    if partitions:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    done.added_partitions = _partitions(spark, name, bool(partitions)) - before
    if statistics:
        spark.sql(f"analyze table {name} compute statistics for all columns")
    return done
