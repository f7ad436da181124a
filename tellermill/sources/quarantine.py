"""Delimited text whose unusable lines are set aside, each with a reason.

A line that does not have the header's fields, or whose key is missing or no number, would
turn into nulls in a typed table. Such lines go to a quarantine table as they are. Other
values that can't be read still become null, but are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill import schema
from tellermill.functions.text import blank_to_null, clean_names
from tellermill.plans.clean import clean, missing_columns
from tellermill.sources.files import read_csv, write_parquet

RECORD, REASON = "_record", "_reason"
TOO_FEW, TOO_MANY, OPEN_QUOTE = "too few fields", "too many fields", "open quote"
NO_KEY, BAD_KEY = "no key", "key is no number"
_QUOTED = r'"([^"\\]|\\.|"")*"'


def _raw_name(table: str, column: str) -> str:
    """What a typed column is called in the text file."""
    names = {new: old for old, new in schema.DISTRICT_NAMES.items()} if table == "district" else {}
    return names.get(column, column)


def read_checked(
    spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ";"
) -> DataFrame:
    """All lines of a text file: its columns as text, and the whole line where it doesn't fit.

    Without `columns` the header names them. Blank lines are no records.
    """
    header = columns is None
    names = clean_names(read_csv(spark, path, sep=sep)).columns if header else columns
    fields = [T.StructField(c, T.StringType()) for c in [*names, RECORD]]
    reader = spark.read.schema(T.StructType(fields)).option("sep", sep).option("header", header)
    # Every field is parsed whatever columns are asked for, else short lines pass unseen.
    return reader.option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False).csv(path)


def with_reason(table: str, df: DataFrame, sep: str = ";") -> DataFrame:
    """Lines of `read_checked` with the reason why one is unusable, or null."""
    record, key = F.col(RECORD), F.col(_raw_name(table, schema.PRIMARY_KEYS[table]))
    bare = F.regexp_replace(record, _QUOTED, "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep))) + 1
    expected = len(df.columns) - 1
    shape = (
        F.when(bare.contains('"'), OPEN_QUOTE)
        .when(fields < expected, TOO_FEW)
        .when(fields > expected, TOO_MANY)
        .otherwise("malformed")
    )
    bad_key = F.when(blank_to_null(key).isNull(), NO_KEY)
    if kind := schema.CASTS[table].get(schema.PRIMARY_KEYS[table]):
        bad_key = bad_key.when(key.try_cast(kind).isNull(), BAD_KEY)
    return df.withColumn(REASON, F.when(record.isNotNull(), shape).otherwise(bad_key))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(RECORD, REASON)


def rejects(table: str, df: DataFrame, sep: str = ";") -> DataFrame:
    """table_name, reason and record of all unusable lines."""
    fields = [c for c in df.columns if c not in (RECORD, REASON)]
    line = F.concat_ws(sep, *(F.coalesce(F.col(c), F.lit("")) for c in fields))
    return df.filter(F.col(REASON).isNotNull()).select(
        F.lit(table).alias("table_name"), F.col(REASON).alias("reason"), F.coalesce(RECORD, line).alias("record")
    )


def lost_values(table: str) -> Column:
    """How many values of a row are text that the column's type can't take."""
    lost = F.lit(0)
    for c, kind in schema.CASTS[table].items():
        text = F.col(_raw_name(table, c))
        lost += (blank_to_null(text).isNotNull() & text.try_cast(kind).isNull()).cast("int")
    return lost


@dataclass(frozen=True)
class Loaded:
    """What became of the lines of one file."""

    lines: int
    accepted: int
    rejected: int
    lost_values: int


def load_checked(
    spark: SparkSession, table: str, path: str, target: str, quarantine: str, sep: str = ";"
) -> Loaded:
    """Clean one text file into Parquet and its unusable lines into a quarantine folder.

    Lines are counted while they are read for the target; a second pass writes rejects only
    if there are any. The quarantine folder is overwritten, by no rows if all are fine.
    """
    df = with_reason(table, read_checked(spark, path, sep=sep), sep)
    if absent := missing_columns(table, df.drop(RECORD, REASON)):
        raise ValueError(f"missing columns: {absent}")
    seen = Observation()
    good = F.col(REASON).isNull()
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~good).alias("rejected"),
        F.coalesce(F.sum(F.when(good, lost_values(table))), F.lit(0)).alias("lost"),
    )
    written = write_parquet(clean(table, accepted(watched)), target, schema.PROCESSED_PARTITIONS[table])
    found = seen.get
    if found["lines"] != written + found["rejected"]:
        raise ValueError(f"{found['lines']} lines, {written} accepted, {found['rejected']} rejected")
    unusable = rejects(table, df, sep)
    write_parquet(unusable if found["rejected"] else spark.createDataFrame([], unusable.schema), quarantine, ["reason"])
    return Loaded(found["lines"], written, found["rejected"], found["lost"])


def with_planted_faults(df: DataFrame, key: str, sep: str = ";") -> DataFrame:
    """Text lines of a raw table, some of them spoiled in a way told by their key's number."""
    rest = [c for c in df.columns if c != key]
    number = F.pmod(F.col(key).cast("bigint"), F.lit(8))
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in rest]

    def line(k: Column, fields: list[Column]) -> Column:
        return F.concat_ws(sep, k, *fields)

    plain = [F.coalesce(F.col(c), F.lit("")) for c in rest]
    return df.select(
        F.when(number == 1, line(F.col(key), plain[:-1]))
        .when(number == 2, line(F.col(key), [*plain, F.lit("more")]))
        .when(number == 3, line(F.lit(" "), plain))
        .when(number == 4, line(F.concat(F.lit("no "), F.col(key)), plain))
        .when(number == 5, line(F.col(key), quoted))
        .otherwise(line(F.col(key), plain))
        .alias("value")
    )
