"""Raw text tables to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.functions.text import (
    clean_names,
    parse_yymmdd,
    parse_yymmdd_time,
    with_labels,
    with_types,
)


def missing_columns(table: str, df: DataFrame) -> list[str]:
    """Declared columns that a raw table lacks."""
    present = set(clean_names(df).columns)
    return [c for c in schema.RAW[table].names if c not in present]


def clean(table: str, raw: DataFrame) -> DataFrame:
    """Typed version of one raw table."""
    df = clean_names(raw)
    if table in ("account", "loan", "trans"):
        df = df.withColumn("date", parse_yymmdd(F.col("date")))
    elif table == "card":
        df = df.withColumn("issued", parse_yymmdd_time(F.col("issued")))
    elif table == "district":
        df = df.withColumnsRenamed(schema.DISTRICT_NAMES)
    if table == "trans":
        df = with_labels(df, schema.TRANS_LABELS)
    elif table == "order":
        df = with_labels(df, schema.ORDER_LABELS)
    return with_types(df, schema.CASTS[table])
