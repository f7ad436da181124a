"""Names, dates, labels and casts of raw text columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*names)


def clean_names(df: DataFrame, wide: bool = False) -> DataFrame:
    """Strip, drop double quotes, lower-case, blanks to underscores.

    ``wide`` also drops single quotes and turns hyphens into underscores.
    """
    table = str.maketrans({'"': "", " ": "_"} | ({"'": "", "-": "_"} if wide else {}))
    return _renamed(df, [c.strip().translate(table).lower() for c in df.columns])


def clean_sink_names(df: DataFrame) -> DataFrame:
    """Hyphen, blank and dot to underscore, lower case, for a database table."""
    table = str.maketrans("- .", "___")
    return _renamed(df, [c.translate(table).lower() for c in df.columns])


def parse_yymmdd(c: Column, century: int = 19) -> Column:
    """Six digits to a date in one fixed century; anything else is null."""
    text = c.cast("string")
    return F.when(
        text.rlike("^[0-9]{6}$"),
        F.try_to_date(F.concat(F.lit(str(century)), text), "yyyyMMdd"),
    )


def parse_yymmdd_time(c: Column, century: int = 19) -> Column:
    """``yyMMdd HH:mm:ss`` to its date."""
    return parse_yymmdd(F.substring(c.cast("string"), 1, 6), century)


def blank_to_null(c: Column) -> Column:
    """Text that is empty after trimming becomes null; other text is unchanged."""
    return F.when(F.trim(c) != "", c)


def with_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Put a business label where a text column is null or blank."""
    return df.withColumns(
        {c: F.coalesce(blank_to_null(F.col(c)), F.lit(v)) for c, v in labels.items() if c in df.columns}
    )


def with_types(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast named columns; malformed text becomes null whatever the ANSI setting.

    So do NaN and infinities, which no figure of a bank can be.
    """

    def typed(c: str, t: str) -> Column:
        value = F.col(c).try_cast(t)
        return F.when(F.abs(value) < float("inf"), value) if t == "double" else value

    return df.withColumns({c: typed(c, t) for c, t in casts.items() if c in df.columns})


def with_trimmed(df: DataFrame, columns: Iterable[str], upper: bool = False) -> DataFrame:
    """Trim category columns, upper-casing them on request."""
    rule = (lambda c: F.upper(F.trim(c))) if upper else F.trim
    return df.withColumns({c: rule(F.col(c)) for c in columns if c in df.columns})
