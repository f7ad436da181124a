"""Helpers that the corpus operators share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lower-cases A-Z and turns every ASCII byte outside 0-9 and a-z into a space.
ALNUM_ONLY = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
LONG, INT, DOUBLE, STRING, BOOLEAN = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()
BINARY = T.BinaryType()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, for clusters where it is not installed."""
    context = spark.sparkContext
    if not getattr(context, "_tellermill_sent", False):
        root = Path(__file__).resolve().parents[2]
        context._tellermill_sent = own = tempfile.TemporaryDirectory()  # as long as the context
        context.addPyFile(shutil.make_archive(f"{own.name}/tellermill", "zip", root, "tellermill"))


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of every row; a null counts as an empty text."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(ALNUM_ONLY).split()


def blank_words(text: bytes) -> list[bytes]:
    """Runs of characters other than space and tab to carriage return."""
    return text.split()  # bytes.split() cuts at exactly these six characters


def hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes that are only comparable inside this process."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of k neighbouring words, from the words' hashes."""
    n = len(x) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = x[:n].copy()
    for j in range(1, k):
        h *= _MULTIPLIER
        h += x[j : j + n]
        h ^= h >> np.uint64(29)
    return h


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of this width that begins at one of starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.asarray(starts) + width, -1)
    return np.cumsum(edge[:n]) > 0


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, or below the warehouse where that is unset.

    Driver and executors share both.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """The rows written to the shared folder and read back: a lost executor loses nothing.

    With clean, Spark removes the shuffle files of this step when it has ended; else they
    stay until the driver's JVM collects what refers to them.
    """
    spark = df.sparkSession
    path, before = shared_folder(spark, name), spark.conf.get(_CLEANUP, "false")
    if clean:
        spark.conf.set(_CLEANUP, "true")
        df = df.select("*")  # a new frame, as one keeps the setting it was made under
    try:
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores behind it until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: str = "text") -> Column:
    """Hash that, beside the id, tells rows of the same id apart."""
    return F.xxhash64(F.col(text))
