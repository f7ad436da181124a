"""Exact duplicates, with frequent texts told apart before any row is shuffled.

Texts are compared by the SHA-256 of their normalised form. Every task summarises the
digests that it reads by Misra-Gries counters; the summaries add up, and a digest whose
lower bound reaches a fixed share of all rows is a candidate. There are few of those, as
their bounds add up to no more than the number of rows. An exact pass counts the
candidates and finds the row that stays for each; these winners are broadcast, so that
the rows of a frequent text are settled where they are read. Only the other digests are
shuffled, none of which has more than a fixed small share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import LONG, stored, struct, table

#: Counters of a task's summary.
COUNTERS = 1024
#: A digest with a lower bound of rows / SHARES is a candidate, so there are SHARES at most.
SHARES = 1024

_PLACE = ("no_id", "id", "row")


def normalised(text: Column) -> Column:
    """The text with a space for each run of spaces, tabs and line ends; empty if null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class Summary:
    """Misra-Gries counters: each is at most the true count, and lacks n / (size + 1) at most."""

    def __init__(self, size: int = COUNTERS):
        self.size = size
        self.low: dict = {}

    def add(self, counts: dict) -> None:
        """Take in counts by key, which may be another summary's counters."""
        low = self.low
        for key, n in counts.items():
            low[key] = low.get(key, 0) + n
        if len(low) > self.size:
            cut = sorted(low.values(), reverse=True)[self.size]
            self.low = {key: n - cut for key, n in low.items() if n > cut}


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    summary = Summary()
    for batch in batches:
        found = batch.column(0).value_counts()
        summary.add(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True)))
    keys, low = pa.array(summary.low.keys(), pa.binary()), pa.array(summary.low.values(), pa.int64())
    yield pa.RecordBatch.from_arrays([keys, low], ["digest", "low"])


def frequent(digests: DataFrame, n: int) -> DataFrame:
    """Digests (column digest) of more than n / SHARES + n / (COUNTERS + 1) rows, and perhaps others.

    n is the number of rows. At most SHARES digests are returned.
    """
    low = digests.select("digest").mapInArrow(_summaries, struct(digest=T.BinaryType(), low=LONG))
    return low.groupBy("digest").agg(F.sum("low").alias("low")).filter(F.col("low") * SHARES >= max(1, n)).select("digest")


def with_copies(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """All rows of docs with a struct `copies`: keep_id, group_size, kept, text_sha256.

    Rows whose normalised texts are equal form a group; a null text counts as empty. The row
    with the smallest doc_id stays (kept) and gives keep_id; a null id comes after all others.
    Of several rows of that id exactly one stays, the first as stored. `carry` names the
    columns to return, all by default; a column called `copies` is replaced, other names may
    be anything. Texts of any length are read whole. An empty table gives an empty result.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c != "copies"]
    rows = docs.select(
        F.struct(*(docs[c] for c in carry)).alias("of"),
        docs["doc_id"].alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(normalised(docs["text"]), 256)).alias("digest"),
    )
    rows = stored(rows.withColumn("no_id", F.col("id").isNull()), "digests")

    found = F.count(F.lit(1)).alias("n"), F.min(F.struct(*_PLACE)).alias("first")
    candidates = stored(frequent(rows, rows.count()), "candidates")
    winners = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*found)
    winners = F.broadcast(stored(winners, "winners"))  # SHARES rows at most

    others = rows.join(winners.select("digest"), "digest", "left_anti")
    joined = rows.join(winners, "digest").unionByName(others.join(others.groupBy("digest").agg(*found), "digest"))
    copies = F.struct(
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    return joined.select("of.*", copies.alias("copies"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    own = F.struct(*docs.columns).alias("own")
    kept = with_copies(docs.select("doc_id", "text", own)).filter("copies.kept")
    return kept.select("own.*")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_copies(docs, ["doc_id"]).select("doc_id", "copies.*")


ORACLE = r"""
with bodies as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
)
select doc_id,
       first_value(doc_id) over (partition by body order by doc_id nulls last) as keep_id,
       count(*) over (partition by body) as group_size,
       row_number() over (partition by body order by doc_id nulls last) = 1 as kept,
       sha256(body) as text_sha256
from bodies
"""
