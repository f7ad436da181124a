"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A key belongs to the next virtual node clockwise. A shard takes no more than its share of
the rows; keys that find it full go on clockwise to the next virtual node whose shard has
room. Which rows go on is decided from the number of keys on each arc of the ring, a table
of fixed size, and from the order of keys on an arc, so rows are placed without a serial pass.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import INT, stored, table

SHARDS = 16
#: Virtual nodes of a shard. The ring, and so every table on the driver, has SHARDS * REPLICAS.
REPLICAS = 128
#: Rows that one task sorts.
TASK_ROWS = 1_000_000


def ring(shards: int, replicas: int = REPLICAS) -> tuple[np.ndarray, list[int]]:
    """Sorted positions of the virtual nodes, and the shard of each.

    The positions of a shard do not depend on how many shards there are.
    """
    nodes = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{r}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards)
        for r in range(replicas)
    )
    return np.array([p for p, _ in nodes], np.int64), [s for _, s in nodes]


def ring_plan(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each arc go: (arc, first rank, end rank, shard, slot of the first).

    counts has the keys on each arc. All keys try their own node first; those left over
    then go on by one node at a time, the arcs taking turns clockwise. Shards hold a
    share of the rows that differs by one at most, so every shard ends up full.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    taken = [0] * shards
    placed = [0] * len(counts)
    plan, waiting = [], [a for a, n in enumerate(counts) if n]
    for step in range(len(counts)):
        for arc in waiting:
            shard = owners[(arc + step) % len(owners)]
            n = min(counts[arc] - placed[arc], room[shard] - taken[shard])
            if n:
                plan.append((arc, placed[arc], placed[arc] + n, shard, taken[shard]))
                placed[arc] += n
                taken[shard] += n
        waiting = [a for a in waiting if placed[a] < counts[a]]
    return plan


def with_shards(
    docs: DataFrame,
    key: Column | None = None,
    shards: int = SHARDS,
    replicas: int = REPLICAS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """All rows and columns of docs, with (new) shard and slot, a gapless number inside the shard.

    Shards hold row counts that differ by one at most, whatever the keys: rows of one key,
    null included, spread clockwise over as many shards as they need. The keys of an arc
    are placed in the order of their positions on the ring, and rows of one position by a
    hash of all their columns, so the same rows get the same places however they are
    stored. Equal rows take places of each other. Rows are sorted over all tasks, a hot key over
    several; only arcs and tasks are counted. Texts are not looked at but for that hash.
    Columns called shard or slot are replaced, other names may be anything. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    positions, owners = ring(shards, replicas)

    @F.arrow_udf(INT)
    def arc(hashed: pa.Array) -> pa.Array:
        at = np.searchsorted(positions, hashed.to_numpy(zero_copy_only=False))
        return pa.array((at % len(positions)).astype(np.int32))

    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    hashable = [docs[f.name] for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    place = F.xxhash64(F.col("doc_id") if key is None else key)
    rows = docs.select(
        F.struct(*(docs[c] for c in columns)).alias("of"),
        place.alias("place"),
        F.xxhash64(*hashable).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    # The last arc goes over the end of the positions, so its keys come in two runs.
    rows = stored(rows.withColumn("arc", arc("place")), "ring")
    found = rows.groupBy("arc").count().collect()  # a row for each virtual node at most
    counts = [0] * len(owners)
    for r in found:
        counts[r["arc"]] = r["count"]
    plan = ring_plan(counts, owners, shards)

    behind = F.when(F.col("place") > int(positions[-1]), 0).otherwise(1)
    order = ["arc", behind, "place", "tie", "row"]
    tasks = max(1, -(-sum(counts) // task_rows))
    sorted_rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    sorted_rows = stored(sorted_rows.select("of", "arc", F.monotonically_increasing_id().alias("at")), "sorted")
    task = F.shiftright("at", 33)
    sizes = sorted_rows.groupBy(task.alias("task")).count().orderBy("task").collect()  # a row for each task
    first, starts = 0, []
    for r in sizes:
        starts.append((r["task"], first - (r["task"] << 33)))
        first += r["count"]
    starts_rows = spark.createDataFrame(starts or [(0, 0)], "task long, shift long")
    before = [0, *np.cumsum(counts).tolist()]
    plan_rows = spark.createDataFrame(
        [(a, before[a] + low, before[a] + high, shard, slot) for a, low, high, shard, slot in plan] or [(0, 0, 0, 0, 0)],
        "to_arc int, low long, high long, shard int, first_slot long",
    )
    # Both tables have a bounded number of rows: the tasks, and the virtual nodes with one
    # more for each time that a shard fills up or a node's keys go on.
    numbered = sorted_rows.join(F.broadcast(starts_rows), task == F.col("task"))
    numbered = numbered.select("of", "arc", (F.col("at") + F.col("shift")).alias("number"))
    there = (F.col("arc") == F.col("to_arc")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    slot = (F.col("first_slot") + F.col("number") - F.col("low")).alias("slot")
    return numbered.join(F.broadcast(plan_rows), there).select("of.*", "shard", slot)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return with_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
