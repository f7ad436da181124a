"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellermill.llm.common import stored

#: A chain of n nodes needs about log2(n) rounds; this is a guard against a fault, not a cap.
MOST_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), where root is its component's least node.

    Alternates large-star and small-star steps (Kiveris and others, 2014). Both connect
    neighbours to the least neighbour, found by an aggregate that combines on the map side.
    Every round is written to the shared folder. Null ends are ignored.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, "edges")
    for _ in range(MOST_ROUNDS):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if _print(after) == _print(now):
            break
        now = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _print(edges: DataFrame) -> tuple:
    """Count and order-independent checksum of an edge table."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
