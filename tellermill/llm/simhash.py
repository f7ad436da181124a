"""SimHash near-duplicates, joined on a binary trie.

Fingerprints form a binary trie. Pairs of trie nodes are followed downwards together: the
bits in which their paths differ add up, and a pair is dropped when they exceed the
allowed distance. The upper levels are followed with DataFrame operations that deal
fingerprints to the pairs of nodes they belong to; a pair of nodes that is small enough
goes to one task, which follows the rest of its trie. Pairs that stay large, such as
thousands of slightly different copies, are taken further down before that.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellermill.llm.common import LONG, stored, struct, table, text_bytes, text_key, unused
from tellermill.llm.graph import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fingerprints that one task joins, and the bits by which larger node pairs are split.
TASK_PRINTS = 131_072
SPLIT_BITS = 4

_BITS = 64
#: Pairs of trie nodes followed at once in a task, and pairs of leaves compared directly.
_FRONTIER = 1 << 18
_DIRECT = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased word shingles; zero for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8", len(words) - k + 1)
    counts = np.zeros(_BITS, np.int64)
    for part in np.array_split(h, 1 + len(h) // 65_536):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h), bitorder="little").tobytes(), "little")


@F.arrow_udf(LONG)
def _fingerprint(text: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t) for t in text_bytes(text)], np.uint64).view(np.int64))


def trie_links(a: np.ndarray, b: np.ndarray | None, depth: int, left: int, emit) -> None:
    """Follow the trie pair of two sorted arrays of fingerprints that share `depth` levels.

    b is None for the pairs inside a. Calls emit with index arrays of linked pairs; `left`
    is the number of bits in which the two may still differ below this depth.
    """
    same, other = b is None, a if b is None else b
    one = np.uint64(1)
    stack = [(depth, np.array([[0], [len(a)], [0], [len(other)], [left]]))]
    while stack:
        level, pairs = stack.pop()
        alo, ahi, blo, bhi, budget = pairs
        direct = (ahi - alo) * (bhi - blo) <= _DIRECT
        if level == _BITS:
            direct[:] = True
        if direct.any():
            p = pairs[:, direct]
            width = p[3] - p[2]
            sizes = (p[1] - p[0]) * width
            owner = np.repeat(np.arange(len(sizes)), sizes)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            i, j = p[0][owner] + within // width[owner], p[2][owner] + within % width[owner]
            # The levels above used up part of the distance; the rest is counted here.
            low = np.uint64((1 << (_BITS - level)) - 1)
            near = np.bitwise_count((a[i] ^ other[j]) & low) <= p[4][owner]
            if same:
                near &= i < j
            emit(i[near], j[near])
            pairs = pairs[:, ~direct]
            alo, ahi, blo, bhi, budget = pairs
        if not pairs.shape[1]:
            continue
        bit = one << np.uint64(_BITS - 1 - level)
        above = ~(bit | (bit - one))
        amid = np.searchsorted(a, (a[alo] & above) | bit)
        bmid = np.searchsorted(other, (other[blo] & above) | bit)
        twin = same & (alo == blo)  # a node with itself: its two children pair once
        crossed = budget > 0
        children = np.concatenate(
            (
                np.array([alo, amid, blo, bmid, budget]),
                np.array([amid, ahi, bmid, bhi, budget]),
                np.array([alo, amid, bmid, bhi, budget - 1])[:, crossed],
                np.array([amid, ahi, blo, bmid, budget - 1])[:, crossed & ~twin],
            ),
            axis=1,
        )
        children = children[:, (children[0] < children[1]) & (children[2] < children[3])]
        for k in range(0, children.shape[1], _FRONTIER):
            stack.append((level + 1, children[:, k : k + _FRONTIER]))


class _Forest:
    """Joins places into trees; each tree is known by its least place."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            x, y = self.root[i], self.root[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _joined(group: pa.Table) -> pa.Table:
    """A forest that connects the linked fingerprints of one pair of trie nodes."""
    side = group["side"].to_numpy()
    prints = group["print"].to_numpy().view(np.uint64)
    depth, left = group["depth"][0].as_py(), group["left"][0].as_py()
    if group["node_a"][0].as_py() == group["node_b"][0].as_py():
        a = np.sort(prints)
        both, forest = a, _Forest(len(a))
        trie_links(a, None, depth, left, forest.join)
    else:
        a, b = np.sort(prints[side == 1]), np.sort(prints[side == 2])
        both, forest = np.concatenate((a, b)), _Forest(len(prints))
        trie_links(a, b, depth, left, lambda i, j: forest.join(i, j + len(a)))
    tied = np.flatnonzero(forest.root != np.arange(len(both)))
    both = both.view(np.int64)
    return pa.table({"a": both[tied], "b": both[forest.root[tied]]})


def _deeper(pairs: DataFrame, bits: int, distance: int) -> DataFrame:
    """Deal the fingerprints of every node pair to the pairs of its descendants `bits` below."""
    masks = [m for m in range(1 << bits) if m.bit_count() <= distance] if bits <= 16 else _near_masks(bits, distance)
    flips = F.explode(F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("cost")) for m in masks)))
    own = F.expr(f"shiftrightunsigned(print, {_BITS} - depth - {bits}) & {(1 << bits) - 1}L")
    flipped = pairs.select("*", own.alias("own"), flips.alias("f")).filter(F.col("f.cost") <= F.col("left"))
    other = F.col("own").bitwiseXOR(F.col("f.mask"))
    itself = F.col("side") == 0
    turned = itself & (other < F.col("own")) | (F.col("side") == 2)  # the fingerprint's node comes second

    def below(node: str, child: Column) -> Column:
        return F.shiftleft(node, bits).bitwiseOR(child).alias(node)

    return flipped.select(
        below("node_a", F.when(turned, other).otherwise(F.col("own"))),
        below("node_b", F.when(turned, F.col("own")).otherwise(other)),
        (F.col("depth") + bits).alias("depth"),
        (F.col("left") - F.col("f.cost")).alias("left"),
        F.when(itself & (F.col("f.mask") == 0), 0).when(turned, 2).otherwise(1).alias("side"),
        "print",
    )


def _near_masks(bits: int, distance: int) -> list[int]:
    masks = {0}
    for _ in range(distance):
        masks |= {m ^ (1 << k) for m in masks for k in range(bits)}
    return sorted(masks)


def linked(prints: DataFrame, distance: int = DISTANCE, task_prints: int = TASK_PRINTS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within this distance of each other.

    `prints` has a column print of distinct signed 64-bit fingerprints. Of the links
    inside one pair of trie nodes a spanning forest is returned, never all pairs.
    """
    n = prints.count()
    start = ceil(log2(max(1, n / task_prints)))
    zero = F.lit(0)
    pairs = prints.select(
        zero.cast("long").alias("node_a"),
        zero.cast("long").alias("node_b"),
        zero.alias("depth"),
        F.lit(distance).alias("left"),
        zero.alias("side"),
        "print",
    )
    if start:
        pairs = _deeper(pairs, start, distance)
    edges, keys = [], ["node_a", "node_b", "depth"]
    while True:
        pairs = stored(pairs, "trie")
        sizes = pairs.groupBy(*keys).agg(
            F.count_if(F.col("side") != 2).alias("in_a"), F.count_if(F.col("side") != 1).alias("in_b")
        )
        sizes = sizes.filter("in_a > 0 and in_b > 0").select(*keys, (F.greatest("in_a", "in_b") > task_prints).alias("large"))
        sizes = stored(sizes, "nodes")
        small = pairs.join(sizes.filter("not large").select(*keys), keys)
        edges.append(small.groupBy(*keys).applyInArrow(_joined, struct(a=LONG, b=LONG)))
        large = sizes.filter("large").select(*keys)
        if large.isEmpty():
            break
        pairs = _deeper(pairs.join(large, keys), SPLIT_BITS, distance)
    result = edges[0]
    for more in edges[1:]:
        result = result.unionAll(more)
    return result


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, task_prints: int = TASK_PRINTS
) -> DataFrame:
    """doc_id, text_key, print and component_id of every document.

    Documents are linked if their fingerprints differ in `distance` bits at most; the
    component is the smallest doc_id that links reach, over any number of steps. Null and
    wordless texts have fingerprint zero and are linked like others. Rows without id get
    the smallest id of their component, or null if no row of it has one. Equal texts are
    one fingerprint, so a group of copies costs one entry in the trie.
    """
    prints = docs.select("doc_id", text_key().alias("text_key"), _fingerprint("text").alias("print"))
    prints = stored(prints, "prints")
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    nodes = stored(nodes, "nodes")
    found = components(linked(nodes.select("print"), distance, task_prints))
    rooted = nodes.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("print", "root").join(ids, "root").select("print", "root", "component_id")
    return prints.join(labels, "print").select("doc_id", "text_key", "print", "root", "component_id")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", shown, "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, then the smallest text hash.

    See near_duplicates for odd rows. Other columns may have any names.
    """
    found = stored(near_duplicates(docs.select("doc_id", "text")), "groups")
    root, id_, key = (unused(c, docs.columns) for c in ("__root", "__id", "__key"))
    own = found.select(F.col("root").alias(root), F.col("doc_id").alias(id_), F.col("text_key").alias(key))
    order = F.struct(F.col(id_).isNull(), id_, key)
    first = own.groupBy(root).agg(F.min(order).alias("first")).select(root, f"first.{id_}", f"first.{key}")
    first = stored(first, "kept")
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first[id_]) & (text_key() == first[key]))
    # Rows that repeat both id and text are rare; only those are grouped whole.
    again = own.groupBy(root, id_, key).count().filter("count > 1").select(root).distinct()
    again = stored(again, "again")
    single = kept.join(again, root, "left_anti")
    repeated = kept.join(again, root, "left_semi").dropDuplicates([root])
    return single.unionByName(repeated).select(docs.columns)
