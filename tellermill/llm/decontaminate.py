"""Benchmark decontamination by winnowing.

Every window of 13 words is reduced to its smallest 8-word hash. Two texts that share a
window choose the same hash in it, so the join of chosen hashes misses no shared window.
Each hit is then extended to the full windows around it and compared word by word.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import (
    BOOLEAN,
    INT,
    LONG,
    STRING,
    alnum_words,
    covered,
    gram_hashes,
    hashes,
    struct,
    table,
    text_bytes,
    text_key,
    unused,
)

WINDOW = 13
GRAM = 8
#: Benchmark text that one pass over the documents holds in memory; larger benchmarks
#: are matched in several passes.
BLOCK_BYTES = 16 << 20

_HIT = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))])
_HIT_TYPE = struct(n_words=LONG, spans=T.ArrayType(INT), items=T.ArrayType(LONG))
_REPORT_TYPE = struct(n_words=LONG, n_hit=LONG, n_items=LONG, items_sha256=STRING, contaminated=BOOLEAN)


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest hash of some run of `width` neighbours."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least = reduce(np.minimum, (grams[j : j + n] for j in range(width)))
    chosen = np.zeros(len(grams), bool)
    for j in range(width):
        chosen[j : j + n] |= grams[j : j + n] == least
    return np.flatnonzero(chosen)


def _find(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value among the keys, or -1."""
    if not len(sorted_keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == values, at, -1)


class _Windows:
    """Distinct windows of one width with the items that have them."""

    def __init__(self, width: int, owners: dict[int, list[np.ndarray]]):
        # owners: item number -> its word hashes, once for each of the item's texts
        self.width = width
        found, seen, items = [], [], []
        for item, texts in owners.items():
            for x in texts:
                h = gram_hashes(x, width)
                found.append(h)
                seen.append(np.lib.stride_tricks.sliding_window_view(x, width))
                items.append(np.full(len(h), item))
        h, item = np.concatenate(found), np.concatenate(items)
        self.keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        self.words = np.concatenate(seen)[first]
        order = np.argsort(back, kind="stable")
        self.items, self.bounds = item[order], np.searchsorted(back[order], np.arange(len(self.keys) + 1))

    def matches(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Those starts whose window is known, and the items that have it."""
        at = _find(self.keys, gram_hashes(x, self.width)[starts])
        starts, at = starts[at >= 0], at[at >= 0]
        if len(starts):
            same = (np.lib.stride_tricks.sliding_window_view(x, self.width)[starts] == self.words[at]).all(axis=1)
            starts, at = starts[same], at[same]
        items = {int(i) for w in np.unique(at) for i in self.items[self.bounds[w] : self.bounds[w + 1]]}
        return starts, items


class _Index:
    """What a Python worker keeps of one benchmark block."""

    def __init__(self, rows: list[tuple[int | None, str | None]], window: int, gram: int):
        self.window, self.gram = window, gram
        by_width: dict[int, dict[int, list[np.ndarray]]] = defaultdict(lambda: defaultdict(list))
        self.ids = [i for i, _ in rows]
        for n, (_, text) in enumerate(rows):
            x = hashes(alnum_words((text or "").encode()))
            if len(x):
                by_width[min(len(x), window)][n].append(x)
        self.windows = {w: _Windows(w, owners) for w, owners in by_width.items()}
        chosen = [np.empty(0, np.uint64)]
        for texts in by_width.get(window, {}).values():
            for x in texts:
                g = gram_hashes(x, gram)
                chosen.append(g[winnow(g, window - gram + 1)])
        self.prints = np.unique(np.concatenate(chosen))

    def hits(self, text: bytes) -> dict:
        x = hashes(alnum_words(text))
        hit, items = np.zeros(len(x), bool), set()
        for width, known in self.windows.items():
            if len(x) < width:
                continue
            if width == self.window:
                g = gram_hashes(x, self.gram)
                places = winnow(g, width - self.gram + 1)
                places = places[_find(self.prints, g[places]) >= 0]
                if not len(places):
                    continue
                around = places[:, None] - np.arange(width - self.gram + 1)
                starts = np.unique(around[(around >= 0) & (around <= len(x) - width)])
            else:
                starts = np.arange(len(x) - width + 1)
            starts, owners = known.matches(x, starts)
            if len(starts):
                hit |= covered(starts, width, len(x))
                items |= owners
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        ids = {self.ids[i] for i in items} - {None}
        return {"n_words": len(x), "spans": edge.tolist(), "items": sorted(ids)}


_INDEXES: dict[str, _Index] = {}


def _matcher(spark: SparkSession, rows: list, window: int, gram: int):
    block, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

    @F.arrow_udf(_HIT_TYPE)
    def hits(text: pa.Array) -> pa.Array:
        if key not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[key] = _Index(block.value, window, gram)
        index = _INDEXES[key]
        return pa.array([index.hits(t) for t in text_bytes(text)], _HIT)

    return hits


def _report_row(hits: list[dict]) -> dict:
    """One document's figures from its hits in all benchmark blocks."""
    n, items = hits[0]["n_words"], sorted({str(i) for h in hits for i in h["items"]})
    hit = np.zeros(n, bool)
    for h in hits:
        for start, end in zip(h["spans"][::2], h["spans"][1::2], strict=True):
            hit[start:end] = True
    n_hit = int(hit.sum())
    return {
        "n_words": n,
        "n_hit": n_hit,
        "n_items": len(items),
        "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
        "contaminated": n_hit > 0 and 20 * n_hit >= n,
    }


@F.arrow_udf(_REPORT_TYPE)
def _report(hits: pa.Array) -> pa.Array:
    return pa.array([_report_row(h) for h in hits.to_pylist()])


def with_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "contamination",
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows and columns of docs, and a struct column with the benchmark overlap.

    The struct has n_words, n_hit (words inside an occurring window), n_items and
    items_sha256 (of the items with occurring windows), contaminated, and the hit spans.
    A benchmark item shorter than a window is itself one window. A null or wordless text
    has no words and is clean; a null or wordless item matches nothing; an item without id
    hits words but is not listed; rows that repeat an item id count as one item. An empty
    benchmark leaves every document clean. A column of the given name is replaced, other
    names may be anything. Texts of any length are read whole. Documents are scanned once for each benchmark
    block, and only hits leave the scan when there are several.
    """
    if not 0 < gram <= window:
        raise ValueError("the gram must not be longer than the window")
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(size) // block_bytes
    part = F.pmod(F.xxhash64("text"), F.lit(blocks))
    matchers = [
        _matcher(spark, [tuple(r) for r in items.filter(part == b).toLocalIterator()], window, gram)
        for b in range(blocks)
    ]
    if blocks == 1:
        return docs.withColumn(name, _report(F.array(matchers[0](F.col("text")))))
    key, id_, of = (unused(c, [*docs.columns, name]) for c in ("__key", "__id", "__of"))
    own = docs.drop(name).withColumn(key, text_key())
    hits = reduce(
        DataFrame.unionAll,
        (own.select("doc_id", F.col(key).alias("key"), m(F.col("text")).alias("hit")) for m in matchers),
    )
    merged = (
        hits.distinct()
        .groupBy(F.col("doc_id").alias(id_), F.col("key").alias(of))
        .agg(F.collect_list("hit").alias("hits"))
        .select(id_, of, _report("hits").alias(name))
    )
    same = own["doc_id"].eqNullSafe(merged[id_]) & (own[key] == merged[of])
    return own.join(merged, same).drop(key, id_, of)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contamination.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; see with_contamination for odd rows."""
    columns = docs.columns
    name = unused("__found", columns)
    found = with_contamination(docs, table(spark, sf_dir, "benchmark"), name)
    return found.filter(~F.col(f"{name}.contaminated")).select(columns)


ORACLE = r"""
with item as (
  select distinct item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark where text is not null),
win as (
  select distinct item_id, list_slice(w, i, i + least(13, len(w)) - 1) g
  from item, unnest(range(1, greatest(len(w) - 13, 0) + 2)) t(i) where len(w) > 0),
width as (select distinct len(g) k from win),
doc as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
own as (
  select doc_id, i, k, list_slice(w, i, i + k - 1) g
  from doc, width, unnest(range(1, len(w) - k + 2)) t(i) where len(w) >= k),
hit as (select doc_id, i, k, item_id from own join win using (g)),
place as (select distinct doc_id, p from hit, unnest(range(i, i + k)) t(p)),
places as (select doc_id, count(*) n_hit from place group by 1),
items as (
  select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
  from (select distinct doc_id, item_id::varchar id from hit where item_id is not null) group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit,
  coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from doc left join places using (doc_id) left join items using (doc_id)
"""
