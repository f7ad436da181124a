"""Katz backoff language model of the corpus: words and pairs of neighbouring words.

Counts are discounted by Good-Turing; what the discounts free goes to pairs not seen, in
proportion to the word model, with weights that make every distribution sum to one.

Documents are cut into chunks of about two million tokens. A chunk sends its distinct words,
then its distinct pairs, to the buckets of the count tables, and gets back the counts of
those alone; so the traffic is that of distinct entries for each chunk, a frequent word or
pair counts once for each chunk, and no task holds the vocabulary. Words that make up
more than a thousandth of the text have too many pairs for one bucket; theirs are split
over buckets by the second word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import BOOLEAN, DOUBLE, LONG, stored, struct, table, text_bytes

CHUNK_TOKENS = 1 << 21
#: Entries that one bucket takes from all chunks together.
BUCKET_ENTRIES = 1 << 21
#: Tokens for each distinct pair of a chunk, roughly; only sets the number of buckets.
TOKENS_A_PAIR = 2
#: Counts up to this are discounted.
LOW = 5
#: Words beyond one in so many tokens have their pairs split.
HOT = 1024

_END = b" "  # no word contains a blank
_SHIFT32 = np.uint64(32)
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Arrays travel as compressed bytes, see _pack.
_BYTES = T.BinaryType()
_CHUNK = struct(
    chunk=LONG, n_tokens=LONG, n_words=LONG, doc_ids=T.ArrayType(LONG), lengths=_BYTES, held=_BYTES, tokens=_BYTES, words=_BYTES
)
_WORDS = struct(bucket=LONG, chunk=LONG, keys=_BYTES, n=_BYTES)
_WORD_TOTALS = struct(chunk=LONG, bucket=LONG, totals=_BYTES, kinds=T.ArrayType(LONG), keys=T.ArrayType(LONG))
_PAIRS = struct(bucket=LONG, chunk=LONG, first=_BYTES, runs=_BYTES, words=_BYTES, word_n=_BYTES, second=_BYTES, n=_BYTES)
_PAIR_TOTALS = struct(
    chunk=LONG,
    bucket=LONG,
    totals=_BYTES,
    low=_BYTES,
    backed=_BYTES,
    sums=_BYTES,
    kinds=T.ArrayType(LONG),
    hot=T.ArrayType(LONG),
    hot_sums=T.ArrayType(DOUBLE),
)
_SCORES = struct(
    doc_id=LONG,
    held_out=BOOLEAN,
    n_tokens=LONG,
    n_known=LONG,
    train_tokens=LONG,
    base_score=DOUBLE,
    score=DOUBLE,
)


def _pack(values: np.ndarray, kind: str) -> bytes:
    """An array as compressed bytes, all first bytes of its values before all second ones."""
    a = np.ascontiguousarray(values, kind)
    return zstandard.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def is_held_out(doc_id: int | None) -> bool:
    """Whether the model must not learn from this document; a missing id is an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as word numbers of their chunk. A document is never split."""
    partition, made = TaskContext.get().partitionId(), 0
    ids, docs, lengths, parts, size = _Ids({_END: 0}), [], [], [], 0

    def row() -> pa.RecordBatch:
        words = np.fromiter(map(xxhash.xxh64_intdigest, ids), "<u8", len(ids))
        held = np.array([is_held_out(d) for d in docs])
        values = (
            (partition << 32) + made,
            size,
            len(ids),
            docs,
            _pack(lengths, "<i4"),
            _pack(held, "?"),
            _pack(np.concatenate(parts), "<i4"),
            _pack(words, "<u8"),
        )
        return _rows(_CHUNK, [values]).to_batches()[0]

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), text_bytes(batch["text"]), strict=True):
            words = text.lower().split()
            words.append(_END)
            docs.append(doc_id)
            lengths.append(len(words))
            parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
            size += len(words)
            if size >= CHUNK_TOKENS:
                yield row()
                made += 1
                ids, docs, lengths, parts, size = _Ids({_END: 0}), [], [], [], 0
    if docs:
        yield row()


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing factors for the counts 0 to LOW; n[r] is how many entries occur r times.

    Katz's formula leaves counts above LOW as they are. Where the counts of counts do not
    give a factor between 0 and 1, half a count is taken off instead.
    """
    d = np.ones(LOW + 1)
    cut = (LOW + 1) * n[LOW + 1] / n[1] if n[1] else 1.0
    for r in range(1, LOW + 1):
        better = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (better - cut) / (1 - cut) if cut < 1 else 0.0
        d[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return d


@dataclass
class WordModel:
    """What is known of words: their number and the discounted probability of a count."""

    tokens: int
    kinds: int
    counts: list[int]
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))

    def __post_init__(self):
        self.factors = discounts(self.counts)
        freed = sum((1 - self.factors[r]) * r * self.counts[r] for r in range(1, LOW + 1))
        # Without low counts nothing is freed; then one token more is taken to be unknown.
        self.total = self.tokens if freed else self.tokens + 1
        self.unknown = freed / self.tokens if freed else 1 / self.total

    def probability(self, count: np.ndarray) -> np.ndarray:
        """Of words with these counts; a count of 0 is the unknown word."""
        seen = self.factors[np.minimum(count, LOW)] * count
        seen = np.where(count > LOW, count, seen) / max(1, self.total)
        return np.where(count > 0, seen, self.unknown)


@dataclass
class PairModel:
    """Discounts of pairs, and for split words what backing off from them needs."""

    factors: np.ndarray
    hot: dict[int, np.ndarray] = field(default_factory=dict)  # word: kinds with count 1 to LOW, word probability seen


def _rows(schema: T.StructType, rows: list[tuple]) -> pa.Table:
    kinds = {LONG: pa.int64(), DOUBLE: pa.float64(), _BYTES: pa.binary()}

    def kind(field_: T.StructField) -> pa.DataType:
        inner = field_.dataType
        return pa.list_(kinds[inner.elementType]) if isinstance(inner, T.ArrayType) else kinds[inner]

    fields = [(f.name, kind(f)) for f in schema]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.table([pa.array(list(c), k) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


class _Chunk:
    """A chunk with its words in the order of their hashes."""

    def __init__(self, left: pa.Table):
        hashed = _unpack(left["words"][0].as_py(), "<u8")
        self.words, rank = np.unique(hashed, return_inverse=True)
        self.tokens = rank[_unpack(left["tokens"][0].as_py(), "<i4")]
        self.end = rank[0]
        self.chunk = left["chunk"][0].as_py()
        self.doc_ids = left["doc_ids"][0].as_py()
        self.lengths = _unpack(left["lengths"][0].as_py(), "<i4")
        self.held = _unpack(left["held"][0].as_py(), "?")
        self.learns = np.repeat(~self.held, self.lengths)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learns], minlength=len(self.words))

    def pairs(self) -> None:
        """Distinct pairs by first and second word, their counts, and the pair of each token."""
        before = np.concatenate(([self.end], self.tokens[:-1]))  # every document ends with the end
        n = len(self.words)
        codes, self.pair = np.unique(before.astype(np.int64) * n + self.tokens, return_inverse=True)
        self.first, self.second = codes // n, codes % n
        self.pair_n = np.bincount(self.pair, weights=self.learns, minlength=len(codes)).astype(np.int32)

    def slices(self, buckets: int, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Bucket and places of the pairs that belong to it, in order."""
        first, second = self.words[self.first], self.words[self.second]
        own = _bucket(first, buckets)
        split = np.isin(first, hot)
        own = np.where(split, buckets + _bucket(second, buckets), own)
        order = np.argsort(own, kind="stable")
        edges = np.flatnonzero(np.diff(own[order])) + 1
        for places in np.split(order, edges):
            yield int(own[places[0]]), places


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _SHIFT32) * np.uint64(buckets) >> _SHIFT32).astype(np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.concatenate(([0], np.flatnonzero(np.diff(values)) + 1))


def _send_words(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(pa.Table.from_batches([batch.slice(i, 1)]))
                counts = chunk.word_counts()
                edges = np.searchsorted(_bucket(chunk.words, buckets), np.arange(buckets + 1))
                rows = [
                    (b, chunk.chunk, _pack(chunk.words[x:y], "<u8"), _pack(counts[x:y], "<i4"))
                    for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True))
                    if y > x
                ]
                yield from _rows(_WORDS, rows).to_batches()

    return send


def _parts(group: pa.Table, column: str, kind: str) -> list[np.ndarray]:
    return [_unpack(value.as_py(), kind) for value in group[column]]


def _count_words(group: pa.Table) -> pa.Table:
    """Totals of a bucket's words for each chunk that has them; the row of chunk -1 sums up."""
    group = group.sort_by("chunk")
    keys = _parts(group, "keys", "<u8")
    words, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, weights=np.concatenate(_parts(group, "n", "<i4")), minlength=len(words)).astype(np.int64)
    bucket, edges = group["bucket"][0].as_py(), np.cumsum([len(k) for k in keys])[:-1]
    rows = [
        (c.as_py(), bucket, _pack(totals[p], "<i8"), None, None)
        for c, p in zip(group["chunk"], np.split(place, edges), strict=True)
    ]
    kinds = np.bincount(np.minimum(totals, LOW + 2), minlength=LOW + 3)[: LOW + 2]
    often = totals * HOT > max(1, totals.sum())
    summary = np.concatenate(([totals.sum(), (totals > 0).sum()], kinds, totals[often]))
    rows.append((-1, bucket, None, summary, words[often].view(np.int64)))
    return _rows(_WORD_TOTALS, rows)


def _word_totals(chunk: _Chunk, right: pa.Table) -> np.ndarray:
    return np.concatenate(_parts(right.sort_by("bucket"), "totals", "<i8"))


def _send_pairs(buckets: int, hot: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left)
        totals = _word_totals(chunk, right)
        chunk.pairs()
        rows = []
        for bucket, at in chunk.slices(buckets, hot):
            first = chunk.first[at]
            starts = _runs(first)
            words, second = np.unique(chunk.second[at], return_inverse=True)
            rows.append(
                (
                    bucket,
                    chunk.chunk,
                    _pack(chunk.words[first[starts]], "<u8"),
                    _pack(np.diff(np.append(starts, len(at))), "<i4"),
                    _pack(chunk.words[words], "<u8"),
                    _pack(totals[words], "<i8"),
                    _pack(second, "<i4"),
                    _pack(chunk.pair_n[at], "<i4"),
                )
            )
        return _rows(_PAIRS, rows)

    return send


def _count_pairs(words: WordModel, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def count(group: pa.Table) -> pa.Table:
        """Totals of a bucket's pairs for each chunk that has them, and what backing off needs.

        The row of chunk -1 has the counts of counts, and for split words their part of the
        sums. A pair is known by a 64-bit hash of its words' hashes.
        """
        group = group.sort_by("chunk")
        bucket, chunks = group["bucket"][0].as_py(), group["chunk"].to_pylist()
        runs, firsts = _parts(group, "runs", "<i4"), _parts(group, "first", "<u8")
        seconds = _parts(group, "second", "<i4")
        first = np.concatenate([np.repeat(f, r) for f, r in zip(firsts, runs, strict=True)])
        second = np.concatenate([w[k] for w, k in zip(_parts(group, "words", "<u8"), seconds, strict=True)])
        word_n = np.concatenate([n[k] for n, k in zip(_parts(group, "word_n", "<i8"), seconds, strict=True)])
        mixed = ((first ^ (first >> _SHIFT32)) * _MIX) ^ (second >> _SHIFT32)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + second
        _, one, place = np.unique(mixed, return_index=True, return_inverse=True)
        weights = np.concatenate(_parts(group, "n", "<i4"))
        totals = np.bincount(place, weights=weights, minlength=len(one)).astype(np.int64)
        kinds = np.bincount(np.minimum(totals, LOW + 2), minlength=LOW + 3)[: LOW + 2]

        owners, owner = np.unique(first[one], return_inverse=True)
        probability = words.probability(word_n[one])
        sums = np.stack(
            [np.bincount(owner, weights=totals == r, minlength=len(owners)) for r in range(1, LOW + 1)]
            + [np.bincount(owner, weights=probability * (totals > 0), minlength=len(owners))],
            axis=1,
        )
        rows, split = [], bucket >= buckets
        edges = np.cumsum([r.sum() for r in runs])[:-1]
        for c, own, run, at in zip(chunks, firsts, runs, np.split(place, edges), strict=True):
            r = totals[at]
            low = backed = back = None
            if not split:
                known = np.searchsorted(owners, own)
                places = np.unique(np.repeat(np.arange(len(run)), run)[r == 0])
                low = _pack(sums[known, :LOW].any(axis=1), "?")
                backed, back = _pack(places, "<i4"), _pack(sums[known[places]].ravel(), "<f8")
            rows.append((c, bucket, _pack(r, "<i8"), low, backed, back, None, None, None))
        hot = (owners.view(np.int64), sums.ravel()) if split else (None, None)
        rows.append((-1, bucket, None, None, None, None, kinds, *hot))
        return _rows(_PAIR_TOTALS, rows)

    return count


def _score(words: WordModel, pairs: PairModel, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left)
        kind = right["kind"].to_numpy()
        word_n = _word_totals(chunk, right.filter(pa.array(kind == 0)))
        found = right.filter(pa.array(kind == 1))
        at_bucket = {b.as_py(): i for i, b in enumerate(found["bucket"])}
        chunk.pairs()
        count = np.zeros(len(chunk.first), np.int64)
        some_low = np.ones(len(chunk.words), bool)
        sums = np.zeros((len(chunk.words), LOW + 1))
        for bucket, at in chunk.slices(buckets, words.hot):
            i = at_bucket[bucket]
            count[at] = _unpack(found["totals"][i].as_py(), "<i8")
            if bucket < buckets:
                own = chunk.first[at]
                own = own[_runs(own)]
                some_low[own] = _unpack(found["low"][i].as_py(), "?")
                backed = own[_unpack(found["backed"][i].as_py(), "<i4")]
                sums[backed] = _unpack(found["sums"][i].as_py(), "<f8").reshape(-1, LOW + 1)
        for word, known in pairs.hot.items():
            at = np.searchsorted(chunk.words, np.uint64(word))
            if at < len(chunk.words) and chunk.words[at] == np.uint64(word):
                sums[at], some_low[at] = known, known[:LOW].any()

        # A first word whose pairs are all frequent frees nothing; it counts once more.
        below = np.maximum(1, word_n + ~some_low)
        freed = np.where(some_low, (sums[:, :LOW] * ((1 - pairs.factors) * np.arange(LOW + 1))[1:]).sum(axis=1), 1) / below
        weight = np.where(word_n > 0, freed / np.maximum(1 - sums[:, LOW], 1e-300), 1.0)
        alone = words.probability(word_n)
        seen = np.where(count > LOW, 1.0, pairs.factors[np.minimum(count, LOW)]) * count / below[chunk.first]
        p = np.where(count > 0, seen, weight[chunk.first] * alone[chunk.second])

        starts = np.concatenate(([0], np.cumsum(chunk.lengths)[:-1]))
        base = np.log10((word_n + 1) / (words.tokens + words.kinds + 1))
        total = len(chunk.doc_ids)
        return pa.table(
            {
                "doc_id": pa.array(chunk.doc_ids, pa.int64()),
                "held_out": pa.array(chunk.held),
                "n_tokens": pa.array(chunk.lengths.astype(np.int64)),
                "n_known": pa.array(np.add.reduceat((word_n > 0)[chunk.tokens], starts, dtype=np.int64)),
                "train_tokens": pa.array(np.full(total, words.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base[chunk.tokens], starts)),
                "score": pa.array(np.add.reduceat(np.log10(p)[chunk.pair], starts)),
            }
        )

    return score


def scores(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, held_out, counts, base_score and score.

    Tokens are the lower-cased words and one end. Documents whose id has a checksum of 2
    modulo 7 are scored but not learned from. A null or blank text is the end alone; a
    missing id counts as an empty text; rows that repeat count each time. An empty table
    gives an empty result; without learned documents every word is the unknown word.
    Words are told apart by 64-bit hashes.
    """
    chunks = stored(docs.select("doc_id", "text").mapInArrow(_chunks, _CHUNK), "chunks")
    size = chunks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    buckets = 1 + (size["words"] or 0) // BUCKET_ENTRIES
    sent = chunks.mapInArrow(_send_words(buckets), _WORDS)
    word_totals = stored(sent.groupBy("bucket").applyInArrow(_count_words, _WORD_TOTALS), "words")
    words = _word_model(word_totals.filter("chunk = -1"))
    word_totals = word_totals.filter("chunk >= 0").select("chunk", "bucket", F.lit(0).alias("kind"), "totals")

    buckets = 1 + (size["tokens"] or 0) // (TOKENS_A_PAIR * BUCKET_ENTRIES)
    pairs_sent = chunks.groupBy("chunk").cogroup(word_totals.groupBy("chunk")).applyInArrow(_send_pairs(buckets, words.hot), _PAIRS)
    counted = pairs_sent.groupBy("bucket").applyInArrow(_count_pairs(words, buckets), _PAIR_TOTALS)
    pair_totals = stored(counted, "pairs")
    pairs = _pair_model(pair_totals.filter("chunk = -1"))

    found = pair_totals.filter("chunk >= 0").select(*word_totals.columns[:2], F.lit(1).alias("kind"), "totals", "low", "backed", "sums")
    known = found.unionByName(word_totals, allowMissingColumns=True).groupBy("chunk")
    return chunks.groupBy("chunk").cogroup(known).applyInArrow(_score(words, pairs, buckets), _SCORES)


def _word_model(summaries: DataFrame) -> WordModel:
    """Of the summary rows of all word buckets, each of bounded size."""
    total, hot = np.zeros(LOW + 4, np.int64), {}
    for r in summaries.toLocalIterator():
        values = np.array(r["kinds"], np.int64)
        total += values[: LOW + 4]
        hot |= dict(zip(r["keys"], values[LOW + 4 :].tolist(), strict=True))
    often = [k for k, n in hot.items() if n * HOT > total[0]]
    return WordModel(int(total[0]), int(total[1]), total[2:].tolist(), np.sort(np.array(often, np.int64).view(np.uint64)))


def _pair_model(summaries: DataFrame) -> PairModel:
    """Of the summary rows of all pair buckets; the sums of split words are added up by Spark."""
    kinds = summaries.select(F.posexplode("kinds").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()
    n = {x["r"]: x["n"] for x in kinds}
    each = summaries.select(F.posexplode("hot").alias("i", "word"), "hot_sums").select(
        "word", F.posexplode(F.slice("hot_sums", F.col("i") * (LOW + 1) + 1, F.lit(LOW + 1))).alias("k", "v")
    )
    hot: dict[int, np.ndarray] = {}
    for x in each.groupBy("word", "k").agg(F.sum("v").alias("v")).collect():  # HOT words at most
        hot.setdefault(x["word"] % (1 << 64), np.zeros(LOW + 1))[x["k"]] = x["v"]
    return PairModel(discounts([n.get(r, 0) for r in range(LOW + 2)]), hot)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
