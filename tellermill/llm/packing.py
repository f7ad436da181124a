"""Best-fit packing with certified bin counts.

Documents become token pieces. Pieces are dealt to partitions, and each partition packs
its own by best-fit decreasing. Dual-feasible functions give a lower bound of the bins that
the partition needs. Where the bins reach the bound the packing is optimal and stays, but
for its emptiest bin; a partition with a gap gives up all bins that are not nearly full.
What was given up is dealt anew and packed again, until it fits one partition.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import INT, LONG, stored, struct, table, text_bytes

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Pieces that one task packs.
PARTITION_PIECES = 16_384
ROUNDS = 8
#: A bin with at most this part of its capacity free counts as full.
NEARLY = 64

#: A worker keeps the ids of words up to about so many bytes; then only those of its last
#: texts stay. This only saves time.
_MEMO_BYTES = 96 << 20
_ENTRY_BYTES = 200
_CHUNK_BYTES = 4 << 20
_LEARN_WORDS = 1000
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS = frozenset(_PUNCTUATION)
_WORD_END = "</w>"
_PIECES = T.ArrayType(struct(piece=INT, start=LONG, length=LONG, ids_crc32=LONG))
_PIECES_ARROW = pa.list_(
    pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
)


class _WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never joins over it, so a text's ids are those of
    its words, one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.keep({b""})

    def keep(self, words: Iterable[bytes]) -> None:
        """Forget all words but these."""
        kept = {w: self[w] for w in words if w in self} | {b"": b""}
        self.clear()
        self.update(kept)
        self.size = sum(len(w) + len(ids) + _ENTRY_BYTES for w, ids in kept.items())

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _put(self, words: list[bytes], ids: list[bytes]) -> None:
        self.update(zip(words, ids, strict=True))
        self.size += sum(map(len, words)) + sum(map(len, ids)) + _ENTRY_BYTES * len(words)

    def learn(self, words: Iterable[bytes]) -> None:
        """Take in words; punctuation behind a letter is always split off by the tokenizer."""
        ended, parts, cores = [], [], set()
        for w in words:
            if w[-1] in _MARKS and b"<|" not in w:
                core = w.rstrip(_PUNCTUATION)
                if core[-1:].isalpha() or core and core[-1] >= 128 and core.decode()[-1].isalpha():
                    ended.append(w)
                    parts.append((core, w[len(core) :]))
                    cores.update(parts[-1])
                    continue
            cores.add(w)
        cores.difference_update(self.keys() & cores)
        letters = [w for w in cores if w.decode().isalpha()]
        for k in range(0, len(letters), 64 * _LEARN_WORDS):
            self._learn_letters(letters[k : k + 64 * _LEARN_WORDS])
        self._learn_singly(list(cores.difference(letters)))
        self._put(ended, [self[core] + self[tail] for core, tail in parts])

    def _learn_singly(self, words: list[bytes]) -> None:
        self._put(words, [self._ids(w.decode()).tobytes() for w in words])

    def _learn_letters(self, words: list[bytes]) -> None:
        """Take in words of letters alone, many at once: each is one word to the tokenizer, with one last token."""
        texts = [b" ".join(words[k : k + _LEARN_WORDS]).decode() for k in range(0, len(words), _LEARN_WORDS)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in found])
        cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(cuts) != len(words):  # its letters are not quite ours
            return self._learn_singly(words)
        data, cuts = ids.tobytes(), cuts.tolist()
        self._put(words, [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)])

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text; each distinct word of all of them is looked up once."""
        given = pa.array(texts, pa.large_binary()).cast(pa.large_string())
        # Special tokens are told by their case, other text is not.
        lowered = pc.if_else(pc.match_substring(given, "<|"), given, pc.ascii_lower(given))
        words = pc.ascii_split_whitespace(lowered)  # blank ends of a text give empty words
        coded = words.flatten().dictionary_encode()
        distinct = _slices(coded.dictionary)
        if self.size > _MEMO_BYTES:
            self.keep(distinct)
        new = [w for w in distinct if w not in self]
        if new:
            self.learn(new)
        ids = list(map(self.__getitem__, distinct))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ends = np.concatenate(([0], np.cumsum(lengths)))
        each = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<u4")))
        data = each.take(coded.indices).flatten().to_numpy().tobytes() if len(ids) else b""
        cuts = np.concatenate(([0], np.cumsum(lengths[coded.indices.to_numpy()])))[words.offsets.to_numpy()] * 4
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield data[a:b]


def _slices(strings: pa.Array) -> list[bytes]:
    """The values of a large string array without nulls."""
    _, offsets, data = strings.buffers()
    if not len(strings):
        return []
    cuts = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1].tolist()
    raw = data.to_pybytes() if data else b""
    return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_MEMO: dict[str, _WordIds] = {}


def _memo(path: str | None) -> _WordIds:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _MEMO:
        _MEMO[path] = _WordIds(path)
    return _MEMO[path]


def _chunks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for t in texts:
        chunk.append(t)
        size += len(t)
        if size >= _CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    yield chunk


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """Number, start, length and checksum of each piece."""
    step = 4 * capacity
    return [
        (k, k * capacity, len(part) // 4, zlib.crc32(part))
        for k, part in enumerate(ids[a : a + step] for a in range(0, len(ids), step))
    ]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32.

    `tokenizer` is the path of a vocabulary file of the tokenizers library whose
    pre-tokenizer splits at white space. A null or empty text has the end id alone.
    """
    end = np.array([END_ID], "<u4").tobytes()

    @F.arrow_udf(_PIECES)
    def piece_list(text: pa.Array) -> pa.Array:
        memo, rows = _memo(tokenizer), []
        for chunk in _chunks(text_bytes(text)):
            for ids in memo.encode(chunk):
                names = ("piece", "start", "length", "ids_crc32")
                rows.append([dict(zip(names, p, strict=True)) for p in cut(ids + end, capacity)])
        return pa.array(rows, _PIECES_ARROW)

    return docs.select("doc_id", F.explode(piece_list("text")).alias("p")).select("doc_id", "p.*")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that these lengths need at least, by two families of dual-feasible functions."""
    sizes, counts = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    if not len(sizes):
        return 0
    best = -(-int(sizes @ counts) // capacity)
    for low in sizes[2 * sizes <= capacity]:  # over capacity - low: a bin; below low: nothing
        value = np.where(sizes > capacity - low, capacity, np.where(sizes < low, 0, sizes))
        best = max(best, -(-int(value @ counts) // capacity))
    for k in range(1, 33):  # rounded to multiples of 1/k, where (k + 1) * size is no multiple
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int(value @ counts) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of each piece, and what each bin has left."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[int] = []
    open_bins: list[tuple[int, int]] = []  # sorted by what is left
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        at = bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            left, b = open_bins.pop(at)
        else:
            left, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        free[b] = left - size
        if free[b]:
            insort(open_bins, (free[b], b))
    return bins, offsets, free


def pack_partition(lengths: np.ndarray, capacity: int, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and whether it stays there."""
    bins, offsets, free = best_fit(lengths, capacity)
    left = np.array(free, np.int64)
    keep = left * NEARLY <= capacity
    if last:
        keep[:] = True
    elif len(free) <= lower_bound(lengths, capacity):
        keep[:] = True
        keep[np.argmax(left)] = left.max() * NEARLY <= capacity
    return bins, offsets, keep[bins]


def _packer(round_: int, capacity: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("__row")
        bins, offsets, keep = pack_partition(group["length"].to_numpy(), capacity, last)
        first = (round_ << 56) + (group["__part"][0].as_py() << 24)
        sequence = pa.array(first + bins, pa.int64(), mask=~keep)
        group = group.drop_columns(["__part"])
        return group.append_column("sequence_id", sequence).append_column("offset", pa.array(offsets))

    return pack


def packed(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    partition_pieces: int = PARTITION_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The rows of pieces, which need a length, with sequence_id and offset.

    Sequences hold at most `capacity` tokens; offsets are gapless from 0. Every piece is
    placed once, equal rows included. An empty table gives an empty result. Each round is
    written to the shared folder, and a task sees one partition of pieces.
    """
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", LONG), T.StructField("offset", LONG)])
    names = pieces.columns
    pool = stored(pieces.select("*", F.monotonically_increasing_id().alias("__row")), "pieces")
    done = []
    for r in range(rounds):
        parts = max(1, -(-pool.count() // partition_pieces))
        last = parts == 1 or r == rounds - 1

        row = T.StructField("__row", LONG)
        fields = T.StructType([*pieces.schema, row, *schema.fields[-2:]])
        part = F.pmod(F.xxhash64("__row", F.lit(r)), F.lit(parts)).alias("__part")
        out = stored(pool.select("*", part).groupBy("__part").applyInArrow(_packer(r, capacity, last), fields), "packed")
        done.append(out.filter(F.col("sequence_id").isNotNull()).select(*names, "sequence_id", "offset"))
        if last:
            break
        pool = out.filter(F.col("sequence_id").isNull()).select(*names, "__row")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Documents as packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed(pieces(docs, tokenizer))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as packed pieces."""
    return packed_documents(docs)
