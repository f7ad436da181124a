import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellermill.llm import packing
from tests.llm.conftest import ODD

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


MEMO = packing._WordIds(public_tokenizers.path(packing.TOKENIZER))
TEXT = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abcAB '.,!é\n\t<|>stʼs🙂ſİς̸́")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_are_the_tokenizers(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(MEMO.tokenizer.to_str()) if not hasattr(test_ids_are_the_tokenizers, "t") else test_ids_are_the_tokenizers.t
    test_ids_are_the_tokenizers.t = t
    texts = [*texts, "a<|endoftext|>, B <|STARTOFTEXT|>."]
    got = list(MEMO.encode([x.encode() for x in texts]))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def fewest(sizes, capacity):
    """Least number of bins by trying everything."""
    best = [len(sizes)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                put(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1 :])
        put(i + 1, [*bins, sizes[i]])

    put(0, [])
    return best[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_bound_never_exceeds_the_best(sizes):
    lengths = np.array(sizes, np.int64)
    bins, offsets, free = packing.best_fit(lengths, 20)
    assert packing.lower_bound(lengths, 20) <= fewest(sorted(sizes, reverse=True), 20) <= len(free)
    for b in range(len(free)):
        own = sorted(zip(offsets[bins == b], lengths[bins == b], strict=True))
        assert [o for o, _ in own] == list(np.cumsum([0, *(x for _, x in own)]))[:-1]


def test_bound_beats_the_sum():
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3
    assert packing.lower_bound(np.array([7, 7, 7, 7, 7, 7]), 20) == 3


@pytest.mark.parametrize("partition_pieces", [40, 16_384])
def test_packing(make_docs, tokenizer, partition_pieces):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choices(["ab", "Cde,", "f.", "ñandú"], k=rnd.choice([3, 200, 900, 2500, 6000])))) for k in range(250)]
    rows += ODD
    docs = make_docs(rows).withColumn("piece", F.lit("mine"))
    got = packing.packed(packing.pieces(docs), partition_pieces=partition_pieces).collect()
    expected = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(-(-len(ids) // 4096)):
            part = ids[4096 * k : 4096 * (k + 1)]
            expected.append((doc_id, k, 4096 * k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((tuple(r)[:5]) for r in got), key=repr) == sorted(expected, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    bound = packing.lower_bound(np.array([r["length"] for r in got]), 4096)
    assert len(bins) <= bound + (1 if partition_pieces > 40 else 3)
    assert packing.packed_documents(docs.limit(0)).count() == 0


def test_words_that_are_forgotten_are_learned_again(tokenizer, monkeypatch):
    """Little memory changes no ids; blank ends, odd letters and special tokens included."""
    monkeypatch.setattr(packing, "_MEMO_BYTES", 2000)
    memo = packing._WordIds(public_tokenizers.path(packing.TOKENIZER))
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(300)] + ["été,", "İstanbul", "ﬀ!", "क़लम", "ΟΔΟΣ", "<|endoftext|>.", "l'eau", "a_b", "..."]
    for _ in range(20):
        texts = ["".join(rnd.choice(words) + rnd.choice([" ", "\n", "\t \v", "\f\r"]) for _ in range(rnd.randint(0, 80))) for _ in range(9)]
        texts += ["", " ", " lead", "trail "]
        got = [np.frombuffer(g, "<u4").tolist() for g in memo.encode([t.encode() for t in texts])]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert memo.size < 2000 + 120_000


def test_a_text_of_a_megabyte(tokenizer):
    texts = ["x" * 100_000, "word " * 200_000, "é," * 50_000, "1 2 " * 100_000]
    got = [np.frombuffer(g, "<u4").tolist() for g in MEMO.encode([t.encode() for t in texts])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(MEMO.encode([])) == []
