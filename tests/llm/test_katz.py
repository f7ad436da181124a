import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tellermill.llm import katz
from tests.llm.conftest import ODD

END = None


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Plain:
    """The same model with dictionaries."""

    def __init__(self, docs):
        self.c, self.pairs = Counter(), Counter()
        for doc_id, text in docs:
            if not held(doc_id):
                t = tokens(text)
                self.c.update(t)
                self.pairs.update(zip([END, *t[:-1]], t, strict=True))
        self.n = sum(self.c.values())
        of = Counter(self.c.values())
        self.d1 = katz.discounts([0, *(of[r] for r in range(1, 7))])
        of2 = Counter(self.pairs.values())
        self.d2 = katz.discounts([0, *(of2[r] for r in range(1, 7))])
        free = sum((1 - self.d1[r]) * r * of[r] for r in range(1, 6))
        self.total = self.n if free else self.n + 1
        self.unknown = free / self.n if free else 1 / self.total
        self.after = {}
        for (h, w), r in self.pairs.items():
            self.after.setdefault(h, {})[w] = r

    def word(self, w):
        c = self.c[w]
        return (self.d1[c] if c <= 5 else 1) * c / self.total if c else self.unknown

    def pair(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.word(w)
        low = any(r <= 5 for r in seen.values())
        below = sum(seen.values()) + (not low)
        if w in seen:
            return (self.d2[seen[w]] if seen[w] <= 5 else 1) * seen[w] / below
        freed = 1 - sum((self.d2[r] if r <= 5 else 1) * r for r in seen.values()) / below
        return freed / (1 - sum(self.word(x) for x in seen)) * self.word(w)


def rows(n=120):
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 60)))) for k in range(n)]
    return [*docs, (500, "never seen words"), *ODD]


@pytest.mark.parametrize("sizes", [None, (200, 300, 4)])
def test_against_dictionaries(spark, make_docs, monkeypatch, sizes):
    docs = rows()
    if sizes:  # many chunks, many buckets, many split words; the workers get these by closure
        monkeypatch.setattr(katz, "BUCKET_ENTRIES", sizes[1])
    model = Plain(docs)
    got = [tuple(r) for r in katz.scores(make_docs(docs).repartition(5)).collect()]
    v = len(model.c)
    expected = []
    for doc_id, text in docs:
        t = tokens(text)
        base = sum(math.log10((model.c[w] + 1) / (model.n + v + 1)) for w in t)
        score = sum(math.log10(model.pair(h, w)) for h, w in zip([END, *t[:-1]], t, strict=True))
        expected.append((doc_id, held(doc_id), len(t), sum(model.c[w] > 0 for w in t), model.n, base, score))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_distributions_sum_to_one():
    model = Plain(rows())
    words = [*model.c, "an unknown word"]
    assert sum(map(model.word, words)) == pytest.approx(1)
    for h in [*model.after, "an unknown word"]:
        assert sum(model.pair(h, w) for w in words) == pytest.approx(1)


def test_pieces_of_the_count(spark, make_docs):
    assert katz.scores(make_docs([])).count() == 0
    only = katz.scores(make_docs([(2, "a b")] if held(2) else [(9, "a b")])).collect()
    assert len(only) == 1
    d = katz.discounts([0, 100, 30, 12, 6, 4, 3])
    assert np.all(d > 0) and np.all(d <= 1)
