import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellermill.llm import toxicity
from tests.llm.conftest import ODD


def corpus():
    rnd = random.Random(1)
    plain = ["river", "stone", "market", "window", "garden", "letter", "summer", "bread"]
    stems, ends = ["gruk", "vlaz"], ["", "en", "ost", "ila", "um"]
    docs, labels = [], []
    for k in range(400):
        toxic = int(k % 4 == 0)
        words = rnd.choices(plain, k=60)
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(stems) + rnd.choice(ends)
        docs.append((k, " ".join(words).title()))
        labels.append((k, toxic))
    return docs, labels


def test_held_out_documents(spark, make_docs):
    rows, labels = corpus()
    docs, marks = make_docs(rows + ODD), spark.createDataFrame([*labels, (None, 1), (9999, 0), (4, None)], "doc_id long, toxic int")
    scored = toxicity.with_toxicity(docs, toxicity.learn(docs, marks)).withColumn("out", toxicity.held_out(F.col("doc_id")))
    found = scored.collect()
    assert len(found) == len(rows) + len(ODD)
    truth = dict(labels)
    apart = [(r["toxicity"]["predicted"], truth[r["doc_id"]]) for r in found if r["out"] and r["doc_id"] in truth and len(r["text"] or "") > 100]
    assert len(apart) > 100 and np.mean([p == t for p, t in apart]) > 0.97
    assert all(0 <= r["toxicity"]["score"] <= 1 for r in found)
    assert all(r["toxicity"]["predicted"] == 0 for r in found if not (r["text"] or "").strip())


def test_held_out_labels_change_nothing(spark, make_docs):
    rows, labels = corpus()
    docs = make_docs(rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    other = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(docs, marks), toxicity.learn(docs, other)
    assert (a.offset, a.slope, a.unit) == (b.offset, b.slope, b.unit)
    for x, y in ((a.seen, b.seen), (a.context, b.context)):
        assert np.array_equal(x.keys, y.keys) and np.array_equal(x.values, y.values)


def plain_shared(grams, suffix):
    """Kneser-Ney probability of the last letter of a text behind the others, by its definition."""
    letters = {g[-1] for g in grams}
    if len(suffix) == 0:
        return 1 / (len(letters) + 1)
    # How many letters are seen before each sequence of this length.
    longer = {g[-len(suffix) - 1 :] for g in grams}
    counts = Counter(g[1:] for g in longer)
    one, two = (sum(n == k for n in counts.values()) for k in (1, 2))
    d = min(max(one / (one + 2 * two), 0.1), 0.9) if one else 0.5
    own = {g: n for g, n in counts.items() if g[:-1] == suffix[:-1]}
    total = sum(own.values())
    below = plain_shared(grams, suffix[1:])
    if not total:
        return below
    return max(own.get(suffix, 0) - d, 0) / total + d * len(own) / total * below


def test_models_by_their_definition(monkeypatch):
    monkeypatch.setattr(toxicity, "CONTEXT", 3)
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcé", k=rnd.randint(1, 6))) for _ in range(60)]
    counts = ({}, {})
    for k, w in enumerate(words):
        padded = "\x02" * 3 + w + "\x03"
        for j in range(len(w) + 1):
            g = padded[j : j + 4]
            counts[k % 2][g] = counts[k % 2].get(g, 0) + 1
    grams = sorted(set(counts[0]) | set(counts[1]))
    rows = toxicity._codes(grams, 4)
    below = toxicity.shared_probabilities(rows)
    assert below == pytest.approx([plain_shared(grams, g[1:]) for g in grams])

    def plain(own, gram):
        one, two = (sum(n == k for n in own.values()) for k in (1, 2))
        d = min(max(one / (one + 2 * two), 0.1), 0.9) if one else 0.5
        after = {g: n for g, n in own.items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return plain_shared(grams, gram[1:])
        return max(own.get(gram, 0) - d, 0) / total + d * len(after) / total * plain_shared(grams, gram[1:])

    model = toxicity.build(grams, *(np.array([c.get(g, 0) for g in grams]) for c in counts))
    found, known = model.seen.get(rows)
    assert known.all()
    assert found == pytest.approx([math.log(plain(counts[1], g)) - math.log(plain(counts[0], g)) for g in grams], abs=1e-5)
    got = model.words(["ab", "zzz", "éa"])
    assert len(got) == 3 and np.isfinite(got).all()
    rows, starts = toxicity.spelled(["ab", "", "éa"], 3)
    assert ["".join(map(chr, r)) for r in rows] == [
        "\x02\x02\x02a", "\x02\x02ab", "\x02ab\x03", "\x02\x02\x02\x03", "\x02\x02\x02é", "\x02\x02éa", "\x02éa\x03"
    ]
    assert starts.tolist() == [0, 3, 4]


def test_given_labels_held_out(spark):
    """Recall and precision on labelled documents that the model has not seen, sf0.1."""
    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("no test data")
    scored = toxicity.op9(spark, str(folder)).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    pairs = [tuple(r) for r in scored.join(labels, "doc_id").select("predicted", "toxic").collect()]
    found = Counter(pairs)
    assert found[1, 1] / (found[1, 1] + found[0, 1]) > 0.88
    assert found[1, 1] / (found[1, 1] + found[1, 0]) > 0.88


def test_without_one_label(spark, make_docs):
    docs = make_docs([(1, "a b c"), (2, None), (3, "long " * 200_000)]).withColumn("of", F.lit(1)).withColumn("x", F.lit(2)).withColumn("toxicity", F.lit(3))
    for rows in ([], [(1, 0)]):
        model = toxicity.learn(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert all(r["toxicity"]["score"] < 0.01 for r in toxicity.with_toxicity(docs, model).collect())
    assert toxicity.with_toxicity(docs.limit(0), model).count() == 0
