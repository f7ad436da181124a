import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tellermill.llm import simhash
from tellermill.llm.graph import components
from tests.llm.conftest import ODD


def plain_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", low)]
    if not w:
        return 0
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint(make_docs):
    texts = [t for _, t in ODD] + ["a b c d", "A b  c\nD a b c d", "a b"]
    for t in texts:
        assert simhash.fingerprint((t or "").encode()) == plain_print(t)


def test_fingerprint_uses_the_same_hash_as_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("ab é"))).first()[0]
    assert xxhash.xxh64_intdigest("ab é".encode(), 42) == row % (1 << 64)


def near_classes(values, distance):
    root = list(range(len(values)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                root[up(i)] = up(j)
    return [up(i) for i in range(len(values))]


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
@pytest.mark.parametrize("task_prints", [10, 1000])
def test_trie_join_loses_no_link(spark, distance, task_prints):
    rnd = random.Random(distance)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(20):
        centre = rnd.getrandbits(64)
        values.add(centre)
        for _ in range(8):  # a chain and a cloud around it
            v = centre
            for _ in range(rnd.randint(0, 5)):
                v ^= 1 << rnd.randint(0, 63)
            values.add(v)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "print long")
    found = {r["node"]: r["root"] for r in components(simhash.linked(df, distance, task_prints)).collect()}
    own = [found.get(v, v) for v in signed]
    brute = near_classes(values, distance)
    assert len(set(zip(own, brute, strict=True))) == len(set(own)) == len(set(brute))


def test_components_of_a_long_chain(spark):
    rows = [(k, k + 1) for k in range(200)] + [(500, 400), (400, 400), (None, 3)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), 500: 400, 400: 400}


def test_groups_and_stage(spark, make_docs, tmp_path):
    long = " ".join(f"word{k}" for k in range(400))
    rows = [(10, long), (12, long), (11, long.replace("word7 ", "other ")), (20, "quite another text of its own"), *ODD]
    docs = make_docs(rows).withColumn("root", F.lit("mine"))
    found = simhash.near_duplicates(docs)
    prints = [plain_print(t) for _, t in rows]
    classes = near_classes(prints, 2)
    expected = []
    for (doc_id, _), p, c in zip(rows, prints, classes, strict=True):
        ids = [d for (d, _), other in zip(rows, classes, strict=True) if other == c and d is not None]
        expected.append((doc_id, p, min(ids, default=None)))
    got = [(r["doc_id"], r["print"] % (1 << 64), r["component_id"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    kept = simhash.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert kept.count() == len(set(classes))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_stage_with_clashing_names(make_docs, tmp_path):
    docs = make_docs([(1, "a b c d"), (2, "a b c d"), (3, "other words in here"), (3, "other words in here")])
    for name in ("__root", "__id", "__key", "first", "count", "root", "print"):
        docs = docs.withColumn(name, F.lit(name))
    kept = simhash.stage(docs.sparkSession, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["__root"], r["__id"]) for r in kept.collect()) == [(1, "__root", "__id"), (3, "__root", "__id")]
