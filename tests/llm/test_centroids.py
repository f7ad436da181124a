import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellermill.llm import centroids
from tellermill.llm.common import ship

SCHEMA = "vec_id long, embedding array<double>"
LONGEST = (1 << 63) - 1


@pytest.fixture(scope="module")
def make_vectors(spark):
    ship(spark)
    return lambda rows, schema=SCHEMA: spark.createDataFrame(rows, schema)


def whole(x):
    return math.floor(x * 256) if abs(x) < 2.0**60 else int(x) * 256


def brute(rows, clusters, rounds):
    """Plain Python, one vector after the other."""
    kept = [
        (i, [whole(x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    means = [v for _, v in order[:clusters]]

    def place(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m, strict=True)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        at = [place(v)[1] for _, v in kept]
        for c in range(len(means)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == c]
            if mine:
                means[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    found = [(i, *place(v)) for i, v in kept]
    by = Counter()
    for _, far, c in found:
        by[c] += min(far, LONGEST)
    total = sum(by.values())
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return Counter((i, c, min(far, LONGEST), min(by[c], LONGEST), min(total, LONGEST), digest[c]) for i, far, c in found)


def corpus(seed, scale=1.0):
    rnd = random.Random(seed)
    base = [[rnd.uniform(-1, 1) for _ in range(64)] for _ in range(6)]
    rows = [(k, [x + rnd.gauss(0, 0.2) for x in rnd.choice(base)]) for k in range(150)]
    rows += [(1000 + k, base[0]) for k in range(60)]  # equal vectors
    rows = [(i, [x * scale for x in v]) for i, v in rows]
    odd = [None, [], [0.5] * 63, [0.5] * 65, [0.1] * 63 + [None], [0.1] * 63 + [math.nan], [math.inf] + [0.0] * 63]
    return rows + [(2000 + k, v) for k, v in enumerate(odd)] + [(None, [0.25] * 64), (3000, [0.0] * 64), (3001, [-0.0] * 64)]


def results(found):
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize(("seed", "scale"), [(1, 1.0), (2, 0.004), (3, 1e6)])
def test_against_plain_python(make_vectors, seed, scale):
    rows = corpus(seed, scale)
    found = centroids.clustered(make_vectors(rows).repartition(4), clusters=9, rounds=3)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert results(found) == brute(rows, 9, 3)


def test_components_beyond_64_bits(make_vectors):
    rnd = random.Random(4)
    rows = [(k, [rnd.choice([1.0, -1.0, 1e9, -3e12, 7e20, 1e30]) * rnd.random() for _ in range(64)]) for k in range(12)]
    rows += [(50, [1.7e308] + [0.0] * 63), (51, [-1.7e308] * 2 + [0.5] * 62)]
    found = centroids.clustered(make_vectors(rows), clusters=4, rounds=2)
    assert results(found) == brute(rows, 4, 2)


def test_fewer_vectors_than_centroids(make_vectors):
    rows = corpus(5)[:3] + [(7, None)]
    assert results(centroids.clustered(make_vectors(rows))) == brute(rows, 40, 5)
    assert results(centroids.clustered(make_vectors([(1, None)]))) == Counter()
    assert centroids.clustered(make_vectors([])).columns[0] == "vec_id"


def test_clusters_without_vectors_keep_their_centroid(make_vectors):
    rows = [(k, [0.5] * 64) for k in range(8)] + [(9, [3.0] * 64)]
    assert results(centroids.clustered(make_vectors(rows), clusters=5, rounds=3)) == brute(rows, 5, 3)


def test_extra_columns_and_single_floats(make_vectors):
    rows = corpus(6)[:40]
    docs = make_vectors(rows, "vec_id long, embedding array<float>")
    for name in ("id", "planes", "cluster", "distance", "inertia"):
        docs = docs.withColumn(name, F.lit("mine"))
    singles = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert results(centroids.clustered(docs, clusters=4, rounds=2)) == brute(singles, 4, 2)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**70), 2**70) | st.integers(-300, 300), min_size=64, max_size=64), min_size=2, max_size=4))
def test_planes_give_exact_products(rows):
    values = np.array(rows, object)
    packed = centroids.as_planes(centroids.planes(values))
    assert centroids.components(packed).tolist() == rows
    want = [[sum(x * y for x, y in zip(a, b, strict=True)) for b in rows] for a in rows]
    assert centroids.dots(packed, packed).tolist() == want


def test_narrow_products():
    values = np.random.default_rng(1).integers(-(2**27), 2**27, (20, 64))
    values[0], values[1], values[2] = 2**27 - 1, -(2**27), 0
    packed = centroids.as_planes(centroids.planes(values))
    assert packed.shape[1] == 28
    assert (centroids.dots(packed, packed) == values @ values.T).all()
    at, far = centroids.nearest(packed, packed, np.array([int(x) for x in (values * values).sum(axis=1)], object))
    assert (at == np.arange(20)).all() and (far == 0).all()
