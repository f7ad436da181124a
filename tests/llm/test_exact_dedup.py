import hashlib
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellermill.llm import exact_dedup
from tests.llm.conftest import ODD, SCHEMA


def body(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for k, (doc_id, text) in enumerate(rows):
        groups.setdefault(body(text), []).append((doc_id is None, doc_id or 0, k))
    out = []
    for text, members in groups.items():
        first = min(members)
        for m in members:
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((None if m[0] else m[1], None if first[0] else first[1], len(members), m == first, digest))
    return Counter(out)


def corpus(seed):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["a  b", "a b", "a\tb", "common\n text", f"t{rnd.randint(0, 60)}", f"own {k}"])) for k in range(1500)]
    rnd.shuffle(rows)
    return rows + ODD


def results(found):
    return Counter(tuple(r) for r in found.select("doc_id", "copies.*").collect())


def test_against_brute_force(make_docs):
    rows = corpus(1)
    assert results(exact_dedup.with_copies(make_docs(rows).repartition(5))) == brute(rows)


def test_only_shuffled_or_only_broadcast(make_docs, monkeypatch):
    """The same groups whether no text or every text counts as frequent."""
    rows = corpus(2)
    docs = make_docs(rows)
    monkeypatch.setattr(exact_dedup, "SHARES", 1)
    assert results(exact_dedup.with_copies(docs)) == brute(rows)
    monkeypatch.setattr(exact_dedup, "SHARES", 1 << 20)
    assert results(exact_dedup.with_copies(docs)) == brute(rows)


def test_frequent_texts_are_found(spark, make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARES", 4)
    rows = [(k, "hot text" if k % 3 == 0 else f"text {k}") for k in range(9000)]
    digests = make_docs(rows).select(F.unhex(F.sha2("text", 256)).alias("digest")).repartition(7)
    found = {bytes(r["digest"]) for r in exact_dedup.frequent(digests, 9000).collect()}
    assert found == {hashlib.sha256(b"hot text").digest()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=40), max_size=8), st.integers(1, 6))
def test_summary_bounds(parts, size):
    """Merged summaries stay below the true counts by n / (size + 1) at most."""
    merged = exact_dedup.Summary(size)
    for part in parts:
        own = exact_dedup.Summary(size)
        own.add(Counter(part))
        assert len(own.low) <= size
        merged.add(own.low)
    true = Counter(x for part in parts for x in part)
    n = sum(true.values())
    assert len(merged.low) <= size
    for key, count in true.items():
        assert count - n / (size + 1) <= merged.low.get(key, 0) <= count


def test_other_columns_stay(spark, make_docs):
    docs = make_docs([(2, "x y"), (1, "x  y"), (3, "z")])
    for name in ("copies", "own", "of", "id", "row", "digest", "no_id", "first", "n", "kept"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for r in docs.filter("doc_id <> 2").collect()}
    rest = [c for c in docs.columns if c != "copies"]
    assert exact_dedup.with_copies(docs).columns == [*rest, "copies"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.with_copies(docs).count() == 0
    assert exact_dedup.without_copies(docs).count() == 0
