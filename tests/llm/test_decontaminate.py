import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tellermill.llm import decontaminate
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        ids = sorted(str(i) for i in found - {None})
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_against_all_windows(spark, make_docs, block_bytes):
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)] + ["ñandú", "Größe", "x9"]

    def text(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    items = [(k, text(rnd.randint(13, 60))) for k in range(12)]
    items += [(20, "short item here"), (21, "Größe"), (22, None), (23, "--"), (None, text(20)), (3, text(14)), (24, items[2][1])]
    docs = [(k, text(rnd.randint(0, 120))) for k in range(40)]
    for k in range(40, 60):
        source = words(items[k % 12][1])
        a = rnd.randint(0, len(source) - 12)
        part = source[a : a + rnd.randint(12, 14)]
        docs.append((k, text(rnd.randint(0, 300)) + " " + " ".join(part).upper() + " " + text(9)))
    docs += ODD
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.with_contamination(make_docs(docs), benchmark, block_bytes=block_bytes)
    got = [tuple(r) for r in found.select("doc_id", "contamination.*").collect()]
    assert sorted(got, key=repr) == brute(docs, items)


def test_empty_tables_and_other_columns(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs([(1, "a b c")]).withColumn("__key", F.lit("mine")).withColumn("hits", F.lit(7))
    found = decontaminate.with_contamination(docs, none)
    assert found.columns == [*docs.columns, "contamination"]
    assert found.first()["contamination"]["contaminated"] is False
    assert decontaminate.with_contamination(docs.limit(0), none).count() == 0


def test_clashing_names(spark, make_docs):
    """In one block and in several, a column of the name is replaced and others stay."""
    passage = " ".join(f"w{k}" for k in range(20))
    docs = make_docs([(1, passage), (2, "clean words only"), (2, "clean words only"), (None, None)])
    for name in ("__found", "__key", "__id", "__of", "hits", "key", "contamination"):
        docs = docs.withColumn(name, F.lit(name))
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    for more in ({}, {"block_bytes": 10}):
        found = decontaminate.with_contamination(docs, bench, **more)
        assert sorted(found.columns) == sorted(docs.columns)
        assert {r["__key"] for r in found.collect()} == {"__key"}
        assert sorted(r["contamination"]["contaminated"] for r in found.collect()) == [False, False, False, True]


def test_a_text_of_a_megabyte(spark, make_docs):
    passage = " ".join(f"w{k}" for k in range(40))
    docs = make_docs([(1, "x y z " * 150_000 + passage + " a" * 100_000)])
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    found = decontaminate.with_contamination(docs, bench).first()["contamination"]
    assert (found["n_words"], found["n_hit"], found["contaminated"]) == (550_040, 40, False)
