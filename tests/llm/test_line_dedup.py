import random
import re

import pytest
from pyspark.sql import functions as F

from tellermill.llm import line_dedup
from tests.llm.conftest import ODD


def word_set(line):
    return frozenset(re.findall(r"[^\x20\x09-\x0D]+", line))


def brute(rows, similarity=(4, 5)):
    """Rows: doc_id, text, text_key. Every line against all earlier ones."""
    seen, out = [], {}
    for doc_id, text, key in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        if (doc_id, key) in out:
            continue
        kept, n, gone = [], 0, 0
        for line in (text or "").split("\n"):
            w = word_set(line)
            if not w:
                kept.append(line)
                continue
            n += 1
            if any(similarity[1] * len(w & v) >= similarity[0] * len(w | v) for v in seen):
                gone += 1
            else:
                kept.append(line)
            seen.append(w)
        out[doc_id, key] = (None if text is None else "\n".join(kept), n, gone)
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"v{k}" for k in range(30)]
    base = [[rnd.choice(words + [f"r{b}{k}" for k in range(9)]) for k in range(rnd.randint(1, 25))] for b in range(12)]
    rows = []
    for k in range(60):
        lines = []
        for _ in range(rnd.randint(0, 5)):
            line = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 3)):
                line[rnd.randrange(len(line))] = rnd.choice(words)
            rnd.shuffle(line)
            lines.append(rnd.choice(["", "  ", "\t"]) + "  ".join(line))
            if rnd.random() < 0.2:
                lines.append("")
        rows.append((k, "\n".join(lines)))
    return rows + ODD


def results(found):
    return sorted((repr(r["doc_id"]), repr(r["text"]), r["lines"]["n_lines"], r["lines"]["n_removed"]) for r in found)


def expected(keyed, similarity=(4, 5)):
    want = brute(keyed, similarity)
    return sorted((repr(d), repr(want[d, k][0]), *want[d, k][1:]) for d, _, k in keyed)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(make_docs, monkeypatch, seed):
    """Also with a shuffle in place of a broadcast, and with samples for shared words."""
    if seed > 1:
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(line_dedup, "GROUP_LINES", seed)
        monkeypatch.setattr(line_dedup, "SAMPLE", seed)
    docs = make_docs(corpus(seed))
    for name in ("lines", "kept", "id", "key", "of", "first", "word", "order", "__kept", "__id"):
        docs = docs.withColumn(name, F.lit("mine"))
    keyed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    found = line_dedup.without_repeated_lines(docs)
    assert found.columns == [*(c for c in docs.columns if c != "lines"), "lines"]
    got = found.collect()
    assert results(got) == expected(keyed) and {r["kept"] for r in got} == {"mine"}


@pytest.mark.parametrize("similarity", [(1, 2), (2, 3), (9, 10), (1, 1)])
def test_other_similarities(make_docs, similarity):
    docs = make_docs(corpus(4) + [(900, "a"), (901, "a b"), (902, "b c"), (903, "c d e"), (904, "c e")])
    keyed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    assert results(line_dedup.without_repeated_lines(docs, similarity).collect()) == expected(keyed, similarity)


def test_many_copies_make_few_pairs(make_docs, monkeypatch):
    """Thousands of slightly different copies: far fewer rows than their pairs, and whole results."""
    rnd = random.Random(9)
    base = [f"b{k}" for k in range(40)]
    rows = []
    for k in range(1500):
        line = list(base)
        for _ in range(3):
            line[rnd.randrange(40)] = f"x{rnd.randint(0, 10**6)}"
        rows.append((k, " ".join(line)))
    made = []
    verified = line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda d, s, pairs, q: made.append(pairs.count()) or verified(d, s, pairs, q))
    docs = make_docs(rows)
    keyed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    assert results(line_dedup.without_repeated_lines(docs).collect()) == expected(keyed)
    assert len(made) > 1 and sum(made) < 1500 * 1499 / 2 / 4


def test_pairs_grow_with_the_copies(make_docs, monkeypatch):
    """Groups of copies below GROUP_LINES: four times the copies make no more than six times the pairs."""
    rnd = random.Random(10)
    made = []
    verified = line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda d, s, pairs, q: made.append(pairs.count()) or verified(d, s, pairs, q))
    sums = []
    for copies in (200, 800):
        rows = []
        for k in range(copies):
            line = [f"b{j}" for j in range(40)]
            line[rnd.randrange(40)] = f"x{k}"
            rows.append((k, " ".join(line)))
        docs = make_docs(rows)
        keyed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
        assert results(line_dedup.without_repeated_lines(docs).collect()) == expected(keyed)
        sums.append(sum(made))
        made.clear()
    assert sums[1] <= 6 * sums[0]


def test_a_text_of_many_lines(make_docs):
    """A megabyte in one text: half of its lines repeat."""
    text = "\n".join(f"line {k % 15_000} of a long text" for k in range(30_000))
    got = line_dedup.without_repeated_lines(make_docs([(1, text + "\n"), (2, "own words here")])).collect()
    assert {r["doc_id"]: tuple(r["lines"]) for r in got} == {1: (30_000, 15_000), 2: (1, 0)}
    assert next(r["text"] for r in got if r["doc_id"] == 1) == text[: len(text) // 2 + 1].rsplit("\n", 1)[0] + "\n"


def test_stage_drops_documents_without_lines(spark, make_docs, tmp_path):
    docs = make_docs([(1, "a b c d e\nx y z"), (2, "a b c d e"), (3, "fresh words\na b c d e"), (4, "")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.stage(spark, docs, str(tmp_path)).collect()}
    assert got == {1: ("a b c d e\nx y z", 15), 3: ("fresh words", 11), 4: ("", 0)}
    assert line_dedup.without_repeated_lines(docs.limit(0)).count() == 0


def test_no_python_runs(make_docs):
    plan = line_dedup.without_repeated_lines(make_docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_steps_leave_no_shuffle_files(spark, make_docs):
    """What a step has shuffled is gone when the step has ended, so disk holds one step's at a time."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = disk.getAllBlocks()
        names = {blocks.apply(k).name() for k in range(blocks.size())}
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    docs = make_docs(corpus(5))
    docs.groupBy("text").count().collect()
    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    line_dedup.line_sets(docs, (4, 5))
    assert len(shuffled() - before) <= 1  # the count of rarity; two shuffles of the sets are gone
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_both_sides_share_a_shuffle(spark, make_docs):
    """The pairs of all open sets: the later side, without closed ones, reads the earlier side's shuffle."""
    slim = line_dedup.line_sets(make_docs(corpus(6)), (4, 5))
    rows = slim.select("id", "even", "odd", (F.col("id") % 3 > 0).alias("open"), "n", F.posexplode("prefix").alias("pos", "word"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many rows
    try:
        found = line_dedup._pairs_of_all(rows, (4, 5))
        got, want = found.collect(), line_dedup._pairs(rows, rows, (4, 5)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got and sorted(got) == sorted(want) and all(r["y"] % 3 for r in got)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]
