import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tellermill.llm import quality
from tests.llm.conftest import ODD


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_counts():
    rnd = random.Random(1)
    texts = [t for _, t in ODD]
    for _ in range(60):
        texts.append("".join(rnd.choice(["a", "b", "é#", "<x>"]) + rnd.choice([" ", "\n", "\t", "  "]) for _ in range(rnd.randint(0, 60))))
    for t in texts:
        assert quality.counts_of((t or "").encode())[:5] == brute(t), t


def test_buckets_bound_the_error(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123_456, 10**12]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for v, b in df.select("v", quality.sketch_bucket(F.col("v"))).collect():
        assert b <= v <= b + b // 32
        if v < 64:
            assert b == v


def corpus():
    rnd = random.Random(2)
    words = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in ("r", "nta", "st")]
    rows = []
    for k in range(400):
        text = " ".join(rnd.choices(words, k=rnd.randint(40, 120)))
        if k % 20 == 0:
            text = text.upper().replace(" ", "!! ")
        elif k % 20 == 1:
            text = text.replace(" ", " ### ")
        rows.append((k, text, ("en", None)[k % 2], ("a", "b", None)[k % 3], 0))
    return rows


def test_junk_goes_and_prose_stays(spark, make_docs, tmp_path):
    docs = make_docs(corpus())
    for name in ("fence", "of", "counts", "of_lang", "of_source", "level", "bucket", "quality", "quality_"):
        docs = docs.withColumn(name, F.lit(name))
    got = {r["doc_id"]: r["quality"] for r in quality.with_quality(docs).collect()}
    assert len(got) == 400
    assert [k for k, q in got.items() if not q["kept"]] == [k for k in got if k % 20 < 2]
    kept = quality.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == 360
    assert kept.filter("fence = 'fence' and of = 'of' and quality = 'quality'").count() == 360


def test_thresholds_follow_the_group(spark, make_docs):
    """What is usual in one source is an outlier in another."""
    rnd = random.Random(4)
    rows = []
    for k in range(400):
        words = [rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randint(0, 99)) for _ in range(60)]
        marked = k < 200 or k == 300
        rows.append((k, " ".join(w + "*" if marked else w for w in words), "en", "code" if k < 200 else "news", 0))
    got = {r["doc_id"]: r["quality"]["kept"] for r in quality.with_quality(make_docs(rows)).collect()}
    assert [k for k, kept in got.items() if not kept] == [300]


def test_odd_rows(make_docs):
    docs = make_docs(ODD)
    found = quality.with_quality(docs).collect()
    assert len(found) == len(ODD)
    assert all(r["quality"]["base_failed"] and not r["quality"]["kept"] for r in found)
    assert quality.with_quality(docs.limit(0)).count() == 0


def fence_rows(docs):
    rows = docs.select("lang", "source", quality._counts("text").alias("counts"))
    return {(r["of_lang"], r["of_source"]): r["fence"].asDict(True) for r in quality.fences(rows).collect()}


def test_small_groups_move_gradually(make_docs):
    """No count of documents is a step: each further one of a source shifts its fences a little."""
    rnd = random.Random(5)
    rows = [(k, " ".join("x" * rnd.randint(3, 7) for _ in range(50)), "en", "big", 0) for k in range(1500)]
    more = [(2000 + k, " ".join("x" * rnd.randint(9, 13) for _ in range(50)), "en", "new", 0) for k in range(300)]
    lows = [fence_rows(make_docs(rows + more[:n]))["en", "new"]["word_length"]["low"] for n in (1, 20, 99, 100, 101, 300)]
    assert lows[0] < lows[1] < lows[2] < lows[5] and lows[5] - lows[0] > 2000
    assert abs(lows[3] - lows[2]) < 60 and abs(lows[4] - lows[3]) < 60


def test_fences_come_from_the_group(make_docs):
    """Sources with other habits and other lengths have other fences, for every measure."""
    rnd = random.Random(6)
    rows = []
    for k in range(600):
        loud = k % 2 == 0
        words = ["".join(rnd.choices("abcde", k=rnd.randint(2, 9 if loud else 6))) for _ in range(rnd.randint(30, 40) * (6 if loud else 1))]
        if loud:
            words = [rnd.choice([w, w, w.upper(), w + "!", w + "#"]) for w in words]
            words = [w for w in words for _ in range(rnd.choice([1, 1, 1, 2]))]
        lines = [" ".join(words[j : j + 5]) for j in range(0, len(words), 5)]
        rows.append((k, "\n".join(lines), "en", "loud" if loud else "calm", 0))
    found = fence_rows(make_docs(rows))
    for m in quality.MEASURES:
        assert found["en", "loud"][m] != found["en", "calm"][m], m


def test_a_very_long_text():
    assert quality.counts_of(b"a b c d\n" * 250_000)[:5] == (1_000_000, 1_000_000, 0, 249_999, 1_000_000)
