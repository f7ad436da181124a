"""Quality rules whose thresholds follow the data.

Each text is measured once. The measures of every language and source go into a quantile
sketch: a histogram whose buckets keep six significant bits, so a quantile is at most one
part in 32 too low, and sketches merge by adding counts. Fences around the quartiles
replace fixed cutoffs; documents are then joined with the fences of their group.

A fence is as far from the quartiles as a multiple of the group's spread: the distance of
its quartiles, or what one more occurrence changes in a short text of the group, whichever
is more. Both come from sketches. A group's figures are mixed with its language's, and
those with the figures of all, by numbers of documents; so a group gets its own thresholds
gradually as it grows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellermill.llm.common import (
    LONG,
    blank_words,
    covered,
    gram_hashes,
    hashes,
    stored,
    struct,
    table,
    text_bytes,
    unused,
)

REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A fence lies this many spreads outside the quartiles.
REACH = 8
#: The figures of the language count as much as so many documents of the group.
PRIOR = 20
#: A short text of a group: this percentage of its texts are not longer.
SHORT_PERCENT = 5
#: Measures in thousandths: a count and what it is a share of.
MEASURES = {
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "line_copies": ("n_dup_lines", "n_lines"),
    "word_runs": ("n_runs", "n_words"),
}
WHOLES = tuple(dict.fromkeys(whole for _, whole in MEASURES.values()))
#: Measures for which small values are suspicious as well.
TWO_SIDED = ("word_length",)
#: Significant bits of a sketch bucket.
BITS = 6

_SYMBOLS = b"#*$%&|<>"
_NOT_FIRST = bytes(range(0x80, 0xC0))  # later bytes of a UTF-8 character
_CAPITALS = bytes(range(65, 91))
_COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_capitals n_marks n_runs".split()
_COUNTS_TYPE = struct(**dict.fromkeys(_COUNTS, LONG))


def _count(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def _repeated_words(words: list[bytes], width: int) -> int:
    """Words in those windows that occur twice or more in the text."""
    if len(words) <= width:
        return 0
    x = hashes(words)
    grams = gram_hashes(x, width)
    order = np.argsort(grams, kind="stable")
    twin = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(twin):
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(x, width)
    twin = twin[(windows[order[twin]] == windows[order[twin + 1]]).all(axis=1)]
    starts = np.unique(np.concatenate((order[twin], order[twin + 1])))
    return int(covered(starts, width, len(x)).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """The counts named in _COUNTS."""
    words = blank_words(text)
    letters = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(letters.translate(None, _NOT_FIRST)),
        _count(text, _SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated_words(words, REPEAT_WINDOW),
        len(lines),
        _count(letters, _CAPITALS),
        _count(letters, b"!?"),
        sum(a == b for a, b in pairwise(words)),
    )


@F.arrow_udf(_COUNTS_TYPE)
def _counts(text: pa.Array) -> pa.Array:
    rows = np.array([counts_of(t) for t in text_bytes(text)], np.int64).reshape(-1, len(_COUNTS))
    return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], _COUNTS)


def _measure(name: str, c: Column) -> Column:
    part, whole = MEASURES[name]
    return F.floor(1000 * c[part] / F.greatest(c[whole], F.lit(1)))


def sketch_bucket(value: Column) -> Column:
    """Least value of the bucket: all bits after the leading six are cleared."""
    drop = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    scale = F.pow(F.lit(2), drop).cast("long")
    return value - F.pmod(value, scale)


def _percentile(percent: int) -> Column:
    """Of ranked buckets: the first that has so many of the group's documents up to it."""
    return F.min(F.when(100 * F.col("up_to") >= percent * F.col("total"), F.col("bucket")))


def fences(measured: DataFrame) -> DataFrame:
    """Lowest and highest accepted value of every measure, a row for each language and source.

    `measured` has lang, source and a struct `counts` for every document that counts. The
    columns are of_lang, of_source and a struct `fence`. Only bucket counts are shuffled,
    added up on the map side, so a hot source costs no more.
    """
    counts = F.col("counts")
    values = {m: _measure(m, counts) for m in MEASURES} | {w: counts[w] for w in WHOLES}
    entries = F.array(*(F.struct(F.lit(k).alias("measure"), sketch_bucket(v).alias("bucket")) for k, v in values.items()))
    sketches = (
        measured.select("lang", "source", F.explode(entries).alias("v"))
        .groupBy("lang", "source", "v.measure", "v.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A group's own sketch, its language's and the one of all, each a sum of sketches.
    levels = F.explode(F.array(*(F.lit(k) for k in range(3)))).alias("level")
    own_lang = F.when(F.col("level") < 2, F.col("lang")).alias("at_lang")
    own_source = F.when(F.col("level") < 1, F.col("source")).alias("at_source")
    keys = ["level", "at_lang", "at_source"]
    merged = sketches.select("*", levels).groupBy("level", own_lang, own_source, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumn("up_to", F.sum("n").over(whole.orderBy("bucket"))).withColumn("total", F.sum("n").over(whole))
    points = ranked.groupBy(*keys, "measure").agg(
        F.first("total").alias("total"), _percentile(SHORT_PERCENT).alias("short"), _percentile(25).alias("q1"), _percentile(75).alias("q3")
    )

    def of(measure: str, point: str) -> Column:
        return F.first(F.when(F.col("measure") == measure, F.col(point)), True).alias(f"{measure}_{point}")

    wanted = [(m, point) for m in MEASURES for point in ("q1", "q3")] + [(w, "short") for w in WHOLES]
    figures = points.groupBy(*keys).agg(F.first("total").alias("total"), *(of(*w) for w in wanted))

    groups = sketches.select("lang", "source").distinct().select("*", levels).select("*", own_lang, own_source)
    b = figures.alias("b")
    three = groups.join(b, reduce(Column.__and__, [groups[k].eqNullSafe(F.col(f"b.{k}")) for k in keys]))
    row = F.struct("b.total", *(F.col(f"b.{m}_{point}") for m, point in wanted))
    three = three.groupBy(groups["lang"].alias("of_lang"), groups["source"].alias("of_source")).agg(
        *(F.first(F.when(groups["level"] == k, row), True).alias(f"level{k}") for k in range(3))
    )

    def mixed(name: str) -> Column:
        """A figure of the group, of its language and of all, weighed by their documents."""
        value = F.col("level2")[name]
        for level in (F.col("level1"), F.col("level0")):
            value = F.floor((level["total"] * level[name] + PRIOR * value) / (level["total"] + PRIOR))
        return value

    limits = []
    for m, (_, whole_count) in MEASURES.items():
        q1, q3 = mixed(f"{m}_q1"), mixed(f"{m}_q3")
        one = F.floor(1000 / F.greatest(mixed(f"{whole_count}_short"), F.lit(1)))
        reach = REACH * F.greatest(q3 - q1, one)
        low = q1 - reach if m in TWO_SIDED else F.lit(0)
        limits.append(F.struct(low.cast("long").alias("low"), (q3 + reach).alias("high")).alias(m))
    return three.select("of_lang", "of_source", F.struct(*limits).alias("fence"))


def with_quality(docs: DataFrame, name: str = "quality", carry: Sequence[str] | None = None) -> DataFrame:
    """All rows of docs with a struct column of counts and the verdict.

    The struct has the counts, base_failed and kept. A text of fewer than 20 words, or more
    than 30 % of them in repeated 8-word windows, fails the base rule and is not kept; so a
    null, empty or blank text is never kept. Other documents are kept if every measure lies
    inside the fences of their language and source. A null language or source is a group
    like any other; equal rows are judged alike. Texts of any length are read whole, once:
    counts are stored with the columns named in `carry`, all by default. A column of the
    given name is replaced, other names may be anything. An empty table gives an empty result.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c != name]
    rows = docs.select(F.struct(*(docs[c] for c in carry)).alias("of"), "lang", "source", _counts("text").alias("counts"))
    rows = stored(rows, "counts")
    counts = F.col("counts")
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
    # Written first: its true size decides whether Spark sends it to all executors or shuffles.
    limits = stored(fences(rows.filter(~failed)), "fences")
    inside = [_measure(m, counts).between(F.col("fence")[m]["low"], F.col("fence")[m]["high"]) for m in MEASURES]
    verdict = ~failed & F.coalesce(reduce(Column.__and__, inside), F.lit(False))
    same = rows["lang"].eqNullSafe(limits["of_lang"]) & rows["source"].eqNullSafe(limits["of_source"])
    judged = rows.join(limits, same, "left")
    return judged.select("of.*", F.struct("counts.*", failed.alias("base_failed"), verdict.alias("kept")).alias(name))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return with_quality(docs, carry=["doc_id"]).select("doc_id", *(f"quality.{c}" for c in columns))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with all their columns; see with_quality for odd rows."""
    name = unused("quality", docs.columns)
    return with_quality(docs, name).filter(F.col(f"{name}.kept")).select(docs.columns)


_MEASURE_ROWS = ", ".join(f"('{m}', '{whole}', {str(m in TWO_SIDED).lower()})" for m, (_, whole) in MEASURES.items())
ORACLE = rf"""
with word as (
  select doc_id, lang, source, coalesce(text, '') t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
line as (
  select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from word),
gram as (
  select doc_id, i, count(*) over (partition by doc_id, list_slice(w, i, i + {REPEAT_WINDOW - 1})) c
  from word, unnest(range(1, len(w) - {REPEAT_WINDOW - 2})) g(i) where len(w) >= {REPEAT_WINDOW}),
hit as (
  select doc_id, count(distinct p) n from gram, unnest(range(i, i + {REPEAT_WINDOW})) h(p) where c > 1 group by 1),
counted as (
  select doc_id, lang, source, len(w) n_words, length(array_to_string(w, '')) word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols, len(l) - len(list_distinct(l)) n_dup_lines,
    coalesce(hit.n, 0) n_repeat_words, len(l) n_lines,
    length(regexp_replace(array_to_string(w, ''), '[^A-Z]', '', 'g')) n_capitals,
    length(regexp_replace(array_to_string(w, ''), '[^!?]', '', 'g')) n_marks,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) n_runs
  from word join line using (doc_id) left join hit using (doc_id)),
measured as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as failed,
    {{'word_length': 1000 * word_chars // greatest(n_words, 1), 'symbols': 1000 * n_symbols // greatest(n_words, 1),
      'capitals': 1000 * n_capitals // greatest(word_chars, 1), 'marks': 1000 * n_marks // greatest(n_words, 1),
      'line_copies': 1000 * n_dup_lines // greatest(n_lines, 1), 'word_runs': 1000 * n_runs // greatest(n_words, 1)}} m
  from counted),
long as (
  select doc_id, lang, source, failed, unnest(['word_length', 'symbols', 'capitals', 'marks', 'line_copies', 'word_runs',
      'n_words', 'word_chars', 'n_lines']) measure,
    unnest([m.word_length, m.symbols, m.capitals, m.marks, m.line_copies, m.word_runs, n_words, word_chars, n_lines])::bigint v
  from measured),
sketch as (
  select level, case when level < 2 then lang end lang, case when level < 1 then source end source, measure,
    v - v % (1::bigint << greatest(length(bin(v)) - {BITS}, 0)) bucket, count(*) n
  from long, (values (0), (1), (2)) levels(level) where not failed group by all),
ranked as (
  select *, sum(n) over (partition by level, lang, source, measure order by bucket) upto,
    sum(n) over (partition by level, lang, source, measure) total from sketch),
point as (
  select level, lang, source, measure, any_value(total)::bigint total, min(bucket) filter (where 100 * upto >= {SHORT_PERCENT} * total) short,
    min(bucket) filter (where 100 * upto >= 25 * total) q1, min(bucket) filter (where 100 * upto >= 75 * total) q3
  from ranked group by all),
of_language as (
  select l.lang, l.measure, (l.total * l.short + {PRIOR} * a.short) // (l.total + {PRIOR}) short,
    (l.total * l.q1 + {PRIOR} * a.q1) // (l.total + {PRIOR}) q1, (l.total * l.q3 + {PRIOR} * a.q3) // (l.total + {PRIOR}) q3
  from point l join point a on l.level = 1 and a.level = 2 and l.measure = a.measure),
mixed as (
  select g.lang, g.source, g.measure, (g.total * g.short + {PRIOR} * l.short) // (g.total + {PRIOR}) short,
    (g.total * g.q1 + {PRIOR} * l.q1) // (g.total + {PRIOR}) q1, (g.total * g.q3 + {PRIOR} * l.q3) // (g.total + {PRIOR}) q3
  from point g join of_language l on g.level = 0 and g.measure = l.measure and g.lang is not distinct from l.lang),
fence as (
  select q.lang, q.source, q.measure, two_sided, q.q1, q.q3, greatest(q.q3 - q.q1, 1000 // greatest(w.short, 1)) spread
  from mixed q join (values {_MEASURE_ROWS}) s(measure, whole, two_sided) using (measure)
    join mixed w on w.measure = s.whole and q.lang is not distinct from w.lang and q.source is not distinct from w.source),
judged as (
  select x.doc_id, x.measure,
    x.v between (case when two_sided then q1 - {REACH} * spread else 0 end) and q3 + {REACH} * spread as inside
  from long x join fence f on f.measure = x.measure and x.lang is not distinct from f.lang and x.source is not distinct from f.source
  where not x.failed),
verdict as (select doc_id, bool_and(inside) kept from judged group by 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed base_failed, coalesce(kept, false) kept
from measured left join verdict using (doc_id)
"""
