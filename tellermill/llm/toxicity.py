"""Toxicity by two Kneser-Ney models of word spelling, one for each label.

Each model predicts the letters of a word from the eight before. Only these longest counts
belong to a label; below them both models back off to the same Kneser-Ney counts, so a
rare expression, which neither has seen, is equally likely in both. A toxic text is taken
as an ordinary one in which one word in 200 comes from the toxic model instead, so that
differences in subject or language between the labels count for little. A document's
score compares its two log-likelihoods for each word.

Sequences of letters are rows of code points and the models sorted arrays of 64-bit hashes,
so a model of a million sequences takes 12 MB.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellermill.llm.common import DOUBLE, INT, LONG, STRING, alnum_words, struct, table, text_bytes

#: Letters before the predicted one.
CONTEXT = 8
#: Labelled rows of each label that the models learn from: those of the least hash.
TRAIN_ROWS = 4_000
#: One in so many of them is kept apart to turn the comparison into a probability.
CALIBRATION = 4
THRESHOLD = 0.7
#: Share of a toxic text's words that the toxic model writes.
MIXTURE = 0.005
#: Words added to a text's length, so that one rare word does not decide a very short text.
EXTRA_WORDS = 30
_START, _END = "\x02", "\x03"
_MEMO_WORDS = 400_000
_LEARN_WORDS = 20_000
_TEXTS = 256


def _codes(texts: Sequence[str], width: int) -> np.ndarray:
    """Code points of texts of one length, a row for each."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), width)


def spelled(words: Sequence[str], context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """Every letter and the end of each word behind its context, as rows of code points; and
    where the rows of each word begin."""
    padded = [_START * context + w + _END for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate(([0], np.cumsum(lengths)))
    first = np.concatenate(([0], np.cumsum(lengths + context)))[:-1]
    rows = np.repeat(first - starts[:-1], lengths) + np.arange(starts[-1])
    return np.lib.stride_tricks.sliding_window_view(codes, context + 1)[rows], starts[:-1]


def _hashed(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row, the same in every process."""
    h = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _unique(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows, and for each given row its number among them."""
    width = rows.shape[1]
    if not width:
        return rows[:1], np.zeros(len(rows), np.int64)
    whole = np.ascontiguousarray(rows).view([("", np.uint32)] * width).ravel()
    found, back = np.unique(whole, return_inverse=True)
    return found.view(np.uint32).reshape(-1, width), back


def _discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2), kept inside (0, 1)."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return min(max(one / (one + 2 * two), 0.1), 0.9) if one else 0.5


def _interpolated(counts: np.ndarray, before: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of sequences from their counts, contexts and shorter probabilities; and
    for each context the share that it leaves to the shorter ones (1 if it has no counts)."""
    discount = _discount(counts)
    total = np.bincount(before, counts)
    kinds = np.bincount(before, counts > 0)
    known = total > 0
    left = np.where(known, discount * kinds / np.where(known, total, 1), 1.0)
    own = np.maximum(counts - discount, 0) / np.where(known, total, 1)[before]
    return own + left[before] * below, left


def shared_probabilities(grams: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of the last letter of each different row behind all but its first.

    The count of a shorter sequence is the number of different letters seen before it.
    """
    if grams.shape[1] == 1:
        return np.full(len(grams), 1 / (len(grams) + 1))  # as likely as a letter that never occurred
    shorter, back = _unique(grams[:, 1:])
    below = shared_probabilities(shorter)
    _, before = _unique(shorter[:, :-1])
    found, _ = _interpolated(np.bincount(back), before, below)
    return found[back]


@dataclass
class Table:
    """Numbers by hashed key."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, values: np.ndarray) -> Table:
        keys = _hashed(rows)
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], values[order].astype(np.float32))

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of rows, and which of them are known."""
        if not len(self.keys):
            return np.zeros(len(rows)), np.zeros(len(rows), bool)
        wanted = _hashed(rows)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = self.keys[at] == wanted
        return np.where(known, self.values[at], 0.0).astype(float), known


@dataclass
class Model:
    """Differences of the two models' log-probabilities, and the calibration."""

    seen: Table
    context: Table
    offset: float = 0.0
    slope: float = 1.0
    unit: float = 1.0

    def words(self, words: Sequence[str]) -> np.ndarray:
        """Log-likelihood of each word in a toxic text less that in an ordinary one.

        Behind a known context an unknown letter gets the context's share of backing off
        in each model, times the same probability, which cancels out.
        """
        if not words:
            return np.zeros(0)
        rows, starts = spelled(words)
        found, known = self.seen.get(rows)
        found[~known] = self.context.get(rows[~known][:, :-1])[0]
        total = np.add.reduceat(found, starts)
        return np.log(1 - MIXTURE + MIXTURE * np.exp(np.minimum(total, 500.0)))

    def per_word(self, texts: Sequence[bytes], memo: dict[bytes, float]) -> np.ndarray:
        """Difference for each word of each text; 0 for a text without words."""
        split = [alnum_words(t) for t in texts]
        if len(memo) > _MEMO_WORDS:
            memo.clear()
        new = list(set().union(*split).difference(memo))
        for k in range(0, len(new), _LEARN_WORDS):
            part = new[k : k + _LEARN_WORDS]
            memo.update(zip(part, self.words([w.decode() for w in part]).tolist(), strict=True))
        return np.array([sum(map(memo.__getitem__, words)) / (len(words) + EXTRA_WORDS) for words in split])

    def score(self, per_word: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * np.arcsinh(np.asarray(per_word) / self.unit), -500, 500)))


def build(grams: Sequence[str], ordinary: np.ndarray, toxic: np.ndarray) -> Model:
    """The two models from different letter sequences and how often each label has them."""
    none = np.zeros((0, 1), np.uint32)
    if not len(grams) or not ordinary.any() or not toxic.any():
        return Model(Table.of(none, np.zeros(0)), Table.of(none, np.zeros(0)), offset=-30.0, slope=0.0)  # nothing to compare
    rows = _codes(grams, CONTEXT + 1)
    below = shared_probabilities(rows)
    contexts, before = _unique(rows[:, :-1])
    likely, left = zip(*(_interpolated(np.asarray(n), before, below) for n in (ordinary, toxic)), strict=True)
    return Model(
        Table.of(rows, np.log(likely[1]) - np.log(likely[0])),
        Table.of(contexts, np.log(left[1]) - np.log(left[0])),
    )


def calibrate(per_word: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Offset and slope of a logistic curve over the squashed comparison, by Newton steps, and
    the unit of that.

    Beyond the unit, the median size among ordinary texts, the comparison counts by its
    logarithm, so a few extreme texts don't set the slope. Labels weigh as the root of
    their rarity.
    """
    if not len(labels) or labels.min() == labels.max():
        return -30.0, 0.0, 1.0
    unit = float(np.median(np.abs(per_word[labels == 0]))) or 1.0
    squashed = np.arcsinh(per_word / unit)
    scale = np.std(squashed) or 1.0
    x = np.column_stack((np.ones(len(labels)), squashed / scale))
    weight = np.sqrt(np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (labels - p)) - ridge * len(labels) * beta
        curve = (x.T * (weight * p * (1 - p))) @ x + ridge * len(labels) * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1] / scale), unit


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letter sequences of a batch of labelled texts, with how often each occurs."""
    schema = pa.schema([("toxic", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])
    for batch in batches:
        words: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(text_bytes(batch["text"]), batch["toxic"].to_pylist(), strict=True):
            words[label].update(alnum_words(text))
        for label in (0, 1):
            grams: Counter = Counter()
            for word, n in words[label].items():
                padded = _START * CONTEXT + word.decode() + _END
                for k in range(len(padded) - CONTEXT):
                    grams[padded[k : k + CONTEXT + 1]] += n
            rows = {"toxic": [label] * len(grams), "gram": list(grams), "n": list(grams.values())}
            yield pa.RecordBatch.from_pydict(rows, schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """The model of the labelled documents that are not held out.

    At most `rows` documents of each label count, those with the least hash of the id, so
    the model has a bounded size. Labels other than 0 and 1, unlabelled documents and rows
    without id are left out. With only one label present every score is near zero.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64("doc_id"))
    parts = [known.filter(F.col("toxic") == label).orderBy("h", "doc_id").limit(rows) for label in (0, 1)]
    sample = docs.select("doc_id", "text").join(parts[0].unionAll(parts[1]), "doc_id")
    apart = F.pmod("h", F.lit(CALIBRATION)) == 0
    grams = (
        sample.filter(~apart)
        .select("text", "toxic")
        .mapInArrow(_counted, struct(toxic=INT, gram=STRING, n=LONG))
        .groupBy("gram")
        .agg(*(F.sum(F.when(F.col("toxic") == label, F.col("n")).otherwise(0)).alias(f"n{label}") for label in (0, 1)))
    )
    counts = grams.toArrow()  # bounded by the sample
    model = build(counts["gram"].to_pylist(), counts["n0"].to_numpy(), counts["n1"].to_numpy())
    if len(model.seen.keys):
        found = sample.filter(apart).select("toxic", per_word(model)(F.col("text")).alias("x")).collect()
        x, y = np.array([r["x"] for r in found]), np.array([r["toxic"] for r in found])
        model.offset, model.slope, model.unit = calibrate(x, y)
    return model


def per_word(model: Model):
    shared = SparkSession.active().sparkContext.broadcast(model)
    memo: dict[bytes, float] = {}

    @F.arrow_udf(DOUBLE)
    def compare(text: pa.Array) -> pa.Array:
        known = shared.value
        texts = list(text_bytes(text))
        parts = [known.per_word(texts[k : k + _TEXTS], memo) for k in range(0, len(texts), _TEXTS)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return compare


def with_toxicity(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """All rows and columns of docs, and a struct column (per_word, score, predicted).

    Only the text decides. A null, empty or wordless text compares as 0, neither likelier
    toxic nor ordinary, and gets the score of that. Texts of any length are read whole, and
    equal texts score alike. A column of the given name is replaced, other names may be
    anything. An empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c != name]
    rows = docs.select(F.struct(*(docs[c] for c in columns)).alias("of"), per_word(model)(docs["text"]).alias("x"))
    squashed = F.asinh(F.col("x") / F.lit(model.unit))
    value = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), model.offset + model.slope * squashed))))
    scored = rows.select("of", "x", value.alias("score"))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("of.*", F.struct(F.col("x").alias("per_word"), "score", predicted.alias("predicted")).alias(name))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = with_toxicity(docs, learn(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", "toxicity.predicted"
    )
