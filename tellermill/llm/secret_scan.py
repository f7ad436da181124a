"""Secret scan: fixed patterns, and entropy in sliding windows over candidate strings."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import LONG, STRING, struct, table, text_bytes

ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same as longer runs, as a run is matched from its start
#: Words without one of which no assignment can match; cheap to look for in bytes.
_HINTS = (b"passw", b"secret", b"token", b"key")

WINDOW = 20
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
#: Character classes of a candidate, tried in this order, and the least entropy in bits of
#: a window that makes it a secret: what all but about 1 % of random strings over the class
#: reach. A window of 20 has 4.32 bits at most; 20 random letters of one case have 3.68 on
#: average, of both cases 3.98, so letters are held to what one case reaches. The class with
#: digits is set for both cases; 20 digits and letters of one case reach it in three of four.
LETTERS_LEAST = 3.2
CLASSES = (
    ("entropy_hex", re.compile(rb"[0-9a-fA-F]+"), 2.9),
    ("entropy_letters", re.compile(rb"[^0-9]+"), LETTERS_LEAST),
    ("entropy_mixed", re.compile(rb".+"), 3.7),
)
#: Words reach that entropy as well. They are told by their letter pairs: the letters that
#: follow each letter in English, German, French and Spanish words.
FOLLOWERS = {
    "a": "bcdfgiklmnprstuvwy", "b": "aeilorsuy", "c": "aehikloqrstuy", "d": "adeiorsuy", "e": "abcdefgilmnprstuvwxy",
    "f": "aefilortu", "g": "aeghilnorsu", "h": "aeilnortu", "i": "abcdefgklmnoprstvz", "j": "aeou", "k": "aeilnorstu",
    "l": "adefiklmostuvy", "m": "abeimopsuy", "n": "acdefgiknostuvyz", "o": "abcdfgilmnoprstuvwy", "p": "aefhiloprstu",
    "q": "u", "r": "acdefgiklmnorstuvy", "s": "acehiklmnopqstuwy", "t": "aehilorstuwyz", "u": "abcdefgilmnprstz",
    "v": "aeiou", "w": "aehinorsu", "x": "aceipt", "y": "aeilmnopst", "z": "aeiotuwz",
}
#: A window without digits reads as words if fewer of its letter pairs, in percent, are others.
ODD_PERCENT = 30
KINDS = ("assign", "access", "hex", *(name for name, _, _ in CLASSES))
#: Candidates that look random or long but are no secrets.
ALLOWED = (
    rb"[0-9]+",  # plain numbers
    rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # identifiers by the UUID scheme
    rb"[=_+/-]+",  # ruled lines
    rb"[0-9]{4}-[0-9]{2}-[0-9]{2}[-_T0-9]*",  # dates
)
#: Stand-ins in documentation. They clear the part between / and = that they are in.
STAND_IN = re.compile(rb"(?i:example|sample|placeholder|changeme|x{6})")
_PART = re.compile(rb"[^/=]+")

_SPAN = T.ArrayType(struct(kind=STRING, start=LONG, end=LONG))
_PAIRS = {(a + b).encode() for a, after in FOLLOWERS.items() for b in after}
_LOGS = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def window_entropies(text: bytes, width: int = WINDOW) -> Iterator[float]:
    """Shannon entropy of each window in bits; moving on changes two counts."""
    counts, weight = [0] * 256, 0.0
    for i, c in enumerate(text):
        weight += _LOGS[counts[c] + 1] - _LOGS[counts[c]]
        counts[c] += 1
        if i >= width - 1:
            yield log2(width) - weight / width
            old = text[i - width + 1]
            weight += _LOGS[counts[old] - 1] - _LOGS[counts[old]]
            counts[old] -= 1


def _running(flags: Iterable[bool]) -> list[int]:
    return [0, *accumulate(flags)]


def _wordlike(word: bytes) -> Callable[[int], bool]:
    """Whether the window from a place on has no digit and reads as words."""
    low = word.lower()
    pairs = [low[i : i + 2] for i in range(len(low) - 1)]
    digits = _running(48 <= c <= 57 for c in low)
    letters = _running(p.isalpha() for p in pairs)
    odd = _running(p.isalpha() and p not in _PAIRS for p in pairs)

    def test(i: int) -> bool:
        end = i + WINDOW
        return digits[end] == digits[i] and 100 * (odd[end - 1] - odd[i]) < ODD_PERCENT * (letters[end - 1] - letters[i])

    return test


def entropy_spans(text: bytes, allowed: re.Pattern[bytes]) -> Iterator[tuple[str, int, int]]:
    """Joined windows of enough entropy, as byte offsets.

    Windows without digits are held to the threshold of letters in every candidate. A window
    is left out if it reads as words, or touches a part between / and = with a stand-in.
    """
    for found in CANDIDATE.finditer(text):
        word = found[0]
        if allowed.fullmatch(word):
            continue
        kind, _, least = next(c for c in CLASSES if c[1].fullmatch(word))
        cleared = [m.span() for m in _PART.finditer(word) if STAND_IN.search(m[0])]
        wordlike = _wordlike(word)
        start = end = None
        near = 0  # parts before this one end before the window
        for i, entropy in enumerate(window_entropies(word)):
            if entropy < min(least, LETTERS_LEAST):
                continue
            if kind != "entropy_hex":
                if wordlike(i) or entropy < least and any(48 <= c <= 57 for c in word[i : i + WINDOW]):
                    continue
            while near < len(cleared) and cleared[near][1] <= i:
                near += 1
            if near < len(cleared) and cleared[near][0] < i + WINDOW:
                continue
            if end is not None and i > end:
                yield kind, found.start() + start, found.start() + end
                start = None
            start, end = i if start is None else start, i + WINDOW
        if end is not None:
            yield kind, found.start() + start, found.start() + end


def spans_of(text: bytes, allowed: re.Pattern[bytes]) -> list[tuple[str, int, int]]:
    """All spans in code points, by start and then kind."""
    low = text.lower()
    base = []
    if any(h in low for h in _HINTS):
        base += [("assign", *m.span()) for m in ASSIGN.finditer(text.decode()) if len(m[1]) >= 6]
    if b"AKIA" in text:
        base += [("access", *m.span()) for m in ACCESS.finditer(text.decode()) if len(m[0]) >= 20]
    extra = list(entropy_spans(text, allowed))
    if extra or re.search(rb"[0-9a-f]{24}", text):
        base += [("hex", *m.span()) for m in HEX.finditer(text.decode())]
    found = list(base)
    starts = sorted((s, e) for _, s, e in base)
    reach = list(accumulate((e for _, e in starts), max))  # of the base spans up to each
    byte = place = 0
    for kind, start, end in extra:  # in order, so each part of the text is counted once
        place += len(text[byte:start].decode())
        byte, b = start, place + end - start  # candidates are ASCII
        at = bisect_right(starts, (place, len(text) + 1))
        if not at or reach[at - 1] < b:
            found.append((kind, place, b))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def with_secrets(docs: DataFrame, name: str = "secrets", allowed: tuple[bytes, ...] = ALLOWED) -> DataFrame:
    """All rows and columns of docs, and an array column of spans (kind, start, end).

    Offsets are code points, the end is exclusive. The fixed kinds are assign, access and
    hex; the entropy kinds add windows of high entropy that no fixed span contains, except
    in candidates that an allow-list pattern matches as a whole, windows of letters that read
    as words, and those in or over a part between / and = with a stand-in such as "example".
    A null or empty text has no spans, equal texts have equal ones, and texts of any length
    are read whole, in time that grows with them. A column of the given name is replaced,
    other names may be anything. Work is local to a row: nothing is shuffled. An empty table
    gives an empty result.
    """
    pattern = re.compile(b"|".join(b"(?:%b)" % p for p in allowed) or b"(?!)")

    @F.arrow_udf(_SPAN)
    def spans(text: pa.Array) -> pa.Array:
        rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans_of(t, pattern)] for t in text_bytes(text)]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return docs.withColumn(name, spans(F.col("text")))


def redacted(docs: DataFrame, **options) -> DataFrame:
    """Docs with every secret replaced by its kind in brackets, and the spans that were found.

    Where spans overlap, the first one hides what the later one shares with it.
    """

    @F.arrow_udf(STRING)
    def hide(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, found in zip(text.to_pylist(), spans.to_pylist(), strict=True):
            parts, at = [], 0
            for s in found:
                if s["end"] > at:
                    parts += [(t or "")[at : max(at, s["start"])], f"[{s['kind']}]"]
                    at = s["end"]
            out.append(None if t is None else "".join(parts) + t[at:])
        return pa.array(out, pa.string())

    return with_secrets(docs, "secrets", **options).withColumn("text", hide("text", "secrets"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"].isin(*KINDS[:3]))

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return with_secrets(docs).select(
        "doc_id", *map(number, KINDS[:3]), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans")
    )
