"""Personal data replaced by keyed surrogates.

Entities are found in the text, brought to one form, and each gets a surrogate of its own
kind: an address keeps its shape, a card number its network and check digit, a name its
gender and script. Two entities never share a surrogate, and no surrogate is an entity of
the corpus: surrogates that collide are drawn again, over the table of distinct entities.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import INT, STRING, stored, struct, table, text_key, unused

# Titles before a name, by the gender they tell.
TITLES = {
    "m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "г-н", "господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Doña", "г-жа", "госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
# Parts of invented names, by script.
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ha he ja ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi wa we za".split(),
    "cyrillic": "ба бе бо ва ве да де ди до жа за ка ке ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се со та те ти то".split(),
    "greek": "βα βε δα δε δι κα κε κο λα λε λι μα με μι να νε νι πα πε πο ρα ρε ρι σα σε τα τε τι".split(),
}
# Endings of invented given names, by script and gender.
ENDINGS = {
    ("latin", "m"): ("n", "r", "s", "ld"),
    ("latin", "f"): ("na", "ra", "lia", "ssa"),
    ("latin", "n"): ("", "l"),
    ("cyrillic", "m"): ("н", "р", "й"),
    ("cyrillic", "f"): ("на", "ра", "я"),
    ("cyrillic", "n"): ("",),
    ("greek", "m"): ("ς", "ων"),
    ("greek", "f"): ("να", "ρα"),
    ("greek", "n"): ("",),
}

# Country codes of two digits; those in 1 and 7 have one, all others three.
CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()

_AT_DOMAIN = re.compile(r"@[\w-]+(?:\.[\w-]+)+")
_IBAN = re.compile(r"(?<![^\W_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![^\W_])")
_IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]{1,38}(?![\w:]|\.\d)")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)", re.ASCII)
_CARD = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])", re.ASCII)
# Groups of digits that may hold telephone numbers; rules tell those from other numbers.
_GAP = r"[ \u00a0\u202f./()–-]"
_RUN = re.compile(rf"(?<![\w.+])(?:\+ ?)?\(?[0-9](?:(?:{_GAP}{{0,3}}|{_GAP}{{0,2}}\+)[0-9]){{6,}}(?![^\W_]|_)")
_GROUP = re.compile(r"(?:\+ ?)?\(?[0-9]+\)?")
_DATE = re.compile(r"(?<![0-9./-])(?:([0-9]{1,2})([./-])([0-9]{1,2})\2(?:[0-9]{4}|[0-9]{2})|[0-9]{4}([./-])([0-9]{1,2})\4([0-9]{1,2}))(?![0-9]|[./-][0-9])")
#: Words right before a number that make any 7 to 15 digits a telephone number.
_CALL = re.compile(
    r"(?i:\b(?:tel|t[eé]l[eé]phone?|tel[eé]fono?|telefon(?:nummer)?|phone|fon|fax|call|dial|mobile?|m[oó]vil|cell|handy|portable|rufnummer|whatsapp)\b)[ .:)]{0,3}\Z"
)
# Small words inside names, which stay.
PARTICLES = "von van de der den del della di da du des la le zu zur ten ter y".split()
_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*\.?"
_TITLED = re.compile(r"\b(" + "|".join(re.escape(t) for ts in TITLES.values() for t in ts) + r")\.? +")
_NAMED = re.compile(rf"(?:{_NAME} ){{0,5}}{_NAME}")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")
_DIGIT = re.compile(r"\d", re.ASCII)

#: After so many draws the surrogates of an entity may come from a wider pool, and again after
#: as many more, up to longer values or any address; only all IPv4 addresses can then run out.
WIDEN = 8
MOST_ATTEMPTS = 500

KINDS = ("email", "domain", "ip", "ip6", "iban", "card", "phone", "given", "surname")
_MENTION = T.ArrayType(struct(start=INT, end=INT, kind=STRING, entity=STRING))


def _luhn(digits: str) -> bool:
    total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return next((s for s in SYLLABLES if name.startswith(s.upper())), "latin")


def _is_date(first: str, second: str) -> bool:
    a, b = sorted((int(first), int(second)))
    return 1 <= a <= 12 and b <= 31


def _is_phone(groups: list[str], gaps: list[str], sign: str, called: bool) -> bool:
    """Whether groups of digits, the gaps between them and a leading + or ( are a phone number.

    Numbers of other countries need +, 00, or a word such as "Tel." before them. National ones
    have a trunk 0, an area code in brackets, the American 3-3-4 digits or the Spanish nine.
    """
    d, sizes = "".join(groups), [len(g) for g in groups]
    if not 7 <= len(d) <= 15 or len(set(d)) == 1:
        return False
    if sign == "+":
        return d[0] != "0"
    if sizes in ([2, 2, 4], [1, 2, 4], [2, 1, 4]) and groups[2][:2] in ("19", "20") and _is_date(*groups[:2]):
        return False
    if all(len(g) == 4 and g[:2] in ("19", "20") for g in groups):
        return False  # years
    if called:
        return True
    if d[:2] == "00":
        return len(d) >= 9 and d[2] != "0"
    if d[0] == "0":
        pairs = len(groups) > 1 and set(sizes) == {2}
        return d[1] != "0" and 2 <= sizes[0] and len(d) <= (10 if pairs else 12) and (len(groups) > 1 or len(d) >= 9)
    if sign == "(":
        return len(groups) > 1 and 2 <= sizes[0] <= 4 and groups[0][:2] not in ("19", "20")[: 2 * (sizes[0] == 4)]
    american = d[1:] if len(d) == 11 and d[0] == "1" else d
    if len(groups) == 1:
        return len(american) == 10 and american[0] in "23456789" and american[3] in "23456789"
    spanish = len(d) == 9 and d[0] in "6789" and len(groups) > 2 and min(sizes) >= 2
    if len(set(gaps)) == 1 and sizes[0] <= 3 and set(sizes[1:]) == {3} and (gaps[0] == "." or gaps[0] != "-" and not spanish):
        return False  # thousands
    shape = sizes[1:] if d[0] == "1" and sizes[0] == 1 else sizes
    grouped = len(shape) == 3 and 2 <= shape[0] <= 4 or len(shape) == 2 and 5 <= shape[0] <= 8
    return spanish or grouped and all(3 <= n <= 4 for n in shape[1:]) and not any("/" in g for g in gaps)


def _phones(text: str) -> Iterator[tuple[int, int]]:
    """Places of telephone numbers.

    A run of groups may hold several, and other numbers. From the left, the longest part is
    taken that ends with its run or before the next telephone number, or else the longest.
    """
    for run in _RUN.finditer(text):
        days = [m.span() for m in _DATE.finditer(text, *run.span()) if _is_date(*(m[1], m[3]) if m[1] else (m[5], m[6]))]
        dated = {k for a, b in days for k in range(a, b)}
        found = [g.span() for g in _GROUP.finditer(text, *run.span()) if g.start() not in dated and g.end() - 1 not in dated]

        def ends(at: int, found: list[tuple[int, int]] = found) -> Iterator[int]:
            """Ends of telephone numbers that begin with this group, the longest first."""
            first, stop = found[at][0], at
            # Right behind a dot, slash or hyphen a number has begun before.
            if first and text[first - 1] in "./-" and text[first] != "+":
                return
            called = bool(_CALL.search(text, max(0, first - 20), first))
            sign = "+" if text[first] == "+" else "(" if text[first] == "(" and text[found[at][1] - 1] == ")" else ""
            head = "".join(_digits(text[a:b]) for a, b in found[at : at + 3])[:3]
            if not sign and not called and head[:1] == "0" and (head == "000" or _digits(text[first : found[at][1]]) == "0" and head[:2] != "00"):
                return
            # Numbers of more than four groups begin with a sign, a word or a 0.
            most = len(found) if sign or called or text[first] in "(0" else at + 4
            while stop < min(most, len(found)) and found[stop][1] - first <= 45 and (stop == at or text[found[stop][0]] != "+"):
                stop += 1
            for last in range(stop, at, -1):
                groups = [_digits(text[a:b]) for a, b in found[at:last]]
                gaps = [text[a[1] : b[0]] for a, b in pairwise(found[at:last])]
                end = found[last - 1][1]
                if re.match(r"[./-][0-9]", text[end : end + 2]) or _DIGIT.search("".join(gaps)):
                    continue
                # Two groups without any sign of a telephone number, and more to come.
                if len(groups) == 2 and last < len(found) and not sign and not called and groups[0][0] != "0":
                    continue
                if _is_phone(groups, gaps, sign, called):
                    yield last

        at = 0
        while at < len(found):
            good = list(ends(at))
            if good:
                last = next((k for k in good if k == len(found) or next(ends(k), None)), good[0])
                yield found[at][0], found[last - 1][1]
                at = last
            else:
                at += 1


def _iban_rest(text: str) -> int:
    """Of a number whose check digits are right: 1."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _ip6(text: str) -> str | None:
    """The one form of an IPv6 address with an eight-part or shortened writing."""
    try:
        return str(ipaddress.IPv6Address(text)) if text.count(":") > 1 and len(text) > 3 else None
    except ValueError:
        return None


def _name_parts(text: str, start: int) -> list[tuple[int, int, bool]]:
    """Places of the words of a name behind a title, and whether each belongs to the surname.

    The name ends before a word that is neither capitalized nor a particle, and behind a word
    with a full stop that is more than an initial. Hyphens and apostrophes part words.
    """
    words = []
    for w in re.finditer(r"\S+", text):
        bare = w[0].rstrip(".")
        if bare in PARTICLES or bare in _GENDER:
            continue
        if not bare[0].isupper():
            break
        words.append((w.start(), bare))
        if w[0][-1] == "." and len(bare) > 1:
            break
    return [
        (start + at + part.start(), start + at + part.end(), k == len(words) - 1)
        for k, (at, bare) in enumerate(words)
        for part in re.finditer(r"[^\W\d_]+", bare)
    ]


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and entity of every mention, in order and without overlap.

    The entity is one form for all spellings: lower-cased addresses, digits alone, and for
    names script, gender and the lower-cased word. Names are found behind titles; then every
    other place of the text with such a name as a whole word, capitalized, is a mention too.
    """
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))

    def add(start: int, end: int, kind: str, entity: str) -> None:
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            found.append((start, end, kind, entity))

    if "@" in text:
        low = 0  # what lies before belongs to another address; so every character is looked at once
        for m in _AT_DOMAIN.finditer(text):
            start = m.start()
            while start > low and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
                start -= 1
            if start < m.start():
                low = m.end()
                add(start, m.start(), "email", text[start : m.end()].lower())
                add(m.start() + 1, m.end(), "domain", m[0][1:].lower())
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                add(*m.span(), "ip", ".".join(str(int(x)) for x in m[0].split(".")))
        for m in _IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if _iban_rest(plain) == 1:
                add(*m.span(), "iban", plain)
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if _luhn(d) or len(d) == 16 and d[0] in "23456":
                add(*m.span(), "card", d)
        for start, end in _phones(text):
            add(start, end, "phone", _digits(text[start:end]))
    if "::" in text or text.count(":") > 6:
        for m in _IP6.finditer(text):
            if address := _ip6(m[0]):
                add(*m.span(), "ip6", address)
    for m in _TITLED.finditer(text):
        name = _NAMED.match(text, m.end())
        for start, end, last in _name_parts(name[0], m.end()) if name else ():
            word = text[start:end]
            label = "" if last else _GENDER[m[1]]
            add(start, end, "surname" if last else "given", f"{_script(word)}:{label}:{word.lower()}")
    named = defaultdict(list)  # by word: the titled mentions, in order
    for m in sorted(found):
        if m[2] in ("given", "surname"):
            named[text[m[0] : m[1]].lower()].append(m)
    if named:
        for m in _WORD.finditer(text):
            titled = named.get(m[0].lower())
            if titled and m[0][0].isupper():
                # Of several persons, the one named last before this place, or else the first.
                nearest = titled[max(0, bisect_left(titled, m.span()) - 1)]
                add(*m.span(), *nearest[2:])
    return sorted(found)


class _Draw:
    """Numbers that depend on the key, the entity and the attempt alone."""

    def __init__(self, key: bytes, *parts: object):
        self.seed, self.n = "\0".join(map(str, parts)).encode(), 0
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def below(self, n: int) -> int:
        self.n += 1
        digest = hashlib.blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key, digest_size=8).digest()
        return int.from_bytes(digest, "big") % n

    def like(self, text: str) -> str:
        """Letters and digits replaced one by one; other characters stay."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                pool = {"cyrillic": "абвгдежзиклмнопрстуф", "greek": "αβγδεζηθικλμνξοπρστυφ"}.get(_script(c), "abcdefghijklmnopqrstuvwxyz")
                out.append(pool[self.below(len(pool))])
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate entity, in the same single form.

    Short values and private networks leave little room: after every WIDEN attempts a text
    grows by a character, an address leaves its network for 10.x.y.z and then for any, a
    telephone number gives up its country code, then its leading digit, and then grows.
    """
    wide = attempt // WIDEN
    draw, more = _Draw(key, kind, entity, attempt), "x" * wide
    if kind == "email":
        local, _, domain = entity.partition("@")
        return f"{draw.like(local + more)}@{domain}"
    if kind == "domain":
        labels, top = entity.rsplit(".", 1)
        return f"{draw.like(labels + more)}.{top}"
    if kind == "ip":
        octets = [int(x) for x in entity.split(".")]
        keep = 1 if octets[0] in (10, 127) else 2 if octets[:2] == [192, 168] else 0
        if wide and keep:
            octets[0], keep = 10, int(wide == 1)
        first = draw.below(222) + 1
        drawn = [first + (first in (10, 127)), *(draw.below(256) for _ in range(2)), 1 + draw.below(254)]
        return ".".join(map(str, octets[:keep] + drawn[keep:]))
    if kind == "ip6":
        old = int(ipaddress.IPv6Address(entity))
        net = old >> 112 if old >> 112 in (0xFE80, 0xFD00) and not wide else 0x2001 if not wide else 0x2000 + draw.below(0x1000)
        return str(ipaddress.IPv6Address((net << 112) + (draw.below(1 << 56) << 56) + draw.below(1 << 56)))
    if kind == "iban":
        rest = "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in entity[4:])
        return f"{entity[:2]}{98 - _iban_rest(entity[:2] + '00' + rest):02d}{rest}"
    if kind == "card":
        body = (entity[0] if wide < 2 else str(2 + draw.below(5))) + "".join(str(draw.below(10)) for _ in entity[2:])
        if not _luhn(entity):
            return body + str(draw.below(10))
        return next(body + c for c in "0123456789" if _luhn(body + c))
    if kind == "phone":
        zeros = len(entity[:2]) - len(entity[:2].lstrip("0"))
        keep = max(zeros, len(entity) - 10)  # a trunk 0 or a country code
        if len(entity) > 10 and not zeros:
            keep = max(keep, 1 if entity[0] in "17" else 2 if entity[:2] in CODES else 3)
        if wide:
            keep = 0
        if wide > 1:
            return "".join(str(draw.below(10)) for _ in range(len(entity) + wide - 2))
        rest = "".join(str(draw.below(10)) for _ in entity[keep + 1 :])
        return entity[:keep] + str(2 + draw.below(8)) + rest
    script, gender, word = entity.split(":", 2)
    parts = SYLLABLES[script]
    n = max(2, (len(word) + 1) // 2) + wide
    stem = "".join(parts[draw.below(len(parts))] for _ in range(n))
    endings = ENDINGS[script, gender] if gender else ("", "n") if script == "latin" else ("",)
    return f"{script}:{gender}:{stem}{endings[draw.below(len(endings))]}"


def written(kind: str, original: str, new: str) -> str:
    """The surrogate entity in the format of the original mention."""
    if kind in ("card", "phone"):
        digits = iter(new)
        return _DIGIT.sub(lambda _: next(digits), original) + "".join(digits)
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in original)
    if kind == "ip6":
        return new.upper() if original.isupper() else new
    if kind == "email":
        new = new.partition("@")[0]
    elif kind in ("given", "surname"):
        new = new.rsplit(":", 1)[1]
        if len(original) == 1:
            new = new[0]  # an initial
    if original.isupper():
        return new.upper()
    return new.capitalize() if original[:1].isupper() else new


def replaced(text: str, found: list[tuple[int, int, str, str]], new: dict[tuple[str, str], str]) -> str:
    parts, at = [], 0
    for start, end, kind, entity in found:
        parts += [text[at:start], written(kind, text[start:end], new[kind, entity])]
        at = end
    return "".join(parts) + text[at:]


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


@F.arrow_udf(_MENTION)
def _mentions(text: pa.Array) -> pa.Array:
    fields = [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("entity", pa.string())]
    rows = [[dict(zip(("start", "end", "kind", "entity"), m, strict=True)) for m in mentions(t)] for t in _texts(text)]
    return pa.array(rows, pa.list_(pa.struct(fields)))


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity) rows.

    Draws a surrogate for each, keeps those that no other entity has and that are no
    entity themselves, and draws again for the rest. Of several entities that draw the
    same, the least keeps it, so the result does not depend on the order of rows. What finds no
    free surrogate in the pool of its shape gets one from a wider pool.
    """

    @F.arrow_udf(STRING)
    def drawn(kind: pa.Array, entity: pa.Array, attempt: pa.Array) -> pa.Array:
        rows = zip(kind.to_pylist(), entity.to_pylist(), attempt.to_pylist(), strict=True)
        return pa.array([surrogate(key, *r) for r in rows], pa.string())

    entities = stored(entities, "entities")
    taken = entities.select("kind", F.col("entity").alias("surrogate"))
    left, done, attempt = entities, None, 0
    while not left.isEmpty():
        if attempt == MOST_ATTEMPTS:
            raise ValueError("more entities of a kind than it has distinct surrogates")
        tried = stored(left.select("kind", "entity", drawn("kind", "entity", F.lit(attempt)).alias("surrogate")), "drawn")
        first = tried.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        good = stored(first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "entity", "surrogate"), "surrogates")
        done = good if done is None else done.unionAll(good)
        taken = taken.unionAll(good.select("kind", "surrogate"))
        left = stored(left.join(good, ["kind", "entity"], "left_anti"), "left")
        attempt += 1
    return entities.select("kind", "entity", F.lit("").alias("surrogate")) if done is None else done


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """All rows and columns of docs, the text with surrogates, and n_replaced.

    Telephone numbers are 7 to 15 digits in any grouping with a sign that they are one (see
    _is_phone); dates, years, thousands, cards and plain numbers are none.
    An entity has the same surrogate wherever it occurs and in whatever format; parts of a
    name are entities of their own, so a surname alone still refers to the same person. Names
    count in the whole of a document that has them behind a title, and in no other.
    Null stays null, and texts without personal data stay as they are. Rows that repeat an
    id and a text are treated alike. A column n_replaced is replaced, other names may be
    anything. Texts of any length are read whole. An empty table gives an empty result. Only mentions and texts that have some are shuffled.
    """
    spans, id_, of, fresh = (unused(c, [*docs.columns, "n_replaced"]) for c in ("__found", "__id", "__of", "__new"))
    found = docs.drop("n_replaced").withColumn(spans, _mentions("text"))
    mention = found.select("doc_id", text_key().alias("key"), F.explode(spans).alias("m"))
    own = stored(mention.select("doc_id", "key", "m.kind", "m.entity").distinct(), "mentions")
    table_ = stored(surrogates(own.select("kind", "entity").distinct(), key), "table")
    new = (
        own.join(table_, ["kind", "entity"])
        .groupBy(F.col("doc_id").alias(id_), F.col("key").alias(of))
        .agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias(fresh))
    )

    @F.arrow_udf(STRING)
    def written_anew(text: pa.Array, places: pa.Array, pairs: pa.Array) -> pa.Array:
        out = []
        for t, found_, known in zip(text.to_pylist(), places.to_pylist(), pairs.to_pylist(), strict=True):
            spans_ = [(m["start"], m["end"], m["kind"], m["entity"]) for m in found_]
            out.append(replaced(t, spans_, {(p["kind"], p["entity"]): p["surrogate"] for p in known}))
        return pa.array(out, pa.string())

    n = F.coalesce(F.size(spans), F.lit(0)).cast("long")
    plain = found.filter(F.size(spans) == 0).withColumn("n_replaced", n).drop(spans)
    some = found.filter(F.size(spans) > 0).withColumn("n_replaced", n)
    same = some["doc_id"].eqNullSafe(new[id_]) & (text_key() == new[of])
    changed = some.join(new, same).withColumn("text", written_anew("text", spans, fresh))
    return plain.unionByName(changed.drop(spans, id_, of, fresh))


#: The key of the registered query. Real runs pass a secret of their own.
DEMONSTRATION_KEY = b"demonstration"


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_surrogates(docs, DEMONSTRATION_KEY).select("doc_id", "text", "n_replaced")
