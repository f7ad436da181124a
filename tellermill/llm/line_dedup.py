"""Line deduplication by an exact set-similarity join, in DataFrame operations alone.

A line is the set of its words. Words are ordered by rarity, and a line is only compared
with lines that share one of its few rarest words (prefix filter), have a similar number
of words (length filter), can still reach the overlap behind that word (positional filter)
and agree in enough bits of a parity signature. What is left is verified on the words.

A line goes if it matches any earlier line, so one match is enough, and sets are numbered
in the order of their first lines. Where a word is shared by some lines, these are first
compared with the earliest ones of them; where it is shared by many, with a sample as well,
then with larger samples. Only lines that found no match there are compared with all
earlier ones.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellermill.llm.common import stored, table, text_key, unused

#: Least Jaccard similarity of matching lines, as a fraction; 4/5 by default.
SIMILARITY = (4, 5)
#: Rarity is counted by hash slot, so its table has a fixed size; words of a slot share it.
SLOTS = 1 << 16
#: Places of lines to verify that are sent to all executors, in bytes; beyond, by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Lines that share a prefix word and are not compared with the earliest of them beforehand;
#: these are LEADERS lines, the first of each class by a hash.
FEW_LINES = 32
LEADERS = 2
#: Lines that share a prefix word and are all compared at once. Where there are more, they
#: are first compared with about SAMPLE of them, then with samples SAMPLE times larger.
GROUP_LINES = 1024
SAMPLE = 16

_HASH_BITS = 57
_BLANKS = " \t\v\f\r"
_PLACE = ("null_id", "doc_id", "text_key", "line_no")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """Stored rows; each step shuffles about as much as the input, so its files go with it."""
    return stored(rows, name, clean=True)


def _spaced(text: Column) -> Column:
    """The text with a space for every blank but line ends; few texts have any of those."""
    spaced, others = text, F.lit(False)
    for blank in _BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
        others = others | F.contains(text, F.lit(blank))
    return F.when(others, spaced).otherwise(text)


def _words(line: Column) -> Column:
    return F.array_remove(F.split(_spaced(line), " "), "")


def rarity(docs: DataFrame) -> Column:
    """Array of 6-bit frequency classes by slot, two classes for each doubling of the count."""
    cut = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    words = cut.select(F.explode(F.split(_spaced(F.col("line")), " ")).alias("w")).filter("w <> ''")
    slot = F.xxhash64("w").bitwiseAND(F.lit(SLOTS - 1))
    counts = words.groupBy(slot.alias("slot")).count().collect()  # SLOTS rows at most
    classes = ["0"] * SLOTS
    for r in counts:
        classes[r["slot"]] = str(min(63, int(2 * log2(r["count"] + 1))))
    return F.split(F.lit(",".join(classes)), ",").cast("array<bigint>")


def lines(docs: DataFrame) -> DataFrame:
    """A row for each line of docs: doc_id, text_key, line_no and line."""
    # The key is computed before the texts are cut; else every line would carry its text.
    cut = docs.select("doc_id", text_key().alias("text_key"), F.split("text", "\n").alias("every"))
    return cut.select("doc_id", "text_key", F.posexplode("every").alias("line_no", "line"))


def _keys(line: Column, classes: Column) -> Column:
    """The distinct words of a line as numbers, rarest first: frequency class, then hash."""
    hashed = F.array_distinct(F.transform(_words(line), lambda word: F.xxhash64(word)))

    def key(h: Column) -> Column:
        rank = F.get(classes, h.bitwiseAND(F.lit(SLOTS - 1)).cast("int"))
        return F.shiftleft(rank, _HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))

    return F.sort_array(F.transform(hashed, key))


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def line_sets(docs: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The distinct word sets of all lines.

    id, first (the place of the earliest line that has it), n (words), even and odd (128
    parities of the words) and prefix: 32-bit hashes of the rarest words, one of which
    every match of fewer words must have. Equal hashes of different words only add pairs
    to verify. A smaller id means an earlier place.
    """
    p, q = similarity
    place = F.struct(F.col("doc_id").isNull().alias("null_id"), *(F.col(c) for c in _PLACE[1:]))
    # Lines without words go first, and by their text: a filter on the keys computes them twice.
    worded = lines(docs).filter(F.trim("line", F.lit(_BLANKS)) != "")
    keyed = worded.select(place.alias("place"), _keys(F.col("line"), rarity(docs)).alias("keys"))
    n = F.size("keys")
    none = F.lit(0).cast("long")

    def parity(bit) -> Column:
        """Parities, by the last six bits, of the keys for which bit is 1."""

        def own(key: Column) -> Column:
            return F.call_function("shiftleft", bit(key), key.bitwiseAND(F.lit(63)).cast("int"))

        return F.aggregate("keys", none, lambda bits, key: bits.bitwiseXOR(own(key)))

    every = parity(lambda _: F.lit(1).cast("long"))
    odd = parity(lambda key: F.shiftright(key, 6).bitwiseAND(F.lit(1).cast("long")))
    prefix = F.slice("keys", 1, n - _ceil_div(p * n, q) + 1)
    small = F.transform(prefix, lambda key: F.shiftright(F.shiftleft(key, 32), 32).cast("int"))
    found = keyed.select(
        F.xxhash64("keys").alias("set_a"),
        F.xxhash64(F.lit("b"), "keys").alias("set_b"),
        "place",
        F.struct(
            n.alias("n"),
            every.bitwiseXOR(odd).alias("even"),
            odd.alias("odd"),
            small.alias("prefix"),
        ).alias("of"),
    )
    sets = found.groupBy("set_a", "set_b").agg(F.min("place").alias("first"), F.any_value("of").alias("of"))
    # Rising numbers by partition and row, so they follow the sort.
    return _stored(sets.orderBy("first").select(F.monotonically_increasing_id().alias("id"), "first", "of.*"), "sets")


def _plausible(x: _Side, y: _Side, similarity: tuple[int, int]) -> Column:
    """Whether two sets pass the length filter and agree in enough of the parities.

    Of t words together a match has at least p * t / (p + q) in common, and all others are
    apart. Whole numbers throughout, as this is computed for every pair that shares a word.
    """
    p, q = similarity
    differ = sum(F.bit_count(x[c].bitwiseXOR(y[c])) for c in ("even", "odd"))
    together = x["n"] + y["n"]
    near = (p + q) * F.shiftright(together - differ, 1) >= p * together
    return (q * F.least(x["n"], y["n"]) >= p * F.greatest(x["n"], y["n"])) & near


def _reachable(x: _Side, y: _Side, similarity: tuple[int, int]) -> Column:
    """Prefix and positional filter for two sets that share the word at their places `pos`.

    The set of fewer words needs fewer of its rarest words for the prefix filter.
    """
    p, q = similarity

    def indexed(s: _Side) -> Column:
        return (p + q) * (s["n"] - s["pos"]) >= 2 * p * s["n"]

    common = F.least(x["n"] - x["pos"], y["n"] - y["pos"])
    return F.when(x["n"] <= y["n"], indexed(x)).otherwise(indexed(y)) & ((p + q) * common >= p * (x["n"] + y["n"]))


class _Side:
    """Columns of one side of a self-join."""

    def __init__(self, name: str):
        self.name = name

    def __getitem__(self, column: str) -> Column:
        return F.col(f"{self.name}.{column}")


def _pairs(earlier: DataFrame, later: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (x, y) of sets that share a prefix word and may match, x earlier and y open."""
    x, y = _Side("x"), _Side("y")
    fits = (x["word"] == y["word"]) & y["open"] & (x["id"] < y["id"]) & _plausible(x, y, similarity) & _reachable(x, y, similarity)
    found = earlier.alias("x").join(later.alias("y"), fits)
    return found.select(x["id"].alias("x"), y["id"].alias("y")).distinct()


def _pairs_of_all(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """_pairs of rows with themselves, by one shuffle that serves both sides.

    So both sides have the same rows and columns up to there. The rows that are not open
    leave the later side by an explode behind it, as a filter would go below the shuffle.
    """
    dealt = rows.repartition("word")
    x, y = _Side("x"), _Side("y")
    once = F.when(F.col("open"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    still = dealt.withColumn("still", F.explode(once))
    used = x["open"] | y["still"]  # always true: the earlier side keeps this column too
    fits = (x["word"] == y["word"]) & used & (x["id"] < y["id"]) & _plausible(x, y, similarity) & _reachable(x, y, similarity)
    found = dealt.alias("x").join(still.alias("y"), fits)
    return found.select(x["id"].alias("x"), y["id"].alias("y")).distinct()


def _led(rows: DataFrame, slim: DataFrame, shared: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (x, y) that may match of leaders x of a shared word and later sets y with it."""
    leaders = shared.select("word", F.explode(F.array_compact("leaders")).alias("id"))
    leaders = slim.drop("prefix").join(_sent_whole(leaders, F.lit(32)), "id")
    leaders = _sent_whole(_stored(leaders, "leaders"), F.lit(64))
    x, y = _Side("x"), _Side("y")
    fits = (x["word"] == y["word"]) & (x["id"] < y["id"]) & _plausible(x, y, similarity)
    return rows.alias("y").join(leaders.alias("x"), fits).select(x["id"].alias("x"), y["id"].alias("y")).distinct()


def _sent_whole(rows: DataFrame, bytes_each: Column) -> DataFrame:
    """Stored rows, marked to go to all executors if they are few bytes altogether."""
    size = rows.agg(F.sum(bytes_each)).first()[0] or 0
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Ids y of the stored pairs (x, y) of sets whose words have the similarity."""
    p, q = similarity
    ids = pairs.select(F.col("x").alias("id")).unionAll(pairs.select("y")).distinct()
    wanted = _stored(sets.join(ids, "id", "left_semi").select("id", "first"), "wanted")
    wanted = _sent_whole(wanted, 64 + F.octet_length(F.coalesce(F.col("first.doc_id").cast("string"), F.lit(""))))
    own = lines(docs)
    same = own["doc_id"].eqNullSafe(wanted["first.doc_id"])
    for c in _PLACE[2:]:
        same = same & (own[c] == wanted[f"first.{c}"])
    # Words as 64-bit hashes: as exact as any hash join, and a third of their size.
    words = F.array_distinct(F.transform(_words(F.col("line")), lambda word: F.xxhash64(word)))
    # Rows that repeat both id and text give the same line again.
    found = own.join(wanted, same).groupBy("id").agg(F.any_value(words).alias("words"))
    found = _stored(found, "words")
    x, y = (found.select(F.col("id").alias(c), F.col("words").alias(f"of_{c}")) for c in "xy")
    common = F.size(F.array_intersect("of_x", "of_y"))
    either = F.size("of_x") + F.size("of_y") - common
    matching = pairs.join(x, "x").join(y, "y").filter(q * common >= p * either)
    return matching.select(F.col("y").alias("later")).distinct()


def later_matches(docs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Ids of the sets that match a set of an earlier line.

    Many slightly different copies of a line would match each other in pairs without number.
    So where more than FEW_LINES sets share a prefix word, they are first compared with the
    LEADERS earliest of them, by classes of a hash. Where more than GROUP_LINES share it,
    they are also compared with about SAMPLE of them, chosen by a hash, then with samples
    that are SAMPLE times larger each time, unless few pairs are left for all of them. A set
    that found its match is settled: it needs no more, and still counts as an earlier line
    for others. A set that is left after a
    sample has few matches in the next one, as about one in SAMPLE of those was in the
    sample before.
    """
    p, q = similarity
    slim = sets.filter(F.col("n") * (q - p) >= p)  # smaller sets match equal ones alone
    slim = slim.select("id", "even", "odd", "n", "prefix")

    def by_word(own: DataFrame) -> DataFrame:
        return own.select("id", "even", "odd", "open", "n", F.posexplode("prefix").alias("pos", "word"))

    rows = by_word(slim.withColumn("open", F.lit(True)))
    drawn = F.pmod(F.xxhash64("id"), F.lit(LEADERS))
    leaders = F.array(*(F.min(F.when(drawn == k, F.col("id"))) for k in range(LEADERS))).alias("leaders")
    counts = rows.groupBy("word").agg(F.count(F.lit(1)).alias("c"), leaders)
    shared = _stored(counts.filter(F.col("c") > min(FEW_LINES, GROUP_LINES)), "shared")
    pairs = _led(rows, slim, shared, similarity)
    common = shared.filter(F.col("c") > GROUP_LINES).select("word", "c")
    most = common.agg(F.max("c")).first()[0] or 0
    hot = _stored(rows.join(_sent_whole(common, F.lit(32)), "word"), "hot") if most else None
    settled, sample = None, SAMPLE
    while True:
        if sample < most:
            still = hot
            if settled is not None:
                still = still.join(_sent_whole(settled, F.lit(16)), still["id"] == settled["later"], "left_anti")
            chosen = hot.filter(F.pmod(F.xxhash64("id"), "c") < sample)
            drawn = _pairs(chosen, still, similarity)
            pairs = drawn if settled is not None else pairs.unionAll(drawn).distinct()
        elif settled is not None:
            break
        pairs = _stored(pairs, "pairs")
        if settled is not None and pairs.count() * most <= sample * slim.count():
            break  # all that share these words make about most / sample times as many
        found = _verified(docs, sets, pairs, similarity)
        settled = _stored(found if settled is None else settled.unionAll(found).distinct(), "settled")
        sample *= SAMPLE

    flagged = slim.join(settled, slim["id"] == settled["later"], "left")
    rows = by_word(flagged.withColumn("open", F.col("later").isNull()))
    rest = _verified(docs, sets, _stored(_pairs_of_all(rows, similarity), "pairs"), similarity)
    return settled.unionAll(rest).distinct()


def without_repeated_lines(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """All rows and columns of docs, the text without repeated lines, and a struct `lines`.

    A line goes if an earlier line has a Jaccard similarity of 4/5 or more with it, by their
    sets of words; exact repeats included, whether or not that earlier line goes itself.
    Earlier means a smaller doc_id (null ids last), then a smaller hash of the text, then a
    smaller line number; rows that repeat both id and text count as one and keep the same
    lines. Lines without words never go. Null texts stay null. `lines` has n_lines (with
    words) and n_removed; a column of that name is replaced, other names may be anything.
    Texts and lines of any length are taken whole. An empty table gives an empty result.
    """
    if not 0 < similarity[0] <= similarity[1]:
        raise ValueError("the similarity must lie above 0 and not above 1")
    source = docs.select("doc_id", "text")
    sets = line_sets(source, similarity)
    gone = _stored(later_matches(source, sets, similarity), "gone")
    kept = (
        sets.join(gone, sets["id"] == gone["later"], "left_anti")
        .groupBy(F.col("first.doc_id").alias("id"), F.col("first.text_key").alias("key"))
        .agg(F.collect_set("first.line_no").alias("kept"))
    )
    kept = _stored(kept, "kept")
    columns = [c for c in docs.columns if c != "lines"]
    rows = docs.select(F.struct(*(docs[c] for c in columns)).alias("of"))
    text = F.col("of.text")
    joined = rows.join(kept, F.col("of.doc_id").eqNullSafe(kept["id"]) & (F.xxhash64(text) == kept["key"]), "left")

    # Step by step, as what stands inside a lambda is computed for each line.
    mine = F.coalesce("kept", F.array().cast("array<int>")).alias("mine")
    joined = joined.select("of", mine, F.split(text, "\n").alias("every"))
    numbers = F.transform("every", lambda line, i: F.when(F.trim(line, F.lit(_BLANKS)) == "", i))
    joined = joined.select("*", F.filter(numbers, lambda i: i.isNotNull()).alias("blank"))
    n, mine = F.coalesce(F.size("every") - F.size("blank"), F.lit(0)), F.col("mine")
    left = F.array_join(F.transform(F.array_sort(F.concat(mine, "blank")), lambda i: F.get("every", i)), "\n")
    figures = F.struct(n.cast("long").alias("n_lines"), (n - F.size(mine)).cast("long").alias("n_removed"))
    new = F.when(n == F.size(mine), text).otherwise(left).alias("text")
    return joined.select(*(new if c == "text" else F.col("of")[c].alias(c) for c in columns), figures.alias("lines"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_lines(docs).select("doc_id", "lines.n_lines", "lines.n_removed", "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that has lost all of its lines goes.

    See without_repeated_lines for odd rows. A column `lines` of the input is given back.
    """
    name = unused("lines_before", docs.columns)
    columns = [F.col(name if c == "lines" else c).alias(c) for c in docs.columns]
    renamed = docs.withColumnRenamed("lines", name) if "lines" in docs.columns else docs
    left = without_repeated_lines(renamed).filter((F.col("lines.n_lines") == 0) | (F.col("lines.n_removed") < F.col("lines.n_lines")))
    if "n_chars" not in docs.columns:
        return left.select(columns)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(columns)
