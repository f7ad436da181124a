"""Repair of conversations by a generalised LR parser over their roles.

A sound conversation is an optional system turn and then pairs of user and assistant
turns, or nothing; the parser's table recognises that by the initials of roles. Each turn
may be kept, deleted or given another role, and turns may be inserted, at fixed costs. The
parser follows all choices at once on a graph-structured stack and merges equal stack tops
by the least (cost, audit). The audit has a letter for each edit, in order.

Turns are sorted over all tasks, so one conversation may span many. A task parses what it
has of a conversation from every stack that may come in, and the parts are then chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill.llm.common import BINARY, BOOLEAN, INT, LONG, STRING, stored, struct, table

#: Grammar C -> empty | H | s H; H -> H u a | u a, by the initials of roles. States of its
#: parser: 0 begin, 1 behind s, 2 and 5 behind u and ua, 3 and 4 behind pairs, 6 and 7
#: behind u and ua that follow pairs.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
#: States that reduce, and how many symbols they take off the stack.
_REDUCE = {5: 2, 7: 3}
_GOTO = {0: 3, 1: 4}
_ACCEPT = {0, 3, 4}

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: What a turn adds that ends amid a sentence and is not deleted.
TRUNCATED_COST = 1
ROLES = {"u": "user", "a": "assistant"}
#: Bytes of turns that a task parses.
TASK_BYTES = 16 << 20
_PIECE_BYTES = 8192

#: Faults of turns, of which the first that holds counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
_PLACE = ("has_turn", "turn", "tie", "row")

Stack = tuple[int, ...]


@lru_cache(maxsize=None)
def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol and the reductions that follow, or None if it can't come here."""
    state = _SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack = (*stack, state)
    while stack[-1] in _REDUCE:
        stack = stack[: -_REDUCE[stack[-1]]]
        stack = (*stack, _GOTO[stack[-1]])
    return stack


def _all_stacks() -> list[Stack]:
    found: list[Stack] = [(0,)]
    for stack in found:
        found += [s for s in (shifted(stack, x) for x in "sua") if s and s not in found]
    return found


STACKS = _all_stacks()


class Parser:
    """Reads turns one after the other and keeps the cheapest way to each stack top.

    An audit is a chain of nodes, each with the letters of one turn: inserts before it and
    its own edit. Two audits that have read the same turns and are not the same differ at a
    letter, or one has more inserts at its end; so it is enough to know their order (rank)
    up to the last turn, and the inserts behind it.
    """

    def __init__(self, stack: Stack):
        self.start = stack
        #: By stack top: cost, rank, inserts since the last turn, stack, chain.
        self.tops = {stack[-1]: (0, 0, "", stack, None)}
        self._insert()

    @staticmethod
    def _better(tops: dict, cost: int, rank: int, tail: str, stack: Stack, chain) -> bool:
        old = tops.get(stack[-1])
        if old is None or (cost, rank, tail) < old[:3]:
            tops[stack[-1]] = (cost, rank, tail, stack, chain)
            return True
        return False

    def _insert(self) -> None:
        todo = list(self.tops)
        while todo:
            cost, rank, tail, stack, chain = self.tops[todo.pop()]
            for symbol in ROLES:
                after = shifted(stack, symbol)
                if after and self._better(self.tops, cost + COST[INSERT], rank, tail + INSERT, after, chain):
                    todo.append(after[-1])

    def read(self, initial: str, fault: int) -> None:
        """Take in one turn: the first letter of its role and its fault."""
        tops: dict = {}
        for cost, rank, tail, stack, chain in self.tops.values():
            self._better(tops, cost + COST[DELETE], rank, tail + DELETE, stack, chain)
            if fault in (BLANK, DUPLICATE):
                continue
            more = cost + TRUNCATED_COST * (fault == TRUNCATED)
            if after := shifted(stack, initial):
                self._better(tops, more + COST[KEEP], rank, tail + KEEP, after, chain)
            for symbol in ROLES:
                if after := shifted(stack, symbol):
                    self._better(tops, more + COST[REROLE], rank, tail + REROLE, after, chain)
        # The letters of this turn decide the order of audits that were equal up to it.
        order = {key: k for k, key in enumerate(sorted({top[1:3] for top in tops.values()}))}
        self.tops = {
            state: (cost, order[rank, tail], "", stack, (chain, tail)) for state, (cost, rank, tail, stack, chain) in tops.items()
        }
        self._insert()

    def ends(self) -> Iterator[tuple[Stack, int, str]]:
        """Stack, cost and audit of every stack top."""
        for cost, _, tail, stack, chain in self.tops.values():
            letters = [tail]
            while chain:
                chain, part = chain
                letters.append(part)
            yield stack, cost, "".join(reversed(letters))


def best(ends: Iterable[tuple[Stack, int, str]]) -> tuple[int, str]:
    """The cheapest accepted cost and audit, the least audit on a tie."""
    return min((cost, audit) for stack, cost, audit in ends if stack[-1] in _ACCEPT)


def edits(stack: Stack, initials: list[str], audit: str) -> Iterator[tuple[str, int, str]]:
    """For each letter of an audit: the letter, the number of its turn (that of the next one
    for an insert), and the initial that the edited turn has ("" if it goes)."""
    k = 0
    for letter in audit:
        symbol = "" if letter == DELETE else initials[k] if letter == KEEP else next(s for s in ROLES if shifted(stack, s))
        stack = shifted(stack, symbol) if symbol else stack
        yield letter, k, symbol
        k += letter != INSERT


# ---- on tables -------------------------------------------------------------------------


def _unfinished(text: Column) -> Column:
    """Whether the last character but for blanks is no full stop, exclamation or question mark."""
    return ~F.substring(F.rtrim(text, F.lit(" \t\n\v\f\r")), -1, 1).isin(".", "!", "?")


def turns(conversations: DataFrame) -> DataFrame:
    """The turns in order, with their faults, stored: conv_id, turn, role, text, fault, initial, of, at.

    `of` is the whole row. `at` numbers the turns of all conversations; without its lower
    33 bits it is the number of the task that has them.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.struct(*conversations.columns).alias("of"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.xxhash64(role, text).alias("tie"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("said"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "turns")
    # Only what is said more than once is looked at again; counts combine before the shuffle.
    same = rows.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*_PLACE)).alias("first")
    )
    same = stored(same.filter("n > 1").select("c", "s", F.col("first.row").alias("first_row")), "repeats")
    marked = rows.join(same, rows["conv_id"].eqNullSafe(same["c"]) & (rows["said"] == same["s"]), "left")
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(F.col("row") != F.col("first_row"), DUPLICATE)
        .when(_unfinished(F.col("text")), TRUNCATED)
        .otherwise(SOUND)
    )
    marked = marked.select(*rows.columns, fault.alias("fault"), F.substring("role", 1, 1).alias("initial")).drop("said")
    size = rows.agg(F.sum(F.octet_length("role") + F.octet_length("text") + 64).alias("s")).first()["s"] or 0
    order = ["conv_id", *_PLACE]
    ranged = marked.repartitionByRange(max(1, -(-int(size) // TASK_BYTES)), *order).sortWithinPartitions(*order)
    return stored(ranged.drop("has_turn", "tie", "row").withColumn("at", F.monotonically_increasing_id()), "ordered")


def _by_task(ordered: DataFrame, *columns: str) -> DataFrame:
    return ordered.select("conv_id", "at", *columns, F.shiftright("at", 33).alias("task"))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _runs(ids: list) -> list[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    cuts = [0, *(k for k in range(1, len(ids)) if ids[k] != ids[k - 1]), len(ids)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))


def _parsing(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    def parsed(group: pa.Table) -> pa.Table:
        """The turns of one task: for each conversation the cheapest ways through them.

        A conversation that may go on in a neighbouring task has a row for each stack that
        may come in and each stack top that may go out; others have one row.
        """
        group = group.sort_by("at")
        ids, initials, faults = (group[c].to_pylist() for c in ("conv_id", "initial", "fault"))
        out = []
        for a, b in _runs(ids):
            own, whole = initials[a:b], a > 0 and b < len(ids)
            base = {"conv_id": ids[a], "task": group["task"][0].as_py(), "whole": whole, "illegal": _illegal(own), "ends": [own[0], own[-1]]}
            for entry in STACKS[:1] if whole else STACKS:
                parser = Parser(entry)
                for initial, fault in zip(own, faults[a:b], strict=True):
                    parser.read(initial, fault)
                ends = list(parser.ends())
                if whole:
                    ends = [((), *best(ends))]
                out += [base | {"entry": entry, "exit": stack, "cost": cost, "audit": audit} for stack, cost, audit in ends]
        return pa.Table.from_pylist(out, schema)

    return parsed


def _chaining(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    def chained(group: pa.Table) -> pa.Table:
        """The parts of one conversation, one for each task, by the cheapest way through all."""
        parts: dict[int, list[dict]] = {}
        for r in group.sort_by("task").to_pylist():
            parts.setdefault(r["task"], []).append(r)
        tops = {0: (0, "", (0,), [])}  # by stack top: cost, audit, stack, rows taken
        for ways in parts.values():
            after: dict = {}
            for cost, audit, stack, taken in tops.values():
                for r in ways:
                    new = cost + r["cost"], audit + r["audit"]
                    top = r["exit"][-1]
                    if tuple(r["entry"]) == stack and (top not in after or new < after[top][:2]):
                        after[top] = (*new, tuple(r["exit"]), [*taken, r])
            tops = after
        taken = min((top for top in tops.values() if top[2][-1] in _ACCEPT), key=lambda top: top[:2])[3]
        for before, r in zip([None, *taken], taken, strict=False):
            r["illegal"] += before is not None and _illegal([before["ends"][1], r["ends"][0]])
        return pa.Table.from_pylist(taken, schema)

    return chained


def parsed(ordered: DataFrame) -> DataFrame:
    """For each task's part of each conversation, stored: the stack that comes in, cost and audit.

    The whole audit of a conversation is one text, and so are its parts in one task when
    they are chained; its turns never are.
    """
    stack = T.ArrayType(INT)
    schema = struct(
        conv_id=ordered.schema["conv_id"].dataType, task=LONG, whole=BOOLEAN, illegal=LONG, ends=T.ArrayType(STRING),
        entry=stack, exit=stack, cost=LONG, audit=STRING,
    )
    arrow = _arrow(schema)
    parts = _by_task(ordered, "initial", "fault").groupBy("task").applyInArrow(_parsing(arrow), schema)
    parts = stored(parts, "parts")
    chained = parts.filter("not whole").groupBy("conv_id").applyInArrow(_chaining(arrow), schema)
    return stored(parts.filter("whole").unionByName(chained), "parsed")


def audits(ordered: DataFrame, parts: DataFrame) -> DataFrame:
    """A row for each conversation: gaps, blank, duplicate, truncated, illegal, cost and audit."""
    kinds = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": TRUNCATED}
    turns = ordered.groupBy("conv_id", "turn").agg(*(F.count_if(F.col("fault") == k).alias(name) for name, k in kinds.items()))
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count("turn")
    gaps = F.coalesce(F.least(span, F.lit((1 << 63) - 1)).cast("long"), F.lit(0)).alias("gaps")
    figures = turns.groupBy("conv_id").agg(gaps, *(F.sum(name).alias(name) for name in kinds))
    letters = F.transform(F.sort_array(F.collect_list(F.struct("task", "audit"))), lambda part: part["audit"])
    found = parts.groupBy(F.col("conv_id").alias("c")).agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(letters, "").alias("audit")
    )
    return figures.join(found, figures["conv_id"].eqNullSafe(found["c"])).drop("c")


def _edited(group: pa.Table, parts: pa.Table) -> Iterator[tuple[dict, list[tuple[str, int, str]]]]:
    """Each part of a task's conversations, with (letter, row of the turn, initial) for its edits."""
    ids, initials = group["conv_id"].to_pylist(), group["initial"].to_pylist()
    by = {r["conv_id"]: r for r in parts.to_pylist()}
    for a, b in _runs(ids):
        r = by[ids[a]]
        yield r, [(letter, a + k, symbol) for letter, k, symbol in edits(tuple(r["entry"]), initials[a:b], r["audit"])]


def repaired(conversations: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, position, edit, role, text, of.

    Blank turns and turns said before in the conversation (same role and text) go; the
    others are kept, deleted or given another role, and turns without text are inserted, so
    that the roles' initials become `(s?(ua)+)?` at the least cost, with the least audit on a
    tie. Turns are taken by their number, nulls first, and those of one number by a hash of
    role and text, equal ones as stored. A null role or text is one space; rows without
    conv_id are one conversation. Conversations and texts may be of any length. `position` orders the turns of a conversation, `edit` is K, R or I, and
    `of` the original row with all its columns, whatever their names (null for an insert).
    An empty table gives an empty result.
    """
    ordered = turns(conversations)
    of = T.StructField("of", ordered.schema["of"].dataType)
    kind = ordered.schema["conv_id"].dataType
    schema = T.StructType([*struct(conv_id=kind, position=STRING, edit=STRING, role=STRING, text=STRING).fields, of])

    def edited(group: pa.Table, parts: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        out, source, at = [], [], group["at"].to_pylist()
        roles, texts = group["role"].to_pylist(), group["text"].to_pylist()
        for r, letters in _edited(group, parts):
            for n, (letter, k, symbol) in enumerate(letters):
                if symbol:
                    place, new = f"{r['task']:010d}.{n:012d}", letter == INSERT
                    out.append((r["conv_id"], place, letter, roles[k] if letter == KEEP else ROLES[symbol], "" if new else texts[k]))
                    source.append(None if new else k)
        of = group["of"].take(pa.array(source, pa.int64())).cast(arrow.field("of").type)
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.Table.from_arrays([*(pa.array(c, arrow.field(i).type) for i, c in enumerate(columns)), of], schema=arrow)

    arrow = _arrow(schema)
    left, right = _by_task(ordered, "initial", "role", "text", "of"), parsed(ordered)
    return left.groupBy("task").cogroup(right.groupBy("task")).applyInArrow(edited, schema)


def _bodies(schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def bodies(group: pa.Table, parts: pa.Table) -> pa.Table:
        """Repaired parts as bytes, a line end before each turn: hashed, or in pieces if not whole."""
        group = group.sort_by("at")
        roles, texts = group["role"].to_pylist(), group["text"].to_pylist()
        out = []
        for r, letters in _edited(group, parts):
            lines = []
            for letter, k, symbol in letters:
                if symbol:
                    lines.append(f"\n{roles[k] if letter == KEEP else ROLES[symbol]}:{'' if letter == INSERT else texts[k]}")
            data = "".join(lines).encode()
            base = {"conv_id": r["conv_id"], "task": r["task"]}
            if r["whole"]:
                out.append(base | {"n": 0, "digest": hashlib.sha256(data[1:]).hexdigest()})
            else:
                out += [base | {"n": n, "piece": data[n : n + _PIECE_BYTES]} for n in range(0, max(1, len(data)), _PIECE_BYTES)]
        return pa.Table.from_pylist(out, schema)

    return bodies


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of sorted pieces, of which only the current batch is held."""
    now, digest, begun = None, None, False
    for batch in batches:
        out = []
        ids, pieces = batch.column(0), batch.column(1)
        for k in range(len(batch)):
            if digest is None or ids[k].as_py() != now:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest, begun = ids[k].as_py(), hashlib.sha256(), False
            piece = pieces[k].as_py()
            digest.update(piece if begun else piece[1:])
            begun = begun or bool(piece)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], ids.type), pa.array([r[1] for r in out], pa.string())], ["conv_id", "digest"])
        kind = ids.type
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()])], ["conv_id", "digest"])


def digests(ordered: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id and digest: SHA-256 of the repaired turns as role:text lines.

    The hash of a conversation has to be taken from its beginning to its end. Conversations
    inside one task's rows are hashed there; one that spans tasks passes through a single
    task in pieces, of which that task holds a batch.
    """
    kind = ordered.schema["conv_id"].dataType
    schema = struct(conv_id=kind, task=LONG, n=LONG, digest=STRING, piece=BINARY)
    left = _by_task(ordered, "initial", "role", "text")
    found = left.groupBy("task").cogroup(parts.groupBy("task")).applyInArrow(_bodies(_arrow(schema)), schema)
    found = stored(found, "bodies")
    pieces = found.filter("digest is null").repartition("conv_id").sortWithinPartitions("conv_id", "task", "n")
    streamed = pieces.select("conv_id", "piece").mapInArrow(_streamed, struct(conv_id=kind, digest=STRING))
    return found.filter("digest is not null").select("conv_id", "digest").unionByName(streamed)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the planted faults of the query, told by a checksum of conversation and turn."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    kind = F.crc32(key) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("kind") == 3, 1).otherwise(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ordered = turns(damaged(conversations))
    parts = parsed(ordered)
    hashes = digests(ordered, parts)
    figures = audits(ordered, parts)
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = ids.join(figures, ids["id"].eqNullSafe(figures["conv_id"]), "left").drop("conv_id")
    found = found.join(hashes, found["id"].eqNullSafe(hashes["conv_id"]), "left").drop("conv_id")
    names = "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
    return found.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in names),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
