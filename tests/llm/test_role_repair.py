import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tellermill.llm import role_repair
from tellermill.llm.common import ship
from tellermill.llm.role_repair import BLANK, DUPLICATE, SOUND, TRUNCATED, Parser, best

SCHEMA = "conv_id long, turn long, role string, text string"
#: The grammar once more, as a plain automaton on initials.
NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
BLANKS = " \t\n\v\f\r"


def every_repair(turns, inserts=3):
    """All (cost, audit) of all edits with so many inserts at most, told by a regular expression."""
    found = []
    choices = [[("D", 3, "")] if f in (BLANK, DUPLICATE) else
               [("D", 3, ""), ("K", 0 + (f == TRUNCATED), i)] + [("R", 2 + (f == TRUNCATED), s) for s in "ua"] for i, f in turns]
    slots = [tuple(p) for n in range(inserts + 1) for p in itertools.product("ua", repeat=n)]
    for picks in itertools.product(*choices):
        for holes in itertools.product(slots, repeat=len(turns) + 1):
            if sum(map(len, holes)) > inserts:
                continue
            audit, roles, cost = "I" * len(holes[0]), "".join(holes[0]), 2 * sum(map(len, holes))
            for (letter, price, role), hole in zip(picks, holes[1:], strict=True):
                audit, roles, cost = audit + letter + "I" * len(hole), roles + role + "".join(hole), cost + price
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit))
    return min(found)


def repair(turns):
    """Least (cost, audit) and the edited initials, by whole texts over the plain automaton."""
    tops = {"0": (0, "", [])}

    def inserted(tops):
        todo = list(tops)
        while todo:
            state = todo.pop()
            cost, audit, out = tops[state]
            for s in "ua":
                after = NEXT.get((state, s))
                new = (cost + 2, audit + "I", [*out, (None, s)])
                if after and (after not in tops or new[:2] < tops[after][:2]):
                    tops[after] = new
                    todo.append(after)
        return tops

    tops = inserted(tops)
    for k, (initial, fault) in enumerate(turns):
        after = {}

        def add(state, new, after=after):
            if state and (state not in after or new[:2] < after[state][:2]):
                after[state] = new

        for state, (cost, audit, out) in tops.items():
            add(state, (cost + 3, audit + "D", out))
            if fault not in (BLANK, DUPLICATE):
                more = cost + (fault == TRUNCATED)
                add(NEXT.get((state, initial)), (more, audit + "K", [*out, (k, None)]))
                for s in "ua":
                    add(NEXT.get((state, s)), (more + 2, audit + "R", [*out, (k, s)]))
        tops = inserted(after)
    return min((t for state, t in tops.items() if state in "0a"), key=lambda t: t[:2])


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """Turns of one number have to be equal."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, faults = set(), []
        for _, _, role, text in mine:
            worded = text.strip(BLANKS)
            faults.append(BLANK if not worded else DUPLICATE if (role, text) in seen else SOUND if worded[-1] in ".!?" else TRUNCATED)
            seen.add((role, text))
        initials = [r[2][:1] for r in mine]
        cost, audit, kept = repair(list(zip(initials, faults, strict=True)))
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = min(max(numbers) - min(numbers) + 1 - len(set(numbers)), (1 << 63) - 1) if numbers else 0
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
        lines = []
        for k, s in kept:
            role = mine[k][2] if s is None else {"u": "user", "a": "assistant"}[s]
            lines.append(f"{role}:{'' if k is None else mine[k][3]}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        n = Counter(faults)
        out[conv] = (conv, gaps, n[BLANK], n[DUPLICATE], n[TRUNCATED], illegal, cost, audit, digest, "\n".join(lines))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    says = ["Yes.", "No!", "Why?", "well", " ", "", "\t\n", "é…", "Fine. \n", None, "word " * 400 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher", "Señor"]
    rows = []
    for conv in range(60):
        turn = rnd.randint(-3, 3)
        for _ in range(rnd.randint(1, 9)):
            rows.append((conv, turn, rnd.choice(roles), rnd.choice(says)))
            turn += rnd.choice([1, 1, 1, 2, 5])
    rows += [(100, k, "user" if k % 2 else "assistant", f"Turn {k % 40}.") for k in range(300)]
    rows += [(None, 3, "user", "No conversation."), (None, None, "assistant", "Nor turn.")]
    rows += [(101, None, "user", "Null turn first."), (101, -9, "assistant", "Then this.")]
    rows += [(102, 7, "user", "The same twice."), (102, 7, "user", "The same twice."), (103, 2**62, "user", "x."), (103, -(2**62) - 5, "user", "y.")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def make(spark):
    ship(spark)
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def query(monkeypatch, spark, rows):
    monkeypatch.setattr(role_repair, "table", lambda *_: rows)
    return role_repair.op13(spark, "")


@pytest.mark.parametrize("task_bytes", [16 << 20, 3000, 100])
def test_query_against_plain_python(spark, make, monkeypatch, task_bytes):
    """Also where conversations span many tasks."""
    monkeypatch.setattr(role_repair, "TASK_BYTES", task_bytes)
    rows = corpus(task_bytes)
    found = query(monkeypatch, spark, make(rows).repartition(3))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == names
    want = Counter(r[:-1] for r in brute(rows).values())
    assert Counter(tuple(r) for r in found.collect()) == want


def test_parser_against_all_edits():
    rnd = random.Random(7)
    faults = [SOUND, SOUND, BLANK, DUPLICATE, TRUNCATED]
    for _ in range(60):
        turns = [(rnd.choice("suax"), rnd.choice(faults)) for _ in range(rnd.randint(0, 3))]
        parser = Parser((0,))
        for initial, fault in turns:
            parser.read(initial, fault)
        assert best(parser.ends()) == every_repair(turns)


def test_parser_against_plain_automaton():
    rnd = random.Random(8)
    for n in [*range(200), 3000]:
        turns = [(rnd.choice(["s", "u", "a", "u", "a", ""]), rnd.choice([SOUND, SOUND, BLANK, DUPLICATE, TRUNCATED])) for _ in range(n)]
        parser = Parser((0,))
        for initial, fault in turns:
            parser.read(initial, fault)
        assert best(parser.ends()) == repair(turns)[:2]


def test_long_runs_take_linear_time():
    parser = Parser((0,))
    parser.read("s", SOUND)
    for _ in range(200_000):
        parser.read("u", DUPLICATE)
    assert best(parser.ends()) == (3 * 200_001, "D" * 200_001)


def test_repaired_rows(spark, make):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Me again."), (1, 2, "system", " "), (1, 3, "assistant", "So")]
    docs = make(rows)
    for name in ("of", "at", "task", "tie", "row", "fault", "edit", "said"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("turn").cast("string")))
    found = role_repair.repaired(docs).orderBy("position").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in found] == [
        ("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "Me again."), ("K", "assistant", "So")
    ]
    assert found[1]["of"] is None and found[3]["of"]["said"] == "said3" and found[3]["of"]["turn"] == 3
    assert role_repair.repaired(docs.limit(0)).count() == 0


def test_repaired_rows_give_the_digest(make):
    rows = corpus(5)
    found = {}
    for r in role_repair.repaired(role_repair.damaged(make(rows))).collect():
        found.setdefault(r["conv_id"], []).append((r["position"], f"{r['role']}:{r['text']}"))
    want = brute(rows)
    for conv, r in want.items():
        assert "\n".join(line for _, line in sorted(found.get(conv, []))) == r[-1]


def test_empty_table(spark, make, monkeypatch):
    assert query(monkeypatch, spark, make([])).count() == 0
    dropped = [(k, 0, "user", "x.") for k in range(200) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    found = query(monkeypatch, spark, make(dropped)).collect()
    assert {tuple(r)[1:] for r in found} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
