"""Batches that are merged into stored tables, against tables loaded at once."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tellermill.operators.history import with_history
from tellermill.plans import facts
from tellermill.plans.incremental import TransactionStore
from tellermill.sources import incremental
from tellermill.sources.incremental import Ledger, StoredTable

SCHEMA = "trans_id long, account_id long, date date, type string, operation string, amount double, balance double, k_symbol string, bank string, account string"


def rows(df):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def transactions(seed, n=300):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        date = rnd.choice([None, *[dt.date(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 400)) for _ in range(20)]])
        account = rnd.choice([None, *range(12)])
        out.append((k, account, date, rnd.choice(["PRIJEM", "VYDAJ", "VYBER"]), "o", rnd.randint(1, 9999) / 100, rnd.randint(-9999, 9999) / 100, "k", "b", "a"))
    return out


@pytest.fixture
def store(spark, tmp_path):
    return TransactionStore(spark, str(tmp_path / "store"), spark.createDataFrame([], SCHEMA).schema)


def whole(store, final):
    """The store holds what one load of all final rows would."""
    spark = store.spark
    trans = spark.createDataFrame(final, SCHEMA)
    assert rows(store.trans.read()) == rows(trans)
    assert rows(store.history.read()) == rows(with_history(trans))
    assert rows(store.activity.read()) == rows(facts.account_transactions(with_history(trans)))


def test_a_batch_is_staged_once(spark, store, monkeypatch):
    """New rows are copied once before they are put in place, stored rows of their folders once."""
    staged, saved = [], incremental.saved

    def counted(df, path):
        out = saved(df, path)
        if "amount" in out.columns:
            staged.append(out.count())
        return out

    monkeypatch.setattr(incremental, "saved", counted)
    trans = spark.createDataFrame(transactions(4), SCHEMA)
    assert store.trans.merge(trans, 1, ("date",)) == 300 and sum(staged) == 300
    staged.clear()
    again = trans.filter("trans_id < 100")
    assert store.trans.merge(again, 2, ("date",)) == 100 and sum(staged) <= 300
    assert rows(store.trans.read()) == rows(trans)


def test_parts_equal_the_whole(spark, store):
    """New, late, corrected and moved rows, in three batches."""
    final = transactions(1)
    rnd = random.Random(2)
    first = []
    for r in final[:200]:
        if r[0] % 5 == 0:  # another account, month and amount at first
            r = (r[0], rnd.randint(0, 20), dt.date(1990, 1 + r[0] % 12, 1), "PRIJEM", "x", 1.0, 2.0, "k", "b", "a")
        first.append(r)
    rnd.shuffle(first)
    second = [r for r in final[:200] if r[0] % 5 == 0] + final[200:250]
    assert store.load("one", spark.createDataFrame(first, SCHEMA)) == 200
    whole(store, first)
    assert store.load("two", spark.createDataFrame(second, SCHEMA)) == len(second)
    assert not [r for r in store.trans.read().filter("date < '1995-01-01'").collect()]  # emptied folders are gone
    assert store.load("two", spark.createDataFrame(first, SCHEMA)) == len(second)  # known: not loaded again
    store.load("three", spark.createDataFrame(final[250:], SCHEMA))
    whole(store, final)
    assert [r["load"] for r in store.ledger.loads().orderBy("load").collect()] == [1, 2, 3]


@pytest.mark.parametrize("at", ["history", "record"])
def test_a_failed_load_starts_over(spark, store, monkeypatch, at):
    """Whatever a load had done when it broke off, giving it again leaves the whole result."""
    keyless = [(None, 3, dt.date(1995, 2, 2), "VYDAJ", "o", 5.0, 1.0, "k", "b", "a")] * 2
    first, second = transactions(3, 60), [*transactions(4, 30), *keyless]
    store.load("one", spark.createDataFrame(first, SCHEMA))

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        if at == "record":
            broken.setattr(Ledger, "record", fail)
        else:
            replace = StoredTable.replace
            broken.setattr(StoredTable, "replace", lambda t, *a: replace(t, *a) if t.path.endswith("trans") and at == "history" else fail())
        with pytest.raises(OSError, match="lost"):
            store.load("two", spark.createDataFrame(second, SCHEMA))
    store.load("two", spark.createDataFrame(second, SCHEMA))
    whole(store, second + first[30:])


def test_only_unseen_rows_of_a_source(spark, store):
    final = transactions(5, 90)
    assert store.load_unseen(spark.createDataFrame(final[:50], SCHEMA)) == 50
    assert store.load_unseen(spark.createDataFrame(final, SCHEMA)) == 40
    assert store.load_unseen(spark.createDataFrame(final, SCHEMA)) == 0
    assert store.ledger.high_mark() == 89
    whole(store, final)


def test_newest_row_of_a_batch(spark, store):
    day = dt.date(1995, 5, 5)
    older, newer = (1, 2, day, "VYDAJ", "o", 1.0, 1.0, "k", "b", "a"), (1, 2, day + dt.timedelta(1), "VYDAJ", "o", 3.0, 1.0, "k", "b", "a")
    store.load("one", spark.createDataFrame([newer, older, older], SCHEMA))
    whole(store, [newer])


def test_an_empty_batch(spark, store):
    assert store.load("none", spark.createDataFrame([], SCHEMA)) == 0
    whole(store, [])


def test_untouched_folders_stay_as_they_are(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "id long, part string").schema, ("id",), F.col("part"))
    make = lambda data: spark.createDataFrame(data, "id long, part string")
    table.merge(make([(1, "a"), (2, "b"), (3, None)]), 1)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "_part=b").iterdir()}
    table.merge(make([(1, "c"), (4, None)]), 2)
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "_part=b").iterdir()} == files
    assert not (tmp_path / "t" / "_part=a").exists()
    assert rows(table.read()) == Counter([(1, "c"), (2, "b"), (3, None), (4, None)])


def test_other_read_errors_are_not_an_empty_table(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        incremental.read_or_empty(spark, str(tmp_path / "bad"), spark.range(1).schema).count()
