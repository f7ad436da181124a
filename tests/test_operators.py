"""Distributed operators against brute force."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellermill.operators import integrity, profile
from tellermill import schema
from tellermill.operators.history import heavy_keys, with_history
from tellermill.operators.outliers import iqr_summary, with_outlier_flag
from tellermill.operators.quantiles import quantile_value, quantiles, value_bucket
from tellermill.sources.files import sample_by_key, sample_rows


def test_buckets_never_decrease(spark):
    rng = random.Random(1)
    values = sorted(
        [0.0, -0.0, 1.0, 2.0, 2.0 - 2**-52, 1024.0, 5e-324, 1e308, -1e308, float("inf"), float("-inf")]
        + [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 9) for _ in range(3000)]
    )
    df = spark.createDataFrame([(v,) for v in values], "v double")
    buckets = [r.b for r in df.select(value_bucket(F.col("v")).alias("b")).collect()]
    assert buckets == sorted(buckets)


@pytest.mark.parametrize("size", [1, 2, 7, 2000])
def test_quantiles_are_exact(spark, size):
    rng = random.Random(size)
    groups = {
        "wide": [round(rng.lognormvariate(8, 2), 2) for _ in range(size)],
        "ties": [float(rng.randint(-3, 3)) for _ in range(size)],
        "narrow": [1000 + rng.random() for _ in range(size)],
        None: [rng.uniform(-5, 5) for _ in range(size)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("wide", None)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(5)
    probs = {"p0": 0.0, "q1": 0.25, "q2": 0.5, "p95": 0.95, "p100": 1.0}
    cont = {r.g: r for r in quantiles(df, ["g"], probs).collect()}
    disc = {r.g: r for r in quantiles(df, ["g"], probs, method="disc").collect()}
    assert set(cont) == set(groups)
    for g, values in groups.items():
        for name, p in probs.items():
            assert cont[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
            assert disc[g][name] == np.quantile(values, p, method="inverted_cdf")


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "amount double")
    flagged = with_outlier_flag(df.unionByName(spark.createDataFrame([(None,)], "amount double")))
    assert [r.is_amount_outlier for r in flagged.collect()] == [0]


def test_outlier_flag_exact_and_approximate(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("amount"))
    assert with_outlier_flag(df).agg(F.sum("is_amount_outlier")).first()[0] == 50
    near = df.select(quantile_value(df, "amount", 0.95, approximate=True).alias("q")).first().q
    assert abs(near - 950) <= 10


def test_iqr(spark):
    rows = [("t", "c", float(v)) for v in (1, 2, 3, 4, 100, -50)] + [("t", "c", None)]
    df = spark.createDataFrame(rows, "table_name string, column_name string, value double")
    row = iqr_summary(df).first()
    q1, q3 = np.quantile([1, 2, 3, 4, 100, -50], [0.25, 0.75])
    assert (row.q1, row.q3, row.outliers, row.total_rows) == (q1, q3, 2, 7)
    assert (row.min_outlier, row.max_outlier, row.negative_outliers) == (-50.0, 100.0, 1)


def _trans(spark, rows):
    return spark.createDataFrame(
        rows, "trans_id int, account_id int, date date, type string, amount double, balance double"
    )


def test_rolling_frame_is_ninety_days(spark):
    days = [dt.date(1998, 1, 1), dt.date(1998, 1, 2), dt.date(1998, 12, 1)]
    df = _trans(spark, [(i, 1, d, "PRIJEM", 10.0 * (i + 1), 0.0) for i, d in enumerate(days)])
    out = with_history(df).orderBy("trans_id").collect()
    assert [r.avg_trans_amount_3m for r in out] == [10.0, 15.0, 30.0]
    whole = with_history(df, days=None).orderBy("trans_id").collect()
    assert [r.avg_trans_amount_3m for r in whole] == [20.0, 20.0, 20.0]


def test_opening_balances(spark):
    day = dt.date(1998, 1, 1)
    df = _trans(
        spark,
        [(i, i, day, t, 10.0, 100.0) for i, t in enumerate(["PRIJEM", "VYDAJ", "VYBER"])],
    )
    assert [r.initial_balance for r in with_history(df).orderBy("trans_id").collect()] == [90.0, 110.0, 110.0]


def test_history_with_repeated_and_null_numbers(spark):
    """An account gets the same figures however many rows it has."""
    rng = random.Random(6)
    day = dt.date(1997, 1, 1)
    rows = [
        (rng.choice([None, 5, 5, 7, 3_000_000_000 + i]), 1, rng.choice([None, day, day + dt.timedelta(40 * i)]),
         rng.choice(["PRIJEM", "VYDAJ", None]), rng.choice([None, i / 4]), rng.choice([None, i / 2]))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "trans_id bigint, account_id bigint, date date, type string, amount double, balance double")
    made = ["initial_balance", "avg_trans_amount_3m", "total_income_3m", "total_expense_3m", "num_trans_3m"]
    found = [
        sorted(map(repr, with_history(df, max_rows=n).select("trans_id", "date", "type", "amount", "final_balance", *made).collect()))
        for n in (0, 60, 10_000)
    ]
    assert found[0] == found[1] == found[2]


def test_amounts_that_are_no_money(spark):
    """NaN, infinity and amounts beyond 18 digits end no report."""
    from tellermill.functions.text import with_types

    raw = spark.createDataFrame(
        [("3000000000", "1", "1998-01-01", "PRIJEM", a, "0") for a in ("NaN", "Infinity", "1e18", "12.5", "x")],
        "trans_id string, account_id string, date string, type string, amount string, balance string",
    )
    df = with_types(raw, schema.CASTS["trans"]).withColumn("date", F.col("date").cast("date"))
    assert df.filter("trans_id = 3000000000").count() == 5
    assert sorted(r.amount or 0 for r in df.collect()) == [0, 0, 0, 12.5, 1e18]
    assert [r.total_income_3m for r in with_history(df).collect()] == [12.5] * 5


def _brute_history(rows):
    out = {}
    for tid, acc, day, kind, amount, balance in rows:
        mine = sorted((r for r in rows if r[1] == acc), key=lambda r: (r[2] or dt.date.min, r[0]))
        at = [r[0] for r in mine].index(tid)
        before = mine[at - 1][5] if at else None
        if before is None:
            before = balance - amount if kind == "PRIJEM" else balance + amount
        if day is None:
            frame = [r for r in mine if r[2] is None]
        else:
            frame = [r for r in mine if r[2] and day - dt.timedelta(90) <= r[2] <= day]
        mean = statistics.mean(round(r[4] * 100) for r in frame)
        out[tid] = (
            before,
            int(mean + 0.5) / 100,
            sum(round(r[4] * 100) for r in frame if r[3] == "PRIJEM") / 100,
            sum(round(r[4] * 100) for r in frame if r[3] == "VYDAJ") / 100,
            len(frame),
        )
    return out


@pytest.mark.parametrize("max_rows", [0, 60, 10_000])
def test_history_of_hot_accounts(spark, max_rows):
    """One account holds most rows; every split threshold gives the same answer."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        # Numbers spread over several blocks, so that a day is split as well.
        tid = rng.randint(0, 3) * (1 << 20) + i
        acc = 1 if rng.random() < 0.6 else rng.choice([2, 3, 4, None])
        day = rng.choice([None, *[dt.date(1997, 1, 1) + dt.timedelta(30 * k) for k in range(9)]])
        rows.append((tid, acc, day, rng.choice(["PRIJEM", "VYDAJ", "VYBER"]), rng.randint(1, 9999) / 100, rng.randint(-9999, 9999) / 100))
    got = {
        r.trans_id: (
            r.initial_balance, r.avg_trans_amount_3m, r.total_income_3m, r.total_expense_3m, r.num_trans_3m,
        )
        for r in with_history(_trans(spark, rows).repartition(4), max_rows=max_rows).collect()
    }
    assert got == _brute_history(rows)


def test_heavy_keys(spark):
    rows = [(k, i * 1000) for i, k in enumerate([1] * 5 + [2] * 3 + [None] * 9)]
    df = spark.createDataFrame(rows, "k int, trans_id bigint")
    assert {r[0] for r in heavy_keys(df, "k", 4).collect()} == {1, None}


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), (" ", 9.0), (None, 4.0), ("NULL", None)], "c string, x double"
    )
    nulls = {r.column_name: r for r in profile.null_profile({"t": df.withColumn("x", F.col("x").cast("string"))}).collect()}
    assert (nulls["c"].nulls, nulls["x"].nulls, nulls["c"].columns_with_nulls, nulls["x"].max_null_pct) == (3, 1, 2, 60.0)
    cols = {r.column_name: r for r in profile.column_profile({"t": df}).collect()}
    assert (cols["c"].distinct_values, cols["c"].nulls, cols["x"].data_type) == (3, 1, "double")
    shares = {r.value: r.pct for r in profile.value_shares({"t": df}, {"t": ["c"]}).collect()}
    assert shares == {"a": 50.0, " ": 25.0, "NULL": 25.0}
    alert = profile.cardinality_alerts({"t": df}, {"t": ["c"]}, high=2).first()
    assert (alert.distinct_values, alert.alert) == (3, "high cardinality")


def test_shape_is_bias_corrected(spark):
    df = spark.createDataFrame(
        [("t", "c", float(v)) for v in (1, 2, 9, 4)], "table_name string, column_name string, value double"
    )
    row = profile.numeric_shape(df).first()
    assert round(row["skew"], 3) == 1.331 and row.is_skewed == 1


def test_integrity(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (3, None)], "id int, k int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    tables = {"c": child, "p": parent}
    fk = integrity.fk_integrity(tables, {("c", "k"): ("p", "k")}).first()
    assert (fk.key_values, fk.missing, fk.orphan_pct, fk.is_ok) == (2, 1, 50.0, 0)
    orphans = integrity.with_orphan_flag(child, "k", parent, "k").collect()
    assert sorted((r.id, r.is_orphan) for r in orphans) == [(1, 0), (2, 1), (3, 1), (3, 1)]
    dup = integrity.duplicate_check({"c": child}, {"c": "id"}).first()
    assert (dup.total_rows, dup.key_duplicates, dup.row_duplicates) == (4, 2, 2)
    pk = integrity.pk_uniqueness({"c": child}, {"c": "id"}).first()
    assert (pk.total_rows, pk.distinct_values, pk.duplicates, pk.is_unique) == (4, 3, 1, 0)
    assert {r.k for r in integrity.without_match(parent, "k", child).collect()} == {2}
    odd = integrity.domain_check({"c": child}, {("c", "k"): [1, 2]}).collect()
    assert [(r.value, r.n) for r in odd] == [(9, 1)]


def test_samples(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    keep = sample_by_key(df, "k")
    n = keep.count()
    assert 800 < n < 1200
    assert keep.join(sample_by_key(df, "k"), "k").count() == n
    assert 20 < sample_rows(df.limit(1000)).count() < 90
    assert 800 < sample_rows(df).count() < 1200
