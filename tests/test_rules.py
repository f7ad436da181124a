"""Cleaning and feature rules on small hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tellermill.functions import rules, text
from tellermill.functions.money import money_mean_2, money_sum, money_text, round_half_up
from tellermill.operators.profile import blanks_to_null
from tellermill.plans import dims, facts
from tellermill.plans.clean import clean, missing_columns


def column(df, name):
    return [r[name] for r in df.collect()]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], [' "Account ID" ', "Date-Of"])
    assert text.clean_names(df).columns == ["account_id", "date-of"]
    assert text.clean_names(df, wide=True).columns == ["account_id", "date_of"]
    assert text.clean_sink_names(spark.createDataFrame([(1, 2)], ["A-b c", "d.E"])).columns == [
        "a_b_c",
        "d_e",
    ]


def test_name_collision_is_reported(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a_b"])
    with pytest.raises(ValueError, match="a_b"):
        text.clean_names(df)


def test_dates(spark):
    values = ["930101", "980231", "9301", None, " ", "9X0101", "000229"]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    assert column(df.select(text.parse_yymmdd(F.col("d")).alias("d")), "d") == [
        dt.date(1993, 1, 1), None, None, None, None, None, None,
    ]
    later = df.select(text.parse_yymmdd(F.col("d"), century=20).alias("d"))
    assert column(later, "d")[-1] == dt.date(2000, 2, 29)
    issued = spark.createDataFrame([("931107 00:00:00",), ("931199 00:00:00",)], "d string")
    assert column(issued.select(text.parse_yymmdd_time(F.col("d")).alias("d")), "d") == [
        dt.date(1993, 11, 7), None,
    ]


def test_labels_casts_and_blanks(spark):
    df = spark.createDataFrame([("  ", "1"), (None, "x"), (" a ", "")], "k string, n string")
    out = text.with_types(text.with_labels(df, {"k": "NONE", "gone": "?"}), {"n": "int"})
    assert [tuple(r) for r in out.collect()] == [("NONE", 1), ("NONE", None), (" a ", None)]
    assert [tuple(r) for r in blanks_to_null(df).collect()] == [
        (None, "1"), (None, "x"), (" a ", None),
    ]
    assert column(text.with_trimmed(df, ["k"], upper=True), "k") == ["", None, "A"]


def test_client_features(spark):
    df = spark.createDataFrame(
        [(i, n) for i, n in enumerate(["706213", "450204", "655213", "  ", "991399"])],
        "client_id int, birth_number string",
    )
    rows = dims.dim_client(df).orderBy("client_id").collect()
    assert [(r.gender, r.birth_date, r.age_at_1998, r.age_segment) for r in rows] == [
        ("F", dt.date(1970, 12, 13), 28, "25-34"),
        ("M", dt.date(1945, 2, 4), 53, "45-54"),
        ("F", dt.date(1965, 2, 13), 33, "25-34"),
        ("M", None, None, None),
        ("M", None, None, None),
    ]


def test_age_bands(spark):
    ages = [24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    got = column(df.select(rules.band(F.col("a"), rules.AGE_BANDS).alias("b")), "b")
    assert got == [
        "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64", "65+", None,
    ]
    legacy = df.select(rules.band(F.col("a"), rules.AGE_BANDS, absent="65+").alias("b"))
    assert column(legacy, "b")[-1] == "65+"


def test_loan_features(spark):
    amounts = [49999.99, 50000.0, 149999.99, 150000.0, 299999.99, 300000.0, 0.0]
    df = spark.createDataFrame(
        [(a, dt.date(1996, 1, 31), 1, 10.0, s) for a, s in zip(amounts, "ABCDAX ")],
        "amount double, date date, duration int, payments double, status string",
    )
    rows = dims.dim_loan(df).collect()
    assert [r.loan_amount_segment for r in rows] == [
        "Small (< 50K)", "Medium (50K-150K)", "Medium (50K-150K)", "Large (150K-300K)",
        "Large (150K-300K)", "Very Large (300K+)", "Small (< 50K)",
    ]
    assert [r.is_risky for r in rows] == [0, 1, 0, 1, 0, 0, 0]
    assert rows[1].status_label == "Contract finished, loan not paid"
    assert rows[5].status_label == "Unknown"
    assert rows[0].loan_end_date == dt.date(1996, 2, 29)
    assert rows[6].payment_to_amount_ratio is None and rows[6].status == ""


def test_account_age(spark):
    df = spark.createDataFrame(
        [(1, " X ", dt.date(1998, 1, 1)), (2, "Y", dt.date(1996, 12, 31)), (3, "Z", None)],
        "account_id int, frequency string, date date",
    )
    rows = dims.with_account_age(df).orderBy("account_id").collect()
    assert [(r.frequency, r.account_age_days, r.account_age_years, r.account_age_segment) for r in rows] == [
        ("X", 364, 1.0, "Recent (1-3 years)"),
        ("Y", 730, 2.0, "Recent (1-3 years)"),
        ("Z", None, None, None),
    ]
    months = column(dims.account_age_months(df).orderBy("account_id"), "account_age_months")
    assert months == [11, 24, None]


def test_second_owner_does_not_multiply_accounts(spark):
    disp = spark.createDataFrame(
        [(1, 9, 1, "OWNER"), (2, 4, 1, "OWNER"), (3, 5, 1, "DISPONENT")],
        "disp_id int, client_id int, account_id int, type string",
    )
    assert [tuple(r) for r in dims.owners(disp).collect()] == [(1, 4)]


def test_highest_card_is_by_rank(spark):
    disp = spark.createDataFrame([(1, 7, "OWNER")], "disp_id int, account_id int, type string")
    card = spark.createDataFrame(
        [(1, 1, "junior"), (2, 1, "gold")], "card_id int, disp_id int, type_card string"
    )
    assert [tuple(r) for r in facts.card_by_account(card, disp).collect()] == [(7, 2, "gold")]


def test_segments_and_flags(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "l int, c int")
    got = df.select(rules.customer_segment(F.col("l"), F.col("c")).alias("s"))
    assert column(got, "s") == ["Premium", "Loan Customer", "Card Customer", "Basic"]
    df = spark.createDataFrame([(3, 1), (3, 0), (0, 1), (0, 0)], "o int, n int")
    got = df.select(rules.risk_flag(F.col("o"), F.col("n")).alias("s"))
    assert column(got, "s") == ["ALTO", "MEDIO", "MEDIO", "BAJO"]
    df = spark.createDataFrame([("PRIJEM",), ("OTHER",), (None,)], "t string")
    got = df.select(rules.named(F.col("t"), rules.TRANS_TYPE_NAMES).alias("s"))
    assert column(got, "s") == ["INGRESO", "OTHER", None]


def test_money(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (-0.25,)], "x double")
    row = df.agg(
        money_sum(F.col("x")).alias("s"), money_mean_2(F.col("x")).alias("m")
    ).first()
    assert (row.s, row.m) == (0.05, 0.02)
    ties = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (-0.001,)], "x double")
    assert column(ties.select(round_half_up(F.col("x"), 0).alias("r")), "r") == [3.0, -3.0, 0.0, 0.0]
    assert column(ties.limit(0).agg(money_mean_2(F.col("x")).alias("m")), "m") == [None]
    big = spark.createDataFrame([(103261740.25,)], "x double")
    assert column(big.select(money_text(F.col("x")).alias("t")), "t") == ["103261740.25"]


def test_clean_reports_missing_columns(spark):
    df = spark.createDataFrame([("1", "2", "930101")], '`"Account_ID"` string, district_id string, date string')
    assert missing_columns("account", df) == ["frequency"]
    row = clean("account", df).first()
    assert (row.account_id, row.district_id, row.date) == (1, 2, dt.date(1993, 1, 1))


def test_district_names(spark):
    df = spark.createDataFrame([("7", "Brno", "?")], "A1 string, A2 string, A12 string")
    row = clean("district", df).first().asDict()
    assert row == {"district_id": 7, "district_name": "Brno", "unemployment_rate_95": None}


def test_activity_and_segments(spark):
    trans = spark.createDataFrame(
        [
            (1, 1, dt.date(1998, 1, 1), "PRIJEM", 100.0, 100.0),
            (2, 1, dt.date(1998, 1, 5), "VYDAJ", 40.0, -1.0),
            (3, 1, dt.date(1998, 1, 9), "VYBER", 10.0, 50.0),
            (4, 2, dt.date(1998, 1, 9), "PRIJEM", 10.0, 10.0),
        ],
        "trans_id int, account_id int, date date, type string, amount double, final_balance double",
    )
    rows = {r.account_id: r for r in facts.account_transactions(trans).collect()}
    one, two = rows[1], rows[2]
    assert (one.total_transactions, one.total_income_transactions, one.total_expense_transactions) == (3, 1, 1)
    assert (one.net_balance, one.income_to_expense_ratio, one.has_negative_balance) == (60.0, 2.5, 1)
    assert (one.days_active, one.transactions_per_day) == (8, 0.375)
    assert (two.income_to_expense_ratio, two.transactions_per_day, two.has_negative_balance) == (None, None, 0)
    wider = facts.account_transactions(trans, expense_types=["VYDAJ", "VYBER"])
    assert {r.account_id: r.total_expense_amount for r in wider.collect()} == {1: 50.0, 2: 0.0}
