"""Every named query against its checking SQL, and invariants of the tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks.compare import compare, connect
from tellermill.plans import dashboard, views
from tellermill.plans.registry import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_checking_sql():
    assert set(QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(bank, db, name):
    assert compare(QUERIES[name](bank), db, entry_point.oracle_sql()[name]) == ""


def test_entry(spark, sf_dir):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "customer_segment" in df.columns
    assert entry_point.queries()["risk_rate"](spark, sf_dir).count() == 1


def test_joins_keep_rows(bank):
    accounts = bank["account"].count()
    assert bank.dim_account.count() == accounts
    assert bank.fact_account_summary.count() == accounts
    assert bank.fact_transactions.count() == bank["trans"].count()


def test_shares_and_rates(bank):
    shares = QUERIES["value_shares"](bank).groupBy("table_name", "column_name").agg(F.sum("pct").alias("s"))
    assert all(abs(r.s - 100) < 0.01 for r in shares.collect())
    assert bank.fact_transactions.filter("num_trans_3m < 1").count() == 0


def test_data_reaches_the_rules(bank):
    """The stand-in tables have what the rules are about: old rows, orphans, childless parents."""
    rows = QUERIES["rolling_90d"](bank).groupBy("account_id").agg(F.max("num_trans_3m").alias("most"), F.count("*").alias("n"))
    assert rows.filter("most < n").count() > 10
    assert QUERIES["clients_without_account"](bank).count() > 0
    assert QUERIES["fk_integrity"](bank).agg(F.sum("missing")).first()[0] > 0
    assert bank["loan"].count() == bank.raw["loan"].count() == bank["loan"].filter("date is not null").count()
    days = QUERIES["dim_date"](bank).select("date")
    assert bank["trans"].join(days, "date", "left_anti").count() == 0


def test_filters_are_optional(bank):
    df = bank.v_customer_behavior
    assert dashboard.apply_filters(df) is df
    only = dashboard.apply_filters(df, "trans_date", genders=["F"])
    assert only.count() == df.filter(F.col("gender") == "F").count()
    with pytest.raises(ValueError, match="nothing_here"):
        dashboard.apply_filters(df.drop("gender").withColumnRenamed("trans_date", "d"), "nothing_here", start="1998-01-01")
    with pytest.raises(ValueError, match="gender"):
        dashboard.apply_filters(df.drop("gender"), genders=["F"])


def test_relative_range_counts_from_latest_date(bank):
    dates = bank.loans.select("loan_start_date")
    latest = dates.agg(F.max("loan_start_date")).first()[0]
    got = dashboard.apply_filters(dates, "loan_start_date", last_months=3)
    assert got.agg(F.max("loan_start_date")).first()[0] == latest
    want = dates.filter(F.col("loan_start_date") > F.add_months(F.lit(latest), -3)).count()
    assert got.count() == want


def test_plain_sql_over_views(spark, bank):
    """The tables answer SQL by their names, with the same figures."""
    bank.create_views()
    by_sql = spark.sql(
        "select loan_amount_segment, count(*) n, sum(case when status in ('B', 'D') then 1 else 0 end) bad "
        "from dim_loan group by loan_amount_segment"
    )
    want = QUERIES["default_rate_by_segment"](bank)
    assert {tuple(r) for r in by_sql.collect()} == {
        (r.loan_amount_segment, r.total_prestamos, r.prestamos_default) for r in want.collect()
    }
    got = spark.sql("select count(*) from v_fraude_analisis where has_negative_balance is null").first()[0]
    assert got == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_transaction_windows_share_one_shuffle(spark, bank):
    """Previous balance and rolling frame of ordinary accounts: one exchange, one sort."""
    from tellermill.operators.history import _frame, _plain

    text = plan(_plain(bank["trans"], _frame(90)))
    assert text.count("Exchange hashpartitioning(account_id") == 1
    assert text.count("Sort [account_id") == 1


def test_no_cartesian_products(spark, sf_dir, bank):
    for name in ("account_summary", "v_fraud_analysis", "executive_kpis", "numeric_profile", "filtered_kpis"):
        text = plan(QUERIES[name](bank))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_views_read_only_their_columns(bank):
    text = plan(views.account_activity(bank.dim_account, bank.fact_account_transactions).select("account_id"))
    assert "c_name" not in text
