"""Aggregates behind the dashboard's cards, charts and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.functions.money import cents, money_mean_2, money_sum, percent, ratio, round_half_up
from tellermill.functions.rules import risk_flag
from tellermill.operators.profile import union_all


def defaulted() -> Column:
    return F.col("is_risky") == 1


def apply_filters(
    df: DataFrame,
    date_column: str | None = None,
    start: str | None = None,
    end: str | None = None,
    last_months: int | None = None,
    regions: Sequence[str] | None = None,
    age_segments: Sequence[str] | None = None,
    genders: Sequence[str] | None = None,
) -> DataFrame:
    """Global filters; each is optional. A filter on a column that is not there is an error.

    ``last_months`` counts back from the latest date in the data.
    """
    tests: list[Column] = []
    if (start or end or last_months) and date_column not in df.columns:
        raise ValueError(f"no date column {date_column}")
    if date_column in df.columns:
        day = F.col(date_column)
        if start:
            tests.append(day >= F.lit(start).cast("date"))
        if end:
            tests.append(day <= F.lit(end).cast("date"))
        if last_months:
            latest = df.agg(F.max(date_column)).scalar()
            tests.append(day > F.add_months(latest, -last_months))
    for column, allowed in (("region", regions), ("age_segment", age_segments), ("gender", genders)):
        if allowed:
            if column not in df.columns:
                raise ValueError(f"no column {column} to filter by")
            tests.append(F.col(column).isin(*allowed))
    for test in tests:
        df = df.filter(test)
    return df


def _cards(df: DataFrame, **values: Column) -> DataFrame:
    """One aggregation, one (metric, value) row per figure."""
    one = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    return one.unpivot([], list(values), "metric", "value")


def risk_kpis(loan: DataFrame, trans: DataFrame) -> DataFrame:
    amount, outlier = F.col("amount"), F.col("is_amount_outlier") == 1
    bad_amount = F.when(defaulted(), amount).otherwise(0.0)
    return union_all(
        [
            _cards(
                loan,
                default_rate_pct=percent(F.count_if(defaulted()), F.count("loan_id")),
                high_risk_loans=F.count_if(defaulted()),
                defaulted_capital=money_sum(bad_amount),
                defaulted_capital_pct=percent(money_sum(bad_amount), money_sum(amount)),
            ),
            _cards(
                trans,
                suspicious_transactions=F.count_if(outlier),
                suspicious_pct=percent(F.count_if(outlier), F.count("*")),
            ),
        ]
    )


def executive_cards(
    client: DataFrame, account: DataFrame, loan: DataFrame, trans: DataFrame
) -> DataFrame:
    active = account.select("account_id").join(
        trans.select("account_id").distinct(), "account_id", "left_semi"
    )
    return union_all(
        [
            _cards(client, customers=F.count("*")),
            _cards(active, active_accounts=F.count("*")),
            _cards(
                loan,
                loans=F.count("*"),
                loan_portfolio=money_sum(F.col("amount")),
                default_rate_pct=percent(F.count_if(defaulted()), F.count("*")),
            ),
            _cards(trans, avg_transaction=money_mean_2(F.col("amount"))),
        ]
    )


def loan_volume_by_region(loan_risk: DataFrame) -> DataFrame:
    return loan_risk.groupBy("region").agg(
        F.count("*").alias("loans"), money_sum(F.col("loan_amount")).alias("volume")
    )


def loan_trend(loan: DataFrame) -> DataFrame:
    return loan.groupBy(F.trunc("loan_start_date", "month").alias("month"), "status").agg(
        F.count("*").alias("loans")
    )


def trans_volume_by_type(trans: DataFrame) -> DataFrame:
    direction = F.when(F.col("type") == schema.INCOME_TYPE, "credit").otherwise("debit")
    return trans.groupBy("type", direction.alias("direction")).agg(
        F.count("*").alias("transactions"), money_sum(F.col("amount")).alias("volume")
    )


def customer_cards(client: DataFrame, owned: DataFrame, trans: DataFrame) -> DataFrame:
    gender = F.col("gender")
    monthly = trans.groupBy("account_id", F.trunc("date", "month").alias("month")).agg(
        F.count("*").alias("n")
    )
    active = (
        owned.join(trans.select("account_id").distinct(), "account_id", "left_semi")
        .select(F.col("owner_client_id").alias("client_id"), F.lit(1).alias("active"))
        .distinct()
    )
    return union_all(
        [
            _cards(
                client.join(active, "client_id", "left"),
                avg_age=round_half_up(
                    F.try_divide(F.sum("age_at_1998").cast("double"), F.count("age_at_1998")), 2
                ),
                male_pct=percent(F.count_if(gender == "M"), F.count("*")),
                female_pct=percent(F.count_if(gender == "F"), F.count("*")),
                active_customers=F.count("active"),
                activity_rate_pct=percent(F.count("active"), F.count("*")),
            ),
            _cards(monthly, avg_transactions_per_month=ratio(F.sum("n"), F.count("*"))),
        ]
    )


def customers_by_age_gender(client: DataFrame, bands: Column) -> DataFrame:
    return client.groupBy(bands.alias("age_segment"), "gender").agg(F.count("*").alias("customers"))


def activity_heatmap(owned: DataFrame, activity: DataFrame) -> DataFrame:
    """Transaction volume, age band by gender."""
    volume = activity.groupBy("account_id").agg(
        F.sum(cents(F.col("amount")).cast("decimal(18,0)")).alias("cents")
    )
    table = (
        volume.join(owned.select("account_id", "age_segment", "gender"), "account_id")
        .groupBy("age_segment")
        .pivot("gender", ["F", "M"])
        .agg(F.sum("cents"))
    )
    return table.select(
        "age_segment", *[(F.col(g).cast("double") / 100).alias(f"volume_{g.lower()}") for g in "FM"]
    )


def customers_by_region(client: DataFrame, district: DataFrame, loan_risk: DataFrame) -> DataFrame:
    people = (
        client.select("client_id", "district_id")
        .join(district.select("district_id", "region"), "district_id")
        .groupBy("region")
        .agg(F.count("*").alias("customers"))
    )
    loans = loan_risk.groupBy("region").agg(money_sum(F.col("loan_amount")).alias("loan_volume"))
    return people.join(loans, "region", "left").fillna(0.0, ["loan_volume"])


def activity_by_account_age(account: DataFrame, activity: DataFrame) -> DataFrame:
    """Mean transactions and mean of account balances, per account age band."""
    return (
        account.select("account_id", "account_age_segment")
        .join(
            activity.select("account_id", "total_transactions", "avg_balance"), "account_id", "left"
        )
        .groupBy("account_age_segment")
        .agg(
            F.count("*").alias("accounts"),
            round_half_up(
                F.try_divide(
                    F.coalesce(F.sum("total_transactions"), F.lit(0)).cast("double"), F.count("*")
                ),
                2,
            ).alias("avg_transactions"),
            round_half_up(F.avg("avg_balance"), 2).alias("avg_balance"),
        )
    )


def income_expense_by_frequency(account: DataFrame, activity: DataFrame) -> DataFrame:
    return (
        account.select("account_id", "frequency")
        .join(activity.select("account_id", "total_income_amount", "total_expense_amount"), "account_id")
        .groupBy("frequency")
        .agg(
            money_sum(F.col("total_income_amount")).alias("income"),
            money_sum(F.col("total_expense_amount")).alias("expense"),
        )
    )


def outlier_scatter(history: DataFrame) -> DataFrame:
    return history.select("trans_id", "amount", "final_balance", "is_amount_outlier", "num_trans_3m")


def outliers_by_type(trans: DataFrame) -> DataFrame:
    return trans.groupBy("type").agg(F.sum("is_amount_outlier").alias("outliers"))


def default_trend_by_region(loan_risk: DataFrame) -> DataFrame:
    return loan_risk.groupBy("region", F.trunc("loan_start_date", "month").alias("month")).agg(
        F.count("*").alias("loans"),
        F.count_if(defaulted()).alias("defaults"),
        percent(F.count_if(defaulted()), F.count("*")).alias("default_rate_pct"),
    )


def top_districts(loan_risk: DataFrame, k: int = 10) -> DataFrame:
    best = (
        loan_risk.groupBy("district_id", "district_name", "region")
        .agg(
            F.count("*").alias("loans"),
            money_sum(F.col("loan_amount")).alias("volume"),
            F.max("average_salary").alias("average_salary"),
            percent(F.count_if(defaulted()), F.count("*")).alias("default_rate_pct"),
        )
        .orderBy(F.desc("volume"), "district_name")
        .limit(k)
    )
    # The window sees k rows: the limit comes first.
    place = F.row_number().over(Window.orderBy(F.desc("volume"), "district_name"))
    return best.withColumn("rank", place)


def top_anomalous_accounts(risk: DataFrame, k: int = 20) -> DataFrame:
    return (
        risk.filter(F.col("num_outliers") > 0)
        .select(
            "account_id",
            "num_outliers",
            F.col("volume").alias("total_volume"),
            F.col("mean").alias("avg_transaction"),
            "has_negative_balance",
            risk_flag(F.col("num_outliers"), F.col("has_negative_balance")).alias("risk_flag"),
        )
        .orderBy(F.desc("num_outliers"), F.desc("total_volume"), "account_id")
        .limit(k)
    )


def kpi_changes(loan: DataFrame) -> DataFrame:
    """Loans per year and per month, with the change against the period before."""
    started = loan.filter(F.col("loan_start_date").isNotNull())
    monthly = started.groupBy(F.trunc("loan_start_date", "month").alias("month")).agg(
        F.count("*").alias("n"),
        F.sum(cents(F.col("amount")).cast("decimal(18,0)")).alias("cents"),
        F.count_if(defaulted()).alias("defaults"),
    )
    # Years are made of months, so the loans are read and shuffled once.
    units = monthly.select("*", F.explode(F.array(F.lit("year"), F.lit("month"))).alias("unit"))
    start = F.when(F.col("unit") == "year", F.trunc("month", "year")).otherwise(F.col("month"))
    periods = units.groupBy("unit", start.alias("period")).agg(
        F.sum("n").alias("loans"),
        (F.sum("cents").cast("double") / 100).alias("volume"),
        percent(F.sum("defaults"), F.sum("n")).alias("default_rate_pct"),
    )
    # At most one row per calendar year or month.
    before = Window.partitionBy("unit").orderBy("period")

    def grown(c: str) -> Column:
        last = F.lag(c).over(before)
        return percent(F.col(c) - last, last)

    return periods.withColumns(
        {
            "loans_change_pct": grown("loans"),
            "volume_change_pct": grown("volume"),
            "default_rate_change_pp": round_half_up(
                F.col("default_rate_pct") - F.lag("default_rate_pct").over(before), 2
            ),
        }
    )
