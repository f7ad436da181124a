"""Fact tables. Each is aggregated to its key before it is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.functions.money import cents, money_mean, money_sum, ratio, sum_cents
from tellermill.functions.rules import card_rank, customer_segment, flag

INCOME = (schema.INCOME_TYPE,)
EXPENSE = (schema.EXPENSE_TYPE,)


def account_transactions(
    trans: DataFrame,
    income_types: Sequence[str] = INCOME,
    expense_types: Sequence[str] = EXPENSE,
) -> DataFrame:
    """Activity per account: counts, sums, extremes, balances and rates.

    One partial and one final aggregation: a hot account is combined on the map
    side and reaches its reducer as one row per task.
    """
    amount, balance = F.col("amount"), F.col("final_balance")
    income = F.col("type").isin(*income_types)
    expense = F.col("type").isin(*expense_types)

    def part(test):
        return F.when(test, amount).otherwise(0.0)

    base = trans.groupBy("account_id").agg(
        F.count("*").alias("total_transactions"),
        F.count_if(income).alias("total_income_transactions"),
        F.count_if(expense).alias("total_expense_transactions"),
        money_sum(part(income)).alias("total_income_amount"),
        money_sum(part(expense)).alias("total_expense_amount"),
        money_mean(amount).alias("avg_transaction_amount"),
        F.max(amount).alias("max_transaction_amount"),
        F.min(amount).alias("min_transaction_amount"),
        F.stddev(amount).alias("stddev_transaction_amount"),
        F.max(balance).alias("max_balance"),
        F.min(balance).alias("min_balance"),
        money_mean(balance).alias("avg_balance"),
        F.max("date").alias("last_transaction_date"),
        F.min("date").alias("first_transaction_date"),
        (sum_cents(part(income) - part(expense)) / 100).alias("net_balance"),
    )
    spent, days = F.col("total_expense_amount"), F.col("days_active")
    return base.withColumn(
        "days_active", F.datediff("last_transaction_date", "first_transaction_date")
    ).withColumns(
        {
            "income_to_expense_ratio": F.when(spent > 0, ratio(F.col("total_income_amount"), spent)),
            "has_negative_balance": flag(F.col("min_balance") < 0),
            "transactions_per_day": F.when(days > 0, ratio(F.col("total_transactions"), days)),
        }
    )


def loan_by_account(loan: DataFrame) -> DataFrame:
    return loan.groupBy("account_id").agg(
        F.count("*").alias("num_loans"),
        money_sum(F.col("amount")).alias("total_loan_amount"),
        money_mean(F.col("amount")).alias("avg_loan_amount"),
        F.sum("is_risky").alias("num_risky_loans"),
        F.max("is_risky").alias("has_risky_loan"),
    )


def card_by_account(card: DataFrame, disp: DataFrame) -> DataFrame:
    """Cards per account over every disposition, and the best card type by rank."""
    return (
        card.select("disp_id", "type_card")
        .join(disp.select("disp_id", "account_id"), "disp_id")
        .groupBy("account_id")
        .agg(
            F.count("*").alias("num_cards"),
            F.max(F.struct(card_rank(F.col("type_card")), "type_card"))["type_card"].alias(
                "highest_card_type"
            ),
        )
    )


def with_products(
    account: DataFrame, loan: DataFrame, card: DataFrame, disp: DataFrame
) -> DataFrame:
    """Add loans, cards and the customer segment to rows keyed by account.

    Both sides are already aggregated by account_id, so the joins reuse that
    partitioning.
    """
    filled = {
        "num_loans": 0,
        "total_loan_amount": 0.0,
        "avg_loan_amount": 0.0,
        "num_risky_loans": 0,
        "has_risky_loan": 0,
        "num_cards": 0,
    }
    return (
        account.join(loan_by_account(loan), "account_id", "left")
        .join(card_by_account(card, disp), "account_id", "left")
        .fillna(filled)
        .withColumn("customer_segment", customer_segment(F.col("num_loans"), F.col("num_cards")))
    )


def account_summary(
    account: DataFrame, activity: DataFrame, loan: DataFrame, card: DataFrame, disp: DataFrame
) -> DataFrame:
    """One row per account: dimension, activity, loans, cards and segment."""
    return with_products(account.join(activity, "account_id", "left"), loan, card, disp)


def loan_dispositions(loan: DataFrame, account: DataFrame) -> DataFrame:
    """One row per loan with its account's owner, state and defaulted capital."""
    return loan.join(
        account.select("account_id", "owner_client_id", "district_id"), "account_id", "left"
    ).select(
        "loan_id",
        "account_id",
        "owner_client_id",
        "district_id",
        "loan_start_date",
        "loan_end_date",
        "status",
        "status_label",
        "amount",
        F.col("is_risky").alias("is_default"),
        F.when(F.col("is_risky") == 1, F.col("amount")).otherwise(0.0).alias("defaulted_capital"),
    )


def avg_monthly_transactions(trans: DataFrame) -> DataFrame:
    """Mean number and amount of transactions per month with activity, per account."""
    dated = trans.filter(F.col("date").isNotNull())
    monthly = dated.groupBy("account_id", F.trunc("date", "month").alias("month")).agg(
        F.count("*").alias("n"),
        F.sum(cents(F.col("amount")).cast("decimal(18,0)")).alias("cents"),
    )
    months = F.count("*")
    return monthly.groupBy("account_id").agg(
        months.alias("active_months"),
        ratio(F.sum("n"), months).alias("avg_transactions_per_month"),
        (ratio(F.sum("cents"), months, 0) / 100).alias("avg_amount_per_month"),
    )
