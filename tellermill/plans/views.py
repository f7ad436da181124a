"""Analysis views over the star schema.

Small sides are joined to each other first, so the transaction table is joined
once. Joins carry no hint: adaptive execution splits a hot account's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEHAVIOR_COLUMNS = [
    "client_id", "age_segment", "gender", "account_id", "frequency", "trans_id",
    "trans_date", "trans_type", "operation", "trans_amount", "final_balance",
    "is_amount_outlier",
]


def _transactions(trans: DataFrame) -> DataFrame:
    return trans.select(
        "account_id",
        "trans_id",
        F.col("date").alias("trans_date"),
        F.col("type").alias("trans_type"),
        "operation",
        F.col("amount").alias("trans_amount"),
        "final_balance",
        "is_amount_outlier",
    )


def customer_behavior(owned: DataFrame, trans: DataFrame) -> DataFrame:
    """Transactions of accounts with a known owner. ``owned``: see the dimensions."""
    return (
        _transactions(trans)
        .join(owned, "account_id")
        .withColumnRenamed("owner_client_id", "client_id")
        .select(*BEHAVIOR_COLUMNS)
    )


def loan_risk_analysis(loan: DataFrame, account: DataFrame, district: DataFrame) -> DataFrame:
    """Loans with owner and district. ``account`` needs its key, district and owner."""
    place = account.select("account_id", "district_id", "owner_client_id").join(
        district.select(
            "district_id", "region", "district_name", "average_salary", "unemployment_rate_96"
        ),
        "district_id",
    )
    return loan.join(place, "account_id").select(
        "loan_id",
        "account_id",
        F.col("amount").alias("loan_amount"),
        "duration",
        "status",
        "status_label",
        "is_risky",
        "loan_start_date",
        "owner_client_id",
        "district_id",
        "region",
        "district_name",
        "average_salary",
        "unemployment_rate_96",
    )


def account_activity(account: DataFrame, activity: DataFrame) -> DataFrame:
    """Every account, with its activity where it has any."""
    return account.select(
        "account_id",
        "district_id",
        "frequency",
        F.col("date").alias("account_start_date"),
        "account_age_years",
        "account_age_segment",
        "owner_client_id",
    ).join(
        activity.select(
            "account_id",
            "total_transactions",
            "total_income_amount",
            "total_expense_amount",
            "net_balance",
            "income_to_expense_ratio",
            "avg_transaction_amount",
            "avg_balance",
            "has_negative_balance",
            "transactions_per_day",
        ),
        "account_id",
        "left",
    )


def fraud_analysis(owned: DataFrame, trans: DataFrame, activity: DataFrame) -> DataFrame:
    """Transactions of owned accounts with the account's balance sign and age."""
    traits = owned.join(
        activity.select("account_id", "has_negative_balance"), "account_id", "left"
    )
    return (
        _transactions(trans)
        .join(traits, "account_id")
        .select(
            "trans_id",
            "account_id",
            "trans_amount",
            "is_amount_outlier",
            "final_balance",
            "has_negative_balance",
            "frequency",
            "account_age_years",
        )
    )
