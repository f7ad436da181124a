"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.functions.money import ratio, round_half_up
from tellermill.functions.rules import (
    ACCOUNT_AGE_BANDS,
    AGE_BANDS,
    LOAN_BANDS,
    band,
    is_risky,
    status_label,
)
from tellermill.functions.text import with_trimmed

def reference_day() -> Column:
    return F.lit(schema.REFERENCE_DATE).cast("date")


def _two_digits(birth_number: Column, start: int) -> Column:
    return F.substring(birth_number.cast("string"), start, 2).try_cast("int")


def dim_client(client: DataFrame) -> DataFrame:
    """Gender, birth date, age and age band read from the birth number."""
    number = F.col("birth_number")
    coded_month = _two_digits(number, 3)
    female = coded_month > 50
    month = F.when(female, coded_month - 50).otherwise(coded_month)
    born = F.try_to_date(
        F.concat(
            (_two_digits(number, 1) + 1900).cast("string"),
            F.lpad(month.cast("string"), 2, "0"),
            F.lpad(_two_digits(number, 5).cast("string"), 2, "0"),
        ),
        "yyyyMMdd",
    )
    age = F.year(reference_day()) - F.year("birth_date")
    return (
        client.withColumns(
            {"gender": F.when(female, "F").otherwise("M"), "birth_date": born}
        )
        .withColumn("age_at_1998", age)
        .withColumn("age_segment", band(F.col("age_at_1998"), AGE_BANDS))
    )


def dim_loan(loan: DataFrame) -> DataFrame:
    """End date, risk flag, state label, repayment ratio and amount band."""
    status = F.col("status")
    return with_trimmed(
        loan.withColumns(
            {
                "loan_end_date": F.add_months("date", F.col("duration")),
                "is_risky": is_risky(status),
                "status_label": status_label(status),
                "payment_to_amount_ratio": ratio(
                    F.col("payments") * F.col("duration"), F.col("amount")
                ),
                "loan_amount_segment": band(F.col("amount"), LOAN_BANDS),
            }
        ).withColumnRenamed("date", "loan_start_date"),
        ["status"],
    )


def owners(disp: DataFrame) -> DataFrame:
    """One owner per account, so that joining owners never multiplies accounts."""
    return (
        disp.filter(F.col("type") == schema.OWNER)
        .groupBy("account_id")
        .agg(F.min("client_id").alias("owner_client_id"))
    )


def with_account_age(account: DataFrame) -> DataFrame:
    """Age in days and years with its band, and the trimmed statement frequency."""
    years = round_half_up(F.col("account_age_days") / 365.25, 2)
    return (
        account.withColumn("account_age_days", F.datediff(reference_day(), "date"))
        .withColumn("account_age_years", years)
        .withColumn("account_age_segment", band(F.col("account_age_years"), ACCOUNT_AGE_BANDS))
        .withColumn("frequency", F.trim("frequency"))
    )


def dim_account(
    account: DataFrame, district: DataFrame, disp: DataFrame, client: DataFrame
) -> DataFrame:
    """Account with district, owner and age. ``client`` is the client dimension.

    The district side is joined without a hint: Spark broadcasts it while its
    size stays under the session's threshold and shuffles beyond that.
    """
    owner = client.select(
        F.col("client_id").alias("owner_client_id"),
        F.col("gender").alias("owner_gender"),
        F.col("age_at_1998").alias("owner_age"),
        F.col("age_segment").alias("owner_age_segment"),
    )
    return with_account_age(
        account.join(district, "district_id", "left")
        .join(owners(disp), "account_id", "left")
        .join(owner, "owner_client_id", "left")
    )


def owned_accounts(account: DataFrame, disp: DataFrame, client: DataFrame) -> DataFrame:
    """Accounts whose owner is a known client, with the owner's traits."""
    owner = client.select(
        F.col("client_id").alias("owner_client_id"), "age_segment", "gender", "age_at_1998"
    )
    return (
        with_account_age(account.select("account_id", "frequency", "date"))
        .select("account_id", "frequency", "account_age_years")
        .join(owners(disp), "account_id")
        .join(owner, "owner_client_id")
    )


def account_age_months(account: DataFrame) -> DataFrame:
    """Whole months from opening to the reference date."""
    months = F.floor(F.months_between(reference_day(), F.col("date"))).cast("int")
    return account.select("account_id", "date", months.alias("account_age_months"))


def dim_card(card: DataFrame) -> DataFrame:
    return with_trimmed(card.withColumnRenamed("type", "type_card"), ["type_card"])


def dim_disp(disp: DataFrame) -> DataFrame:
    return with_trimmed(disp, ["type"])


def dim_order(order: DataFrame) -> DataFrame:
    return with_trimmed(order, ["k_symbol"])


def dim_date(*frames: tuple[DataFrame, str]) -> DataFrame:
    """One row per day between the first and last date of the given columns."""
    spans = None
    for df, column in frames:
        span = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
        spans = span if spans is None else spans.unionByName(span)
    day = F.col("date")
    return (
        spans.agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter(F.col("low").isNotNull())
        .select(F.explode(F.sequence("low", "high")).alias("date"))
        .select(
            "date",
            F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
            F.dayofmonth(day).alias("day"),
            (F.weekday(day) + 1).alias("day_of_week"),
            F.weekofyear(day).alias("week"),
            F.month(day).alias("month"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
        )
    )


def dim_transaction_type(trans: DataFrame) -> DataFrame:
    """Distinct (type, operation) pairs with a key that is stable across runs."""
    # A mark before every value keeps null apart from an empty text.
    marked = [F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in ("type", "operation")]
    pair = F.concat_ws("|", *marked)
    return trans.select("type", "operation").distinct().select(
        F.md5(pair).alias("transaction_type_key"), "type", "operation"
    )
