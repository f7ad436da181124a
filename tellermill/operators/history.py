"""Account history: previous balance and rolling activity, safe for hot accounts.

An ordinary account is one window partition. An account with more rows than one
task should sort is cut into chunks of a day and a block of transaction numbers;
each chunk is reduced to its closing balance and totals, the windows run over
the chunks, and the rows of a chunk only need what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.functions.money import cents, round_half_up
from tellermill.functions.rules import opening_balance
from tellermill.operators.nullsafe import same_keys

MAX_ROWS_PER_TASK = 4_000_000
CHUNK_ROWS = 1 << 20
# Order of the rows of a day: total but for rows that are equal in all that matters here,
# so both ways of computing agree on repeated and null numbers.
ORDER = ("trans_id", "type", "amount", "balance")


def heavy_keys(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows, at most ``rows / max_rows`` of them.

    With each comes the least transaction number and the width of a block of numbers.
    """
    spread = (F.max("trans_id") - F.min("trans_id") + 1).cast("double")
    return (
        df.groupBy(F.col(key).alias(f"_{key}"))
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("trans_id").alias("_low"),
            F.greatest(F.ceil(spread * CHUNK_ROWS / F.count(F.lit(1))), F.lit(1)).alias("_width"),
        )
        .filter(F.col("_rows") > max_rows)
        .drop("_rows")
    )


def _frame(days: int | None) -> str:
    if days is None:
        return "partition by account_id"
    return (
        "partition by account_id order by date "
        f"range between interval '{days}' day preceding and current row"
    )


def _measures() -> dict[str, Column]:
    """What a row, or a chunk of rows, adds to the rolling figures."""
    amount = cents(F.col("amount"))

    def of_type(kind: str) -> Column:
        return F.when(F.col("type") == kind, amount).otherwise(0).cast("decimal(18,0)")

    return {
        "m_amount": amount.cast("decimal(18,0)"),
        "m_valued": F.col("amount").isNotNull().cast("bigint"),
        "m_income": of_type(schema.INCOME_TYPE),
        "m_expense": of_type(schema.EXPENSE_TYPE),
        "m_rows": F.lit(1).cast("bigint"),
    }


def _over(frame: str) -> dict[str, Column]:
    return {f"r_{m[2:]}": F.expr(f"sum({m}) over ({frame})") for m in _measures()}


def _plain(trans: DataFrame, frame: str) -> DataFrame:
    order = Window.partitionBy("account_id").orderBy("date", *ORDER)
    return trans.withColumns(_measures()).withColumns(
        {"previous": F.lag("balance").over(order), **_over(frame)}
    )


def _chunked(trans: DataFrame, frame: str, heavy: DataFrame) -> DataFrame:
    # One struct column is the key of the aggregation, the join and the inner
    # window, and its null fields match each other: the rows are shuffled once.
    # Blocks are as wide as gives about CHUNK_ROWS rows, however far apart the numbers are.
    limits = F.broadcast(heavy)
    block = F.floor((F.col("trans_id") - F.col("_low")) / F.col("_width")).alias("block")
    rows = (
        trans.join(limits, same_keys(["account_id"]))
        .withColumns({**_measures(), "chunk": F.struct("account_id", "date", block)})
        .drop(*heavy.columns)
    )
    last = F.max(F.struct(*ORDER))["balance"]
    before = F.lag("closing").over(Window.partitionBy("account_id").orderBy("date", "block"))
    chunks = (
        rows.groupBy("chunk")
        .agg(*[F.sum(m).alias(m) for m in _measures()], last.alias("closing"))
        .select("*", "chunk.*")
        .withColumns({"carried": before, **_over(frame)})
        .select("chunk", "carried", *_over(frame))
    )
    inner = Window.partitionBy("chunk").orderBy(*ORDER)
    return rows.join(chunks, "chunk").withColumn(
        "previous",
        F.when(F.row_number().over(inner) == 1, F.col("carried")).otherwise(
            F.lag("balance").over(inner)
        ),
    )


def with_history(
    trans: DataFrame, days: int | None = 90, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Opening balance, and average, income, expense and count over the last ``days``.

    Rows of the same date share one rolling frame. ``days=None`` takes the whole
    account as the frame.
    """
    frame = _frame(days)
    heavy = heavy_keys(trans, "account_id", max_rows)
    # Bounded: no more than (rows / max_rows) account numbers exist in it.
    known = F.broadcast(heavy.select("_account_id"))
    usual = _plain(trans.join(known, same_keys(["account_id"]), "left_anti"), frame)
    hot = _chunked(trans, frame, heavy)
    made = ["previous", *_over(frame)]
    joined = usual.select(*trans.columns, *made).unionByName(hot.select(*trans.columns, *made))
    return (
        joined.withColumns(
            {
                "initial_balance": F.coalesce(
                    "previous", opening_balance(F.col("type"), F.col("balance"), F.col("amount"))
                ),
                "avg_trans_amount_3m": round_half_up(
                    F.try_divide(F.col("r_amount").cast("double"), F.col("r_valued")), 0
                )
                / 100,
                "total_income_3m": F.col("r_income").cast("double") / 100,
                "total_expense_3m": F.col("r_expense").cast("double") / 100,
                "num_trans_3m": F.col("r_rows"),
            }
        )
        .drop(*made)
        .withColumnRenamed("balance", "final_balance")
    )
