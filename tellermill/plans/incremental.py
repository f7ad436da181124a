"""Transactions in batches: the typed table, the account history and the account activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellermill import schema
from tellermill.operators.history import with_history
from tellermill.operators.nullsafe import same_keys
from tellermill.plans import facts
from tellermill.sources.files import work_folder
from tellermill.sources.incremental import Ledger, StoredTable, read_or_empty, saved

#: Folders of the tables that are kept by account.
ACCOUNT_PARTS = 64
MARK = "trans_id"


def _by_account() -> Column:
    return F.lpad(F.pmod(F.xxhash64("account_id"), F.lit(ACCOUNT_PARTS)).cast("string"), 4, "0")


class TransactionStore:
    """Transactions, their history and the activity of accounts below one folder.

    A batch may bring new transactions, late ones and corrected ones. Transactions are kept
    by month. Of the other two tables only the rows of accounts that a batch touches are
    computed again, from the stored transactions of these accounts. The outlier flag depends
    on all amounts, so it is set when the table is read.
    """

    def __init__(self, spark: SparkSession, folder: str, trans: T.StructType):
        self.spark, self.folder = spark, folder
        blank = spark.createDataFrame([], trans)
        self.ledger = Ledger(spark, f"{folder}/loads")
        month = F.date_format("date", "yyyy-MM")
        self.trans = StoredTable(spark, f"{folder}/trans", trans, ("trans_id",), month)
        history = with_history(blank)
        self.history = StoredTable(spark, f"{folder}/history", history.schema, ("account_id",), _by_account())
        activity = facts.account_transactions(history)
        self.activity = StoredTable(spark, f"{folder}/activity", activity.schema, ("account_id",), _by_account())

    def load(self, batch: str, trans: DataFrame) -> int:
        """Take in a batch of typed transactions; one that is complete is not loaded again.

        Of several rows of a number in a batch the one with the latest date wins, and a later
        batch replaces what an earlier one brought. After a failure the same batch can be
        given again: it starts over and leaves nothing twice. Returns the batch's rows.
        """
        if done := self.ledger.find(batch):
            return done["row_count"]
        load = self.ledger.next_load()
        trans = saved(trans, work_folder(self.spark, "batch"))
        # Accounts of replaced rows are only known before they are replaced, so they are
        # noted first; a second try adds to the note of the first.
        note = f"{self.folder}/touched/{load:010d}"
        ids = trans.select(F.col("trans_id").alias("_trans_id")).filter("_trans_id is not null").distinct()
        before = self.trans.read().join(ids, same_keys(["trans_id"]), "left_semi").select("account_id")
        accounts = trans.select("account_id").unionByName(before).distinct()
        accounts.write.mode("append").parquet(note)
        rows = self.trans.merge(trans, load, ("date",))
        touched = read_or_empty(self.spark, note, accounts.schema).distinct()
        self._refresh(touched, load)
        mark = trans.agg(F.max(F.col(MARK).cast("long"))).first()[0]
        self.ledger.record(batch, load, rows, mark)
        return rows

    def load_unseen(self, source: DataFrame) -> int:
        """Take in the rows of a growing source whose numbers lie above all loaded ones."""
        high = self.ledger.high_mark()
        return self.load(f"above {'nothing' if high is None else high}", self.ledger.unseen(source, MARK))

    def _refresh(self, accounts: DataFrame, load: int) -> None:
        own = accounts.toDF("_account_id")
        trans = self.trans.read().join(own, same_keys(["account_id"]), "left_semi")
        history = with_history(trans)
        self.history.replace(history, accounts, load)
        fresh = self.history.read().join(own, same_keys(["account_id"]), "left_semi")
        self.activity.replace(facts.account_transactions(fresh), accounts, load)


def in_two_loads(store: TransactionStore, trans: DataFrame) -> None:
    """Load a table in two batches, the earlier dates first and with provisional rows.

    The second batch brings the later half, and corrects what the first had booked under a
    wrong amount, month and account. It is given twice, as after a lost answer.
    """
    ends = trans.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.date_add("a", F.floor(F.datediff("b", "a") / 2).cast("int")))
    half = ends.first()[0]
    early = F.col("date").isNull() | (F.col("date") <= F.lit(half))
    wrong = F.coalesce(F.col("type") == schema.INCOME_TYPE, F.lit(False)) & F.col("trans_id").isNotNull()
    provisional = trans.filter(early).withColumns(
        {
            "amount": F.when(wrong, F.col("amount") + 1).otherwise(F.col("amount")),
            "date": F.when(wrong, F.add_months("date", -1)).otherwise(F.col("date")),
            "account_id": F.when(wrong, F.col("account_id") + 1).otherwise(F.col("account_id")),
        }
    )
    store.load("first half", provisional)
    final = trans.filter(~early | wrong)
    for _ in range(2):
        store.load("second half", final)
