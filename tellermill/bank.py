"""The bank data set and everything derived from it, built lazily."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tellermill import schema
from tellermill.operators.history import with_history
from tellermill.operators.outliers import with_outlier_flag
from tellermill.plans import dims, facts, views
from tellermill.plans.clean import clean
from tellermill.sources.files import read_csv, read_parquet
from tellermill.sources.standin import STANDIN, StandinReader


class Tables(Mapping):
    """Frames by table name, each opened when it is first used."""

    def __init__(self, names: Iterator[str], open_table: Callable[[str], DataFrame]):
        self._names = list(names)
        self._open = open_table
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = self._open(name)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Bank:
    """Lazy frames by name; nothing runs until a result is asked for.

    ``processed`` holds the eight typed tables, ``raw`` their text form if known.
    """

    def __init__(
        self, processed: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None = None
    ):
        self.processed = processed
        self.raw = raw or {}

    @classmethod
    def from_raw(cls, raw: Mapping[str, DataFrame]) -> Bank:
        return cls(Tables(raw, lambda t: clean(t, raw[t])), raw)

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str, sep: str = ";") -> Bank:
        return cls.from_raw(
            Tables(schema.RAW, lambda t: read_csv(spark, f"{folder}/{t}.csv", sep=sep))
        )

    @classmethod
    def from_processed(cls, spark: SparkSession, folder: str) -> Bank:
        return cls(Tables(schema.RAW, lambda t: read_parquet(spark, f"{folder}/{t}")))

    @classmethod
    def from_standin(cls, spark: SparkSession, sf_dir: str) -> Bank:
        return cls.from_raw(Tables(STANDIN, StandinReader(spark, sf_dir)))

    def __getitem__(self, table: str) -> DataFrame:
        return self.processed[table]

    # Dimensions

    @cached_property
    def dim_client(self) -> DataFrame:
        return dims.dim_client(self["client"])

    @cached_property
    def dim_account(self) -> DataFrame:
        return dims.dim_account(self["account"], self["district"], self["disp"], self.dim_client)

    @cached_property
    def loans(self) -> DataFrame:
        """Loan features without the outlier flag, which needs a quantile."""
        return dims.dim_loan(self["loan"])

    @cached_property
    def dim_loan(self) -> DataFrame:
        return with_outlier_flag(self.loans, source=self["loan"])

    @cached_property
    def dim_district(self) -> DataFrame:
        return self["district"]

    @cached_property
    def dim_card(self) -> DataFrame:
        return dims.dim_card(self["card"])

    @cached_property
    def dim_disp(self) -> DataFrame:
        return dims.dim_disp(self["disp"])

    @cached_property
    def dim_order(self) -> DataFrame:
        return dims.dim_order(self["order"])

    # Facts

    @cached_property
    def moves(self) -> DataFrame:
        """Transactions in their curated naming, without windows or flags."""
        return self["trans"].withColumnRenamed("balance", "final_balance")

    @cached_property
    def flagged_moves(self) -> DataFrame:
        """Transactions with the outlier flag, for reports that need no history."""
        return with_outlier_flag(self.moves, source=self["trans"])

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return with_outlier_flag(with_history(self["trans"]), source=self["trans"])

    @cached_property
    def fact_account_transactions(self) -> DataFrame:
        return facts.account_transactions(self.moves)

    @cached_property
    def fact_account_summary(self) -> DataFrame:
        return facts.account_summary(
            self.dim_account,
            self.fact_account_transactions,
            self.loans,
            self.dim_card,
            self.dim_disp,
        )

    @cached_property
    def products(self) -> DataFrame:
        """Loans, cards and segment per account, for reports that need no more."""
        return facts.with_products(
            self["account"].select("account_id"), self.loans, self.dim_card, self.dim_disp
        )

    # Views

    @cached_property
    def owned(self) -> DataFrame:
        """Accounts with a known owner, without the district columns."""
        return dims.owned_accounts(self["account"], self["disp"], self.dim_client)

    @cached_property
    def account_owner(self) -> DataFrame:
        """Account, district and owner numbers only."""
        return self["account"].join(dims.owners(self["disp"]), "account_id", "left")

    @cached_property
    def v_customer_behavior(self) -> DataFrame:
        return views.customer_behavior(self.owned, self.flagged_moves)

    @cached_property
    def v_loan_risk_analysis(self) -> DataFrame:
        return views.loan_risk_analysis(self.loans, self.account_owner, self.dim_district)

    @cached_property
    def v_account_activity(self) -> DataFrame:
        return views.account_activity(self.dim_account, self.fact_account_transactions)

    @cached_property
    def v_fraud_analysis(self) -> DataFrame:
        return views.fraud_analysis(
            self.owned, self.flagged_moves, self.fact_account_transactions
        )

    def create_views(self) -> None:
        """Temporary views over the curated tables and analysis views, for plain SQL."""
        frames = self.curated() | {
            "v_customer_behavior": self.v_customer_behavior,
            "v_loan_risk_analysis": self.v_loan_risk_analysis,
            "v_account_activity": self.v_account_activity,
            "v_fraude_analisis": self.v_fraud_analysis,
        }
        for name, df in frames.items():
            df.createOrReplaceTempView(name)

    def curated(self) -> dict[str, DataFrame]:
        """The ten curated tables by name."""
        return {name: getattr(self, name) for name in schema.CURATED_PARTITIONS}
