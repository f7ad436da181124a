"""The three batch steps: raw text to typed, typed to star schema, star schema to warehouse."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tellermill import schema
from tellermill.bank import Bank
from tellermill.operators.history import with_history
from tellermill.operators.outliers import with_outlier_flag
from tellermill.plans import facts
from tellermill.plans.clean import clean, missing_columns
from tellermill.plans.marts import mart
from tellermill.sources import jdbc
from tellermill.sources.catalog import register
from tellermill.sources.files import read_csv, read_parquet, write_parquet
from tellermill.sources.quarantine import Loaded, load_checked

SUMMARY = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


# Curated tables that are built from other stored tables of the same step.
STORED_INPUTS = {
    "fact_account_transactions": ("fact_transactions",),
    "fact_account_summary": ("dim_account", "fact_account_transactions", "dim_loan", "dim_card", "dim_disp"),
}


class StepFailed(RuntimeError):
    """Some tables of a step failed; ``summary`` tells which."""

    def __init__(self, summary: DataFrame, failed: list[str]):
        super().__init__(f"tables failed: {', '.join(failed)}")
        self.summary = summary


def run_each(
    spark: SparkSession,
    work: Mapping[str, Callable[[], int]],
    inputs: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Do every table, going on after failures, and raise at the end if any failed.

    A table whose ``inputs`` failed is not built, as only their previous state is there.
    """
    done, failed = [], []
    for name, run in work.items():
        absent = [n for n in (inputs or {}).get(name, ()) if n in failed]
        if absent:
            done.append((name, None, f"skipped, inputs failed: {', '.join(absent)}"))
            failed.append(name)
            continue
        try:
            done.append((name, run(), None))
        except Exception as problem:  # one bad table must not hide the others
            done.append((name, None, str(problem)))
            failed.append(name)
    summary = spark.createDataFrame(done, SUMMARY)
    if failed:
        raise StepFailed(summary, failed)
    return summary


def raw_to_processed(spark: SparkSession, raw: str, processed: str, sep: str = ";") -> DataFrame:
    """Clean the eight text tables into Parquet. Returns rows written per table."""

    def run(table: str) -> int:
        df = read_csv(spark, f"{raw}/{table}.csv", sep=sep)
        absent = missing_columns(table, df)
        if absent:
            raise ValueError(f"missing columns: {absent}")
        return write_parquet(
            clean(table, df), f"{processed}/{table}", schema.PROCESSED_PARTITIONS[table]
        )

    return run_each(spark, {t: lambda t=t: run(t) for t in schema.RAW})


def raw_to_processed_checked(
    spark: SparkSession, raw: str, processed: str, quarantine: str, sep: str = ";"
) -> DataFrame:
    """Like raw_to_processed, with unusable lines set aside: lines, accepted, rejected and
    lost values of each table."""
    counts: dict[str, Loaded] = {}

    def run(table: str) -> int:
        counts[table] = load_checked(
            spark, table, f"{raw}/{table}.csv", f"{processed}/{table}", f"{quarantine}/{table}", sep
        )
        return counts[table].accepted

    run_each(spark, {t: lambda t=t: run(t) for t in schema.RAW})
    rows = [(t, n.lines, n.accepted, n.rejected, n.lost_values) for t, n in counts.items()]
    names = "table_name string, lines bigint, accepted bigint, rejected bigint, lost_values bigint"
    return spark.createDataFrame(rows, names)


def processed_to_curated(spark: SparkSession, processed: str, curated: str) -> DataFrame:
    """Build the ten star-schema tables.

    The transaction windows run once: the two account facts read the stored
    transaction table instead of computing it again.
    """
    bank = Bank.from_processed(spark, processed)

    def save(name: str, df: DataFrame) -> int:
        return write_parquet(df, f"{curated}/{name}", schema.CURATED_PARTITIONS[name])

    def stored(name: str) -> DataFrame:
        return read_parquet(spark, f"{curated}/{name}")

    work = {
        "dim_client": lambda: save("dim_client", bank.dim_client),
        "dim_account": lambda: save("dim_account", bank.dim_account),
        "dim_loan": lambda: save("dim_loan", bank.dim_loan),
        "dim_district": lambda: save("dim_district", bank.dim_district),
        "dim_card": lambda: save("dim_card", bank.dim_card),
        "dim_disp": lambda: save("dim_disp", bank.dim_disp),
        "dim_order": lambda: save("dim_order", bank.dim_order),
        "fact_transactions": lambda: save(
            "fact_transactions",
            with_outlier_flag(with_history(bank["trans"]), source=bank["trans"]),
        ),
        "fact_account_transactions": lambda: save(
            "fact_account_transactions", facts.account_transactions(stored("fact_transactions"))
        ),
        "fact_account_summary": lambda: save(
            "fact_account_summary",
            facts.account_summary(
                stored("dim_account"),
                stored("fact_account_transactions"),
                stored("dim_loan"),
                stored("dim_card"),
                stored("dim_disp"),
            ),
        ),
    }
    return run_each(spark, work, STORED_INPUTS)


def register_curated(spark: SparkSession, curated: str, database: str = "default") -> None:
    """Catalog entries for the stored star schema."""
    for name, partitions in schema.CURATED_PARTITIONS.items():
        register(spark, f"{database}.{name}", f"{curated}/{name}", bool(partitions))


def curated_to_warehouse(
    spark: SparkSession, curated: str, url: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Load the star schema into a database and check the row count right after each load.

    The stored rows are counted from the files' footers.
    """

    def run(name: str) -> int:
        stored = read_parquet(spark, f"{curated}/{name}")
        jdbc.write_table(jdbc.for_sink(mart(name, stored)), url, name, options)
        sent, found = stored.count(), jdbc.count_rows(spark, url, name, options)
        if found != sent:
            raise ValueError(f"{sent} rows sent, {found} found")
        return found

    return run_each(spark, {n: lambda n=n: run(n) for n in schema.CURATED_PARTITIONS})


def verify_warehouse(
    spark: SparkSession,
    loaded: DataFrame,
    url: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Expected against found rows per loaded table; a missing table is a row with ok = 0."""

    def count(name: str) -> int | None:
        try:
            return jdbc.count_rows(spark, url, name, options)
        except Exception:  # the database has no such table, which the report is to show
            return None

    found = [(n, count(n)) for n in schema.CURATED_PARTITIONS]
    return jdbc.reconcile(
        loaded.select("table_name", loaded["rows"].alias("row_count")),
        spark.createDataFrame(found, "table_name string, row_count bigint"),
    )
