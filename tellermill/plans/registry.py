"""Named queries over a bank data set."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.bank import Bank
from tellermill.functions import rules
from tellermill.functions.money import money_sum, percent
from tellermill.functions.text import blank_to_null, clean_names, clean_sink_names
from tellermill.operators import integrity, profile, sketches
from tellermill.operators.outliers import iqr_summary
from tellermill.operators.quantiles import quantiles
from tellermill.plans import analytics, dashboard, dims, facts, incremental, jobs
from tellermill.plans.clean import clean
from tellermill.plans.marts import mart
from tellermill.sources import catalog, quarantine
from tellermill.sources.files import (
    detect_separator,
    peek,
    read_csv,
    read_parquet,
    sample_by_key,
    work_folder,
    write_csv,
    write_parquet,
)
from tellermill.sources.jdbc import for_sink, reconcile

Query = Callable[[Bank], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources and sinks


@query
def scan_partitioned(b: Bank) -> DataFrame:
    """Typed transactions stored by type, read back with one folder selected."""
    trans = b["trans"]
    folder = work_folder(trans.sparkSession, "trans")
    write_parquet(trans, folder, schema.PROCESSED_PARTITIONS["trans"])
    stored = read_parquet(trans.sparkSession, folder)
    return stored.filter(F.col("type") == schema.INCOME_TYPE).select(
        "trans_id", "account_id", "type", "date", "amount"
    )


@query
def load_reconciliation(b: Bank) -> DataFrame:
    """Rows counted while the curated tables were written, against the rows read back."""
    spark = b["account"].sparkSession
    folder = work_folder(spark, "curated")
    sent = [
        (name, write_parquet(df, f"{folder}/{name}", schema.CURATED_PARTITIONS[name]))
        for name, df in b.curated().items()
    ]
    back = {name: read_parquet(spark, f"{folder}/{name}") for name, _ in sent}
    return reconcile(
        spark.createDataFrame(sent, "table_name string, row_count bigint"),
        analytics.table_counts(back, {}).select("table_name", "row_count"),
    )


@query
def scan_curated(b: Bank) -> DataFrame:
    """Loans of the curated layer stored by status, read back with one folder selected."""
    loan = b.dim_loan
    folder = work_folder(loan.sparkSession, "dim_loan")
    write_parquet(loan, folder, schema.CURATED_PARTITIONS["dim_loan"])
    stored = read_parquet(loan.sparkSession, folder).filter(F.col("status") == "B")
    return stored.select("loan_id", "account_id", "status", "loan_start_date", "amount", "is_amount_outlier")


@query
def csv_round_trip(b: Bank) -> DataFrame:
    """Raw loans written as delimited text and read with the separator found in it."""
    loan = b.raw["loan"]
    spark = loan.sparkSession
    folder = work_folder(spark, "loan-csv")
    write_csv(loan, folder, sep="|")
    return read_csv(spark, folder, schema.RAW["loan"], sep=detect_separator(spark, folder))


def _checked_loans(b: Bank) -> DataFrame:
    """Raw loans written as text with planted faults, read back line by line."""
    loan = b.raw["loan"]
    folder = work_folder(loan.sparkSession, "spoiled-csv")
    quarantine.with_planted_faults(loan, "loan_id").write.text(folder)
    return quarantine.with_reason("loan", quarantine.read_checked(loan.sparkSession, folder, loan.columns))


@query
def csv_rejects(b: Bank) -> DataFrame:
    """Lines by what became of them; together they are all lines of the file."""
    df = _checked_loans(b)
    return df.groupBy(F.coalesce(quarantine.REASON, F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))


@query
def csv_accepted(b: Bank) -> DataFrame:
    """Typed loans of the lines that are usable."""
    return clean("loan", quarantine.accepted(_checked_loans(b)))


@query
def renamed_columns(b: Bank) -> DataFrame:
    """Column names as they come from spreadsheets, brought to one form."""
    return clean_names(b.raw["disp"].toDF(' "Disp-Id"', "Client Id", "account'id", "TYPE "), wide=True)


@query
def renamed_for_sink(b: Bank) -> DataFrame:
    return clean_sink_names(b.raw["disp"].toDF("Disp.Id", "Client-Id", "account id", "TYPE"))


@query
def peek_trans(b: Bank) -> DataFrame:
    return peek(b["trans"].select("trans_id", "account_id", "date", "amount"), "trans_id")


@query
def blanks_as_nulls(b: Bank) -> DataFrame:
    return b.raw["trans"].select("trans_id", *(blank_to_null(F.col(c)).alias(c) for c in ("operation", "k_symbol", "bank")))


@query
def sample_accounts(b: Bank) -> DataFrame:
    return sample_by_key(b["account"], "account_id")


@query
def sink_types(b: Bank) -> DataFrame:
    activity = b.fact_account_transactions.drop("stddev_transaction_amount")
    return for_sink(activity.withColumn("share", F.lit(1).cast("decimal(10,2)")))


@query
def load_summary(b: Bank) -> DataFrame:
    """A step over the curated tables in which one fails: the others go on, what needs it is skipped."""
    spark = b["account"].sparkSession
    folder = work_folder(spark, "curated")

    def save(name: str, df: DataFrame) -> int:
        if name == "dim_card":
            raise ValueError("planted")
        return write_parquet(df, f"{folder}/{name}", schema.CURATED_PARTITIONS[name])

    try:
        summary = jobs.run_each(spark, {n: partial(save, n, df) for n, df in b.curated().items()}, jobs.STORED_INPUTS)
    except jobs.StepFailed as failure:
        summary = failure.summary
    outcome = F.when(F.col("error").isNull(), "written").when(F.col("error").startswith("skipped"), "skipped").otherwise("failed")
    return summary.select("table_name", summary["rows"].alias("row_count"), outcome.alias("outcome"))


@query
def crawled_loans(b: Bank) -> DataFrame:
    """Loans read by name from the catalog, after their folder has gained partitions and a column."""
    loan = b.dim_loan
    spark = loan.sparkSession
    folder = work_folder(spark, "crawled")
    name = f"loans_{folder.rpartition('-')[2]}"
    first = F.col("status").isin("A", "C")
    write_parquet(loan.filter(first).drop("is_amount_outlier"), folder, ["status"])
    catalog.crawl(spark, name, folder, ["status"])
    loan.filter(~first).write.mode("append").partitionBy("status").parquet(folder)
    catalog.crawl(spark, name, folder, ["status"])
    return spark.table(name).select("loan_id", "account_id", "status", "amount", "is_amount_outlier")


# Incremental loads


def _loaded_in_parts(b: Bank) -> incremental.TransactionStore:
    trans = b["trans"]
    store = incremental.TransactionStore(trans.sparkSession, work_folder(trans.sparkSession, "store"), trans.schema)
    incremental.in_two_loads(store, trans)
    return store


@query
def incremental_history(b: Bank) -> DataFrame:
    """All transactions with their history, loaded in two batches with corrections."""
    return _loaded_in_parts(b).history.read()


@query
def incremental_activity(b: Bank) -> DataFrame:
    """Activity of all accounts, kept up to date over the same batches."""
    return profile.rounded(_loaded_in_parts(b).activity.read(), 4, "stddev_transaction_amount")


# Cleaning


@query
def parse_dates(b: Bank) -> DataFrame:
    return b["account"].select("account_id", "date")


@query
def impute_labels(b: Bank) -> DataFrame:
    return b["trans"].select("trans_id", "operation", "k_symbol", "bank", "account")


@query
def clean_trans(b: Bank) -> DataFrame:
    return b["trans"]


@query
def clean_district(b: Bank) -> DataFrame:
    return b["district"]


@query
def clean_disp(b: Bank) -> DataFrame:
    return b.dim_disp


@query
def clean_order(b: Bank) -> DataFrame:
    return b.dim_order


@query
def card_issued(b: Bank) -> DataFrame:
    return b.dim_card


# Dimensions and facts


@query
def client_features(b: Bank) -> DataFrame:
    return b.dim_client


@query
def loan_features(b: Bank) -> DataFrame:
    return b.dim_loan


@query
def account_enriched(b: Bank) -> DataFrame:
    return b.dim_account


@query
def account_age_months(b: Bank) -> DataFrame:
    return dims.account_age_months(b["account"])


@query
def initial_balance(b: Bank) -> DataFrame:
    return b.fact_transactions.select(
        "trans_id", "account_id", "date", "type", "amount", "initial_balance", "final_balance"
    )


@query
def rolling_90d(b: Bank) -> DataFrame:
    return b.fact_transactions.select(
        "trans_id", "account_id", "date",
        "avg_trans_amount_3m", "total_income_3m", "total_expense_3m", "num_trans_3m",
    )


@query
def outlier_p95_trans(b: Bank) -> DataFrame:
    return b.flagged_moves.select("trans_id", "amount", "is_amount_outlier")


@query
def outlier_p95_loan(b: Bank) -> DataFrame:
    return b.dim_loan.select("loan_id", "amount", "is_amount_outlier")


@query
def account_transactions(b: Bank) -> DataFrame:
    return profile.rounded(b.fact_account_transactions, 4, "stddev_transaction_amount")


@query
def loan_by_account(b: Bank) -> DataFrame:
    return facts.loan_by_account(b.loans)


@query
def card_by_account(b: Bank) -> DataFrame:
    return facts.card_by_account(b.dim_card, b.dim_disp)


@query
def account_summary(b: Bank) -> DataFrame:
    return profile.rounded(b.fact_account_summary, 4, "stddev_transaction_amount")


@query
def mart_dim_client(b: Bank) -> DataFrame:
    return mart("dim_client", b.dim_client)


@query
def mart_dim_account(b: Bank) -> DataFrame:
    return mart("dim_account", b.dim_account)


@query
def mart_dim_loan(b: Bank) -> DataFrame:
    return mart("dim_loan", b.dim_loan)


@query
def mart_fact_transactions(b: Bank) -> DataFrame:
    return mart("fact_transactions", b.fact_transactions)


@query
def fact_loan_dispositions(b: Bank) -> DataFrame:
    return facts.loan_dispositions(b.loans, b.account_owner)


@query
def avg_monthly_trans(b: Bank) -> DataFrame:
    return facts.avg_monthly_transactions(b["trans"])


@query
def dim_date(b: Bank) -> DataFrame:
    return dims.dim_date((b["account"], "date"), (b["loan"], "date"), (b["trans"], "date"))


@query
def dim_transaction_type(b: Bank) -> DataFrame:
    return dims.dim_transaction_type(b["trans"])


# Views


@query
def v_customer_behavior(b: Bank) -> DataFrame:
    return b.v_customer_behavior


@query
def v_loan_risk_analysis(b: Bank) -> DataFrame:
    return b.v_loan_risk_analysis


@query
def v_account_activity(b: Bank) -> DataFrame:
    return b.v_account_activity


@query
def v_fraud_analysis(b: Bank) -> DataFrame:
    return b.v_fraud_analysis


# Reports


@query
def default_rate_by_segment(b: Bank) -> DataFrame:
    return analytics.default_rate_by_segment(b.loans)


@query
def risky_profile(b: Bank) -> DataFrame:
    return analytics.risky_profile(b.owned, b.loans)


@query
def risk_by_region(b: Bank) -> DataFrame:
    return analytics.risk_by_region(b.v_loan_risk_analysis)


@query
def trans_by_age_gender(b: Bank) -> DataFrame:
    return analytics.trans_by_age_gender(b.owned, b.moves)


@query
def activity_segments(b: Bank) -> DataFrame:
    return analytics.activity_segments(b["account"], b.moves)


@query
def trans_by_frequency(b: Bank) -> DataFrame:
    return analytics.trans_by_frequency(dims.with_account_age(b["account"]), b.moves)


@query
def top_suspicious(b: Bank) -> DataFrame:
    return analytics.top_suspicious(b.owned, b.flagged_moves)


@query
def executive_kpis(b: Bank) -> DataFrame:
    return analytics.executive_kpis(b.dim_client, b.loans, b.flagged_moves, b.products)


@query
def segment_list(b: Bank) -> DataFrame:
    return analytics.segment_list(b.products)


@query
def data_quality_summary(b: Bank) -> DataFrame:
    return analytics.data_quality_summary(b.dim_client, b.loans, b.products)


@query
def table_counts(b: Bank) -> DataFrame:
    return analytics.table_counts({**b.processed, **b.curated()}, schema.PRIMARY_KEYS)


@query
def label_translation(b: Bank) -> DataFrame:
    frequency = analytics.label_counts(
        dims.with_account_age(b["account"]),
        "frequency",
        "frequency",
        rules.named(F.col("code"), rules.FREQUENCY_NAMES),
    )
    types = analytics.label_counts(
        b["trans"], "type", "type", rules.named(F.col("code"), rules.TRANS_TYPE_NAMES)
    )
    return frequency.unionByName(types)


@query
def payment_consistency(b: Bank) -> DataFrame:
    return analytics.payment_consistency(b["loan"])


@query
def anomaly_checks(b: Bank) -> DataFrame:
    return analytics.anomaly_checks(b.moves, b["loan"])


@query
def top_operations(b: Bank) -> DataFrame:
    return analytics.top_operations(b["trans"])


@query
def region_top_accounts(b: Bank) -> DataFrame:
    return analytics.region_top_accounts(b["account"], b["district"])


@query
def unemployment_extremes(b: Bank) -> DataFrame:
    return analytics.unemployment_extremes(b["district"])


@query
def trans_stats_by_type(b: Bank) -> DataFrame:
    medians = quantiles(b["trans"], ["type"], {"median": 0.5}, value="amount")
    return analytics.with_medians(analytics.amount_stats(b["trans"], "type"), medians, "type")


@query
def loan_amount_by_status(b: Bank) -> DataFrame:
    medians = quantiles(b["loan"], ["status"], {"median": 0.5}, value="amount")
    return analytics.with_medians(analytics.amount_stats(b["loan"], "status"), medians, "status")


@query
def loan_duration_by_status(b: Bank) -> DataFrame:
    medians = quantiles(b["loan"], ["status"], {"median": 0.5}, value="duration")
    return analytics.with_medians(analytics.loan_duration_stats(b["loan"]), medians, "status")


@query
def salary_by_frequency(b: Bank) -> DataFrame:
    placed = dims.with_account_age(b["account"]).join(b["district"], "district_id")
    medians = quantiles(placed, ["frequency"], {"median": 0.5}, value="average_salary")
    return analytics.with_medians(analytics.salary_stats(placed), medians, "frequency")


@query
def balance_profile(b: Bank) -> DataFrame:
    median = quantiles(b.moves, [], {"q": 0.5}, value="final_balance").select("q").scalar()
    return analytics.balance_profile(b.moves, median)


@query
def risk_rate(b: Bank) -> DataFrame:
    return analytics.risk_rate(b["loan"])


@query
def disp_per_client(b: Bank) -> DataFrame:
    per_client = analytics.dispositions(b["disp"])
    median = quantiles(per_client, [], {"q": 0.5}, value="n").select("q").scalar()
    return analytics.disp_per_client(per_client, median)


@query
def openings_by_year(b: Bank) -> DataFrame:
    return analytics.openings_by_year(
        {"account": (b["account"], "date"), "loan": (b["loan"], "date")}
    )


@query
def account_risk_flag(b: Bank) -> DataFrame:
    risk = analytics.account_risk(b.flagged_moves)
    return risk.select(
        "account_id",
        "num_outliers",
        "has_negative_balance",
        rules.risk_flag(F.col("num_outliers"), F.col("has_negative_balance")).alias("risk_flag"),
    )


@query
def top_anomalous_accounts(b: Bank) -> DataFrame:
    return dashboard.top_anomalous_accounts(analytics.account_risk(b.flagged_moves))


# Data quality


@query
def value_shares(b: Bank) -> DataFrame:
    return profile.value_shares(b.processed, schema.CATEGORY_COLUMNS)


@query
def cardinality_alerts(b: Bank) -> DataFrame:
    return profile.cardinality_alerts(b.processed, schema.CATEGORY_COLUMNS)


@query
def numeric_profile(b: Bank) -> DataFrame:
    values = profile.numeric_values(b.processed, schema.NUMERIC_COLUMNS)
    return profile.rounded(
        profile.numeric_profile(values), 4, "mean", "std", *profile.PERCENTILES
    )


@query
def numeric_shape(b: Bank) -> DataFrame:
    values = profile.numeric_values(b.processed, schema.NUMERIC_COLUMNS)
    return profile.rounded(
        profile.numeric_shape(values), 4, "value_range", "iqr", "variation", "skew"
    )


@query
def outlier_iqr(b: Bank) -> DataFrame:
    values = profile.numeric_values(b.processed, schema.OUTLIER_COLUMNS)
    return profile.rounded(
        iqr_summary(values, (1.5, 3.0)), 4, "q1", "q3", "iqr", "lower_bound", "upper_bound"
    )


@query
def column_profile(b: Bank) -> DataFrame:
    return profile.column_profile(b.processed)


def _stored_sketches(b: Bank) -> DataFrame:
    """Sketches of all processed tables by month or folder, stored and read back."""
    parts = {t: F.date_format("date", "yyyy-MM") for t in ("account", "loan", "trans")}
    rows = [sketches.column_sketches(t, b[t], parts.get(t)) for t in schema.RAW]
    spark = b["account"].sparkSession
    folder = work_folder(spark, "sketches")
    write_parquet(profile.union_all(rows), folder)
    return read_parquet(spark, folder)


@query
def sketched_distinct(b: Bank) -> DataFrame:
    """Distinct values of every column, and whether merged sketches come close enough."""
    estimates = sketches.distinct_estimates(sketches.merged(_stored_sketches(b)))
    exact = profile.column_profile(b.processed).select(*profile.KEYS, "non_null", "distinct_values")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= sketches.DISTINCT_ERROR * F.col("distinct_values")
    return exact.join(estimates.drop("non_null"), profile.KEYS).select(
        *profile.KEYS, "non_null", "distinct_values", near.cast("int").alias("within_error")
    )


@query
def sketched_quantiles(b: Bank) -> DataFrame:
    """Nine quantiles of every number column from merged sketches, held against true ranks."""
    estimates = sketches.quantile_estimates(sketches.merged(_stored_sketches(b)), profile.PERCENTILES)
    values = profile.numeric_values(b.processed, schema.NUMERIC_COLUMNS)
    errors = sketches.rank_errors(values, estimates, profile.PERCENTILES)
    return errors.select(*profile.KEYS, "non_null", (F.col("rank_error") <= sketches.RANK_ERROR).cast("int").alias("within_error"))


@query
def null_profile(b: Bank) -> DataFrame:
    return profile.null_profile(b.raw)


@query
def duplicate_check(b: Bank) -> DataFrame:
    return integrity.duplicate_check(b.processed, schema.PRIMARY_KEYS)


@query
def pk_uniqueness(b: Bank) -> DataFrame:
    return integrity.pk_uniqueness(b.processed, schema.PRIMARY_KEYS)


@query
def fk_integrity(b: Bank) -> DataFrame:
    return integrity.fk_integrity(b.processed, schema.FOREIGN_KEYS)


@query
def orphan_flag(b: Bank) -> DataFrame:
    return integrity.with_orphan_flag(
        b["trans"].select("trans_id", "account_id"), "account_id", b["account"], "account_id"
    )


@query
def accounts_without_trans(b: Bank) -> DataFrame:
    return integrity.without_match(b["account"].select("account_id"), "account_id", b["trans"])


@query
def clients_without_account(b: Bank) -> DataFrame:
    return integrity.without_match(b["client"].select("client_id"), "client_id", b["disp"])


@query
def domain_check(b: Bank) -> DataFrame:
    return integrity.domain_check(b.processed, schema.DOMAINS)


@query
def date_format_check(b: Bank) -> DataFrame:
    return integrity.date_format_check(b.raw, schema.RAW_DATE_COLUMNS)


# Dashboard


@query
def filtered_kpis(b: Bank) -> DataFrame:
    """Cards under global filters: two regions in all data, women of two age bands, a year back."""
    loans = dashboard.apply_filters(
        b.v_loan_risk_analysis, "loan_start_date", last_months=12, regions=["EUROPE", "ASIA"]
    ).agg(
        F.count("*").cast("double").alias("loans"),
        money_sum(F.col("loan_amount")).alias("loan_volume"),
        percent(F.count_if(dashboard.defaulted()), F.count("*")).alias("default_rate_pct"),
    )
    regions = b.dim_account.select("account_id", "region")
    moves = dashboard.apply_filters(
        b.v_customer_behavior.join(regions, "account_id"),
        "trans_date",
        start="1924-01-05",
        end="1925-06-25",
        regions=["EUROPE", "ASIA"],
        age_segments=["25-34", "35-44"],
        genders=["F"],
    ).agg(
        F.count("*").cast("double").alias("transactions"),
        money_sum(F.col("trans_amount")).alias("trans_volume"),
    )
    return profile.union_all(
        [df.unpivot([], df.columns, "metric", "value") for df in (loans, moves)]
    )


@query
def risk_kpis(b: Bank) -> DataFrame:
    return dashboard.risk_kpis(b.loans, b.flagged_moves)


@query
def executive_cards(b: Bank) -> DataFrame:
    return dashboard.executive_cards(b.dim_client, b["account"], b.loans, b["trans"])


@query
def loan_volume_by_region(b: Bank) -> DataFrame:
    return dashboard.loan_volume_by_region(b.v_loan_risk_analysis)


@query
def loan_trend(b: Bank) -> DataFrame:
    return dashboard.loan_trend(b.loans)


@query
def trans_volume_by_type(b: Bank) -> DataFrame:
    return dashboard.trans_volume_by_type(b["trans"])


@query
def top_districts(b: Bank) -> DataFrame:
    return dashboard.top_districts(b.v_loan_risk_analysis)


@query
def customer_cards(b: Bank) -> DataFrame:
    return dashboard.customer_cards(b.dim_client, b.owned, b["trans"])


@query
def customers_by_age_gender(b: Bank) -> DataFrame:
    age = F.col("age_at_1998")
    sets = {"standard": rules.AGE_BANDS, "filter": rules.FILTER_AGE_BANDS}
    return profile.union_all(
        [
            dashboard.customers_by_age_gender(b.dim_client, rules.band(age, bands)).select(
                F.lit(name).alias("band_set"), "*"
            )
            for name, bands in sets.items()
        ]
    )


@query
def activity_heatmap(b: Bank) -> DataFrame:
    return dashboard.activity_heatmap(b.owned, b["trans"])


@query
def customers_by_region(b: Bank) -> DataFrame:
    return dashboard.customers_by_region(b.dim_client, b["district"], b.v_loan_risk_analysis)


@query
def activity_by_account_age(b: Bank) -> DataFrame:
    return dashboard.activity_by_account_age(
        dims.with_account_age(b["account"]), b.fact_account_transactions
    )


@query
def income_expense_by_frequency(b: Bank) -> DataFrame:
    return dashboard.income_expense_by_frequency(
        dims.with_account_age(b["account"]), b.fact_account_transactions
    )


@query
def outlier_scatter(b: Bank) -> DataFrame:
    return dashboard.outlier_scatter(b.fact_transactions)


@query
def outliers_by_type(b: Bank) -> DataFrame:
    return dashboard.outliers_by_type(b.flagged_moves)


@query
def default_trend_by_region(b: Bank) -> DataFrame:
    return dashboard.default_trend_by_region(b.v_loan_risk_analysis)


@query
def kpi_yoy(b: Bank) -> DataFrame:
    return dashboard.kpi_changes(b.loans)
