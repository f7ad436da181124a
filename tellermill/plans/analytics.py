"""Credit-risk, behaviour, anomaly and executive reports.

Reports over transactions reduce them per account before joining account or
client traits: the join then moves one row per account and category, and a hot
account is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.functions.money import (
    cents,
    money_mean_2,
    money_sum,
    money_text,
    percent,
    round_half_up,
)
from tellermill.functions.rules import (
    ACTIVITY_BANDS,
    DEFAULT_LABELS,
    NORMAL,
    SUSPICIOUS,
    band,
    flag,
)
from tellermill.operators.profile import union_all


def risky() -> Column:
    return F.col("status").isin(*schema.RISKY_STATUSES)


def mean_2(c: Column) -> Column:
    """Mean of whole numbers, two decimals."""
    return round_half_up(F.try_divide(F.sum(c).cast("double"), F.count(c)), 2)


def _by_account(trans: DataFrame, *categories: str) -> DataFrame:
    """Partial sums of transactions per account and category."""
    return trans.groupBy("account_id", *categories).agg(
        F.count("*").alias("n_rows"),
        F.count("trans_id").alias("n"),
        F.count("amount").alias("n_amount"),
        F.sum(cents(F.col("amount")).cast("decimal(18,0)")).alias("cents"),
    )


def _mean_of_parts() -> Column:
    return round_half_up(F.try_divide(F.sum("cents").cast("double"), F.sum("n_amount")), 0) / 100


def default_rate_by_segment(loan: DataFrame) -> DataFrame:
    return (
        loan.groupBy("loan_amount_segment")
        .agg(
            F.count("*").alias("total_prestamos"),
            F.count_if(risky()).alias("prestamos_default"),
            percent(F.count_if(risky()), F.count("*")).alias("tasa_default_porcentaje"),
            money_mean_2(F.col("amount")).alias("monto_promedio"),
        )
        .orderBy(F.desc("tasa_default_porcentaje"), "loan_amount_segment")
    )


def risky_profile(owned: DataFrame, loan: DataFrame) -> DataFrame:
    """Risky loans by the owner's gender and age band. ``owned``: see views."""
    return (
        loan.filter(F.col("is_risky") == 1)
        .select("loan_id", "account_id", "amount")
        .join(owned, "account_id")
        .groupBy("gender", "age_segment")
        .agg(
            F.countDistinct("loan_id").alias("total_prestamos_riesgosos"),
            money_mean_2(F.col("amount")).alias("monto_promedio_prestamo"),
            mean_2(F.col("age_at_1998")).alias("edad_promedio"),
        )
        .orderBy(F.desc("total_prestamos_riesgosos"), "gender", "age_segment")
    )


def risk_by_region(loan_risk: DataFrame, more_than: int = 10) -> DataFrame:
    return (
        loan_risk.groupBy("region")
        .agg(
            mean_2(F.col("average_salary")).alias("salario_promedio"),
            F.count("loan_id").alias("total_prestamos"),
            F.count_if(risky()).alias("total_defaults"),
            percent(F.count_if(risky()), F.count("loan_id")).alias("tasa_default_pct"),
        )
        .filter(F.col("total_prestamos") > more_than)
        .orderBy(F.desc("tasa_default_pct"), "region")
    )


def trans_by_age_gender(owned: DataFrame, trans: DataFrame) -> DataFrame:
    return (
        _by_account(trans, "type")
        .join(owned.select("account_id", "age_segment", "gender"), "account_id")
        .groupBy("age_segment", "gender", F.col("type").alias("tipo_transaccion"))
        .agg(
            F.sum("n").alias("num_transacciones"),
            _mean_of_parts().alias("monto_promedio"),
        )
        .orderBy(F.desc("num_transacciones"), "age_segment", "gender", "tipo_transaccion")
    )


def activity_segments(account: DataFrame, trans: DataFrame) -> DataFrame:
    counts = trans.groupBy("account_id").agg(F.count("trans_id").alias("trans_count"))
    return (
        account.select("account_id")
        .join(counts, "account_id", "left")
        .fillna(0, ["trans_count"])
        .groupBy(band(F.col("trans_count"), ACTIVITY_BANDS).alias("segmento_actividad"))
        .agg(F.count("*").alias("num_cuentas"))
        .orderBy(F.desc("num_cuentas"), "segmento_actividad")
    )


def trans_by_frequency(account: DataFrame, trans: DataFrame) -> DataFrame:
    return (
        _by_account(trans, "type", "operation")
        .join(account.select("account_id", "frequency"), "account_id")
        .groupBy(
            F.col("frequency").alias("tipo_cuenta"),
            F.col("type").alias("tipo_transaccion"),
            F.col("operation").alias("operacion"),
        )
        .agg(
            F.sum("n_rows").alias("num_transacciones"),
            (F.sum("cents").cast("double") / 100).alias("volumen_total"),
        )
        .orderBy(F.desc("num_transacciones"), "tipo_cuenta", "tipo_transaccion", "operacion")
    )


def top_suspicious(owned: DataFrame, trans: DataFrame, k: int = 100) -> DataFrame:
    """The largest flagged transactions of owned accounts."""
    return (
        trans.filter(F.col("is_amount_outlier") == 1)
        .join(owned.select("account_id"), "account_id", "left_semi")
        .select(
            "trans_id",
            "account_id",
            F.col("date").alias("trans_date"),
            F.col("type").alias("trans_type"),
            "operation",
            F.col("amount").alias("trans_amount"),
            "final_balance",
            F.when(F.col("is_amount_outlier") == 1, SUSPICIOUS).otherwise(NORMAL).alias("flag_fraude"),
        )
        .orderBy(F.desc("trans_amount"), "trans_id")
        .limit(k)
    )


def executive_kpis(
    client: DataFrame, loan: DataFrame, trans: DataFrame, products: DataFrame
) -> DataFrame:
    """Five headline figures as (name, text), one pass over each table."""

    def row(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.select(F.lit(name).alias("metrica"), value.alias("valor"))

    loans = loan.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status_label").isin(*DEFAULT_LABELS)).alias("bad"),
        money_sum(F.col("amount")).alias("volume"),
    )
    loans = loans.select(
        F.stack(
            F.lit(2),
            F.lit("Tasa de Morosidad (%)"), money_text(percent(F.col("bad"), F.col("n"))),
            F.lit("Volumen Total Préstamos"), money_text(F.col("volume")),
        ).alias("metrica", "valor")
    )
    outliers = trans.agg(
        percent(F.count_if(F.col("is_amount_outlier") == 1), F.count("*")).alias("v")
    )
    geared = products.agg(
        percent(F.count_if((F.col("num_loans") > 0) | (F.col("num_cards") > 0)), F.count("*")).alias("v")
    )
    return union_all(
        [
            row(client.agg(F.count("*").alias("v")), "Total Clientes", F.col("v").cast("string")),
            loans,
            row(outliers, "Tasa de Detección de Anomalías (Outliers) (%)", money_text(F.col("v"))),
            row(
                geared,
                "Ratio de Apalancamiento (Clientes con Préstamo/Tarjeta) (%)",
                money_text(F.col("v")),
            ),
        ]
    )


def segment_list(products: DataFrame) -> DataFrame:
    """Distinct segments in one ordered text."""
    return products.select("customer_segment").distinct().agg(
        F.expr("listagg(customer_segment, ', ') within group (order by customer_segment)").alias("segments")
    )


def data_quality_summary(client: DataFrame, loan: DataFrame, products: DataFrame) -> DataFrame:
    gender, bad = F.col("gender"), F.coalesce(F.sum("is_risky"), F.lit(0))
    share = F.coalesce(percent(bad, F.count("*"), 1), F.lit(0.0))
    return union_all(
        [
            client.select(gender).agg(
                F.concat(
                    F.lit("M: "), F.count_if(gender == "M").cast("string"),
                    F.lit(" | F: "), F.count_if(gender == "F").cast("string"),
                ).alias("valor")
            ).select(F.lit("Clientes por género").alias("metrica"), "valor"),
            loan.agg(
                F.concat(
                    bad.cast("string"), F.lit(" de "), F.count("*").cast("string"),
                    F.lit(" ("), share.cast("decimal(5,1)").cast("string"), F.lit("%)"),
                ).alias("valor")
            ).select(F.lit("Préstamos riesgosos").alias("metrica"), "valor"),
            segment_list(products).select(
                F.lit("Segmentos de clientes").alias("metrica"), F.col("segments").alias("valor")
            ),
        ]
    )


def table_counts(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """Rows, columns and key of each table, the largest first."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
                F.lit(keys.get(name)).cast("string").alias("key_column"),
            )
            for name, df in tables.items()
        ]
    ).orderBy(F.desc("row_count"), "table_name")


def top_operations(trans: DataFrame, k: int = 5) -> DataFrame:
    return (
        trans.groupBy("operation")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "operation")
        .limit(k)
    )


def region_top_accounts(account: DataFrame, district: DataFrame, k: int = 10) -> DataFrame:
    """Regions with most accounts; the district side is in its raw naming on request."""
    place = district.select(F.col("district_id").alias("a1"), "region")
    return (
        account.join(place, account["district_id"] == place["a1"])
        .groupBy("region")
        .agg(F.count("*").alias("num_accounts"))
        .orderBy(F.desc("num_accounts"), "region")
        .limit(k)
    )


def unemployment_extremes(district: DataFrame, k: int = 10) -> DataFrame:
    rates = district.select(
        "district_id", "region", F.col("unemployment_rate_96").alias("unemployment_rate")
    ).filter(F.col("unemployment_rate").isNotNull())
    low = rates.orderBy("unemployment_rate", "district_id").limit(k)
    high = rates.orderBy(F.desc("unemployment_rate"), "district_id").limit(k)
    return union_all(
        [df.select(F.lit(kind).alias("kind"), "*") for kind, df in (("lowest", low), ("highest", high))]
    )


def payment_consistency(loan: DataFrame, tolerance_pct: float = 10.0) -> DataFrame:
    """Instalment against amount / duration, flagged when it differs too much."""
    expected = F.try_divide(F.col("amount"), F.col("duration"))
    gap = F.abs(F.col("payments") - F.col("expected_payment"))
    off = F.try_divide(F.col("payment_diff"), F.col("expected_payment")) * 100
    return (
        loan.select("loan_id", "amount", "duration", "payments")
        .withColumn("expected_payment", expected)
        .withColumn("payment_diff", gap)
        .withColumn("payment_diff_pct", off)
        .withColumn("is_inconsistent", F.coalesce(off > tolerance_pct, F.lit(False)).cast("int"))
    )


def anomaly_checks(trans: DataFrame, loan: DataFrame) -> DataFrame:
    """How many rows fail each plausibility check."""
    moves = trans.agg(
        F.count_if(F.col("amount") == 0).alias("zero"),
        F.count_if(F.col("final_balance") < 0).alias("negative"),
    ).select(
        F.stack(
            F.lit(2),
            F.lit("transactions with zero amount"), F.col("zero"),
            F.lit("transactions with negative balance"), F.col("negative"),
        ).alias("check_name", "n")
    )
    loans = payment_consistency(loan).agg(F.count_if(F.col("is_inconsistent") == 1).alias("n"))
    return moves.unionByName(
        loans.select(F.lit("loans with inconsistent payment").alias("check_name"), "n")
    )


def balance_profile(trans: DataFrame, median: Column) -> DataFrame:
    """Level of balances, and how many are negative. ``median``: a scalar column."""
    balance = F.col("final_balance")
    below = balance < 0
    return trans.agg(
        money_mean_2(balance).alias("mean_balance"),
        F.min(balance).alias("min_balance"),
        F.max(balance).alias("max_balance"),
        F.count_if(below).alias("negative_count"),
        percent(F.count_if(below), F.count("*")).alias("negative_pct"),
        money_mean_2(F.when(below, balance)).alias("negative_mean"),
    ).withColumn("median_balance", round_half_up(median, 2))


def with_medians(basic: DataFrame, medians: DataFrame, key: str) -> DataFrame:
    """Add a rounded median per group; groups without values get null."""
    return basic.join(
        medians.select(
            F.col(key).alias(f"_{key}"), round_half_up(F.col("median"), 2).alias("median")
        ),
        F.col(key).eqNullSafe(F.col(f"_{key}")),
        "left",
    ).drop(f"_{key}")


def amount_stats(df: DataFrame, key: str) -> DataFrame:
    """Count, mean and sum of money per group."""
    return df.groupBy(key).agg(
        F.count("*").alias("n"),
        money_mean_2(F.col("amount")).alias("mean"),
        money_sum(F.col("amount")).alias("total"),
    )


def loan_duration_stats(loan: DataFrame) -> DataFrame:
    return loan.groupBy("status").agg(
        mean_2(F.col("duration")).alias("mean"),
        F.min("duration").alias("shortest"),
        F.max("duration").alias("longest"),
    )


def salary_stats(account_district: DataFrame) -> DataFrame:
    return account_district.groupBy("frequency").agg(
        mean_2(F.col("average_salary")).alias("mean"),
        F.count("average_salary").alias("n"),
    )


def risk_rate(loan: DataFrame) -> DataFrame:
    return loan.agg(
        F.count("*").alias("loans"),
        F.count_if(risky()).alias("risky_loans"),
        percent(F.count_if(risky()), F.count("*")).alias("risk_rate_pct"),
    )


def dispositions(disp: DataFrame) -> DataFrame:
    return disp.filter(F.col("client_id").isNotNull()).groupBy("client_id").agg(F.count("*").alias("n"))


def disp_per_client(per_client: DataFrame, median: Column) -> DataFrame:
    n = F.col("n")
    return per_client.agg(
        mean_2(n).alias("mean"),
        F.max(n).alias("largest"),
        F.count_if(n > 1).alias("clients_with_several"),
        percent(F.count_if(n > 1), F.count("*")).alias("several_pct"),
    ).withColumn("median", median)


def openings_by_year(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per year, with the first, last and busiest year of each table."""
    yearly = union_all(
        [
            df.filter(F.col(c).isNotNull())
            .groupBy(F.year(c).alias("year"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(name).alias("table_name"), "*")
            for name, (df, c) in frames.items()
        ]
    )
    # At most one row per calendar year and table.
    span = yearly.groupBy("table_name").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        (-F.max(F.struct("n", -F.col("year").alias("y")))["col2"]).alias("busiest_year"),
    )
    return yearly.join(span, "table_name")


def label_counts(df: DataFrame, kind: str, code: str, name: Column) -> DataFrame:
    """Rows per code with its display name; codes are named after aggregation."""
    return (
        df.groupBy(F.col(code).alias("code"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(kind).alias("kind"), "code", name.alias("label"), "n")
    )


def account_risk(trans: DataFrame) -> DataFrame:
    """Outliers, volume and balance sign per account with transactions."""
    amount = F.col("amount")
    return trans.groupBy("account_id").agg(
        F.sum("is_amount_outlier").alias("num_outliers"),
        money_sum(amount).alias("volume"),
        money_mean_2(amount).alias("mean"),
        flag(F.min("final_balance") < 0).alias("has_negative_balance"),
    )
