"""Business rules: bands, labels and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellermill import schema

# Upper edges (exclusive) and labels of the bands.
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"), (None, "65+")]
FILTER_AGE_BANDS = [(31, "Young (18-30)"), (51, "Middle Age (31-50)"), (None, "Senior (51+)")]
LOAN_BANDS = [
    (50000, "Small (< 50K)"),
    (150000, "Medium (50K-150K)"),
    (300000, "Large (150K-300K)"),
    (None, "Very Large (300K+)"),
]
ACCOUNT_AGE_BANDS = [
    (1, "New (< 1 year)"),
    (3, "Recent (1-3 years)"),
    (5, "Established (3-5 years)"),
    (None, "Mature (5+ years)"),
]
ACTIVITY_BANDS = [(1, "Inactiva"), (10, "Baja Actividad"), (50, "Actividad Media"), (None, "Alta Actividad")]

# Descriptions of the loan states.
STATUS_LABELS = {
    "A": "Contract finished, no problems",
    "B": "Contract finished, loan not paid",
    "C": "Contract running, OK so far",
    "D": "Contract running, client in debt",
}
DEFAULT_LABELS = (STATUS_LABELS["B"], STATUS_LABELS["D"])

# Display names of coded categories.
FREQUENCY_NAMES = {
    "POPLATEK MESICNE": "Mensual",
    "POPLATEK TYDNE": "Semanal",
    "POPLATEK PO OBRATU": "Variable",
}
TRANS_TYPE_NAMES = {"PRIJEM": "INGRESO", "VYBER": "RETIRO", "VYDAJ": "GASTO/PAGO"}

# Card types from lowest to highest.
CARD_RANKS = {"junior": 1, "classic": 2, "gold": 3}

SUSPICIOUS = "🚨 SOSPECHOSA"
NORMAL = "Normal"


def band(c: Column, bands: Sequence[tuple[float | None, str]], absent: str | None = None) -> Column:
    """Label of the first band whose edge exceeds the value; ``absent`` for null."""
    picked = F.when(c.isNull(), F.lit(absent).cast("string"))
    for edge, label in bands:
        picked = picked.otherwise(label) if edge is None else picked.when(c < edge, label)
    return picked


def named(c: Column, names: Mapping[str, str]) -> Column:
    """Display name of a code, or the code itself when it has none."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, c), c)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def is_risky(status: Column) -> Column:
    return flag(status.isin(*schema.RISKY_STATUSES))


def status_label(status: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, status), F.lit("Unknown"))


def risk_flag(outliers: Column, negative: Column) -> Column:
    """ALTO, MEDIO or BAJO from the number of outliers and a negative balance."""
    overdrawn = negative == 1
    return (
        F.when((outliers >= 3) & overdrawn, "ALTO")
        .when((outliers > 0) | overdrawn, "MEDIO")
        .otherwise("BAJO")
    )


def customer_segment(loans: Column, cards: Column) -> Column:
    return (
        F.when((loans > 0) & (cards > 0), "Premium")
        .when(loans > 0, "Loan Customer")
        .when(cards > 0, "Card Customer")
        .otherwise("Basic")
    )


def card_rank(card_type: Column) -> Column:
    """Rank of a card type; unlisted types rank below every listed one."""
    lookup = F.create_map(*[F.lit(x) for pair in CARD_RANKS.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, card_type), F.lit(0))


def opening_balance(trans_type: Column, balance: Column, amount: Column) -> Column:
    """Balance before a transaction, derived from the transaction alone."""
    return F.when(trans_type == schema.INCOME_TYPE, balance - amount).otherwise(balance + amount)
