"""Table layouts, keys and vocabularies of the bank data set."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw files: every column is read as text and typed afterwards.
RAW = {
    "account": _strings("account_id", "district_id", "frequency", "date"),
    "client": _strings("client_id", "birth_number", "district_id"),
    "disp": _strings("disp_id", "client_id", "account_id", "type"),
    "loan": _strings("loan_id", "account_id", "date", "amount", "duration", "payments", "status"),
    "order": _strings("order_id", "account_id", "bank_to", "account_to", "amount", "k_symbol"),
    "trans": _strings(
        "trans_id", "account_id", "date", "type", "operation",
        "amount", "balance", "k_symbol", "bank", "account",
    ),
    "card": _strings("card_id", "disp_id", "type", "issued"),
    "district": _strings(*[f"a{i}" for i in range(1, 17)]),
}

# Target types after cleaning. Columns not named here stay text. Row numbers
# are bigint, as tables may have more than 2^31 rows.
CASTS = {
    "account": {"account_id": "bigint", "district_id": "int"},
    "client": {"client_id": "bigint", "district_id": "int"},
    "disp": {"disp_id": "bigint", "client_id": "bigint", "account_id": "bigint"},
    "loan": {
        "loan_id": "bigint", "account_id": "bigint", "amount": "double",
        "duration": "int", "payments": "double",
    },
    "order": {"order_id": "bigint", "account_id": "bigint", "amount": "double"},
    "trans": {"trans_id": "bigint", "account_id": "bigint", "amount": "double", "balance": "double"},
    "card": {"card_id": "bigint", "disp_id": "bigint"},
    "district": {
        "district_id": "int", "population": "int", "average_salary": "int",
        "unemployment_rate_95": "double", "unemployment_rate_96": "double",
        "num_entrepreneurs_per_1000": "int", "num_crimes_95": "int", "num_crimes_96": "int",
    },
}

# Names of the sixteen coded district columns.
DISTRICT_NAMES = {
    "a1": "district_id",
    "a2": "district_name",
    "a3": "region",
    "a4": "population",
    "a5": "num_cities_lt_499",
    "a6": "num_cities_500_1999",
    "a7": "num_cities_2000_9999",
    "a8": "num_cities_gt_10000",
    "a9": "num_cities",
    "a10": "urban_ratio",
    "a11": "average_salary",
    "a12": "unemployment_rate_95",
    "a13": "unemployment_rate_96",
    "a14": "num_entrepreneurs_per_1000",
    "a15": "num_crimes_95",
    "a16": "num_crimes_96",
}

# Business labels for absent text.
TRANS_LABELS = {
    "bank": "INTERNO",
    "account": "NA_CASH",
    "k_symbol": "NO_SYMBOL",
    "operation": "UNKNOWN",
}
ORDER_LABELS = {"k_symbol": "NO_SYMBOL"}

# Keys.
PRIMARY_KEYS = {
    "account": "account_id",
    "client": "client_id",
    "disp": "disp_id",
    "loan": "loan_id",
    "order": "order_id",
    "trans": "trans_id",
    "card": "card_id",
    "district": "district_id",
}

# Fixed values: (child table, child column) -> (parent table, parent column)
FOREIGN_KEYS = {
    ("disp", "client_id"): ("client", "client_id"),
    ("disp", "account_id"): ("account", "account_id"),
    ("loan", "account_id"): ("account", "account_id"),
    ("order", "account_id"): ("account", "account_id"),
    ("trans", "account_id"): ("account", "account_id"),
    ("card", "disp_id"): ("disp", "disp_id"),
    ("account", "district_id"): ("district", "district_id"),
}

# Expected vocabularies.
DOMAINS = {
    ("account", "frequency"): ["POPLATEK MESICNE", "POPLATEK TYDNE", "POPLATEK PO OBRATU"],
    ("trans", "type"): ["PRIJEM", "VYDAJ", "CREDIT", "WITHDRAWAL"],
    ("loan", "status"): ["A", "B", "C", "D"],
    ("disp", "type"): ["OWNER", "DISPONENT"],
}

INCOME_TYPE = "PRIJEM"
EXPENSE_TYPE = "VYDAJ"
RISKY_STATUSES = ("B", "D")
OWNER = "OWNER"
REFERENCE_DATE = "1998-12-31"

# Columns described in the data-quality profile.
NUMERIC_COLUMNS = {
    "trans": ["amount", "balance"],
    "loan": ["amount", "payments", "duration"],
    "order": ["amount"],
    "district": [
        "population", "average_salary", "unemployment_rate_95",
        "unemployment_rate_96", "num_crimes_95", "num_crimes_96",
    ],
}
OUTLIER_COLUMNS = {
    "trans": ["amount", "balance"],
    "loan": ["amount", "payments"],
    "order": ["amount"],
    "district": ["average_salary", "unemployment_rate_95", "unemployment_rate_96"],
}
CATEGORY_COLUMNS = {
    "account": ["frequency"],
    "trans": ["type", "operation", "k_symbol"],
    "loan": ["status"],
    "order": ["k_symbol"],
    "card": ["type"],
    "disp": ["type"],
}
RAW_DATE_COLUMNS = {
    "account": ["date"],
    "loan": ["date"],
    "trans": ["date"],
    "card": ["issued"],
    "client": ["birth_number"],
}

# Folder columns of the stored layers, always low-cardinality categories.
PROCESSED_PARTITIONS = {
    "account": ["frequency"],
    "client": None,
    "disp": ["type"],
    "loan": ["status"],
    "order": None,
    "trans": ["type"],
    "card": ["type"],
    "district": None,
}
CURATED_PARTITIONS = {
    "dim_client": None,
    "dim_account": ["district_id"],
    "dim_loan": ["status"],
    "dim_district": None,
    "dim_card": ["type_card"],
    "dim_disp": ["type"],
    "dim_order": None,
    "fact_transactions": ["type"],
    "fact_account_transactions": None,
    "fact_account_summary": ["customer_segment"],
}

# Column subsets sent to the warehouse; tables not named here are sent whole.
MART_COLUMNS = {
    "dim_client": [
        "client_id", "birth_number", "district_id", "gender",
        "birth_date", "age_at_1998", "age_segment",
    ],
    "dim_account": [
        "account_id", "district_id", "frequency", "date", "owner_client_id",
        "account_age_days", "account_age_years", "account_age_segment",
        "district_name", "region", "average_salary", "unemployment_rate_96",
    ],
    "dim_loan": [
        "loan_id", "account_id", "loan_start_date", "loan_end_date", "amount",
        "duration", "payments", "status", "status_label", "is_risky",
        "payment_to_amount_ratio", "loan_amount_segment", "is_amount_outlier",
    ],
    "fact_transactions": [
        "trans_id", "account_id", "date", "type", "operation", "amount",
        "initial_balance", "final_balance", "k_symbol", "is_amount_outlier",
        "avg_trans_amount_3m", "num_trans_3m",
    ],
}
