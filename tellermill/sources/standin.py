"""Raw-shaped bank tables derived from the benchmark's Parquet tables.

Each entry gives the parts of a SELECT that Spark SQL and the checking database
both understand. They supply inputs only: no rule of the library is in here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_YYMMDD = (
    "concat(lpad(cast(year({0}) % 100 as string), 2, '0'), "
    "lpad(cast(month({0}) as string), 2, '0'), lpad(cast(day({0}) as string), 2, '0'))"
)

# Every eleventh client owns nothing: the account goes to the client before.
_OWNER = (
    "select 2 * c_custkey as disp_id, case when c_custkey % 11 = 10 then c_custkey - 1 else c_custkey end as client_id, "
    "c_custkey as account_id, 'OWNER' as type from customer"
)
_USER = (
    "select 2 * c_custkey + 1 as disp_id, c_custkey as client_id, c_custkey - 1 as account_id, "
    "'DISPONENT' as type from customer where c_custkey % 5 = 0 and c_custkey > 0"
)

# table -> (columns, FROM clause)
STANDIN: dict[str, tuple[dict[str, str], str]] = {
    "account": (
        {
            "account_id": "cast(c_custkey as string)",
            "district_id": "cast(c_nationkey as string)",
            "frequency": "case c_custkey % 3 when 0 then 'POPLATEK MESICNE' "
            "when 1 then ' POPLATEK TYDNE ' else 'POPLATEK PO OBRATU' end",
            "date": "case when c_custkey % 101 = 100 then '9X0101' else "
            "concat(cast(93 + c_custkey % 6 as string), "
            "lpad(cast(1 + cast(floor(c_custkey / 6) as bigint) % 12 as string), 2, '0'), "
            "lpad(cast(1 + c_custkey % 28 as string), 2, '0')) end",
        },
        "customer",
    ),
    "client": (
        {
            "client_id": "cast(c_custkey as string)",
            "birth_number": "case when c_custkey % 97 = 96 then '' else "
            "concat(cast(10 + c_custkey % 71 as string), "
            "lpad(cast(1 + cast(floor(c_custkey / 2) as bigint) % 12 + "
            "case when c_custkey % 2 = 1 then 50 else 0 end as string), 2, '0'), "
            "lpad(cast(1 + c_custkey % 28 as string), 2, '0')) end",
            "district_id": "cast(c_nationkey as string)",
        },
        "customer",
    ),
    "disp": (
        {
            "disp_id": "cast(disp_id as string)",
            "client_id": "cast(client_id as string)",
            "account_id": "cast(account_id as string)",
            "type": "type",
        },
        f"({_OWNER} union all {_USER}) disp_rows",
    ),
    "loan": (
        {
            "loan_id": "cast(o_orderkey as string)",
            "account_id": "cast(o_custkey as string)",
            # Four years earlier, so that every order falls into one century.
            "date": _YYMMDD.format("(o_orderdate - interval '4' year)"),
            "amount": "cast(o_totalprice as string)",
            "duration": "cast(12 * (1 + o_orderkey % 5) as string)",
            "payments": "cast(floor(o_totalprice * 100 / (12 * (1 + o_orderkey % 5))) / 100 as string)",
            "status": "case when o_orderstatus = 'F' then case when o_orderpriority = '1-URGENT' "
            "then 'B' else 'A' end when o_orderpriority = '5-LOW' then 'D' else 'C' end",
        },
        "orders",
    ),
    "trans": (
        {
            "trans_id": "cast(event_id as string)",
            # Every fiftieth transaction belongs to an account that does not exist.
            "account_id": "cast(case when event_id % 50 = 49 then user_id + 100000000 else user_id end as string)",
            # Two years, so that the 90 days of a rolling figure leave rows out.
            "date": _YYMMDD.format("(ts + interval '1' day * cast(event_id % 700 as int))"),
            "type": "case event_type when 'purchase' then 'VYDAJ' when 'click' then 'VYDAJ' "
            "when 'error' then 'VYBER' else 'PRIJEM' end",
            "operation": "case event_type when 'purchase' then 'PREVOD NA UCET' "
            "when 'click' then 'VYBER' when 'signup' then 'VKLAD' when 'view' then ' ' end",
            "amount": "cast(value as string)",
            "balance": "cast((100000 - 7 * round(value * 100)) / 100 as string)",
            "k_symbol": "case event_id % 4 when 0 then 'SIPO' when 1 then '' when 2 then ' ' end",
            "bank": "case when event_id % 3 = 0 then 'AB' end",
            "account": "case when event_id % 3 = 0 then cast(event_id as string) end",
        },
        "events",
    ),
    "order": (
        {
            "order_id": "cast(l_orderkey as string)",
            "account_id": "cast(l_suppkey as string)",
            "amount": "cast(l_extendedprice as string)",
            "k_symbol": "case l_linenumber % 4 when 0 then ' POJISTNE ' when 1 then '' when 2 then ' ' end",
        },
        "lineitem",
    ),
    "card": (
        {
            "card_id": "cast(c_custkey as string)",
            # Seven cards share a disposition, so that most accounts have none.
            "disp_id": "cast(2 * (c_custkey - c_custkey % 7) as string)",
            "type": "case c_custkey % 3 when 0 then 'classic' when 1 then 'junior' else 'gold' end",
            "issued": "concat('9', cast(4 + c_custkey % 5 as string), "
            "lpad(cast(1 + c_custkey % 12 as string), 2, '0'), "
            "lpad(cast(1 + c_custkey % 28 as string), 2, '0'), ' 00:00:00')",
        },
        "customer",
    ),
    "district": (
        {
            "a1": "cast(n_nationkey as string)",
            "a2": "n_name",
            "a3": "r_name",
            "a4": "cast(40000 + 1000 * n_nationkey as string)",
            "a5": "cast(n_nationkey % 9 as string)",
            "a6": "cast(n_nationkey % 7 as string)",
            "a7": "cast(n_nationkey % 5 as string)",
            "a8": "cast(n_nationkey % 3 as string)",
            "a9": "cast(1 + n_nationkey % 4 as string)",
            "a10": "cast((400 + n_nationkey * 7) / 10 as string)",
            "a11": "cast(8000 + 137 * n_nationkey as string)",
            "a12": "case when n_nationkey = 12 then '?' else cast((10 + n_nationkey * 3) / 10 as string) end",
            "a13": "cast((12 + n_nationkey * 3) / 10 as string)",
            "a14": "case when n_nationkey = 7 then '' else cast(80 + n_nationkey as string) end",
            "a15": "cast(900 + n_nationkey as string)",
            "a16": "cast(950 + n_nationkey as string)",
        },
        "nation join region on n_regionkey = r_regionkey",
    ),
}

# Columns read from each Parquet table; naming them spares a look at every file's footer.
_FILES = {
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

_INPUTS = {
    "account": ["customer"],
    "client": ["customer"],
    "disp": ["customer"],
    "loan": ["orders"],
    "trans": ["events"],
    "order": ["lineitem"],
    "card": ["customer"],
    "district": ["nation", "region"],
}


def select_text(table: str) -> str:
    columns, source = STANDIN[table]
    return "select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from {source}"


class StandinReader:
    """Raw-shaped tables over the Parquet files in one folder, each file opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._folder = sf_dir
        self._files: dict[str, DataFrame] = {}

    def _file(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self._spark.read.schema(_FILES[name]).parquet(
                f"{self._folder}/{name}.parquet"
            )
        return self._files[name]

    def __call__(self, table: str) -> DataFrame:
        text = select_text(table)
        inputs = {n: self._file(n) for n in _INPUTS[table]}
        for name in inputs:
            text = _braced(text, name)
        return self._spark.sql(text, **inputs)


def _braced(text: str, name: str) -> str:
    """Point FROM and JOIN clauses at a DataFrame handed to ``spark.sql``."""
    for word in ("from", "join"):
        text = text.replace(f"{word} {name}", f"{word} {{{name}}}")
    return text
