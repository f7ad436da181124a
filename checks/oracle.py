"""Checking SQL: every named query written a second time, for another engine.

The stand-in expressions supply the same raw text to both sides. Everything
after that is written independently, as plain common table expressions.
"""

from __future__ import annotations

import re

from tellermill.sources.standin import STANDIN, select_text

ORACLES: dict[str, str] = {}


def rnd(x: str, k: int = 2) -> str:
    """Half away from zero, in doubles."""
    p = 10**k
    return f"(sign({x}) * floor(abs({x}) * {p} + 0.5) / {p} + 0.0)"


def cents(x: str) -> str:
    return f"cast(round(({x}) * 100) as bigint)"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def total(x: str) -> str:
    return f"({dbl(f'sum({cents(x)})')} / 100)"


def mean(x: str) -> str:
    return f"({total(x)} / count({x}))"


def mean2(x: str) -> str:
    return f"({rnd(f'({dbl(f"sum({cents(x)})")} / nullif(count({x}), 0))', 0)} / 100)"


def pct(a: str, b: str, k: int = 2) -> str:
    return rnd(f"({dbl(a)} * 100 / nullif({b}, 0))", k)


def ratio(a: str, b: str, k: int = 4) -> str:
    return rnd(f"({dbl(a)} / nullif({b}, 0))", k)


CTE: dict[str, str] = {f"raw_{t}": select_text(t) for t in STANDIN}


def _ymd(c: str) -> str:
    return (
        f"case when regexp_full_match({c}, '[0-9]{{6}}') "
        f"then cast(try_strptime('19' || {c}, '%Y%m%d') as date) end"
    )


def _label(c: str, label: str) -> str:
    return f"case when {c} is null or trim({c}) = '' then '{label}' else {c} end as {c}"


def _num(t: str, *cols: str) -> str:
    return ", ".join(f"try_cast({c} as {t}) as {c}" for c in cols)


CTE |= {
    "account": f"select {_num('bigint', 'account_id')}, {_num('integer', 'district_id')}, frequency, {_ymd('date')} as date from raw_account",
    "client": f"select {_num('bigint', 'client_id')}, {_num('integer', 'district_id')}, birth_number from raw_client",
    "disp": f"select {_num('bigint', 'disp_id', 'client_id', 'account_id')}, type from raw_disp",
    "loan": f"select {_num('bigint', 'loan_id', 'account_id')}, {_num('integer', 'duration')}, {_num('double', 'amount', 'payments')}, "
    f"{_ymd('date')} as date, status from raw_loan",
    "orders_": f"select {_num('bigint', 'order_id', 'account_id')}, {_num('double', 'amount')}, "
    f"{_label('k_symbol', 'NO_SYMBOL')} from raw_order",
    "trans": f"select {_num('bigint', 'trans_id', 'account_id')}, {_num('double', 'amount', 'balance')}, "
    f"{_ymd('date')} as date, type, {_label('operation', 'UNKNOWN')}, {_label('k_symbol', 'NO_SYMBOL')}, "
    f"{_label('bank', 'INTERNO')}, {_label('account', 'NA_CASH')} from raw_trans",
    "card": f"select {_num('bigint', 'card_id', 'disp_id')}, type, {_ymd('substr(issued, 1, 6)')} as issued from raw_card",
    "district": "select try_cast(a1 as integer) as district_id, a2 as district_name, a3 as region, "
    "try_cast(a4 as integer) as population, a5 as num_cities_lt_499, a6 as num_cities_500_1999, a7 as num_cities_2000_9999, "
    "a8 as num_cities_gt_10000, a9 as num_cities, a10 as urban_ratio, try_cast(a14 as integer) as num_entrepreneurs_per_1000, "
    "try_cast(a11 as integer) as average_salary, "
    "try_cast(a12 as double) as unemployment_rate_95, try_cast(a13 as double) as unemployment_rate_96, "
    "try_cast(a15 as integer) as num_crimes_95, try_cast(a16 as integer) as num_crimes_96 from raw_district",
    "born": "select *, case when mm > 50 then mm - 50 else mm end as m from (select client_id, district_id, birth_number, "
    "try_cast(substr(birth_number, 1, 2) as integer) as yy, try_cast(substr(birth_number, 3, 2) as integer) as mm, "
    "try_cast(substr(birth_number, 5, 2) as integer) as dd from client) numbers",
    "born_on": "select *, cast(try_strptime('19' || lpad(cast(yy as varchar), 2, '0') || lpad(cast(m as varchar), 2, '0') "
    "|| lpad(cast(dd as varchar), 2, '0'), '%Y%m%d') as date) as birth_date from born",
    "dim_client": "select client_id, district_id, birth_number, case when mm > 50 then 'F' else 'M' end as gender, birth_date, "
    "cast(1998 - year(birth_date) as integer) as age_at_1998, case when birth_date is null then null "
    "when 1998 - year(birth_date) < 25 then '18-24' when 1998 - year(birth_date) < 35 then '25-34' "
    "when 1998 - year(birth_date) < 45 then '35-44' when 1998 - year(birth_date) < 55 then '45-54' "
    "when 1998 - year(birth_date) < 65 then '55-64' else '65+' end as age_segment from born_on",
    "loans": "select loan_id, account_id, date as loan_start_date, amount, duration, payments, trim(status) as status, "
    "cast(date + to_months(duration) as date) as loan_end_date, "
    "case when status = 'B' or status = 'D' then 1 else 0 end as is_risky, "
    "case status when 'A' then 'Contract finished, no problems' when 'B' then 'Contract finished, loan not paid' "
    "when 'C' then 'Contract running, OK so far' when 'D' then 'Contract running, client in debt' else 'Unknown' end as status_label, "
    f"{ratio('payments * duration', 'amount')} as payment_to_amount_ratio, "
    "case when amount is null then null when amount < 50000 then 'Small (< 50K)' when amount < 150000 then 'Medium (50K-150K)' "
    "when amount < 300000 then 'Large (150K-300K)' else 'Very Large (300K+)' end as loan_amount_segment from loan",
    "dim_loan": "select *, case when amount > (select quantile_disc(amount, 0.95) from loan) then 1 else 0 end as is_amount_outlier from loans",
    "owner": "select account_id, min(client_id) as owner_client_id from disp where type = 'OWNER' group by account_id",
    "aged": "select *, date_diff('day', date, date '1998-12-31') as age_days from account",
    "aged2": f"select *, {rnd('(age_days / 365.25::double)')} as age_years from aged",
    "account_aged": "select account_id, district_id, trim(frequency) as frequency, date, cast(age_days as integer) as account_age_days, "
    "age_years as account_age_years, case when age_years is null then null when age_years < 1 then 'New (< 1 year)' "
    "when age_years < 3 then 'Recent (1-3 years)' when age_years < 5 then 'Established (3-5 years)' "
    "else 'Mature (5+ years)' end as account_age_segment from aged2",
    "dim_account": "select a.*, d.district_name, d.region, d.population, d.num_cities_lt_499, d.num_cities_500_1999, "
    "d.num_cities_2000_9999, d.num_cities_gt_10000, d.num_cities, d.urban_ratio, d.num_entrepreneurs_per_1000, d.average_salary, d.unemployment_rate_95, "
    "d.unemployment_rate_96, d.num_crimes_95, d.num_crimes_96, o.owner_client_id, c.gender as owner_gender, "
    "c.age_at_1998 as owner_age, c.age_segment as owner_age_segment from account_aged a "
    "left join district d on a.district_id = d.district_id left join owner o on a.account_id = o.account_id "
    "left join dim_client c on o.owner_client_id = c.client_id",
    "dated": "select date from account union all select date from loan union all select date from trans",
    "dim_card": "select card_id, disp_id, trim(type) as type_card, issued from card",
    "flagged": "select trans_id, account_id, date, type, operation, amount, balance as final_balance, k_symbol, bank, account, "
    "case when amount > (select quantile_disc(amount, 0.95) from trans) then 1 else 0 end as is_amount_outlier from trans",
    "windowed": "select trans_id, lag(balance) over (partition by account_id order by date, trans_id) as prev, "
    f"sum({cents('amount')}) over w as s_all, count(amount) over w as n_all, count(*) over w as n_rows, "
    f"sum(case when type = 'PRIJEM' then {cents('amount')} else 0 end) over w as s_in, "
    f"sum(case when type = 'VYDAJ' then {cents('amount')} else 0 end) over w as s_out from trans "
    "window w as (partition by account_id order by date range between interval 90 days preceding and current row)",
    "fact_transactions": "select f.*, coalesce(w.prev, case when f.type = 'PRIJEM' then f.final_balance - f.amount "
    "else f.final_balance + f.amount end) as initial_balance, "
    f"{rnd(f'({dbl("w.s_all")} / nullif(w.n_all, 0))', 0)} / 100 as avg_trans_amount_3m, "
    "cast(w.s_in as double) / 100 as total_income_3m, cast(w.s_out as double) / 100 as total_expense_3m, "
    "w.n_rows as num_trans_3m from flagged f join windowed w using (trans_id)",
    "activity_base": "select account_id, count(*) as total_transactions, "
    "count(*) filter (where type = 'PRIJEM') as total_income_transactions, "
    "count(*) filter (where type = 'VYDAJ') as total_expense_transactions, "
    f"{total("case when type = 'PRIJEM' then amount else 0 end")} as total_income_amount, "
    f"{total("case when type = 'VYDAJ' then amount else 0 end")} as total_expense_amount, "
    f"{total("case when type = 'PRIJEM' then amount when type = 'VYDAJ' then -amount else 0 end")} as net_balance, "
    f"{mean('amount')} as avg_transaction_amount, max(amount) as max_transaction_amount, min(amount) as min_transaction_amount, "
    f"{rnd('stddev_samp(amount)', 4)} as stddev_transaction_amount, max(balance) as max_balance, min(balance) as min_balance, "
    f"{mean('balance')} as avg_balance, max(date) as last_transaction_date, min(date) as first_transaction_date, "
    "cast(date_diff('day', min(date), max(date)) as integer) as days_active from trans group by account_id",
    "activity": f"select *, case when total_expense_amount > 0 then {ratio('total_income_amount', 'total_expense_amount')} end "
    "as income_to_expense_ratio, case when min_balance < 0 then 1 else 0 end as has_negative_balance, "
    f"case when days_active > 0 then {ratio('total_transactions', 'days_active')} end as transactions_per_day from activity_base",
    "loan_agg": f"select account_id, count(*) as num_loans, {total('amount')} as total_loan_amount, {mean('amount')} as avg_loan_amount, "
    "cast(sum(is_risky) as bigint) as num_risky_loans, max(is_risky) as has_risky_loan from loans group by account_id",
    "card_agg": "select d.account_id, count(*) as num_cards, case max(case c.type_card when 'gold' then 3 when 'classic' then 2 "
    "when 'junior' then 1 else 0 end) when 3 then 'gold' when 2 then 'classic' when 1 then 'junior' end as highest_card_type "
    "from dim_card c join disp d on c.disp_id = d.disp_id group by d.account_id",
    "products": "select a.account_id, coalesce(l.num_loans, 0) as num_loans, coalesce(l.total_loan_amount, 0.0) as total_loan_amount, "
    "coalesce(l.avg_loan_amount, 0.0) as avg_loan_amount, coalesce(l.num_risky_loans, 0) as num_risky_loans, "
    "coalesce(l.has_risky_loan, 0) as has_risky_loan, coalesce(c.num_cards, 0) as num_cards, c.highest_card_type, "
    "case when l.num_loans > 0 and c.num_cards > 0 then 'Premium' when l.num_loans > 0 then 'Loan Customer' "
    "when c.num_cards > 0 then 'Card Customer' else 'Basic' end as customer_segment from account a "
    "left join loan_agg l on a.account_id = l.account_id left join card_agg c on a.account_id = c.account_id",
    "owned": "select a.account_id, a.frequency, a.account_age_years, c.client_id, c.gender, c.age_segment, c.age_at_1998 "
    "from account_aged a join owner o on a.account_id = o.account_id join dim_client c on c.client_id = o.owner_client_id",
    "behavior": "select o.client_id, o.age_segment, o.gender, o.account_id, o.frequency, t.trans_id, t.date as trans_date, "
    "t.type as trans_type, t.operation, t.amount as trans_amount, t.final_balance, t.is_amount_outlier "
    "from owned o join flagged t on o.account_id = t.account_id",
    "loan_risk": "select l.loan_id, l.account_id, l.amount as loan_amount, l.duration, l.status, l.status_label, l.is_risky, "
    "l.loan_start_date, o.owner_client_id, d.district_id, d.region, d.district_name, d.average_salary, d.unemployment_rate_96 "
    "from loans l join account a on l.account_id = a.account_id join district d on a.district_id = d.district_id "
    "left join owner o on o.account_id = a.account_id",
    "account_risk": f"select account_id, cast(sum(is_amount_outlier) as bigint) as num_outliers, {total('amount')} as volume, "
    f"{mean2('amount')} as mean, case when min(final_balance) < 0 then 1 else 0 end as has_negative_balance "
    "from flagged group by account_id",
}

RISK_FLAG = (
    "case when num_outliers >= 3 and has_negative_balance = 1 then 'ALTO' "
    "when num_outliers > 0 or has_negative_balance = 1 then 'MEDIO' else 'BAJO' end as risk_flag"
)

PROCESSED = ["account", "client", "disp", "loan", "trans", "order", "card", "district"]
COLUMNS = {
    "account": {"account_id": "bigint", "district_id": "int", "frequency": "string", "date": "date"},
    "client": {"client_id": "bigint", "birth_number": "string", "district_id": "int"},
    "disp": {"disp_id": "bigint", "client_id": "bigint", "account_id": "bigint", "type": "string"},
    "loan": {
        "loan_id": "bigint", "account_id": "bigint", "date": "date", "amount": "double",
        "duration": "int", "payments": "double", "status": "string",
    },
    "trans": {
        "trans_id": "bigint", "account_id": "bigint", "date": "date", "type": "string", "operation": "string",
        "amount": "double", "balance": "double", "k_symbol": "string", "bank": "string", "account": "string",
    },
    "order": {"order_id": "bigint", "account_id": "bigint", "amount": "double", "k_symbol": "string"},
    "card": {"card_id": "bigint", "disp_id": "bigint", "type": "string", "issued": "date"},
    "district": {
        "district_id": "int", "district_name": "string", "region": "string", "population": "int",
        "num_cities_lt_499": "string", "num_cities_500_1999": "string", "num_cities_2000_9999": "string",
        "num_cities_gt_10000": "string", "num_cities": "string", "urban_ratio": "string",
        "average_salary": "int", "unemployment_rate_95": "double", "unemployment_rate_96": "double",
        "num_entrepreneurs_per_1000": "int", "num_crimes_95": "int", "num_crimes_96": "int",
    },
}
KEYS = {
    "account": "account_id", "client": "client_id", "disp": "disp_id", "loan": "loan_id",
    "order": "order_id", "trans": "trans_id", "card": "card_id", "district": "district_id",
}


def _cte(t: str) -> str:
    return "orders_" if t == "order" else t


def sql(name: str, body: str) -> None:
    """Register a query with the expressions it needs, in order."""
    used: dict[str, str] = {}

    def need(text: str, skip: str | None = None) -> None:
        for word in dict.fromkeys(re.findall(r"(?:from|join)\s+(\w+)", text)):
            if word in CTE and word not in used and word != skip:
                need(CTE[word], word)
                used[word] = CTE[word]

    need(body)
    head = ",\n".join(f"{n} as ({t})" for n, t in used.items())
    ORACLES[name] = f"with {head}\n{body}"


# Sources, cleaning

sql("scan_partitioned", "select trans_id, account_id, type, date, amount from trans where type = 'PRIJEM'")
sql(
    "load_reconciliation",
    " union all ".join(
        f"select '{m}' as table_name, (select count(*) from {t}) as expected, (select count(*) from {t}) as found, 1 as ok"
        for m, t in {
            "dim_client": "client", "dim_account": "account", "dim_loan": "loan", "dim_district": "district", "dim_card": "card",
            "dim_disp": "disp", "dim_order": "orders_", "fact_transactions": "trans",
            "fact_account_transactions": "activity", "fact_account_summary": "account",
        }.items()
    ),
)
sql(
    "scan_curated",
    "select loan_id, account_id, status, loan_start_date, amount, is_amount_outlier from dim_loan where status = 'B'",
)
sql("csv_round_trip", "select * from raw_loan")
sql(
    "csv_rejects",
    "select case cast(loan_id as bigint) % 8 when 1 then 'too few fields' when 2 then 'too many fields' "
    "when 3 then 'no key' when 4 then 'key is no number' else 'accepted' end as outcome, count(*) as lines from raw_loan group by 1",
)
sql("csv_accepted", "select * from loan where loan_id % 8 not in (1, 2, 3, 4)")
sql("renamed_columns", "select disp_id, client_id, account_id as accountid, type from raw_disp")
sql("renamed_for_sink", "select disp_id, client_id, account_id, type from raw_disp")
sql("peek_trans", "select trans_id, account_id, date, amount from trans order by trans_id limit 5")
sql(
    "blanks_as_nulls",
    "select trans_id, "
    + ", ".join(f"case when trim({c}) <> '' then {c} end as {c}" for c in ("operation", "k_symbol", "bank"))
    + " from raw_trans",
)
sql(
    "sample_accounts",
    "select account_id, district_id, frequency, date from account "
    "where cast('0x' || substr(md5(cast(account_id as varchar)), 1, 8) as bigint) % 10000 < 500",
)
sql(
    "sink_types",
    "select * exclude (stddev_transaction_amount), cast(1 as double) as share from activity",
)
sql(
    "load_summary",
    " union all ".join(
        f"select '{m}' as table_name, {n} as row_count, '{o}' as outcome"
        for m, n, o in [
            *(
                (m, f"(select count(*) from {t})", "written")
                for m, t in {
                    "dim_client": "client", "dim_account": "account", "dim_loan": "loan", "dim_district": "district",
                    "dim_disp": "disp", "dim_order": "orders_", "fact_transactions": "trans", "fact_account_transactions": "activity",
                }.items()
            ),
            ("dim_card", "null", "failed"),
            ("fact_account_summary", "null", "skipped"),
        ]
    ),
)
sql(
    "crawled_loans",
    "select loan_id, account_id, status, amount, case when status not in ('A', 'C') then is_amount_outlier end as is_amount_outlier from dim_loan",
)
sql("incremental_history", "select * exclude (is_amount_outlier) from fact_transactions")
sql("incremental_activity", "select * from activity")
sql("parse_dates", "select account_id, date from account")
sql("impute_labels", "select trans_id, operation, k_symbol, bank, account from trans")
sql("clean_trans", "select * from trans")
sql("clean_district", "select * from district")
sql("clean_disp", "select disp_id, client_id, account_id, trim(type) as type from disp")
sql("clean_order", "select order_id, account_id, amount, trim(k_symbol) as k_symbol from orders_")
sql("card_issued", "select * from dim_card")

# Dimensions and facts

sql("client_features", "select * from dim_client")
sql("loan_features", "select * from dim_loan")
sql("account_enriched", "select * from dim_account")
sql(
    "account_age_months",
    "select account_id, date, cast((1998 * 12 + 12) - (year(date) * 12 + month(date)) as integer) as account_age_months from account",
)
sql(
    "initial_balance",
    "select trans_id, account_id, date, type, amount, initial_balance, final_balance from fact_transactions",
)
sql(
    "rolling_90d",
    "select trans_id, account_id, date, avg_trans_amount_3m, total_income_3m, total_expense_3m, num_trans_3m from fact_transactions",
)
sql("outlier_p95_trans", "select trans_id, amount, is_amount_outlier from flagged")
sql("outlier_p95_loan", "select loan_id, amount, is_amount_outlier from dim_loan")
sql("account_transactions", "select * from activity")
sql("loan_by_account", "select * from loan_agg")
sql("card_by_account", "select * from card_agg")
sql(
    "account_summary",
    "select d.*, t.* exclude (account_id), p.* exclude (account_id) from dim_account d "
    "left join activity t on d.account_id = t.account_id join products p on p.account_id = d.account_id",
)
sql(
    "mart_dim_client",
    "select client_id, birth_number, district_id, gender, birth_date, age_at_1998, age_segment from dim_client",
)
sql(
    "mart_dim_account",
    "select account_id, district_id, frequency, date, owner_client_id, account_age_days, account_age_years, "
    "account_age_segment, district_name, region, average_salary, unemployment_rate_96 from dim_account",
)
sql(
    "mart_dim_loan",
    "select loan_id, account_id, loan_start_date, loan_end_date, amount, duration, payments, status, status_label, "
    "is_risky, payment_to_amount_ratio, loan_amount_segment, is_amount_outlier from dim_loan",
)
sql(
    "mart_fact_transactions",
    "select trans_id, account_id, date, type, operation, amount, initial_balance, final_balance, k_symbol, "
    "is_amount_outlier, avg_trans_amount_3m, num_trans_3m from fact_transactions",
)
sql(
    "fact_loan_dispositions",
    "select l.loan_id, l.account_id, o.owner_client_id, a.district_id, l.loan_start_date, l.loan_end_date, l.status, "
    "l.status_label, l.amount, l.is_risky as is_default, case when l.is_risky = 1 then l.amount else 0.0 end as defaulted_capital "
    "from loans l left join account a on a.account_id = l.account_id left join owner o on o.account_id = l.account_id",
)
sql(
    "avg_monthly_trans",
    "select account_id, count(*) as active_months, "
    f"{ratio('sum(n)', 'count(*)')} as avg_transactions_per_month, {ratio('sum(c)', 'count(*)', 0)} / 100 as avg_amount_per_month "
    f"from (select account_id, date_trunc('month', date) as m, count(*) as n, sum({cents('amount')}) as c from trans "
    "where date is not null group by 1, 2) months group by account_id",
)
sql(
    "dim_date",
    "select date, cast(strftime(date, '%Y%m%d') as integer) as date_key, "
    + ", ".join(
        f"cast({f}(date) as integer) as {n}"
        for n, f in {
            "day": "day", "day_of_week": "isodow", "week": "week", "month": "month", "quarter": "quarter", "year": "year",
        }.items()
    )
    + " from ("
    "select cast(unnest(generate_series((select min(date) from dated x), (select max(date) from dated y), interval 1 day)) "
    "as date) as date) days",
)
sql(
    "dim_transaction_type",
    "select distinct md5(coalesce('=' || type, '-') || '|' || coalesce('=' || operation, '-')) as transaction_type_key, "
    "type, operation from trans",
)

# Views

sql("v_customer_behavior", "select * from behavior")
sql("v_loan_risk_analysis", "select * from loan_risk")
sql(
    "v_account_activity",
    "select a.account_id, a.district_id, a.frequency, a.date as account_start_date, a.account_age_years, a.account_age_segment, "
    "a.owner_client_id, t.total_transactions, t.total_income_amount, t.total_expense_amount, t.net_balance, "
    "t.income_to_expense_ratio, t.avg_transaction_amount, t.avg_balance, t.has_negative_balance, t.transactions_per_day "
    "from dim_account a left join activity t on a.account_id = t.account_id",
)
sql(
    "v_fraud_analysis",
    "select b.trans_id, b.account_id, b.trans_amount, b.is_amount_outlier, b.final_balance, t.has_negative_balance, "
    "a.frequency, a.account_age_years from behavior b join dim_account a on b.account_id = a.account_id "
    "left join activity t on a.account_id = t.account_id",
)

# Reports

BAD = "count(*) filter (where status in ('B', 'D'))"
sql(
    "default_rate_by_segment",
    f"select loan_amount_segment, count(*) as total_prestamos, {BAD} as prestamos_default, "
    f"{pct(BAD, 'count(*)')} as tasa_default_porcentaje, {mean2('amount')} as monto_promedio from loans group by 1",
)
sql(
    "risky_profile",
    "select o.gender, o.age_segment, count(distinct l.loan_id) as total_prestamos_riesgosos, "
    f"{mean2('l.amount')} as monto_promedio_prestamo, {rnd('(cast(sum(o.age_at_1998) as double) / nullif(count(o.age_at_1998), 0))')} "
    "as edad_promedio from owned o join loans l on o.account_id = l.account_id where l.is_risky = 1 group by 1, 2",
)
sql(
    "risk_by_region",
    f"select region, {rnd('(cast(sum(average_salary) as double) / nullif(count(average_salary), 0))')} as salario_promedio, "
    f"count(loan_id) as total_prestamos, {BAD} as total_defaults, {pct(BAD, 'count(loan_id)')} as tasa_default_pct "
    "from loan_risk group by region having count(loan_id) > 10",
)
sql(
    "trans_by_age_gender",
    "select age_segment, gender, trans_type as tipo_transaccion, count(trans_id) as num_transacciones, "
    f"{mean2('trans_amount')} as monto_promedio from behavior group by 1, 2, 3",
)
sql(
    "activity_segments",
    "select case when n = 0 then 'Inactiva' when n < 10 then 'Baja Actividad' when n < 50 then 'Actividad Media' "
    "else 'Alta Actividad' end as segmento_actividad, count(*) as num_cuentas from (select a.account_id, count(t.trans_id) as n "
    "from account a left join trans t on a.account_id = t.account_id group by a.account_id) counts group by 1",
)
sql(
    "trans_by_frequency",
    "select a.frequency as tipo_cuenta, t.type as tipo_transaccion, t.operation as operacion, count(*) as num_transacciones, "
    f"{total('t.amount')} as volumen_total from account_aged a join trans t on a.account_id = t.account_id group by 1, 2, 3",
)
sql(
    "top_suspicious",
    "select trans_id, account_id, trans_date, trans_type, operation, trans_amount, final_balance, "
    "case when is_amount_outlier = 1 then '🚨 SOSPECHOSA' else 'Normal' end as flag_fraude from behavior "
    "where is_amount_outlier = 1 order by trans_amount desc, trans_id limit 100",
)


def _money_text(x: str) -> str:
    return f"cast(cast({x} as decimal(28, 2)) as varchar)"


LABELS = "count(*) filter (where status_label in ('Contract finished, loan not paid', 'Contract running, client in debt'))"
sql(
    "executive_kpis",
    "select 'Total Clientes' as metrica, cast(count(*) as varchar) as valor from dim_client union all "
    f"select 'Tasa de Morosidad (%)', {_money_text(pct(LABELS, 'count(*)'))} from loans union all "
    f"select 'Volumen Total Préstamos', {_money_text(total('amount'))} from loans union all "
    "select 'Tasa de Detección de Anomalías (Outliers) (%)', "
    f"{_money_text(pct('sum(is_amount_outlier)', 'count(*)'))} from flagged union all "
    "select 'Ratio de Apalancamiento (Clientes con Préstamo/Tarjeta) (%)', "
    f"{_money_text(pct('count(*) filter (where num_loans > 0 or num_cards > 0)', 'count(*)'))} from products",
)
SEGMENTS = "string_agg(distinct customer_segment, ', ' order by customer_segment)"
sql("segment_list", f"select {SEGMENTS} as segments from products")
sql(
    "data_quality_summary",
    "select 'Clientes por género' as metrica, 'M: ' || count(*) filter (where gender = 'M') || ' | F: ' || "
    "count(*) filter (where gender = 'F') as valor from dim_client union all "
    "select 'Préstamos riesgosos', cast(sum(is_risky) as varchar) || ' de ' || count(*) || ' (' || "
    f"cast(cast({pct('sum(is_risky)', 'count(*)', 1)} as decimal(5, 1)) as varchar) || '%)' from loans union all "
    f"select 'Segmentos de clientes', {SEGMENTS} from products",
)
CURATED_COLUMNS = {
    "dim_client": ("dim_client", 7),
    "dim_account": ("dim_account", 26),
    "dim_loan": ("dim_loan", 13),
    "dim_district": ("district", 16),
    "dim_card": ("dim_card", 4),
    "dim_disp": ("disp", 4),
    "dim_order": ("orders_", 4),
    "fact_transactions": ("fact_transactions", 16),
    "fact_account_transactions": ("activity", 20),
    "fact_account_summary": ("products", 53),
}
sql(
    "table_counts",
    " union all ".join(
        [
            f"select '{t}' as table_name, count(*) as row_count, {len(COLUMNS[t])} as column_count, "
            f"cast('{KEYS[t]}' as varchar) as key_column from {_cte(t)}"
            for t in PROCESSED
        ]
        + [
            f"select '{n}', count(*), {k}, cast(null as varchar) from {c}"
            for n, (c, k) in CURATED_COLUMNS.items()
        ]
    ),
)
sql(
    "label_translation",
    "select 'frequency' as kind, frequency as code, case frequency when 'POPLATEK MESICNE' then 'Mensual' "
    "when 'POPLATEK TYDNE' then 'Semanal' when 'POPLATEK PO OBRATU' then 'Variable' else frequency end as label, "
    "count(*) as n from account_aged group by 1, 2, 3 union all "
    "select 'type', type, case type when 'PRIJEM' then 'INGRESO' when 'VYBER' then 'RETIRO' when 'VYDAJ' then 'GASTO/PAGO' "
    "else type end, count(*) from trans group by 1, 2, 3",
)
CTE["payments"] = "select *, amount / nullif(duration, 0) as expected_payment from loan"
CTE["payments2"] = "select *, abs(payments - expected_payment) as payment_diff from payments"
CTE["payments3"] = "select *, payment_diff / nullif(expected_payment, 0) * 100 as payment_diff_pct from payments2"
sql(
    "payment_consistency",
    "select loan_id, amount, duration, payments, expected_payment, payment_diff, payment_diff_pct, "
    "case when payment_diff_pct > 10 then 1 else 0 end as is_inconsistent from payments3",
)
sql(
    "anomaly_checks",
    "select 'transactions with zero amount' as check_name, count(*) filter (where amount = 0) as n from trans union all "
    "select 'transactions with negative balance', count(*) filter (where balance < 0) from trans union all "
    "select 'loans with inconsistent payment', count(*) filter (where payment_diff_pct > 10) from payments3",
)
sql("top_operations", "select operation, count(*) as n from trans group by 1 order by n desc, operation limit 5")
sql(
    "region_top_accounts",
    "select d.region, count(*) as num_accounts from account a join district d on a.district_id = d.district_id "
    "group by 1 order by 2 desc, 1 limit 10",
)
sql(
    "unemployment_extremes",
    "(select 'lowest' as kind, district_id, region, unemployment_rate_96 as unemployment_rate from district "
    "where unemployment_rate_96 is not null order by unemployment_rate_96, district_id limit 10) union all "
    "(select 'highest', district_id, region, unemployment_rate_96 from district "
    "where unemployment_rate_96 is not null order by unemployment_rate_96 desc, district_id limit 10)",
)
sql(
    "trans_stats_by_type",
    f"select type, count(*) as n, {mean2('amount')} as mean, {rnd('median(amount)')} as median, {total('amount')} as total "
    "from trans group by 1",
)
sql(
    "loan_amount_by_status",
    f"select status, count(*) as n, {mean2('amount')} as mean, {rnd('median(amount)')} as median, {total('amount')} as total "
    "from loan group by 1",
)
sql(
    "loan_duration_by_status",
    "select status, " + rnd("(cast(sum(duration) as double) / nullif(count(duration), 0))") + " as mean, "
    f"{rnd('median(cast(duration as double))')} as median, min(duration) as shortest, max(duration) as longest from loan group by 1",
)
sql(
    "salary_by_frequency",
    "select a.frequency, " + rnd("(cast(sum(d.average_salary) as double) / nullif(count(d.average_salary), 0))") + " as mean, "
    f"{rnd('median(cast(d.average_salary as double))')} as median, count(d.average_salary) as n "
    "from account_aged a join district d on a.district_id = d.district_id group by 1",
)
sql(
    "balance_profile",
    f"select {mean2('balance')} as mean_balance, min(balance) as min_balance, max(balance) as max_balance, "
    f"count(*) filter (where balance < 0) as negative_count, {pct('count(*) filter (where balance < 0)', 'count(*)')} as negative_pct, "
    f"{mean2('case when balance < 0 then balance end')} as negative_mean, {rnd('median(balance)')} as median_balance from trans",
)
sql(
    "risk_rate",
    f"select count(*) as loans, {BAD} as risky_loans, {pct(BAD, 'count(*)')} as risk_rate_pct from loan",
)
sql(
    "disp_per_client",
    "select " + rnd("(cast(sum(n) as double) / nullif(count(n), 0))") + " as mean, max(n) as largest, "
    f"count(*) filter (where n > 1) as clients_with_several, {pct('count(*) filter (where n > 1)', 'count(*)')} as several_pct, "
    "median(cast(n as double)) as median from (select client_id, count(*) as n from disp where client_id is not null group by 1) c",
)
CTE["yearly"] = (
    "select 'account' as table_name, cast(year(date) as integer) as year, count(*) as n from account where date is not null group by 1, 2 "
    "union all select 'loan', cast(year(date) as integer), count(*) from loan where date is not null group by 1, 2"
)
sql(
    "openings_by_year",
    "select y.table_name, y.year, y.n, min(y.year) over t as first_year, max(y.year) over t as last_year, "
    "first_value(y.year) over (partition by y.table_name order by y.n desc, y.year rows between unbounded preceding "
    "and unbounded following) as busiest_year from yearly y window t as (partition by y.table_name)",
)
sql("account_risk_flag", f"select account_id, num_outliers, has_negative_balance, {RISK_FLAG} from account_risk")
sql(
    "top_anomalous_accounts",
    f"select account_id, num_outliers, volume as total_volume, mean as avg_transaction, has_negative_balance, {RISK_FLAG} "
    "from account_risk where num_outliers > 0 order by num_outliers desc, volume desc, account_id limit 20",
)

# Data quality

CATEGORY = {
    "account": ["frequency"],
    "trans": ["type", "operation", "k_symbol"],
    "loan": ["status"],
    "order": ["k_symbol"],
    "card": ["type"],
    "disp": ["type"],
}
CTE["categories"] = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, {c} as value, count(*) as n from {_cte(t)} where {c} is not null group by 3"
    for t, cs in CATEGORY.items()
    for c in cs
)
CTE["category_totals"] = "select *, sum(n) over (partition by table_name, column_name) as whole from categories"
sql(
    "value_shares",
    f"select table_name, column_name, value, n, {pct('n', 'whole', 4)} as pct from category_totals",
)
sql(
    "cardinality_alerts",
    "select table_name, column_name, count(*) as distinct_values, case when count(*) = 1 then 'single value' "
    "when count(*) > 50 then 'high cardinality' else 'ok' end as alert from categories group by 1, 2",
)
NUMERIC = {
    "trans": ["amount", "balance"],
    "loan": ["amount", "payments", "duration"],
    "order": ["amount"],
    "district": [
        "population", "average_salary", "unemployment_rate_95",
        "unemployment_rate_96", "num_crimes_95", "num_crimes_96",
    ],
}
OUTLIERS = {
    "trans": ["amount", "balance"],
    "loan": ["amount", "payments"],
    "order": ["amount"],
    "district": ["average_salary", "unemployment_rate_95", "unemployment_rate_96"],
}


def _values(columns: dict[str, list[str]]) -> str:
    return " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, cast({c} as double) as value from {_cte(t)}"
        for t, cs in columns.items()
        for c in cs
    )


CTE["numbers"] = _values(NUMERIC)
CTE["outlier_numbers"] = _values(OUTLIERS)
CUTS = {"p01": 0.01, "p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
sql(
    "numeric_profile",
    f"select table_name, column_name, count(value) as n, {rnd('avg(value)', 4)} as mean, {rnd('stddev_samp(value)', 4)} as std, "
    "min(value) as min, max(value) as max, "
    + ", ".join(f"{rnd(f'quantile_cont(value, {p})', 4)} as {n}" for n, p in CUTS.items())
    + " from numbers group by 1, 2",
)
sql(
    "sketched_quantiles",
    "select table_name, column_name, count(value) as non_null, 1 as within_error from numbers group by 1, 2 having count(value) > 0",
)
sql(
    "numeric_shape",
    f"select table_name, column_name, {rnd('(max(value) - min(value))', 4)} as value_range, "
    f"{rnd('(quantile_cont(value, 0.75) - quantile_cont(value, 0.25))', 4)} as iqr, "
    f"{rnd('(stddev_samp(value) / avg(value))', 4)} as variation, {rnd('skewness(value)', 4)} as skew, "
    "case when abs(skewness(value)) > 1 then 1 else 0 end as is_skewed from numbers group by 1, 2",
)
CTE["quartiles"] = (
    "select table_name, column_name, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from outlier_numbers group by 1, 2"
)
CTE["factors"] = "select unnest([1.5::double, 3.0::double]) as factor"
CTE["fences"] = (
    "select table_name, column_name, factor, q1, q3, q3 - q1 as iqr, q1 - factor * (q3 - q1) as lower_bound, "
    "q3 + factor * (q3 - q1) as upper_bound from quartiles cross join factors"
)
OUTSIDE = "(v.value < f.lower_bound or v.value > f.upper_bound)"
CTE["outside"] = (
    "select f.factor, f.table_name, f.column_name, f.q1, f.q3, f.iqr, f.lower_bound, f.upper_bound, count(*) as total_rows, "
    f"count(*) filter (where {OUTSIDE}) as outliers, count(*) filter (where {OUTSIDE} and v.value < 0) as negative_outliers, "
    f"min(case when {OUTSIDE} then v.value end) as min_outlier, max(case when {OUTSIDE} then v.value end) as max_outlier, "
    "max(v.value) as max_value from fences f join outlier_numbers v using (table_name, column_name) group by 1, 2, 3, 4, 5, 6, 7, 8"
)
sql(
    "outlier_iqr",
    "select factor, table_name, column_name, "
    + ", ".join(f"{rnd(c, 4)} as {c}" for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound"))
    + f", total_rows, outliers, negative_outliers, min_outlier, max_outlier, max_value, {pct('outliers', 'total_rows')} as outlier_pct from outside",
)
sql(
    "sketched_distinct",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count({c}) as non_null, "
        f"count(distinct {c}) as distinct_values, 1 as within_error from {_cte(t)}"
        for t, cols in COLUMNS.items()
        for c in cols
    ),
)
sql(
    "column_profile",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, '{ty}' as data_type, count({c}) as non_null, "
        f"count(*) - count({c}) as nulls, {pct(f'(count(*) - count({c}))', 'count(*)')} as null_pct, "
        f"count(distinct {c}) as distinct_values, min(cast({c} as varchar)) as example from {_cte(t)}"
        for t, cols in COLUMNS.items()
        for c, ty in cols.items()
    ),
)
CTE["null_counts"] = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) as whole, "
    f"count(*) filter (where {c} is null or {c} in ('', ' ', 'NULL', 'null')) as nulls from raw_{t}"
    for t in STANDIN
    for c in STANDIN[t][0]
)
CTE["null_rates"] = f"select *, {pct('nulls', 'whole')} as null_pct from null_counts where nulls > 0"
sql(
    "null_profile",
    "select table_name, column_name, nulls, whole - nulls as non_nulls, null_pct, "
    "count(*) over (partition by table_name) as columns_with_nulls, max(null_pct) over (partition by table_name) as max_null_pct from null_rates",
)
sql(
    "duplicate_check",
    " union all ".join(
        f"select '{t}' as table_name, '{KEYS[t]}' as key_column, (select count(*) from {_cte(t)}) as total_rows, "
        f"(select coalesce(sum(n), 0)::bigint from (select count(*) as n from {_cte(t)} group by {KEYS[t]} having count(*) > 1) k) as key_duplicates, "
        f"(select coalesce(sum(n), 0)::bigint from (select count(*) as n from {_cte(t)} group by {', '.join(COLUMNS[t])} having count(*) > 1) r) as row_duplicates"
        for t in PROCESSED
    ),
)
sql(
    "pk_uniqueness",
    " union all ".join(
        f"select '{t}' as table_name, '{KEYS[t]}' as key_column, count(*) as total_rows, count(distinct {KEYS[t]}) as distinct_values, "
        f"count(*) - count(distinct {KEYS[t]}) as duplicates, case when count(*) = count(distinct {KEYS[t]}) then 1 else 0 end as is_unique "
        f"from {_cte(t)}"
        for t in PROCESSED
    ),
)
FOREIGN = [
    ("disp", "client_id", "client", "client_id"),
    ("disp", "account_id", "account", "account_id"),
    ("loan", "account_id", "account", "account_id"),
    ("order", "account_id", "account", "account_id"),
    ("trans", "account_id", "account", "account_id"),
    ("card", "disp_id", "disp", "disp_id"),
    ("account", "district_id", "district", "district_id"),
]
CTE["references_"] = " union all ".join(
    f"select '{c}' as child_table, '{cc}' as child_column, '{p}' as parent_table, '{pc}' as parent_column, "
    f"count(distinct {cc}) as key_values, count(distinct {cc}) filter (where {cc} not in (select {pc} from {p} where {pc} is not null)) "
    f"as missing from {_cte(c)}"
    for c, cc, p, pc in FOREIGN
)
sql(
    "fk_integrity",
    f"select *, coalesce({pct('missing', 'key_values')}, 0.0) as orphan_pct, case when missing = 0 then 1 else 0 end as is_ok from references_",
)
sql(
    "orphan_flag",
    "select trans_id, account_id, case when exists (select 1 from account a where a.account_id = t.account_id) then 0 else 1 end "
    "as is_orphan from trans t",
)
sql(
    "accounts_without_trans",
    "select account_id from account where account_id not in (select account_id from trans where account_id is not null)",
)
sql(
    "clients_without_account",
    "select client_id from client where client_id not in (select client_id from disp where client_id is not null)",
)
sql(
    "domain_check",
    "select 'account' as table_name, 'frequency' as column_name, frequency as value, count(*) as n from account "
    "where frequency not in ('POPLATEK MESICNE', 'POPLATEK TYDNE', 'POPLATEK PO OBRATU') group by 3 union all "
    "select 'trans', 'type', type, count(*) from trans where type not in ('PRIJEM', 'VYDAJ', 'CREDIT', 'WITHDRAWAL') group by 3 union all "
    "select 'loan', 'status', status, count(*) from loan where status not in ('A', 'B', 'C', 'D') group by 3 union all "
    "select 'disp', 'type', type, count(*) from disp where type not in ('OWNER', 'DISPONENT') group by 3",
)
CTE["date_formats"] = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) filter (where trim({c}) <> '') as filled, "
    f"count(*) filter (where regexp_full_match(trim({c}), '[0-9]+')) as digits_only, "
    f"count(*) filter (where trim({c}) <> '' and {_ymd(f'substr(trim({c}), 1, 6)')} is null) as unparseable from raw_{t}"
    for t, c in (("account", "date"), ("loan", "date"), ("trans", "date"), ("card", "issued"), ("client", "birth_number"))
)
sql(
    "date_format_check",
    "select *, case when digits_only > 0 then 1 else 0 end as needs_conversion from date_formats",
)

# Dashboard

DEFAULTED = "count(*) filter (where is_risky = 1)"


def _long(pairs: dict[str, str], source: str) -> str:
    return " union all ".join(
        f"select '{m}' as metric, cast({x} as double) as value from {source}" for m, x in pairs.items()
    )


CTE["late_loans"] = (
    "select * from loan_risk where region in ('EUROPE', 'ASIA') and loan_start_date > "
    "(select max(loan_start_date) from loan_risk) - interval 12 months"
)
CTE["some_moves"] = (
    "select b.* from behavior b join dim_account a on b.account_id = a.account_id where trans_date between date '1924-01-05' "
    "and date '1925-06-25' and a.region in ('EUROPE', 'ASIA') and age_segment in ('25-34', '35-44') and gender = 'F'"
)
sql(
    "filtered_kpis",
    _long(
        {"loans": "count(*)", "loan_volume": total("loan_amount"), "default_rate_pct": pct(DEFAULTED, "count(*)")},
        "late_loans",
    )
    + " union all "
    + _long({"transactions": "count(*)", "trans_volume": total("trans_amount")}, "some_moves"),
)
BAD_AMOUNT = "case when is_risky = 1 then amount else 0 end"
sql(
    "risk_kpis",
    _long(
        {
            "default_rate_pct": pct(DEFAULTED, "count(loan_id)"),
            "high_risk_loans": DEFAULTED,
            "defaulted_capital": total(BAD_AMOUNT),
            "defaulted_capital_pct": pct(total(BAD_AMOUNT), total("amount")),
        },
        "loans",
    )
    + " union all "
    + _long(
        {
            "suspicious_transactions": "sum(is_amount_outlier)",
            "suspicious_pct": pct("sum(is_amount_outlier)", "count(*)"),
        },
        "flagged",
    ),
)
sql(
    "executive_cards",
    _long({"customers": "count(*)"}, "dim_client")
    + " union all "
    + _long({"active_accounts": "count(*)"}, "account where account_id in (select account_id from trans)")
    + " union all "
    + _long(
        {"loans": "count(*)", "loan_portfolio": total("amount"), "default_rate_pct": pct(DEFAULTED, "count(*)")}, "loans"
    )
    + " union all "
    + _long({"avg_transaction": mean2("amount")}, "trans"),
)
sql(
    "loan_volume_by_region",
    f"select region, count(*) as loans, {total('loan_amount')} as volume from loan_risk group by 1",
)
sql(
    "loan_trend",
    "select cast(date_trunc('month', loan_start_date) as date) as month, status, count(*) as loans from loans group by 1, 2",
)
sql(
    "trans_volume_by_type",
    "select type, case when type = 'PRIJEM' then 'credit' else 'debit' end as direction, count(*) as transactions, "
    f"{total('amount')} as volume from trans group by 1, 2",
)
CTE["district_totals"] = (
    f"select district_id, district_name, region, count(*) as loans, {total('loan_amount')} as volume, "
    f"max(average_salary) as average_salary, {pct(DEFAULTED, 'count(*)')} as default_rate_pct from loan_risk group by 1, 2, 3"
)
CTE["district_ranks"] = (
    "select *, cast(row_number() over (order by volume desc, district_name) as integer) as rank from district_totals"
)
sql("top_districts", "select * from district_ranks where rank <= 10")
CTE["active_clients"] = "select distinct client_id from owned where account_id in (select account_id from trans)"
CTE["client_activity"] = "select c.*, a.client_id as active from dim_client c left join active_clients a on a.client_id = c.client_id"
CTE["account_months"] = "select account_id, date_trunc('month', date) as m, count(*) as n from trans group by 1, 2"
sql(
    "customer_cards",
    _long(
        {
            "avg_age": rnd("(cast(sum(age_at_1998) as double) / nullif(count(age_at_1998), 0))"),
            "male_pct": pct("count(*) filter (where gender = 'M')", "count(*)"),
            "female_pct": pct("count(*) filter (where gender = 'F')", "count(*)"),
            "active_customers": "count(active)",
            "activity_rate_pct": pct("count(active)", "count(*)"),
        },
        "client_activity",
    )
    + " union all "
    + _long({"avg_transactions_per_month": ratio("sum(n)", "count(*)")}, "account_months"),
)
sql(
    "customers_by_age_gender",
    "select 'standard' as band_set, age_segment, gender, count(*) as customers from dim_client group by 2, 3 union all "
    "select 'filter', case when age_at_1998 is null then null when age_at_1998 < 31 then 'Young (18-30)' "
    "when age_at_1998 < 51 then 'Middle Age (31-50)' else 'Senior (51+)' end, gender, count(*) from dim_client group by 2, 3",
)
sql(
    "activity_heatmap",
    f"select age_segment, {total("case when gender = 'F' then trans_amount end")} as volume_f, "
    f"{total("case when gender = 'M' then trans_amount end")} as volume_m from behavior group by 1",
)
CTE["region_clients"] = (
    "select d.region, count(*) as customers from dim_client c join district d on c.district_id = d.district_id group by 1"
)
CTE["region_loans"] = f"select region, {total('loan_amount')} as loan_volume from loan_risk group by 1"
sql(
    "customers_by_region",
    "select c.region, c.customers, coalesce(l.loan_volume, 0.0) as loan_volume from region_clients c left join region_loans l on c.region = l.region",
)
sql(
    "activity_by_account_age",
    "select a.account_age_segment, count(*) as accounts, "
    + rnd("(cast(coalesce(sum(t.total_transactions), 0) as double) / count(*))")
    + f" as avg_transactions, {rnd('avg(t.avg_balance)')} as avg_balance from account_aged a "
    "left join activity t on a.account_id = t.account_id group by 1",
)
sql(
    "income_expense_by_frequency",
    f"select a.frequency, {total('t.total_income_amount')} as income, {total('t.total_expense_amount')} as expense "
    "from account_aged a join activity t on a.account_id = t.account_id group by 1",
)
sql(
    "outlier_scatter",
    "select trans_id, amount, final_balance, is_amount_outlier, num_trans_3m from fact_transactions",
)
sql("outliers_by_type", "select type, cast(sum(is_amount_outlier) as bigint) as outliers from flagged group by 1")
sql(
    "default_trend_by_region",
    "select region, cast(date_trunc('month', loan_start_date) as date) as month, count(*) as loans, "
    f"{DEFAULTED} as defaults, {pct(DEFAULTED, 'count(*)')} as default_rate_pct from loan_risk group by 1, 2",
)
CTE["periods"] = " union all ".join(
    f"select '{u}' as unit, cast(date_trunc('{u}', loan_start_date) as date) as period, count(*) as loans, "
    f"{total('amount')} as volume, {pct(DEFAULTED, 'count(*)')} as default_rate_pct from loans where loan_start_date is not null group by 2"
    for u in ("year", "month")
)
CTE["period_steps"] = (
    "select *, lag(loans) over w as l0, lag(volume) over w as v0, lag(default_rate_pct) over w as d0 from periods "
    "window w as (partition by unit order by period)"
)
sql(
    "kpi_yoy",
    f"select unit, period, loans, volume, default_rate_pct, {pct('(loans - l0)', 'l0')} as loans_change_pct, "
    f"{pct('(volume - v0)', 'v0')} as volume_change_pct, {rnd('(default_rate_pct - d0)')} as default_rate_change_pp from period_steps",
)
