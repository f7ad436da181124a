"""Unusable lines are set aside with a reason, and no line is lost."""

import pytest

from tellermill import schema
from tellermill.plans import jobs
from tellermill.sources import quarantine
from tellermill.sources.quarantine import BAD_KEY, NO_KEY, OPEN_QUOTE, TOO_FEW, TOO_MANY

LOANS = '''loan_id;account_id;date;amount;duration;payments;status
1;10;930101;100.5;12;8.4;A
2;10;930101;100.5;12
3;10;930101;100.5;12;8.4;A;surplus;more
;10;930101;100.5;12;8.4;A
 ;10;930101;100.5;12;8.4;A
x4;10;930101;100.5;12;8.4;A
5;10;930101;n/a;twelve;8.4;"B;C"

6;;;;;;
7;10;"930101;100.5;12;8.4;A
8;10;93
'''


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for table, columns in schema.RAW.items():
        (folder / f"{table}.csv").write_text(LOANS if table == "loan" else ";".join(columns.names) + "\n")
    return folder


def test_every_line_is_accepted_or_set_aside(spark, raw, tmp_path):
    found = quarantine.load_checked(spark, "loan", str(raw / "loan.csv"), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert (found.lines, found.accepted, found.rejected, found.lost_values) == (10, 3, 7, 2)
    good = {r["loan_id"]: r for r in spark.read.parquet(str(tmp_path / "good")).collect()}
    assert sorted(good) == [1, 5, 6]
    assert good[1]["amount"] == 100.5 and good[5]["amount"] is None and good[5]["status"] == "B;C" and good[6]["status"] is None
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r["reason"], r["record"][:2]) for r in bad) == sorted(
        [(TOO_FEW, "2;"), (TOO_MANY, "3;"), (NO_KEY, ";1"), (NO_KEY, " ;"), (BAD_KEY, "x4"), (OPEN_QUOTE, "7;"), (TOO_FEW, "8;")]
    )
    assert next(r["record"] for r in bad if r["reason"] == TOO_MANY) == "3;10;930101;100.5;12;8.4;A;surplus;more"
    assert {r["table_name"] for r in bad} == {"loan"}


def test_all_tables_in_one_step(spark, raw, tmp_path):
    out = {n: str(tmp_path / n) for n in ("processed", "quarantine")}
    summary = {r["table_name"]: r for r in jobs.raw_to_processed_checked(spark, str(raw), out["processed"], out["quarantine"]).collect()}
    assert set(summary) == set(schema.RAW)
    assert all(r["lines"] == r["accepted"] + r["rejected"] for r in summary.values())
    assert (summary["loan"]["lines"], summary["loan"]["rejected"], summary["client"]["lines"]) == (10, 7, 0)
    assert spark.read.parquet(out["quarantine"] + "/loan").count() == 7


def test_a_clean_file_empties_the_quarantine(spark, raw, tmp_path):
    """A second load of the mended file leaves no old rejects."""
    paths = str(raw / "loan.csv"), str(tmp_path / "good"), str(tmp_path / "bad")
    quarantine.load_checked(spark, "loan", *paths)
    (raw / "loan.csv").write_text("\n".join(LOANS.splitlines()[:2]) + "\n")
    assert quarantine.load_checked(spark, "loan", *paths) == quarantine.Loaded(1, 1, 0, 0)
    names = "table_name string, reason string, record string"
    assert spark.read.schema(names).parquet(paths[2]).count() == 0


def test_other_header_order_and_missing_columns(spark, raw, tmp_path):
    (raw / "loan.csv").write_text('status;"Loan Id";account_id;date;amount;duration;payments\nA;1;2;930101;5;6;7\n')
    found = quarantine.load_checked(spark, "loan", str(raw / "loan.csv"), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert found.accepted == 1
    assert spark.read.parquet(str(tmp_path / "good")).first()["loan_id"] == 1
    (raw / "loan.csv").write_text("loan_id;status\n1;A\n")
    with pytest.raises(ValueError, match="missing columns"):
        quarantine.load_checked(spark, "loan", str(raw / "loan.csv"), str(tmp_path / "good"), str(tmp_path / "bad"))
    with pytest.raises(jobs.StepFailed, match="loan"):
        jobs.raw_to_processed_checked(spark, str(raw), str(tmp_path / "p"), str(tmp_path / "q"))


def test_shape_is_checked_whatever_columns_are_read(spark, raw):
    df = quarantine.with_reason("loan", quarantine.read_checked(spark, str(raw / "loan.csv")))
    assert df.filter(f"{quarantine.REASON} is not null").select("status").count() == 7
