"""Merged sketches against exact figures."""

import random

import pytest
from pyspark.sql import functions as F

from tellermill.operators import profile, sketches
from tellermill.operators.quantiles import long_values


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(1)
    rows = [
        (k % 5 if k % 7 else None, rnd.randint(0, 3000), rnd.lognormvariate(3, 2) if k % 11 else None, rnd.choice(["a", "b", None]), -0.0 if k % 2 else 0.0)
        for k in range(20_000)
    ]
    return spark.createDataFrame(rows, "part int, id long, amount double, kind string, zero double")


def test_merged_parts_equal_the_whole(table):
    """Distinct sketches are the same however rows are dealt to parts; counts are exact."""
    parts = sketches.column_sketches("t", table.repartition(9), "part")
    assert parts.count() == 6 * 5 and parts.filter("part is null").count() == 5
    merged = {r["column_name"]: r for r in sketches.distinct_estimates(sketches.merged(parts)).collect()}
    whole = {r["column_name"]: r for r in sketches.distinct_estimates(sketches.merged(sketches.column_sketches("t", table))).collect()}
    exact = {r["column_name"]: r for r in profile.column_profile({"t": table}).collect()}
    assert set(merged) == set(whole) == set(table.columns)
    for c, r in merged.items():
        assert r["distinct_estimate"] == whole[c]["distinct_estimate"]
        assert r["non_null"] == exact[c]["non_null"]
        assert abs(r["distinct_estimate"] - exact[c]["distinct_values"]) <= sketches.DISTINCT_ERROR * exact[c]["distinct_values"]
    assert merged["zero"]["distinct_estimate"] == 1 == exact["zero"]["distinct_values"]


def test_ranks_of_merged_quantiles(table):
    merged = sketches.merged(sketches.column_sketches("t", table.repartition(7), "part"))
    estimates = sketches.quantile_estimates(merged, profile.PERCENTILES)
    assert {r["column_name"] for r in estimates.collect()} == {"part", "id", "amount", "zero"}
    values = long_values(table, ["id", "amount", "zero"]).select(F.lit("t").alias("table_name"), "*")
    errors = {r["column_name"]: r for r in sketches.rank_errors(values, estimates, profile.PERCENTILES).collect()}
    assert set(errors) == {"id", "amount", "zero"}
    assert all(r["rank_error"] <= sketches.RANK_ERROR for r in errors.values())
    assert errors["zero"]["rank_error"] == 0


def test_wrong_estimates_are_noticed(table):
    wrong = table.select(F.lit("t").alias("table_name"), F.lit("id").alias("column_name"), F.lit(1).alias("non_null"), F.lit(1500.0).alias("p90")).limit(1)
    values = long_values(table, ["id"]).select(F.lit("t").alias("table_name"), "*")
    assert sketches.rank_errors(values, wrong, {"p90": 0.9}).first()["rank_error"] > 0.3


def test_one_changed_part_is_sketched_alone(table):
    """Stored sketches of the other parts stay; the merged result is that of the new table."""
    stored = sketches.column_sketches("t", table, "part").filter("part is null or part <> '3'")
    changed = table.filter("part = 3").withColumn("id", F.col("id") + 1_000_000)
    fresh = sketches.column_sketches("t", changed, "part")
    now = table.filter("part is null or part <> 3").unionByName(changed)
    got, want = (
        {r["column_name"]: r["distinct_estimate"] for r in sketches.distinct_estimates(sketches.merged(rows)).collect()}
        for rows in (stored.unionByName(fresh), sketches.column_sketches("t", now))
    )
    assert got == want


def test_no_row_is_expanded(table):
    for df in (sketches.column_sketches("t", table, "part"), profile.column_profile({"t": table})):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "count(distinct" not in plan.lower()
    assert "Expand" not in sketches.column_sketches("t", table, "part")._jdf.queryExecution().optimizedPlan().toString()


def test_empty_and_null_columns(spark):
    empty = spark.createDataFrame([], "a long, b double")
    assert sketches.column_sketches("t", empty, "a").count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "a long, b double")
    whole = sketches.merged(sketches.column_sketches("t", nulls))
    assert {tuple(r) for r in sketches.distinct_estimates(whole).collect()} == {("t", "a", 0, 0), ("t", "b", 0, 0)}
    assert sketches.quantile_estimates(whole, {"q": 0.5}).count() == 0
    listed = profile.column_profile({"t": empty}).collect()
    assert [(r["column_name"], r["non_null"], r["distinct_values"]) for r in sorted(listed)] == [("a", 0, 0), ("b", 0, 0)]
