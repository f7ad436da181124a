"""Files, database, catalog and the three batch steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tellermill import schema
from tellermill.plans import jobs
from tellermill.sources import catalog, files, jdbc

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_csv_read(spark, tmp_path):
    path = tmp_path / "account.csv"
    path.write_text('"account_id";"district_id";"frequency";"date"\n1;18;"POPLATEK MESICNE";930101\n2;1;;"9301"\n')
    df = files.read_csv(spark, str(path))
    assert df.schema == schema.RAW["account"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", "18", "POPLATEK MESICNE", "930101"), ("2", "1", None, "9301"),
    ]
    assert files.read_csv(spark, str(path), schema.RAW["account"]).count() == 2


@pytest.mark.parametrize("sep", files.SEPARATORS)
def test_separator(spark, tmp_path, sep):
    path = tmp_path / "t.csv"
    path.write_text("\n".join([sep.join("abc"), sep.join("1,2".split(",") + ["3"])] * 3))
    assert files.detect_separator(spark, str(path)) == sep


def test_csv_sample_round_trip(spark, tmp_path):
    source = tmp_path / "s.csv"
    source.write_text("A-Id,B C\n" + "\n".join(f"{i},{i}" for i in range(50)) + "\n")
    files.sample_file(spark, str(source), str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"))
    assert back.columns == ["a_id", "b_c"] and back.count() <= 50


def test_parquet_round_trip(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("type"))
    path = str(tmp_path / "p")
    assert files.write_parquet(df, path, ["type"]) == 100
    assert files.write_parquet(df, path, ["type"]) == 100
    back = files.read_parquet(spark, path)
    assert back.count() == 100 and {f.name for f in (tmp_path / "p").iterdir() if f.is_dir()} == {"type=0", "type=1", "type=2"}
    plan = back.filter(F.col("type") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan
    assert [r.id for r in files.peek(df, "id", 3).collect()] == [0, 1, 2]


def test_work_folder_needs_a_shared_place(spark):
    assert files.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_sink_types(spark):
    df = spark.range(3).select(
        "id", F.col("id").alias("n-rows"), (F.col("id") + 2**40).alias("big"), F.lit(1).cast("decimal(9,2)").alias("D.x")
    )
    out = jdbc.for_sink(df)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("id", "bigint"), ("n_rows", "bigint"), ("big", "bigint"), ("d_x", "double"),
    ]
    assert out.agg(F.max("big")).first()[0] == 2**40 + 2


def test_database_round_trip(spark):
    url = "jdbc:derby:memory:round;create=true"
    df = spark.range(1500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 0.5).alias("v"))
    for _ in range(2):
        jdbc.write_table(df, url, "numbers", DERBY, connections=2)
    assert jdbc.count_rows(spark, url, "numbers", DERBY) == 1500
    back = jdbc.read_table(spark, url, "numbers", DERBY)
    assert back.agg(F.sum("K")).first()[0] == sum(range(1500))
    split = jdbc.read_table(spark, url, "numbers", DERBY, split=("k", 100, 1000, 4))
    assert split.rdd.getNumPartitions() == 4 and split.agg(F.sum("K")).first()[0] == sum(range(1500))
    found = spark.createDataFrame([("numbers", 1500), ("extra", 1)], "table_name string, row_count bigint")
    want = spark.createDataFrame([("numbers", 1500), ("gone", 2)], "table_name string, row_count bigint")
    ok = {r.table_name: r.ok for r in jdbc.reconcile(want, found).collect()}
    assert ok == {"numbers": 1, "extra": 0, "gone": 0}


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "c")
    files.write_parquet(spark.range(10).select("id", (F.col("id") % 2).alias("part")), path, ["part"])
    for _ in range(2):
        catalog.register(spark, "stored_c", path, partitioned=True)
    assert spark.sql("select count(*) from stored_c where part = 1").first()[0] == 5
    spark.sql("drop table stored_c")


@pytest.fixture(scope="module")
def layers(spark, bank, tmp_path_factory):
    base = tmp_path_factory.mktemp("layers")
    for name in bank.raw:
        full = bank.raw[name]
        absent = [c for c in schema.RAW[name].names if c not in full.columns]
        files.write_csv(full.withColumns({c: F.lit(None).cast("string") for c in absent}), str(base / "raw" / f"{name}.csv"))
    return base


def test_batch_steps(spark, bank, layers):
    raw, processed, curated = (str(layers / n) for n in ("raw", "processed", "curated"))
    first = {r.table_name: r.rows for r in jobs.raw_to_processed(spark, raw, processed).collect()}
    assert first == {t: bank[t].count() for t in schema.RAW}
    second = {r.table_name: r.rows for r in jobs.processed_to_curated(spark, processed, curated).collect()}
    assert second["fact_account_summary"] == second["dim_account"] == first["account"]
    assert second["fact_transactions"] == first["trans"]

    summary = files.read_parquet(spark, f"{curated}/fact_account_summary")
    columns = ["account_id", "total_transactions", "net_balance", "num_loans", "num_cards", "customer_segment", "owner_gender"]
    want = sorted(map(repr, bank.fact_account_summary.select(*columns).collect()))
    assert sorted(map(repr, summary.select(*columns).collect())) == want

    jobs.register_curated(spark, curated)
    assert spark.table("default.dim_loan").count() == second["dim_loan"]
    for name in schema.CURATED_PARTITIONS:
        spark.sql(f"drop table default.{name}")

    url = "jdbc:derby:memory:mart;create=true"
    loaded = jobs.curated_to_warehouse(spark, curated, url, DERBY)
    checked = jobs.verify_warehouse(spark, loaded, url, DERBY).collect()
    assert len(checked) == 10 and all(r.ok for r in checked)


def test_failed_table_is_reported(spark, tmp_path):
    (tmp_path / "account.csv").write_text("account_id;district_id\n1;2\n")
    with pytest.raises(jobs.StepFailed) as failure:
        jobs.raw_to_processed(spark, str(tmp_path), str(tmp_path / "out"))
    errors = {r.table_name: r.error for r in failure.value.summary.collect()}
    assert "missing columns" in errors["account"] and len(errors) == 8


def test_dates_survive_the_database(spark):
    url = "jdbc:derby:memory:dates;create=true"
    df = spark.createDataFrame([(dt.date(1998, 12, 31),)], "d date")
    jdbc.write_table(df, url, "days", DERBY, connections=1)
    assert jdbc.read_table(spark, url, "days", DERBY).first()[0] == dt.date(1998, 12, 31)


def test_crawl_follows_the_folder(spark, tmp_path):
    """New partitions and columns reach the entry; statistics are there; a changed type is an error."""
    path, name = str(tmp_path / "crawled"), "default.crawled"
    rows = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "id long, n int, part string")
    rows.write.partitionBy("part").parquet(path)
    first = catalog.crawl(spark, name, path, ["part"])
    assert first.created and first.added_partitions == 2
    assert catalog.crawl(spark, name, path, ["part"]) == catalog.Crawled()
    rows.selectExpr("id + 5 as id", "n", "1.5D as extra", "'c' as part").write.mode("append").partitionBy("part").parquet(path)
    second = catalog.crawl(spark, name, path, ["part"])
    assert (second.created, second.added_columns, second.added_partitions) == (False, ["extra"], 1)
    found = {tuple(r) for r in spark.table(name).select("id", "n", "extra", "part").collect()}
    assert found == {(1, 10, None, "a"), (2, 20, None, "b"), (6, 10, 1.5, "c"), (7, 20, 1.5, "c")}
    plan = spark.sql(f"select * from {name} where part = 'c'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    stats = {r["info_name"]: r["info_value"] for r in spark.sql(f"describe extended {name} id").collect()}
    assert stats["distinct_count"] == "4" and stats["max"] == "7"
    rows.selectExpr("id", "cast(n as string) as n", "part").write.mode("overwrite").partitionBy("part").parquet(path)
    with pytest.raises(ValueError, match="changed their type"):
        catalog.crawl(spark, name, path, ["part"])
    spark.sql(f"drop table {name}")


def test_crawl_without_partitions(spark, tmp_path):
    path, name = str(tmp_path / "flat"), "default.flat"
    spark.range(3).write.parquet(path)
    assert catalog.crawl(spark, name, path, statistics=False) == catalog.Crawled(True, [], 0)
    assert spark.table(name).count() == 3
    spark.sql(f"drop table {name}")
