"""The four jobs end to end: generated tables through preparation to the report."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyloom import jobs
from tallyloom.__main__ import main
from tallyloom.sources import csv_files
from tallyloom.sources.tables import SCHEMAS, read_table, schema_of, table_path

N_ORDERS = 3_000
GENERATED = list(SCHEMAS)[:9]


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """The same tables as Parquet and as CSV, the CSV with three damaged lines."""
    folder = tmp_path_factory.mktemp("delivered")
    jobs.generate(spark, f"{folder}/parquet", N_ORDERS, hot_share=0.333)
    jobs.generate(spark, f"{folder}/csv", N_ORDERS, hot_share=0.333, csv=True)
    bad = ["1,2,F,many,1995-01-01,5-LOW", "17,4", "9,9,F,10.00,no date,5-LOW"]
    spark.createDataFrame([(b,) for b in bad], "value string").write.mode("append").text(
        f"{folder}/csv/orders.csv"
    )
    return str(folder), bad


@pytest.fixture(scope="module")
def prepared(spark, delivered, tmp_path_factory):
    folder, _ = delivered
    out = str(tmp_path_factory.mktemp("prepared"))
    jobs.prepare(spark, f"{folder}/parquet", f"{out}/parquet")
    jobs.prepare(spark, f"{folder}/csv", f"{out}/csv", csv=True)
    return out


def test_generated_sizes_and_types(spark, delivered):
    folder, _ = delivered
    sizes = {"region": 5, "nation": 25, "customer": 300, "orders": 3_000, "lineitem": 12_000}
    for name, n in sizes.items():
        path = table_path(f"{folder}/parquet", name)
        assert read_table(spark, f"{folder}/parquet", name).count() == n
        stored = spark.read.parquet(path).schema
        assert [(f.name, f.dataType) for f in stored] == [
            (f.name, f.dataType) for f in schema_of(name)
        ]


def test_hot_share(spark, delivered):
    folder, _ = delivered
    orders = read_table(spark, f"{folder}/parquet", "orders")
    assert orders.where("o_custkey = 0").count() == pytest.approx(N_ORDERS / 3, rel=0.1)


def test_generation_does_not_depend_on_partitions(spark, tmp_path, monkeypatch, delivered):
    folder, _ = delivered
    monkeypatch.setattr(jobs, "ROWS_PER_TASK", 700)
    jobs.generate(spark, str(tmp_path), N_ORDERS, hot_share=0.333)
    for name in ("customer", "part", "orders", "lineitem", "events", "documents"):
        one = read_table(spark, f"{folder}/parquet", name)
        many = read_table(spark, str(tmp_path), name)
        assert many.rdd.getNumPartitions() > 1 or name in ("customer", "part", "documents")
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_csv_and_parquet_deliveries_agree(spark, prepared):
    for name in ("customers", "documents", "events", "lines"):
        a = spark.read.parquet(f"{prepared}/parquet/{name}")
        b = spark.read.parquet(f"{prepared}/csv/{name}").select(*a.columns)
        assert a.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_bad_lines_kept(spark, prepared, delivered):
    bad = spark.read.parquet(f"{prepared}/csv/ingested/orders").where("not readable")
    assert sorted(r["raw_line"] for r in bad.collect()) == sorted(delivered[1])


def test_nothing_lost(spark, prepared, delivered):
    folder, _ = delivered
    source = f"{folder}/parquet"
    customers = spark.read.parquet(f"{prepared}/parquet/customers")
    assert customers.count() == read_table(spark, source, "customer").count()
    documents = spark.read.parquet(f"{prepared}/parquet/documents")
    n = documents.agg(F.sum("n_copies")).first()[0]
    assert n == read_table(spark, source, "documents").count()
    assert documents.count() < n
    lines = spark.read.parquet(f"{prepared}/parquet/lines")
    assert lines.count() == read_table(spark, source, "lineitem").count()


def test_files_of_a_year_do_not_grow_with_tasks(spark, delivered, tmp_path):
    folder, _ = delivered
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        jobs.prepare(spark, f"{folder}/parquet", str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    years = list((tmp_path / "out" / "lines" / "match=matched").glob("order_year=*"))
    assert years and all(len(list(y.glob("*.parquet"))) == 1 for y in years)


def test_a_year_of_lines_is_read_alone(spark, prepared):
    year = spark.read.parquet(f"{prepared}/parquet/lines").where("order_year = 1997")
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert year.select(F.year("o_orderdate")).distinct().collect() == [(1997,)]


def test_prepare_again_replaces_everything(spark, prepared, delivered, tmp_path):
    folder, _ = delivered
    before = spark.read.parquet(f"{prepared}/parquet/lines").count()
    jobs.generate(spark, f"{tmp_path}/other", 400, seed=3)
    jobs.prepare(spark, f"{tmp_path}/other", f"{tmp_path}/out")
    jobs.prepare(spark, f"{folder}/parquet", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/lines").count() == before
    customers = spark.read.parquet(f"{tmp_path}/out/customers")
    assert customers.count() == customers.select("c_custkey").distinct().count()


def test_generate_does_not_overwrite_unasked(spark, tmp_path):
    jobs.generate(spark, str(tmp_path), 20)
    with pytest.raises(AnalysisException):
        jobs.generate(spark, str(tmp_path), 20)
    main(["generate", str(tmp_path), "--orders", "30", "--overwrite"])
    assert read_table(spark, str(tmp_path), "orders").count() == 30


def test_analyse_and_report(spark, delivered, tmp_path):
    folder, _ = delivered
    main(["analyse", f"{folder}/parquet", f"{tmp_path}/analysis"])
    main(["report", f"{folder}/parquet", f"{tmp_path}/report", "--format", "json"])
    profile = spark.read.parquet(f"{tmp_path}/analysis/value_profile").first()
    assert profile["n"] == N_ORDERS and profile["min"] <= profile["p50"] <= profile["max"]
    figures = spark.read.json(f"{tmp_path}/report/key_figures")
    values = {r["metric"]: r["value"] for r in figures.collect()}
    assert values["orders"] == N_ORDERS and values["order lines"] == 4 * N_ORDERS
    assert len(list((tmp_path / "report" / "key_figures").glob("part-*.json"))) == 1


def test_a_dirty_delivery_loses_nothing(spark, delivered, tmp_path):
    """Orders, customers and parts missing, an order repeated, unreadable properties,
    blank lines, numbers that are none, documents without text."""
    folder, _ = delivered
    source = f"{folder}/csv"
    dirty = str(tmp_path / "dirty")
    tables = {t: spark.read.parquet(table_path(f"{folder}/parquet", t)) for t in GENERATED}
    orders = tables["orders"].where("o_orderkey % 10 != 3")
    again = orders.where("o_orderkey < 50").withColumn("o_totalprice", F.lit(float("nan")))
    tables["orders"] = orders.unionByName(again)
    tables["customer"] = tables["customer"].where("c_custkey % 7 != 1")
    tables["part"] = tables["part"].where("p_partkey % 11 != 5")
    props = F.when(F.col("event_id") < 4, "{broken").otherwise(F.lit('{"k": 1, "page": "home"}'))
    tables["events"] = tables["events"].withColumn("props", props)
    text = F.when(F.col("doc_id") >= 5, F.col("text"))
    tables["documents"] = tables["documents"].withColumn("text", text)
    for name, table in tables.items():
        table.write.parquet(table_path(dirty, name))
    out = str(tmp_path / "out")
    jobs.prepare(spark, dirty, out)

    delivered_lines = tables["lineitem"]
    lines = spark.read.parquet(f"{out}/lines")
    columns = delivered_lines.columns
    assert lines.count() == delivered_lines.count()
    assert not delivered_lines.exceptAll(lines.select(columns)).count()
    by_match = {r["match"]: r["count"] for r in lines.groupBy("match").count().collect()}
    assert set(by_match) == {"matched", "no order", "no customer", "no part"}
    events = spark.read.parquet(f"{out}/events")
    assert events.where("props = '{broken'").count() == 4
    assert events.where("NOT props_readable").count() == 4
    assert events.where("props LIKE '%home%' AND k = 1").count() == events.count() - 4
    violations = {
        r["rule"]: int(r["n_violations"])
        for r in spark.read.option("header", True).csv(f"{out}/rule_violations").collect()
    }
    assert violations["event properties readable"] == 4
    assert violations["order price positive"] == again.count() == violations["order key unique"]
    assert spark.read.parquet(f"{out}/documents").where("text IS NULL").count() == 5
    # Analyses and reports of a table with such numbers do not stop.
    jobs.report(spark, dirty, str(tmp_path / "report"))

    blank = spark.createDataFrame([("",), ("   ",), ("7,7,F,NaN,1995-01-01,5-LOW",), ("8,8,F,Infinity,1995-01-01,5-LOW",)], "value string")
    spark.read.text(f"{source}/orders.csv").unionByName(blank).write.text(f"{tmp_path}/lines.csv")
    table = csv_files.ingest_csv(spark, f"{tmp_path}/lines.csv", schema_of("orders"), f"{tmp_path}/in")
    kept = {r[0] for r in csv_files.bad_lines(table).collect()}
    assert {r[0] for r in blank.collect()} <= kept
    assert table.count() == spark.read.text(f"{tmp_path}/lines.csv").count()
