"""Every query on tables in which one key holds a third of the rows.

Broadcast joins are off, AQE's skew thresholds and the quantile limit are low,
so the ways taken for large tables are taken here.
"""

from __future__ import annotations

import pytest

from duck import assert_same
from tallyloom import jobs
from tallyloom.operators import quantiles, slices
from tallyloom.plans.registry import QUERIES, runner
from tallyloom.sources.tables import SCHEMAS, read_table, table_path

LARGE_TABLE_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Generated hot tables; those the generator does not make come empty."""
    folder = str(tmp_path_factory.mktemp("hot"))
    jobs.generate(spark, folder, 20_000, seed=11, hot_share=0.333)
    for name in ("embeddings", "pages", "benchmark", "labels", "conversations"):
        spark.createDataFrame([], SCHEMAS[name]).coalesce(1).write.parquet(table_path(folder, name))
    return folder


@pytest.fixture(scope="module")
def duck(hot):
    import duckdb

    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{table_path(hot, name)}/*.parquet'")
    yield con
    con.close()


@pytest.fixture
def as_if_large(spark, monkeypatch):
    before = {k: spark.conf.get(k) for k in LARGE_TABLE_SETTINGS}
    for k, v in LARGE_TABLE_SETTINGS.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(quantiles, "LIMIT", 500)
    monkeypatch.setattr(quantiles, "TOGETHER", 1)
    monkeypatch.setattr(slices, "ROWS", 300)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_tables_are_hot(spark, hot):
    n = read_table(spark, hot, "lineitem").where("l_partkey = 0").count()
    assert n == pytest.approx(80_000 / 3, rel=0.05)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, hot, duck, as_if_large, name):
    assert assert_same(runner(name)(spark, hot), duck, QUERIES[name].sql) > 0


def test_hot_partitions_are_split(spark, hot, as_if_large):
    """The join of whole lines to the hot part runs as several tasks."""
    df = runner("star_enrichment")(spark, hot)
    df.collect()
    assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
