"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest

from tallyloom.plans.registry import QUERIES, runner
from tallyloom.sources.scratch import scratch_root
from tallyloom.sources.tables import SCHEMAS, read_table

# Queries whose windows or sorts may run in one task: over calendar periods,
# brands, or report rows, all of bounded number.
ONE_TASK_WINDOWS = {"monthly_orders", "daily_events", "brand_share"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf001):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield {name: plan_of(runner(name)(spark, sf001)) for name in QUERIES}
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python(plans, name):
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in plans[name], node


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ONE_TASK_WINDOWS))
def test_no_window_over_a_whole_table(plans, name):
    lines = plans[name].splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = "".join(lines[max(0, i - 2) : i])
            assert "Window" not in above and "Sort " not in above, above


def test_filter_and_columns_reach_the_scan(plans):
    scan = next(
        line
        for line in plans["revenue_by_region_year"].splitlines()
        if "FileScan" in line and "lineitem" in line
    )
    assert "GreaterThanOrEqual(l_shipdate" in scan
    assert "l_tax" not in scan and "l_partkey" not in scan


def test_order_totals_are_joined_without_another_shuffle(plans):
    """One exchange by order key per side; the totals' own serves the join."""
    plan = plans["revenue_by_region_year"]
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_top_rows_are_cut_before_the_shuffle(plans):
    for name in ("top_parts_by_type", "top_events_by_type"):
        plan = plans[name]
        assert "Partial" in plan[plan.index("Exchange hashpartitioning") :]


def test_reference_check_shuffles_each_side_once(plans):
    plan = plans["rule_violations"]
    assert plan.count("Exchange hashpartitioning(_key") == 0
    assert plan.count("Exchange hashpartitioning(o_orderkey") == 1
    assert plan.count("Exchange hashpartitioning(l_orderkey#") == 2  # alone and with line number


def test_rules_need_no_scan_of_their_own(plans):
    scans = [line for line in plans["rule_violations"].splitlines() if "FileScan" in line]
    for table in ("lineitem", "orders", "customer"):
        assert sum(f"/{table}.parquet" in line for line in scans) <= 2, table


def test_each_text_is_digested_once(plans):
    for name in ("exact_duplicates", "folded_duplicates"):
        assert plans[name].count("sha2(") == 1
        assert "SortAggregate" not in plans[name]


def test_declared_schemas_match_the_files(spark, sf001):
    for name in SCHEMAS:
        declared = read_table(spark, sf001, name).schema
        stored = spark.read.parquet(f"{sf001}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in stored]


def test_scratch_is_the_session_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
