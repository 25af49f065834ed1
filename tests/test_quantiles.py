"""Exact quantiles: the narrowing path against numpy, with small limits."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import quantiles
from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.sources.tables import read_table

PROBS = (0.0, 0.25, 0.5, 0.9, 1.0)


@pytest.fixture(autouse=True)
def one_limit_for_all(monkeypatch):
    monkeypatch.setattr(quantiles, "TOGETHER", 1)


@pytest.fixture
def ways(monkeypatch):
    """The ways taken, in order."""
    taken = []
    for way in ("_buffered", "_counted", "_narrowed"):
        original = getattr(quantiles, way)

        def noted(*args, _way=way, _original=original, **kwargs):
            taken.append(_way)
            return _original(*args, **kwargs)

        monkeypatch.setattr(quantiles, way, noted)
    return taken


def expected(values):
    return [float(v) for v in np.quantile(np.array(values, dtype=float), PROBS)]


def check(result, values):
    got = list(result)[-len(PROBS) :]
    assert got == pytest.approx(expected(values), rel=1e-12, abs=1e-12)


@pytest.fixture(scope="module")
def values(spark, sf01):
    """Lines with a third of all rows in one group and a null group."""
    lines = read_table(spark, sf01, "lineitem")
    group = (
        F.when(F.col("l_returnflag") == "A", "hot")
        .when(F.col("l_discount") < 0.01, None)
        .otherwise(F.col("l_linestatus"))
    )
    return lines.select(group.alias("g"), "l_extendedprice", "l_quantity").cache()


@pytest.mark.parametrize("limit", [5, 50, 1000, 100_000])
@pytest.mark.parametrize("column", ["l_extendedprice", "l_quantity"])
def test_whole_table(values, column, limit):
    row = exact_quantiles(values, column, PROBS, limit=limit).first()
    check(row, [r[0] for r in values.select(column).collect()])


@pytest.mark.parametrize(
    "limit, taken",
    [
        (40, ["_narrowed"]),
        (15_000, ["_buffered", "_narrowed"]),
        (25_000, ["_buffered"]),
    ],
)
def test_groups(values, limit, taken, ways):
    rows = exact_quantiles(values, "l_extendedprice", PROBS, ["g"], limit=limit).collect()
    by_group = {}
    for g, v in values.select("g", "l_extendedprice").collect():
        by_group.setdefault(g, []).append(v)
    assert {r["g"] for r in rows} == set(by_group)
    assert len(rows) == len(by_group)
    for r in rows:
        check(r, by_group[r["g"]])
    assert ways == taken


def test_each_group_takes_its_way(spark, ways):
    """Few rows; many rows of few values; many rows of many values."""
    df = spark.range(3_000).select(
        F.when(F.col("id") < 50, "small").when(F.col("id") < 1_500, "few").otherwise("many").alias("g"),
        F.when(F.col("id") < 1_500, F.col("id") % 20).otherwise(F.col("id")).cast("double").alias("v"),
    )
    rows = exact_quantiles(df, "v", PROBS, ["g"], limit=100).collect()
    assert ways == ["_buffered", "_counted", "_narrowed"]
    check(next(r for r in rows if r["g"] == "small"), [i % 20 for i in range(50)])
    check(next(r for r in rows if r["g"] == "few"), [i % 20 for i in range(50, 1_500)])
    check(next(r for r in rows if r["g"] == "many"), range(1_500, 3_000))


@pytest.mark.parametrize("limit, way", [(70_000, "_buffered"), (60, "_counted"), (40, "_narrowed")])
def test_the_whole_takes_its_way(values, ways, limit, way):
    row = exact_quantiles(values, "l_quantity", PROBS, limit=limit).first()
    check(row, [r[0] for r in values.select("l_quantity").collect()])
    assert ways == [way]


def test_bad_marks_do_not_change_the_result(values, monkeypatch):
    """Brackets around the wrong ranks: the slots are listed after all."""

    def misplaced(column, evenly, accuracy):
        return F.array(*[F.lit(float(-i)) for i in range(len(evenly), 0, -1)])

    monkeypatch.setattr(quantiles.F, "percentile_approx", misplaced)
    row = exact_quantiles(values, "l_quantity", PROBS, limit=30).first()
    check(row, [r[0] for r in values.select("l_quantity").collect()])


def test_hot_groups_without_broadcast(spark, values):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = exact_quantiles(values, "l_quantity", PROBS, ["g"], limit=30).collect()
    finally:
        spark.conf.set(key, before)
    by_group = {}
    for g, v in values.select("g", "l_quantity").collect():
        by_group.setdefault(g, []).append(v)
    for r in rows:
        check(r, by_group[r["g"]])


def test_empty_and_null(spark):
    nothing = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(nothing, "v", (0.5,), ["g"]).count() == 0
    nulls = spark.createDataFrame([("a", None), ("a", 2.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in exact_quantiles(nulls, "v", (0.5,), ["g"]).collect()] == [("a", 2.0)]


@settings(
    max_examples=12,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "a", "a", "b", None]),
            st.one_of(st.integers(-3, 3).map(float), st.floats(-1e9, 1e9)),
        ),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 20),
)
def test_any_values_any_limit(spark, data, limit):
    df = spark.createDataFrame(data, "g string, v double").coalesce(2)
    by_group = {}
    for g, v in data:
        by_group.setdefault(g, []).append(v)
    rows = exact_quantiles(df, "v", PROBS, ["g"], limit=limit).collect()
    assert len(rows) == len(by_group)
    for r in rows:
        got = [r[quantiles.quantile_name(p)] for p in PROBS]
        assert got == pytest.approx(expected(by_group[r["g"]]), rel=1e-9, abs=1e-9)


def test_not_a_number_sorts_last(spark):
    data = [(float(i),) for i in range(50)] + [(float("nan"),)] * 50
    df = spark.createDataFrame(data, "v double")
    probs = (0.1, 0.4, 0.9)
    narrowed = exact_quantiles(df, "v", probs, limit=5).first()
    buffered = exact_quantiles(df, "v", probs).first()
    assert [repr(v) for v in narrowed] == [repr(v) for v in buffered]
    assert repr(narrowed[2]) == "nan"


@pytest.mark.parametrize("p", [0.0, 0.25, 0.55, 0.9, 1.0])
def test_the_three_ways_agree_bit_for_bit(spark, monkeypatch, p):
    """Ties, infinities, NaN and a null group, whatever the room for values."""
    inf, nan = float("inf"), float("nan")
    values = [k / 7 for k in range(60)] + [123.45] * 41 + [inf] * 30 + [-inf] * 5 + [nan] * 3
    rows = [(g, v) for g in ("a", None) for v in values + [None]]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    name = quantiles.quantile_name(p)

    def found(limit, together):
        monkeypatch.setattr(quantiles, "TOGETHER", together)
        return {r["g"]: repr(r[name]) for r in quantiles.exact_quantiles(df, "v", [p], ["g"], limit).collect()}

    buffered = found(10_000, 20)
    assert found(100, 20) == buffered
    assert found(1, 1) == buffered
    assert found(10, 1) == buffered
