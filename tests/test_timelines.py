"""As-of joins, sessions, and places in whole tables against loops, in one piece and sliced."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import asof, ranking, sessions, slices

START = datetime(2024, 1, 1)
LEFT = "l_id long, k string, t timestamp_ntz"
RIGHT = "r_id long, rk string, rt timestamp_ntz, v double"


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def made(spark):
    """Half of the rows under one key, ties, repeated rows, nulls."""
    rng = random.Random(7)

    def key():
        return rng.choice(["hot"] * 6 + ["a", "b", "c", "lone", None])

    def minute():
        return rng.choice([None] + [rng.randrange(400) for _ in range(20)])

    left = [(k, key(), at(minute())) for k in range(600)]
    left += left[:20]
    right = [(k, key(), at(minute()), float(rng.randrange(5))) for k in range(300)]
    right += [(k, "hot", at(399 + k % 2), None) for k in range(300, 320)] + right[:9]
    return left, right, spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)


@pytest.mark.parametrize("limit", [10**6, 40, 1])
@pytest.mark.parametrize("strict", [False, True])
def test_as_of_equals_a_loop(made, limit, strict):
    left, right, one, two = made
    expected = []
    for row in left:
        found = [
            (r[2], r[0], r[3] is not None, r[3])
            for r in right
            if None not in (row[1], row[2], r[2]) and r[1] == row[1]
            and (r[2] < row[2] if strict else r[2] <= row[2])
        ]
        best = max(found, default=None)
        expected.append((*row, *((best[1], best[3]) if best else (None, None))))
    got = asof.as_of(one, two, ("k", "rk"), ("t", "rt"), ["r_id", "v"], strict, limit)
    assert got.columns == ["l_id", "k", "t", "r_id", "v"]
    assert rows_of(got) == sorted(expected, key=repr)


def test_as_of_with_empty_sides(made):
    left, _, one, two = made
    got = asof.as_of(one, two.limit(0), ("k", "rk"), ("t", "rt"), ["r_id"])
    assert rows_of(got) == sorted(((*r, None) for r in left), key=repr)
    assert asof.as_of(one.limit(0), two, ("k", "rk"), ("t", "rt"), ["r_id"]).count() == 0


@pytest.mark.parametrize("limit", [10**6, 40, 1])
def test_sessions_equal_a_loop(made, limit):
    left, _, one, _ = made
    expected, last, number = [], {}, {}
    for row in sorted(left, key=lambda r: (r[2] or START, r[0])):
        _, k, t = row
        if k is None or t is None:
            expected.append((*row, None))
            continue
        if k not in last or t > last[k] + timedelta(minutes=3):
            number[k] = number.get(k, 0) + 1
        last[k] = t
        expected.append((*row, number[k]))
    gap = F.make_dt_interval(mins=F.lit(3))
    got = sessions.with_sessions(one, "k", "t", gap, rows=limit)
    assert rows_of(got) == sorted(expected, key=repr)
    assert sessions.with_sessions(one.limit(0), "k", "t", gap).count() == 0


def test_slices_are_bounded_and_in_order(made):
    _, _, one, _ = made
    known = one.where("k IS NOT NULL AND t IS NOT NULL")
    sliced, divided = slices.with_slices(known, "k", "t", 40)
    assert divided and sliced.count() == known.count()
    found = sliced.groupBy("k", "_slice").agg(
        F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high")
    ).orderBy("k", "_slice").collect()
    for a, b in zip(found, found[1:]):
        assert a.k != b.k or a.high < b.low
    # A slice goes on to the end of the stretch in which it is full.
    assert max(r.n for r in found) < 2 * 40
    assert {r.k for r in found if r["_slice"] > 0} >= {"hot"}
    assert not slices.with_slices(known, "k", "t", 10**6)[1]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partitions", ["1", "5", "40"])
def test_places_equal_a_loop(spark, descending, partitions):
    rng = random.Random(11)
    nan = float("nan")
    values = [7.0] * 150 + [None] * 30 + [nan] * 4 + [float(rng.randrange(40)) for _ in range(150)]
    data = [(k, v, rng.choice([None, 1, 2, 10**6])) for k, v in enumerate(values)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "id long, x double, m long")

    def size(v):
        return (1, 0.0) if v is None else (0, (-1 if descending else 1) * (1e9 if v != v else v))

    ordered = sorted(data, key=lambda r: (size(r[1]), r[0]))
    expected, first, running = [], {}, 0
    for place, (k, v, m) in enumerate(ordered, 1):
        running += m or 0
        expected.append((k, place, first.setdefault(size(v), place), running))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.with_global_order(df, "x", ["id"], F.col("m"), descending)
        assert got.columns == ["id", "x", "m", "place", "rank", "running"]
        assert rows_of(got.select("id", "place", "rank", F.col("running").cast("long"))) == sorted(
            expected, key=repr
        )
        assert ranking.with_global_order(df.limit(0), "x", ["id"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_equal_values_spread_over_partitions(spark, sf001):
    """A day of very many orders is not one task."""
    df = spark.range(4000).select("id", F.lit(1).alias("x"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = ranking.with_global_order(df, "x", ["id"])
        parts = got.select("id", "place", "rank").collect()
    finally:
        spark.conf.set(key, "true")
    assert {r.rank for r in parts} == {1} and all(r.place == r.id + 1 for r in parts)
