"""Intervals that hold points, and changes between deliveries, against loops."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import differences, intervals

START = datetime(2024, 1, 1)
POINTS = "p_id long, k string, t timestamp_ntz"
SPANS = "s_id long, sk string, low timestamp_ntz, high timestamp_ntz"


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def made(spark):
    """Half of the rows under one key; spans of no time, a microsecond, up to all time,
    turned round, without key, start or end; repeated rows."""
    rng = random.Random(5)

    def key():
        return rng.choice(["hot"] * 5 + ["a", "b", "lone", None])

    points = [(n, key(), at(rng.choice([None] + [rng.randrange(-50, 5000)] * 20))) for n in range(300)]
    points += points[:12]
    spans = []
    for n in range(250):
        low = rng.randrange(-100, 5000)
        length = rng.choice([0, 1e-6, 1, 3, 4, 16, 64, 300, 20_000, -5])
        spans.append((n, key(), at(low), at(low + length)))
    spans += [(900, "hot", None, at(9)), (901, "hot", at(9), None), *spans[:9]]
    return points, spans, spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)


def pairs_of(points, spans):
    return [
        (*p, s[0])
        for p in points
        for s in spans
        if None not in (p[1], p[2], s[2], s[3]) and p[1] == s[1] and s[2] <= p[2] < s[3]
    ]


KEYS = (("k", "sk"), "t", ("low", "high"))


def test_every_pair_is_found_once(made):
    points, spans, one, two = made
    expected = pairs_of(points, spans)
    assert len(expected) > 500
    got = intervals.covering(one, two, *KEYS, ["s_id"])
    assert got.columns == ["p_id", "k", "t", "s_id"]
    assert rows_of(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("limit", [10**6, 40, 1])
def test_counts_are_those_of_the_pairs(made, limit):
    points, spans, one, two = made
    seen = Counter(r[:3] for r in pairs_of(set(points), spans))
    expected = sorted(((*p, seen[p]) for p in points), key=repr)
    got = intervals.covered_counts(one, two, *KEYS, "n", limit)
    assert got.columns == ["p_id", "k", "t", "n"]
    assert rows_of(got) == expected


def test_empty_sides(made):
    points, _, one, two = made
    assert intervals.covering(one.limit(0), two, *KEYS, ["s_id"]).count() == 0
    assert intervals.covering(one, two.limit(0), *KEYS, ["s_id"]).count() == 0
    assert intervals.covered_counts(one.limit(0), two, *KEYS, "n").count() == 0
    none = intervals.covered_counts(one, two.limit(0), *KEYS, "n")
    assert rows_of(none) == sorted(((*p, 0) for p in points), key=repr)


def test_long_intervals_are_not_copied(spark):
    """Spans of a second and of a century lie in two buckets each at most."""
    data = [(n, "a", START, START + timedelta(seconds=10**n)) for n in range(10)]
    joined = intervals.covering(
        spark.createDataFrame([(1, "a", START)], POINTS), spark.createDataFrame(data, SPANS), *KEYS, ["s_id"]
    )
    assert joined.count() == 10
    for length in (1, 2, 4, 5, 16, 17, 10**6, 4**11, 4**11 + 1, 3 * 10**15):
        level = F.greatest(F.ceil(F.log(F.lit(float(length))) / F.log(F.lit(4.0))), F.lit(0))
        for low in (0, 7, 10**15 + 3):
            first = intervals._bucket(F.lit(low), level)
            last = intervals._bucket(F.lit(low + length - 1), level)
            assert spark.range(1).select(last - first).first()[0] <= 1, length


ROWS = "k long, name string, x double"


def test_changes_equal_a_loop(spark):
    rng = random.Random(3)
    nan = float("nan")

    def delivery(size):
        made = [
            (rng.choice([None, *range(60)]), rng.choice(["a", "b", None]), rng.choice([1.0, None, 2.0]))
            for _ in range(size)
        ]
        return made + [(500, "same", 1.0)] * 200

    before = delivery(90) + [(700, "n", nan), (701, "x", 1.0), (702, "r", 0.0)]
    after = delivery(80) + [(700, "n", nan), (701, "y", 1.0), (702, "r", -0.0), (500, "same", 1.0)]

    def plain(row):
        return tuple("nan" if v != v else v + 0.0 if isinstance(v, float) else v for v in row)

    old, new = Counter(map(plain, before)), Counter(map(plain, after))
    lost, won = old - new, new - old
    expected = []
    for k in {r[0] for r in lost | won}:
        a = [r for r in lost.elements() if r[0] == k]
        b = [r for r in won.elements() if r[0] == k]
        if len(a) == len(b) == 1:
            expected.append((k, "changed", 1, a[0][1:], b[0][1:]))
        else:
            expected += [(k, "removed", n, r[1:], None) for r, n in lost.items() if r[0] == k]
            expected += [(k, "added", n, None, r[1:]) for r, n in won.items() if r[0] == k]
    got = differences.changes(
        spark.createDataFrame(before, ROWS), spark.createDataFrame(after, ROWS).select("x", "k", "name"), ["k"]
    )
    assert got.columns == ["k", "change", "copies", "old", "new"]
    found = [
        (*r[:3], r.old and plain(r.old), r.new and plain(r.new)) for r in got.collect()
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert {r[1] for r in expected} == {"changed", "removed", "added"}
    assert (500, "added", 1, None, ("same", 1.0)) in expected


def test_equal_and_empty_deliveries(spark):
    some = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (None, None, None)], ROWS)
    assert differences.changes(some, some, ["k"]).count() == 0
    gone = differences.changes(some, some.limit(0), ["k"]).select("k", "change", "copies")
    assert rows_of(gone) == [(1, "removed", 2), (None, "removed", 1)]
    assert differences.changes(some.limit(0), some.limit(0), ["k"]).count() == 0
