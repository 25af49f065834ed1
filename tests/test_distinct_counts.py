"""Distinct counts under all subtotals, against loops over sets."""

from __future__ import annotations

import random
from itertools import product

import pytest

from tallyloom.operators.distinct_counts import distinct_counts, estimated_distinct_counts

SCHEMA = "g string, k int, v long"


def counted(rows):
    """For each cell and subtotal, told apart by which columns are over all values."""
    cells = {}
    for g, k, v in rows:
        for all_g, all_k in product((False, True), repeat=2):
            cell = cells.setdefault((None if all_g else g, None if all_k else k, all_g, all_k), set())
            if v is not None:
                cell.add(v)
    return {cell: len(values) for cell, values in cells.items()}


def found(df):
    rows = df.collect()
    out = {(r.g, r.k, r.all_g, r.all_k): r.n_distinct for r in rows}
    assert len(out) == len(rows)
    return out


def test_cells_and_subtotals_equal_sets(spark):
    draw = random.Random(5)
    values = [None, 0, -1, 1, -32_768, 32_767, 32_768, 32_769, -32_769, 10**12, -(10**12)]
    values += list(range(50))
    rows = [
        (draw.choice(["a", "b", "", None]), draw.choice([1, 2, None]), draw.choice(values))
        for _ in range(600)
    ]
    # A hot cell, and one that holds no value at all.
    rows += [("hot", 1, n % 70_000) for n in range(0, 400_000, 37)] + [("none", 2, None)] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(distinct_counts(df, ["g", "k"], "v")) == counted(rows)


def test_estimates_are_near(spark):
    rows = [("a" if n % 3 else None, n % 2, n * 7919) for n in range(30_000)] * 2
    rows.append(("none", 2, None))
    df = spark.createDataFrame(rows, SCHEMA)
    expected = counted(rows)
    got = found(estimated_distinct_counts(df, ["g", "k"], "v"))
    assert got.keys() == expected.keys()
    assert all(abs(got[c] - n) <= 0.04 * n for c, n in expected.items())


def test_empty_tables_and_other_types(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert distinct_counts(df, ["g", "k"], "v").collect() == []
    with pytest.raises(TypeError):
        distinct_counts(df, ["k"], "g")


def test_rows_are_shuffled_as_bitmaps(spark):
    """No row leaves its task but as a bitmap of a finest cell; no row is expanded."""
    df = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    counts = distinct_counts(df, ["g", "k"], "v")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.index("Expand") < plan.index("partial_bitmap_construct_agg")
