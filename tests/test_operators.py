"""Operators against hand-made or brute-force results on small fixtures."""

from __future__ import annotations

import collections
import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import draws, money, text_keys
from tallyloom.operators import duplicates, generator, profile, quality, ranking, reporting, trends
from tallyloom.sources import csv_files, sinks
from tallyloom.sources.tables import read_table, schema_of


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# quality


def test_a_rule_counts_nulls_as_violations(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = {"x positive": F.col("x") > 0, "x set": F.col("x").isNotNull()}
    assert rows(quality.count_violations(df, rules)) == [("x positive", 3, 2), ("x set", 3, 1)]


def test_rules_on_an_empty_table(spark):
    df = spark.createDataFrame([], "x int")
    assert rows(quality.count_violations(df, {"x set": F.col("x").isNotNull()})) == [
        ("x set", 0, 0)
    ]


def test_reject_reason_is_the_first_broken_rule(spark):
    df = spark.createDataFrame([(1, "a"), (-1, ""), (2, ""), (None, "a")], "x int, s string")
    rules = {"x": F.col("x") > 0, "s": F.col("s") != ""}
    got = {(r["x"], r["s"]): r["reject_reason"] for r in quality.with_reject_reason(df, rules).collect()}
    assert got == {(1, "a"): None, (-1, ""): "x", (2, ""): "s", (None, "a"): "x"}


def test_reference_rules(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (3,), (3,)], "pk int")
    got = quality.check_reference(child, "fk", parent, "pk", "a", has_child="b", unique="c")
    # 9, 9 and null have no parent; both 3s have no child; 3 is there twice.
    assert rows(got) == [("a", 6, 3), ("b", 4, 2), ("c", 4, 1)]


def test_reference_to_an_empty_table(spark):
    child = spark.createDataFrame([(1,), (1,)], "fk int")
    parent = spark.createDataFrame([], "pk int")
    got = quality.check_reference(child, "fk", parent, "pk", "a", has_child="b", unique="c")
    assert rows(got) == [("a", 2, 2), ("b", 0, 0), ("c", 0, 0)]


def test_repeats(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 1)], "a int, b int")
    assert rows(quality.count_repeats(df, ["a", "b"], "u")) == [("u", 4, 2)]


# duplicates and text keys


def test_duplicates_against_brute_force(spark, sf001):
    documents = read_table(spark, sf001, "documents")
    texts = collections.defaultdict(list)
    for r in documents.collect():
        texts[r["text"]].append(r["doc_id"])
    expected = sorted((min(ids), len(ids)) for ids in texts.values())
    kept = duplicates.keep_lowest(documents, text_keys.exact_key("text"), "doc_id", ["lang"])
    assert sorted((r["doc_id"], r["n_copies"]) for r in kept.collect()) == expected


def test_folded_key(spark):
    texts = ["Grey  Cat", "grey cat", " GREY\tCAT\n", "greycat", "grey cats"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    kept = duplicates.keep_lowest(df, text_keys.folded_key("t"), "id", ["t"])
    assert rows(kept.select("id", "n_copies")) == [(0, 3), (3, 1), (4, 1)]


def test_kept_row_carries_its_own_columns(spark):
    df = spark.createDataFrame([(2, "x", "late"), (1, "x", "early")], "id int, t string, tag string")
    kept = duplicates.keep_lowest(df, text_keys.exact_key("t"), "id", ["tag"])
    assert rows(kept) == [(1, "early", 2)]


def test_null_texts_are_no_copies(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, ""), (4, "")], "id int, t string")
    kept = duplicates.keep_lowest(df, text_keys.exact_key("t"), "id", ["t"])
    assert rows(kept) == [(1, None, 1), (2, None, 1), (3, "", 2)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_texts_of_rows_without_id_are_kept_once(spark):
    data = [(None, "x", "b"), (None, "x", "a"), (None, "y", "c"), (1, "y", "d"), (None, None, "e")]
    df = spark.createDataFrame(data, "id int, t string, tag string")
    for key in (text_keys.exact_key("t"), text_keys.folded_key("t")):
        kept = duplicates.keep_lowest(df, key, "id", ["t", "tag"], missing=F.col("t").isNull())
        found = sorted(((r.id, r.t, r.tag, r.n_copies) for r in kept.collect()), key=str)
        assert found in (
            [(1, "y", "d", 2), (None, "x", tag, 2), (None, None, "e", 1)] for tag in "ab"
        )


def test_repeated_ids_multiply_nothing(spark):
    data = [(1, "a", "x"), (1, "b", "y"), (2, "c", "z"), (2, "a", "w"), (3, "b", "v"), (1, "a", "u")]
    data += [(None, "c", "n"), (None, "d", "m"), (None, "d", "l"), (1, None, "k"), (1, None, "k")]
    df = spark.createDataFrame(data, "id int, t string, tag string")
    for carry in (["tag"], ["t", "tag"]):
        kept = duplicates.keep_lowest(df, text_keys.exact_key("t"), "id", carry)
        found = sorted(((r.id, r.tag, r.n_copies) for r in kept.collect()), key=str)
        assert found == [
            (1, "k", 1), (1, "k", 1), (1, "u", 3), (1, "y", 2), (2, "z", 2), (None, "l", 2)
        ]


def test_one_row_per_repeated_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert rows(duplicates.one_per_key(df, "k")) == [
        (1, "a"), (2, "c"), (None, "d"), (None, "e")
    ]


NOT_FINITE = [float("nan"), float("inf"), float("-inf")]


def test_numbers_that_are_not_finite(spark):
    df = spark.createDataFrame([(1.0,), (None,), *[(x,) for x in NOT_FINITE]], "x double")
    rules = {"x": quality.finite("x") & (F.col("x") > 0)}
    assert rows(quality.count_violations(df, rules)) == [("x", 5, 4)]
    assert rows(profile.histogram(df, "x", 5)) == [(0.0, 1), (None, 3)]
    assert str(df.agg(money.total_cents(money.cents("x"))).first()[0]) == "1.00"
    assert str(df.agg(money.total_revenue(money.revenue_units("x", "x"))).first()[0]) == "0.00"


# money


def test_money_sums_are_exact(spark):
    # 0.1 added ten million times is off by about 1e-4 as doubles.
    df = spark.range(10_000_000).select(F.lit(0.1).alias("price"), F.lit(0.07).alias("off"))
    total, revenue = df.agg(
        money.total_cents(money.cents("price")),
        money.total_revenue(money.revenue_units("price", "off")),
    ).first()
    assert str(total) == "1000000.00"
    assert str(revenue) == "930000.00"


@pytest.mark.parametrize("value, text", [(-994.28, "-994.28"), (1.1, "1.10"), (0.29, "0.29")])
def test_cents_round_to_the_nearest(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert str(df.agg(money.total_cents(money.cents("x"))).first()[0]) == text


# generator


def test_names_of_large_ids_stay_distinct(spark):
    ids = spark.createDataFrame([(7,), (1_234_567_890_123,)], "id bigint")
    names = [r["c_name"] for r in generator.customers(ids, 1).collect()]
    assert names == ["Customer#000000007", "Customer#1234567890123"]


@pytest.mark.parametrize("hot_share", [0.0, 0.3])
def test_parents_with_gaps_are_drawn_by_place(spark, hot_share):
    keys = sorted([7 * k * k - 1000 for k in range(300)])
    table = spark.createDataFrame([(k,) for k in keys + keys[:9] + [None]], "c int")
    parents = generator.parents_of(table, "c")
    assert (parents.n, parents.first) == (300, -1000)
    numbered = parents.numbered.select("place", "parent").collect()
    assert sorted(map(tuple, numbered)) == list(enumerate(keys))
    ids = spark.range(4000)
    place = draws.parent_key(5, "o_custkey", F.col("id"), 300, hot_share)
    drawn = {r["id"]: keys[r["place"]] for r in ids.select("id", place.alias("place")).collect()}
    made = generator.orders(ids, 5, parents, hot_share).select("o_orderkey", "o_custkey")
    assert dict(map(tuple, made.collect())) == drawn


def test_parents_without_gaps_and_none(spark):
    assert generator.parents_of(spark.range(40, 90), "id") == (50, 40, None)
    ids = spark.range(2000)
    users = {r["user_id"] for r in generator.events(ids, 1, generator.Parents(50, 40)).collect()}
    assert users == set(range(40, 90))
    none = generator.parents_of(spark.createDataFrame([(None,)], "k long"), "k")
    assert {r["user_id"] for r in generator.events(ids, 1, none).collect()} == {None}


def test_parent_keys_stay_in_range(spark):
    n_parents = 3_000_000_000
    keys = spark.range(20_000).select(draws.parent_key(1, "k", F.col("id"), n_parents).alias("k"))
    low, high, n = keys.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first()
    assert 0 <= low < 0.01 * n_parents and 0.99 * n_parents < high < n_parents
    assert n > 19_990


# profile


def test_correlation_of_a_line(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("a"), (5 - 2 * F.col("id")).cast("double").alias("b")
    )
    row = profile.correlations(df, ["a", "b"]).first()
    assert (row["x"], row["y"]) == ("a", "b") and math.isclose(row["r"], -1.0)


def test_histogram_bins(spark):
    df = spark.createDataFrame([(v,) for v in (-0.5, 0.0, 4.9, 5.0, 12.0, None)], "v double")
    assert rows(profile.histogram(df, "v", 5)) == [(-5.0, 1), (0.0, 2), (10.0, 1), (5.0, 1)]


def test_crosstab_keeps_values_not_listed(spark):
    data = [("r", "a", 1), ("r", "b", 2), ("r", None, 4), ("s", "a", 8)]
    df = spark.createDataFrame(data, "row string, col string, n int")
    got = profile.crosstab(df, "row", "col", ["a"], "n")
    assert got.columns == ["row", "a", "other"]
    assert rows(got) == [("r", 1, 6), ("s", 8, 0)]


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 10), 100, -100]], "v double")
    assert rows(profile.outliers(df, "v")) == [(-100.0,), (100.0,)]


def test_group_profile_keeps_the_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, v double")
    got = {r["g"]: (r["n"], r["p50"]) for r in profile.group_profile(df, "v", ["g"]).collect()}
    assert got == {"a": (2, 2.0), None: (1, 5.0)}


# ranking, trends, reporting


def test_top_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1)], "g string, v int")
    assert rows(ranking.top_per_group(df, ["g"], [F.col("v").desc()], 2)) == [
        ("a", 2, 2),
        ("a", 3, 1),
        ("b", 1, 1),
    ]


def test_change_and_moving_average(spark):
    stamps = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-29 12:00:00", "2024-03-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts")
    )
    months = trends.by_period(df, "ts", "month", {"n": F.count(F.lit(1))})
    changed = trends.with_change(months, "n").orderBy("period")
    assert [(str(r[0]), *r[1:]) for r in changed.collect()] == [
        ("2024-01-01", 1, None, None),
        ("2024-02-01", 2, 1, 1),
        ("2024-03-01", 1, 2, -1),
    ]
    averaged = trends.with_moving_average(months, "n", 2, "avg").orderBy("period")
    assert [r["avg"] for r in averaged.collect()] == [1.0, 1.5, 1.5]


def test_subtotals(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "a", 4)], "p string, q string, n int")
    got = reporting.subtotals(df, ["p", "q"], [F.sum("n").alias("n")])
    assert rows(got) == sorted(
        [
            ("x", "a", 2, 1), ("x", "b", 2, 2), ("y", "a", 2, 4),
            ("x", None, 1, 3), ("y", None, 1, 4), (None, None, 0, 7),
        ],
        key=repr,
    )


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "g string, v double")
    got = reporting.with_share_and_rank(df, "v", "g")
    assert rows(got) == [("a", 1.0, 0.25, 2), ("b", 3.0, 0.75, 1)]


# CSV and sinks


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    good = ['1,2,F,10.50,1995-01-01,"5-LOW, really"', "2,2,O,,1995-01-02,5-LOW"]
    bad = ["x,2,F,1.0,1995-01-01,5-LOW", "3,2,F", "4,2,F,1.0,1995-01-01,5-LOW,extra"]
    (tmp_path / "in.csv").write_text("\n".join(good + bad) + "\n")
    table = csv_files.ingest_csv(
        spark, f"{tmp_path}/in.csv", schema_of("orders"), f"{tmp_path}/out"
    )
    kept = csv_files.good_rows(table)
    assert sorted(r["o_orderkey"] for r in kept.select("o_orderkey").collect()) == [1, 2]
    assert kept.where("o_orderkey = 2").first()["o_totalprice"] is None
    assert kept.where("o_orderkey = 1").first()["o_orderpriority"] == "5-LOW, really"
    assert sorted(r[0] for r in csv_files.bad_lines(table).collect()) == sorted(bad)
    assert kept.schema == schema_of("orders")


@pytest.mark.parametrize("gather", [True, False])
def test_only_the_written_partitions_are_replaced(spark, tmp_path, gather):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, 1995), (2, 1996), (3, 1996)], "k int, y int")
    again = spark.createDataFrame([(4, 1996)], "k int, y int")
    sinks.write_partitioned(df, path, "y", gather)
    sinks.write_partitioned(again, path, "y", gather)
    assert rows(spark.read.schema(df.schema).parquet(path)) == [(1, 1995), (4, 1996)]


def test_the_whole_table_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_partitioned(spark.createDataFrame([(1, 1995)], "k int, y int"), path, "y")
    again = spark.createDataFrame([(4, 1996)], "k int, y int")
    sinks.write_partitioned(again, path, "y", whole=True)
    assert rows(spark.read.schema(again.schema).parquet(path)) == [(4, 1996)]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_report_is_one_ordered_file(spark, tmp_path, fmt):
    df = spark.range(1000).repartition(8).select("id", (-F.col("id")).alias("neg"))
    sinks.write_report(df, f"{tmp_path}/r", fmt, order=["neg"])
    (part,) = (tmp_path / "r").glob(f"part-*.{fmt}")
    lines = part.read_text().splitlines()
    if fmt == "csv":
        assert lines.pop(0) == "id,neg"
        assert lines[0] == "999,-999"
    else:
        assert lines[0] == '{"id":999,"neg":-999}'
    assert len(lines) == 1000


def test_unknown_report_format(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_report(spark.range(1), f"{tmp_path}/r", "xml")
