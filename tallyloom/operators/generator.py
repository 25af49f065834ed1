"""Sample tables of any size.

Each function turns a column of ids into the rows of one table. The ids may
come from ``spark.range(n)`` or from a table already there; the same id and
seed give the same row on any cluster.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.draws import choice, draw, hundredths, is_hot, moment, parent_key, whole
from tallyloom.sources.scratch import written

# The domains of the categorical columns.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
LANGS = ["de", "en", "es", "fr"]
WORDS = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "harbor", "inlet", "juniper"]

N_NATIONS = 25
N_BRANDS = 25
N_SOURCES = 20
FIRST_ORDER_DAY, N_ORDER_DAYS = "1995-01-01", 2404
FIRST_EVENT_DAY, N_EVENT_DAYS = "2024-01-01", 30


def regions(spark: SparkSession) -> DataFrame:
    key = F.col("id").cast("int")
    names = F.array(*[F.lit(r) for r in REGIONS])
    return spark.range(len(REGIONS)).select(
        key.alias("r_regionkey"), F.element_at(names, key + 1).alias("r_name")
    )


def nations(spark: SparkSession) -> DataFrame:
    key = F.col("id").cast("int")
    return spark.range(N_NATIONS).select(
        key.alias("n_nationkey"),
        F.concat(F.lit("NATION_"), key).alias("n_name"),
        (key % len(REGIONS)).alias("n_regionkey"),
    )


def _label(prefix: str, row_id: Column) -> Column:
    digits = row_id.cast("string")
    # lpad cuts what is longer than the width asked for.
    width = F.greatest(F.lit(9), F.length(digits))
    return F.concat(F.lit(prefix), F.lpad(digits, width, F.lit("0")))


class Parents(NamedTuple):
    """Keys that rows may refer to: ``n`` of them, ``first`` the smallest. They follow
    one another without gaps unless ``numbered`` holds each (``parent``) with its
    ``place``, from 0, in their order."""

    n: int
    first: int = 0
    numbered: DataFrame | None = None


def parents_of(table: DataFrame, key: str) -> Parents:
    """The distinct keys of a table; nulls are none.

    Keys with gaps are numbered without a window over all of them: they are
    range-partitioned and written, so that their partitions stay what they are,
    then numbered within each partition after all of those before it.
    """
    found = F.col(key).cast("bigint")
    facts = table.agg(
        F.count_distinct(found).alias("n"), F.min(found).alias("low"), F.max(found).alias("high")
    ).first()
    if not facts.n:
        return Parents(0)
    if facts.high - facts.low + 1 == facts.n:
        return Parents(facts.n, facts.low)
    keys = table.select(found.alias("parent")).where("parent IS NOT NULL").distinct()
    ranged = keys.repartitionByRange("parent").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "parent-keys")
    # One row per shuffle partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("parent")) - 1
    numbered = ranged.join(starts, "part").select("parent", (F.col("start") + place).alias("place"))
    return Parents(facts.n, facts.low, written(numbered, "parents"))


def _with_parent(
    rows: DataFrame, column: str, seed: int, parents: Parents | int, hot_share: float = 0.0
) -> DataFrame:
    """``rows`` with a drawn key of ``parents`` (a number n: keys from 0 to n - 1) as
    ``column``, null if there are none; ``hot_share`` of the rows take the first."""
    if isinstance(parents, int):
        parents = Parents(parents)
    i = F.col("id")
    if not parents.n:
        return rows.withColumn(column, F.lit(None).cast("bigint"))
    if parents.numbered is None:
        drawn = parent_key(seed, column, i, parents.n, hot_share)
        return rows.withColumn(column, F.lit(parents.first) + drawn)
    # Hot rows draw a place like all others, so no place is hot in the join.
    placed = rows.withColumn("_place", parent_key(seed, column, i, parents.n))
    key = F.col("parent")
    if hot_share:
        key = F.when(is_hot(seed, column, i, hot_share), F.lit(parents.first)).otherwise(key)
    joined = placed.join(parents.numbered, F.col("_place") == F.col("place"))
    return joined.select(*rows.columns, key.alias(column))


def customers(ids: DataFrame, seed: int) -> DataFrame:
    i = F.col("id")
    return ids.select(
        i.alias("c_custkey"),
        _label("Customer#", i).alias("c_name"),
        whole(seed, "c_nationkey", i, 0, N_NATIONS - 1).cast("int").alias("c_nationkey"),
        hundredths(seed, "c_acctbal", i, -99_999, 999_999).alias("c_acctbal"),
        choice(seed, "c_mktsegment", i, SEGMENTS).alias("c_mktsegment"),
    )


def suppliers(ids: DataFrame, seed: int) -> DataFrame:
    i = F.col("id")
    return ids.select(
        i.alias("s_suppkey"),
        _label("Supplier#", i).alias("s_name"),
        whole(seed, "s_nationkey", i, 0, N_NATIONS - 1).cast("int").alias("s_nationkey"),
        hundredths(seed, "s_acctbal", i, -99_999, 999_999).alias("s_acctbal"),
    )


def parts(ids: DataFrame, seed: int) -> DataFrame:
    i = F.col("id")
    return ids.select(
        i.alias("p_partkey"),
        F.concat_ws(" ", choice(seed, "p_name/1", i, WORDS), choice(seed, "p_name/2", i, WORDS)).alias(
            "p_name"
        ),
        F.concat(F.lit("Brand#"), whole(seed, "p_brand", i, 1, N_BRANDS)).alias("p_brand"),
        choice(seed, "p_type", i, TYPES).alias("p_type"),
        whole(seed, "p_size", i, 1, 50).cast("int").alias("p_size"),
        hundredths(seed, "p_retailprice", i, 90_000, 99_990).alias("p_retailprice"),
    )


def orders(
    ids: DataFrame, seed: int, customers: Parents | int, hot_share: float = 0.0
) -> DataFrame:
    """``hot_share`` of the orders go to the first customer."""
    i = F.col("id")
    return _with_parent(ids, "o_custkey", seed, customers, hot_share).select(
        i.alias("o_orderkey"),
        "o_custkey",
        choice(seed, "o_orderstatus", i, STATUSES).alias("o_orderstatus"),
        hundredths(seed, "o_totalprice", i, 100_000, 49_999_999).alias("o_totalprice"),
        moment(seed, "o_orderdate", i, FIRST_ORDER_DAY, N_ORDER_DAYS).alias("o_orderdate"),
        choice(seed, "o_orderpriority", i, PRIORITIES).alias("o_orderpriority"),
    )


def lines(
    ids: DataFrame,
    seed: int,
    orders: Parents | int,
    parts: Parents | int,
    suppliers: Parents | int,
    hot_share: float = 0.0,
) -> DataFrame:
    """``hot_share`` of the lines go to the first part."""
    i = F.col("id")
    quantity = whole(seed, "l_quantity", i, 1, 50)
    rows = _with_parent(ids, "l_orderkey", seed, orders)
    rows = _with_parent(rows, "l_partkey", seed, parts, hot_share)
    rows = _with_parent(rows, "l_suppkey", seed, suppliers)
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        whole(seed, "l_linenumber", i, 1, 7).cast("int").alias("l_linenumber"),
        quantity.cast("double").alias("l_quantity"),
        hundredths(seed, "l_extendedprice", i, 90_000, 10_500_000).alias("l_extendedprice"),
        hundredths(seed, "l_discount", i, 0, 10).alias("l_discount"),
        hundredths(seed, "l_tax", i, 0, 8).alias("l_tax"),
        choice(seed, "l_returnflag", i, RETURN_FLAGS).alias("l_returnflag"),
        choice(seed, "l_linestatus", i, LINE_STATUSES).alias("l_linestatus"),
        moment(seed, "l_shipdate", i, FIRST_ORDER_DAY, N_ORDER_DAYS + 95).alias("l_shipdate"),
    )


def events(
    ids: DataFrame, seed: int, users: Parents | int, hot_share: float = 0.0
) -> DataFrame:
    """``hot_share`` of the events belong to the first user."""
    i = F.col("id")
    day = moment(seed, "ts", i, FIRST_EVENT_DAY, N_EVENT_DAYS)
    second = whole(seed, "ts/second", i, 0, 86_399)
    # The fourth power of a draw: most values small, some far outside the quartiles.
    step = whole(seed, "value", i, 0, 22_000)
    square = (step * step / 10_000).cast("bigint")
    cents = (square * square / 48_400).cast("bigint")
    return _with_parent(ids, "user_id", seed, users, hot_share).select(
        i.alias("event_id"),
        (day + F.make_dt_interval(secs=second)).alias("ts"),
        "user_id",
        choice(seed, "event_type", i, EVENT_TYPES).alias("event_type"),
        (cents.cast("double") / 100.0).alias("value"),
        F.format_string('{"k": %d}', whole(seed, "props", i, 0, 99)).alias("props"),
    )


def documents(ids: DataFrame, seed: int, copy_share: float = 0.1) -> DataFrame:
    """``copy_share`` of the texts are the same text, in varying case and spacing."""
    i = F.col("id")
    is_copy = draw(seed, "text/copy", i) % 1_000_000 < round(copy_share * 1_000_000)
    # A copy draws its words as row 0 does.
    origin = F.when(is_copy, F.lit(0).cast("bigint")).otherwise(i)
    words = [choice(seed, f"text/{n}", origin, WORDS) for n in range(8)]
    own = F.concat(F.concat_ws(" ", *words), F.lit(" "), origin.cast("string"))
    style = draw(seed, "text/style", i) % 3
    text = F.when(style == 0, F.upper(own)).when(style == 1, F.concat(own, F.lit("  "))).otherwise(own)
    return ids.select(i.alias("doc_id"), text.alias("text")).select(
        "doc_id",
        "text",
        choice(seed, "lang", F.col("doc_id"), LANGS).alias("lang"),
        F.concat(F.lit("source"), whole(seed, "source", F.col("doc_id"), 0, N_SOURCES - 1)).alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
