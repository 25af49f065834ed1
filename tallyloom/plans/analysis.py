"""Profiles, outliers, correlation, distribution, trends, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.money import cents, total_cents
from tallyloom.operators import profile, ranking, trends
from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.plans.query import Query
from tallyloom.sources.tables import read_table

# The rows and columns of the cross-tabulation.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def value_profile(spark: SparkSession, root: str) -> DataFrame:
    events = read_table(spark, root, "events")
    return _rounded(profile.profile(events, "value"), "mean", "sd", "p25", "p50", "p75")


_PROFILE_SQL = """count(value) AS n, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS sd, min(value) AS min, max(value) AS max,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75"""

VALUE_PROFILE_SQL = f"SELECT {_PROFILE_SQL} FROM events"


def value_profile_by_type(spark: SparkSession, root: str) -> DataFrame:
    events = read_table(spark, root, "events")
    by_type = profile.group_profile(events, "value", ["event_type"])
    return _rounded(by_type, "mean", "sd", "p25", "p50", "p75")


VALUE_PROFILE_BY_TYPE_SQL = f"SELECT event_type, {_PROFILE_SQL} FROM events GROUP BY 1"


def value_quartiles_narrowed(spark: SparkSession, root: str) -> DataFrame:
    """Quartiles by type with room for few values: ranks are narrowed, as they are
    in groups too large to be buffered."""
    events = read_table(spark, root, "events")
    narrowed = exact_quantiles(events, "value", profile.QUARTILES, ["event_type"], limit=10)
    return _rounded(narrowed, "p25", "p50", "p75")


VALUE_QUARTILES_NARROWED_SQL = """
SELECT event_type, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75
FROM events GROUP BY 1
"""


def value_profile_by_user(spark: SparkSession, root: str) -> DataFrame:
    """As by type, over a key whose number of values grows with the data."""
    events = read_table(spark, root, "events")
    by_user = profile.group_profile(events, "value", ["user_id"])
    return _rounded(by_user, "mean", "sd", "p25", "p50", "p75")


VALUE_PROFILE_BY_USER_SQL = f"SELECT user_id, {_PROFILE_SQL} FROM events GROUP BY 1"


def line_profiles(spark: SparkSession, root: str) -> DataFrame:
    per_column = profile.column_profiles(read_table(spark, root, "lineitem"), MEASURES)
    return _rounded(per_column, "mean", "sd", "p25", "p50", "p75")


LINE_PROFILES_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {_PROFILE_SQL.replace('value', c)} FROM lineitem" for c in MEASURES
)


def value_outliers(spark: SparkSession, root: str) -> DataFrame:
    events = read_table(spark, root, "events")
    return profile.outliers(events, "value").select("event_id", "event_type", "value")


VALUE_OUTLIERS_SQL = """
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT event_id, event_type, value FROM events, q
WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)
"""


def line_correlations(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(profile.correlations(read_table(spark, root, "lineitem"), MEASURES), "r")


LINE_CORRELATIONS_SQL = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(MEASURES)
    for b in MEASURES[i + 1 :]
)


def value_histogram(spark: SparkSession, root: str) -> DataFrame:
    return profile.histogram(read_table(spark, root, "events"), "value", 25.0, ["event_type"])


VALUE_HISTOGRAM_SQL = """
SELECT event_type, floor(value / 25.0::DOUBLE) * 25.0::DOUBLE AS low, count(*) AS n
FROM events GROUP BY 1, 2
"""


def priority_by_segment(spark: SparkSession, root: str) -> DataFrame:
    """Orders per priority and customer segment; values not listed count as ``other``.

    Orders reach the join as one row per customer with a count per priority: a
    customer with much of the orders is one row, and the join reuses the
    partitioning by customer.
    """
    orders = read_table(spark, root, "orders")
    customer = read_table(spark, root, "customer")
    is_priority = {p: F.col("o_orderpriority") == p for p in PRIORITIES}
    is_priority["other"] = ~F.coalesce(F.col("o_orderpriority").isin(PRIORITIES), F.lit(False))
    per_customer = orders.groupBy("o_custkey").agg(
        *[F.count_if(c).alias(p) for p, c in is_priority.items()]
    )
    per_segment = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy("c_mktsegment")
        .agg(*[F.sum(f"`{p}`").alias(p) for p in is_priority])
        .unpivot(
            "c_mktsegment", [F.col(f"`{p}`") for p in is_priority], "o_orderpriority", "n"
        )
        .where("n > 0")
    )
    return profile.crosstab(per_segment, "o_orderpriority", "c_mktsegment", SEGMENTS, "n")


PRIORITY_BY_SEGMENT_SQL = f"""
WITH j AS (SELECT c_mktsegment,
             CASE WHEN o_orderpriority IN ({", ".join(f"'{p}'" for p in PRIORITIES)})
                  THEN o_orderpriority ELSE 'other' END AS o_orderpriority
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderpriority,
       {", ".join(f"count(*) FILTER (WHERE c_mktsegment = '{s}') AS {s}" for s in SEGMENTS)},
       count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN
         ({", ".join(f"'{s}'" for s in SEGMENTS)})) AS other
FROM j GROUP BY 1
"""


def monthly_orders(spark: SparkSession, root: str) -> DataFrame:
    months = trends.by_period(
        read_table(spark, root, "orders"),
        "o_orderdate",
        "month",
        {"n": F.count(F.lit(1)), "total": total_cents(cents("o_totalprice"))},
    )
    return trends.with_change(months, "total").withColumnRenamed("period", "month")


MONTHLY_ORDERS_SQL = """
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
                  sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY 1),
     p AS (SELECT *, lag(total) OVER (ORDER BY month) AS previous FROM m)
SELECT CAST(month AS VARCHAR) AS month, n, CAST(total AS DOUBLE) AS total,
       CAST(previous AS DOUBLE) AS previous, CAST(total - previous AS DOUBLE) AS change FROM p
"""


def daily_events(spark: SparkSession, root: str) -> DataFrame:
    days = trends.by_period(
        read_table(spark, root, "events"), "ts", "day", {"n": F.count(F.lit(1))}
    )
    smoothed = trends.with_moving_average(days, "n", 7, "moving_average")
    return _rounded(smoothed, "moving_average").withColumnRenamed("period", "day")


DAILY_EVENTS_SQL = """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, n,
       round(avg(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6)
         AS moving_average FROM d
"""


def top_parts_by_type(spark: SparkSession, root: str) -> DataFrame:
    part = read_table(spark, root, "part").select("p_type", "p_partkey", "p_name", "p_retailprice")
    order = [F.col("p_retailprice").desc(), F.col("p_partkey")]
    top = ranking.top_per_group(part, ["p_type"], order, 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


TOP_PARTS_BY_TYPE_SQL = """
SELECT p_type, p_partkey, p_name, p_retailprice,
       row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank
FROM part QUALIFY rank <= 3
"""


def top_events_by_type(spark: SparkSession, root: str) -> DataFrame:
    events = read_table(spark, root, "events").select("event_type", "event_id", "user_id", "value")
    order = [F.col("value").desc(), F.col("event_id")]
    top = ranking.top_per_group(events, ["event_type"], order, 5)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


TOP_EVENTS_BY_TYPE_SQL = """
SELECT event_type, event_id, user_id, value,
       row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
FROM events QUALIFY rank <= 5
"""

QUERIES = {
    "value_profile": Query(value_profile, VALUE_PROFILE_SQL),
    "value_profile_by_type": Query(value_profile_by_type, VALUE_PROFILE_BY_TYPE_SQL),
    "value_profile_by_user": Query(value_profile_by_user, VALUE_PROFILE_BY_USER_SQL),
    "value_quartiles_narrowed": Query(value_quartiles_narrowed, VALUE_QUARTILES_NARROWED_SQL),
    "line_profiles": Query(line_profiles, LINE_PROFILES_SQL),
    "value_outliers": Query(value_outliers, VALUE_OUTLIERS_SQL),
    "line_correlations": Query(line_correlations, LINE_CORRELATIONS_SQL),
    "value_histogram": Query(value_histogram, VALUE_HISTOGRAM_SQL),
    "priority_by_segment": Query(priority_by_segment, PRIORITY_BY_SEGMENT_SQL),
    "monthly_orders": Query(monthly_orders, MONTHLY_ORDERS_SQL),
    "daily_events": Query(daily_events, DAILY_EVENTS_SQL),
    "top_parts_by_type": Query(top_parts_by_type, TOP_PARTS_BY_TYPE_SQL),
    "top_events_by_type": Query(top_events_by_type, TOP_EVENTS_BY_TYPE_SQL),
}
