"""Distinct counts under all subtotals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.distinct_counts import distinct_counts
from tallyloom.plans.query import Query
from tallyloom.sources.tables import read_table


def active_users_cube(spark: SparkSession, root: str) -> DataFrame:
    """Different users by event type and day, and over all of either."""
    events = read_table(spark, root, "events").select(
        "event_type", F.to_date("ts").cast("string").alias("day"), "user_id"
    )
    return distinct_counts(events, ["event_type", "day"], "user_id")


ACTIVE_USERS_CUBE_SQL = """
SELECT event_type, day, grouping(event_type) = 1 AS all_event_type, grouping(day) = 1 AS all_day,
       count(DISTINCT user_id) AS n_distinct
FROM (SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id FROM events)
GROUP BY CUBE (event_type, day)
"""


def ordering_customers_cube(spark: SparkSession, root: str) -> DataFrame:
    """Different customers by year, priority and status of their orders."""
    orders = read_table(spark, root, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderpriority", "o_orderstatus", "o_custkey"
    )
    return distinct_counts(orders, ["year", "o_orderpriority", "o_orderstatus"], "o_custkey")


ORDERING_CUSTOMERS_CUBE_SQL = """
SELECT year, o_orderpriority, o_orderstatus, grouping(year) = 1 AS all_year,
       grouping(o_orderpriority) = 1 AS all_o_orderpriority,
       grouping(o_orderstatus) = 1 AS all_o_orderstatus, count(DISTINCT o_custkey) AS n_distinct
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
GROUP BY CUBE (year, o_orderpriority, o_orderstatus)
"""

QUERIES: dict[str, Query] = {
    "active_users_cube": Query(active_users_cube, ACTIVE_USERS_CUBE_SQL),
    "ordering_customers_cube": Query(ordering_customers_cube, ORDERING_CUSTOMERS_CUBE_SQL),
}
