"""Rows in time: latest earlier rows, intervals, sessions, changes, places in a whole table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.money import cents
from tallyloom.operators.asof import as_of
from tallyloom.operators.differences import changes
from tallyloom.operators.intervals import covered_counts, covering
from tallyloom.operators.ranking import with_global_order
from tallyloom.operators.sessions import with_sessions
from tallyloom.plans.query import Query
from tallyloom.sources.tables import read_table

# Hours without an event after which a user's next one begins a session.
GAP_HOURS = 12


def event_last_order(spark: SparkSession, root: str) -> DataFrame:
    """Every event with the user's latest order at its time or before."""
    orders = read_table(spark, root, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return as_of(
        read_table(spark, root, "events").select("event_id", "user_id", "ts"),
        orders,
        on=("user_id", "o_custkey"),
        times=("ts", "o_orderdate"),
        carry=["o_orderkey", "o_totalprice"],
    ).select("event_id", "user_id", "o_orderkey", "o_totalprice")


EVENT_LAST_ORDER_SQL = """
SELECT event_id, user_id, o_orderkey, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                                   ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS nth
      FROM events LEFT JOIN orders ON o_custkey = user_id AND o_orderdate <= ts)
WHERE nth = 1
"""


def purchase_last_view(spark: SparkSession, root: str) -> DataFrame:
    """Every purchase with the user's latest view before it."""
    events = read_table(spark, root, "events")
    views = events.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"),
        F.col("user_id").alias("view_user"),
        F.col("ts").alias("view_ts"),
        F.col("value").alias("view_value"),
    )
    return as_of(
        events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value"),
        views,
        on=("user_id", "view_user"),
        times=("ts", "view_ts"),
        carry=["view_id", "view_ts", "view_value"],
        strict=True,
    )


PURCHASE_LAST_VIEW_SQL = """
SELECT event_id, user_id, CAST(ts AS VARCHAR) AS ts, value, view_id,
       CAST(view_ts AS VARCHAR) AS view_ts, view_value
FROM (SELECT p.event_id, p.user_id, p.ts, p.value, v.event_id AS view_id, v.ts AS view_ts,
             v.value AS view_value,
             row_number() OVER (PARTITION BY p.event_id
                                ORDER BY v.ts DESC NULLS LAST, v.event_id DESC) AS nth
      FROM (SELECT * FROM events WHERE event_type = 'purchase') p
      LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
        ON v.user_id = p.user_id AND v.ts < p.ts)
WHERE nth = 1
"""


def user_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Sessions of every user: first and last event, number of events, and value."""
    gap = F.make_dt_interval(hours=F.lit(GAP_HOURS))
    events = read_table(spark, root, "events").withColumn("cents", cents("value"))
    numbered = with_sessions(events, "user_id", "ts", gap)
    return numbered.groupBy("user_id", "session").agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"),
        (F.sum("cents") * F.lit(Decimal("0.01"))).cast("decimal(38,2)").alias("value"),
    )


USER_SESSIONS_SQL = f"""
WITH marked AS (
    SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL {GAP_HOURS} HOUR
              THEN 1 ELSE 0 END AS begins
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), numbered AS (
    SELECT *, CAST(sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session
    FROM marked
)
SELECT user_id, session, CAST(min(ts) AS VARCHAR) AS first_ts, CAST(max(ts) AS VARCHAR) AS last_ts,
       count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value
FROM numbered GROUP BY user_id, session
"""


def order_places(spark: SparkSession, root: str) -> DataFrame:
    """Every order by its place among all by day, latest first, the place of the first of
    its day, and the money of all up to it."""
    orders = read_table(spark, root, "orders")
    placed = with_global_order(
        orders.select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("cents")),
        "o_orderdate",
        ["o_orderkey"],
        F.col("cents"),
        descending=True,
    )
    return placed.select(
        "o_orderkey",
        "place",
        "rank",
        (F.col("running") * F.lit(Decimal("0.01"))).cast("decimal(38,2)").alias("running_total"),
    )


ORDER_PLACES_SQL = """
SELECT o_orderkey, row_number() OVER w AS place, rank() OVER (ORDER BY o_orderdate DESC) AS rank,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE)
           AS running_total
FROM orders WINDOW w AS (ORDER BY o_orderdate DESC, o_orderkey)
"""


def errors_after_purchase(spark: SparkSession, root: str) -> DataFrame:
    """Every error of a user in the hours after a purchase, as many as its value."""
    events = read_table(spark, root, "events")
    minutes = F.floor(F.col("value") * 60).cast("int")
    purchases = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"),
        F.col("user_id").alias("buyer"),
        F.col("ts").alias("from_ts"),
        (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("until_ts"),
    )
    return covering(
        events.where("event_type = 'error'").select("event_id", "user_id", "ts"),
        purchases,
        on=("user_id", "buyer"),
        time="ts",
        span=("from_ts", "until_ts"),
        carry=["purchase_id", "from_ts", "until_ts"],
    )


ERRORS_AFTER_PURCHASE_SQL = """
WITH purchases AS (
    SELECT event_id AS purchase_id, user_id, ts AS from_ts,
           ts + to_minutes(CAST(floor(value * 60) AS BIGINT)) AS until_ts
    FROM events WHERE event_type = 'purchase'
)
SELECT e.event_id, e.user_id, CAST(e.ts AS VARCHAR) AS ts, purchase_id,
       CAST(from_ts AS VARCHAR) AS from_ts, CAST(until_ts AS VARCHAR) AS until_ts
FROM events e JOIN purchases p ON p.user_id = e.user_id AND from_ts <= e.ts AND e.ts < until_ts
WHERE e.event_type = 'error'
"""


def order_open_lines(spark: SparkSession, root: str) -> DataFrame:
    """Every order with the number of its customer's lines that are ordered by then, its
    own among them, and not yet shipped."""
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = read_table(spark, root, "lineitem").select("l_orderkey", "l_shipdate")
    ordered = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where(
        "l_shipdate > o_orderdate"
    )
    return covered_counts(
        orders,
        ordered,
        on=("o_custkey", "o_custkey"),
        time="o_orderdate",
        span=("o_orderdate", "l_shipdate"),
        name="n_open",
    ).select("o_orderkey", "o_custkey", "n_open")


ORDER_OPEN_LINES_SQL = """
WITH spans AS (
    SELECT o_custkey AS c, o_orderdate AS opened, l_shipdate AS shipped
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate > o_orderdate
)
SELECT o_orderkey, o_custkey, count(opened) AS n_open
FROM orders LEFT JOIN spans ON c = o_custkey AND opened <= o_orderdate AND o_orderdate < shipped
GROUP BY o_orderkey, o_custkey
"""


def order_mix_changes(spark: SparkSession, root: str) -> DataFrame:
    """What customers ordered by priority in 1996 against 1997, order by order."""
    orders = read_table(spark, root, "orders")

    def year(number: int) -> DataFrame:
        return orders.where(F.year("o_orderdate") == number).select(
            "o_custkey", "o_orderpriority", "o_orderstatus"
        )

    found = changes(year(1996), year(1997), ["o_custkey", "o_orderpriority"])
    return found.select(
        "o_custkey",
        "o_orderpriority",
        "change",
        "copies",
        F.col("old.o_orderstatus").alias("old_status"),
        F.col("new.o_orderstatus").alias("new_status"),
    )


ORDER_MIX_CHANGES_SQL = """
WITH before AS (
    SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE year(o_orderdate) = 1996
), after AS (
    SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE year(o_orderdate) = 1997
), lost AS (
    SELECT * FROM before EXCEPT ALL SELECT * FROM after
), won AS (
    SELECT * FROM after EXCEPT ALL SELECT * FROM before
), pairs AS (
    SELECT o_custkey, o_orderpriority, any_value(l.o_orderstatus) AS old_status,
           any_value(w.o_orderstatus) AS new_status
    FROM lost l JOIN won w USING (o_custkey, o_orderpriority)
    GROUP BY o_custkey, o_orderpriority HAVING count(*) = 1
), rest AS (
    SELECT *, 'removed' AS change FROM lost UNION ALL SELECT *, 'added' FROM won
)
SELECT o_custkey, o_orderpriority, 'changed' AS change, CAST(1 AS BIGINT) AS copies,
       old_status, new_status
FROM pairs
UNION ALL
SELECT o_custkey, o_orderpriority, change, count(*),
       CASE WHEN change = 'removed' THEN o_orderstatus END,
       CASE WHEN change = 'added' THEN o_orderstatus END
FROM rest ANTI JOIN pairs USING (o_custkey, o_orderpriority)
GROUP BY o_custkey, o_orderpriority, change, o_orderstatus
"""

QUERIES: dict[str, Query] = {
    "event_last_order": Query(event_last_order, EVENT_LAST_ORDER_SQL),
    "purchase_last_view": Query(purchase_last_view, PURCHASE_LAST_VIEW_SQL),
    "user_sessions": Query(user_sessions, USER_SESSIONS_SQL),
    "order_places": Query(order_places, ORDER_PLACES_SQL),
    "errors_after_purchase": Query(errors_after_purchase, ERRORS_AFTER_PURCHASE_SQL),
    "order_open_lines": Query(order_open_lines, ORDER_OPEN_LINES_SQL),
    "order_mix_changes": Query(order_mix_changes, ORDER_MIX_CHANGES_SQL),
}
