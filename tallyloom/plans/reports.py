"""Subtotals, shares, key figures and the report file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.money import cents, revenue_units, total_cents, total_revenue
from tallyloom.operators import reporting, star
from tallyloom.plans.query import Query
from tallyloom.sources import sinks
from tallyloom.sources.scratch import scratch_path
from tallyloom.sources.tables import read_table


def customer_subtotals(spark: SparkSession, root: str) -> DataFrame:
    """Customers and balances per nation, per region and overall.

    Customers are summed to one row per nation before the join, so the rollup
    expands 25 rows rather than the customer table.
    """
    customer, nation, region = (
        read_table(spark, root, t) for t in ("customer", "nation", "region")
    )
    per_nation = customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("c_acctbal")).alias("balance")
    )
    placed = per_nation.join(
        star.places(nation, region), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return reporting.subtotals(
        placed,
        ["r_name", "n_name"],
        [F.sum("n").alias("n"), total_cents(F.col("balance")).alias("balance")],
    )


CUSTOMER_SUBTOTALS_SQL = """
SELECT r_name, n_name,
       CAST(2 - grouping(r_name) - grouping(n_name) AS BIGINT) AS level, count(*) AS n,
       CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
"""


def brand_share(spark: SparkSession, root: str) -> DataFrame:
    """Revenue per brand, its share and rank.

    Lines are summed per part before the join: a part sold in much of the lines
    is one row there.
    """
    lineitem = read_table(spark, root, "lineitem")
    part = read_table(spark, root, "part")
    per_part = lineitem.groupBy("l_partkey").agg(F.sum(revenue_units()).alias("revenue"))
    per_brand = (
        per_part.join(part, per_part.l_partkey == part.p_partkey)
        .groupBy("p_brand")
        .agg(total_revenue(F.col("revenue")).alias("revenue"))
    )
    ranked = reporting.with_share_and_rank(per_brand, "revenue", "p_brand")
    return ranked.withColumn("share", F.round("share", 8))


BRAND_SHARE_SQL = """
WITH b AS (SELECT p_brand, round(sum(CAST(l_extendedprice AS DECIMAL(12,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS revenue
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE), 8) AS share,
       rank() OVER (ORDER BY revenue DESC, p_brand) AS rank FROM b
"""


def key_figures(spark: SparkSession, root: str) -> DataFrame:
    orders, lineitem, events = (read_table(spark, root, t) for t in ("orders", "lineitem", "events"))
    per_user = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "purchase").alias("bought")
    )
    parts = [
        reporting.key_figures(
            orders,
            {
                "orders": F.count(F.lit(1)),
                "order value": total_cents(cents("o_totalprice")),
                "open orders": F.count_if(F.col("o_orderstatus") == "O"),
                "urgent orders": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
            },
        ),
        reporting.key_figures(
            lineitem,
            {
                "order lines": F.count(F.lit(1)),
                "net revenue": total_revenue(revenue_units()),
                "units sold": F.sum(F.col("l_quantity").cast("bigint")),
                "returned lines": F.count_if(F.col("l_returnflag") == "R"),
            },
        ),
        reporting.key_figures(
            per_user,
            {
                "events": F.sum("n"),
                "active users": F.count(F.lit(1)),
                "buying users": F.count_if(F.col("bought") > 0),
            },
        ),
    ]
    return reporting.figure_table(parts)


KEY_FIGURES_SQL = """
SELECT 'orders' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders
UNION ALL SELECT 'order value', CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM orders
UNION ALL SELECT 'open orders', CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) FROM orders
UNION ALL SELECT 'urgent orders', CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE)
  FROM orders
UNION ALL SELECT 'order lines', CAST(count(*) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'net revenue', CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2))
  * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'units sold', CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'returned lines', CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) FROM lineitem
UNION ALL SELECT 'events', CAST(count(*) AS DOUBLE) FROM events
UNION ALL SELECT 'active users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM events
UNION ALL SELECT 'buying users',
  CAST(count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS DOUBLE) FROM events
"""


def report_file(spark: SparkSession, root: str) -> DataFrame:
    """The subtotals written as one CSV file with a header and read back."""
    table = customer_subtotals(spark, root)
    path = scratch_path(spark, "subtotals-csv")
    sinks.write_report(table, path, order=["r_name", "n_name"])
    return spark.read.schema(table.schema).option("header", True).csv(path)


# The tables of the report job, each with the order of its rows.
TABLES = {
    "customer_subtotals": (customer_subtotals, ["r_name", "n_name"]),
    "brand_share": (brand_share, ["rank"]),
    "key_figures": (key_figures, ["metric"]),
}

QUERIES = {
    "customer_subtotals": Query(customer_subtotals, CUSTOMER_SUBTOTALS_SQL),
    "brand_share": Query(brand_share, BRAND_SHARE_SQL),
    "key_figures": Query(key_figures, KEY_FIGURES_SQL),
    "report_file": Query(report_file, CUSTOMER_SUBTOTALS_SQL),
}
