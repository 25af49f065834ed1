"""Joins along the star: order lines to orders, customers, nations and regions.

Nation and region are fixed lists of 25 and 5 rows; Spark broadcasts them by
their file size. No hint is given for tables that grow: Spark broadcasts those
only under its own size threshold and sort-merges beyond it, where AQE splits
the partition of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.money import revenue_units


# Fixed value: the match of a line with nothing missing.
MATCHED = "matched"


def places(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def order_totals(lineitem: DataFrame) -> DataFrame:
    """Revenue units and number of lines per order.

    Lines meet orders as one row per order. The aggregation leaves them
    partitioned by order key, which the join then reuses.
    """
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(revenue_units()).alias("revenue_units"), F.count(F.lit(1)).alias("n")
    )


def enriched_lines(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """The order lines that have an order, customer, place and part, with them."""
    matched = matched_lines(lineitem, orders, customer, part, nation, region)
    return matched.where(F.col("match") == MATCHED).drop("match")


def matched_lines(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """Every order line with its order, customer, part, nation and region as far as
    there are any, and in ``match`` the first of them that is missing.

    Orders, customers and places are joined first: the lines, the largest table
    by far, are then shuffled for two joins rather than three.
    """
    placed_orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        places(nation, region), customer.c_nationkey == F.col("n_nationkey"), "left"
    )
    joined = lineitem.join(
        placed_orders, lineitem.l_orderkey == F.col("o_orderkey"), "left"
    ).join(part, lineitem.l_partkey == part.p_partkey, "left")
    missing = (
        F.when(F.col("o_orderkey").isNull(), "no order")
        .when(F.col("c_custkey").isNull(), "no customer")
        .when(F.col("r_name").isNull(), "no place")
        .when(F.col("p_partkey").isNull(), "no part")
    )
    return joined.withColumn("match", missing.otherwise(MATCHED))
