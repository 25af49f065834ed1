"""Subtotals, shares and key figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subtotals(df: DataFrame, levels: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """``measures`` per combination of ``levels``, per prefix of it and overall.

    ``level`` tells how many of the columns a row is broken down by.
    """
    depth = sum((1 - F.grouping(c).cast("bigint") for c in levels), F.lit(0).cast("bigint"))
    return df.rollup(*levels).agg(depth.alias("level"), *measures)


def with_share_and_rank(groups: DataFrame, measure: str, tie_break: str) -> DataFrame:
    """Add each group's share of the total and its rank.

    For one row per value of a bounded domain: the windows run in one task.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col(measure).desc(), F.col(tie_break))
    share = F.col(measure).cast("double") / F.sum(measure).over(everything).cast("double")
    return groups.withColumn("share", share).withColumn(
        "rank", F.rank().over(order).cast("bigint")
    )


def key_figures(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    """One row per figure (metric, value); all figures of a table in one scan."""
    wide = df.agg(*[c.cast("double").alias(n) for n, c in figures.items()])
    rows = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in figures]
    )
    return wide.select(F.inline(rows))


def figure_table(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
