"""Totals per calendar period, change against the previous one, moving averages.

The windows here have no partition key. They run over rows already aggregated
to one per calendar period, so the single task sees a few thousand rows at any
data size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_period(df: DataFrame, ts: str, unit: str, measures: Mapping[str, Column]) -> DataFrame:
    """``measures`` per day, month or year of ``ts``; the period is its first day."""
    period = F.trunc(F.col(ts).cast("date"), unit) if unit != "day" else F.col(ts).cast("date")
    return df.groupBy(period.alias("period")).agg(*[m.alias(n) for n, m in measures.items()])


def with_change(periods: DataFrame, measure: str) -> DataFrame:
    """Add the previous period's value and the difference from it."""
    before = F.lag(measure).over(Window.orderBy("period"))
    return periods.withColumn("previous", before).withColumn(
        "change", F.col(measure) - F.col("previous")
    )


def with_moving_average(periods: DataFrame, measure: str, rows: int, name: str) -> DataFrame:
    """Add the mean of this and the ``rows - 1`` periods before it."""
    window = Window.orderBy("period").rowsBetween(-(rows - 1), Window.currentRow)
    return periods.withColumn(name, F.avg(measure).over(window))
