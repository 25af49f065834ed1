"""Top rows per group; places, ranks and running totals over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group under ``order``, which must be free of ties.

    A row_number filter plans a WindowGroupLimit below the shuffle: every task
    passes on at most ``k`` rows per group, however large the group.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= k)


def with_global_order(
    df: DataFrame,
    by: str,
    ties: Sequence[str],
    amount: Column | None = None,
    descending: bool = False,
) -> DataFrame:
    """``df`` with three columns over all of its rows in the order of ``by``, nulls last:
    ``place`` (from 1), ``rank`` (that of the first row of equal ``by``) and ``running``,
    the sum of ``amount`` (decimal or whole numbers; null counts as nothing) up to the
    row; null without ``amount``.

    Rows of equal ``by`` are ordered by ``ties``, which should tell them apart; if they do
    not, which of the rows gets which of their places is left open. NaN is the largest
    number. No window goes over the table: rows are range-partitioned by both, so that
    equal values, however many, spread over partitions, which are written to stay what
    they are; each is numbered by itself and moved on by the totals of those before
    it. What meets in one task is one row per partition.
    """
    value = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    order = [value, *ties]
    ranged = df.withColumn("_amount", F.lit(0) if amount is None else F.coalesce(amount, F.lit(0)))
    ranged = ranged.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "in-order")
    within = Window.partitionBy("_part").orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*",
        F.row_number().over(within).alias("_place"),
        F.rank().over(Window.partitionBy("_part").orderBy(value)).alias("_rank"),
        F.sum("_amount").over(so_far).alias("_sum"),
    )
    # One row a partition, as are all that follow until the join.
    ends = written(
        local.groupBy("_part").agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum("_amount").alias("_total"),
            F.min_by(F.struct(by), "_place").alias("_first"),
            F.max_by(F.struct(by), "_place").alias("_last"),
            F.max("_rank").alias("_last_rank"),
        ),
        "partition-ends",
    )
    parts = Window.orderBy("_part")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        "*",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_total").over(before).alias("_total_before"),
        F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(parts)), F.lit(False)).alias("_goes_on"),
    )
    # Where the values that a partition ends with begin: in it, unless they fill it and
    # go on from the one before.
    begun_before = (F.col("_last_rank") == 1) & F.col("_goes_on")
    ends = ends.withColumn(
        "_began", F.when(~begun_before, F.col("_rows_before") + F.col("_last_rank"))
    )
    ends = ends.select(
        F.col("_part").alias("_of"),
        "_rows_before",
        "_total_before",
        F.when(F.col("_goes_on"), F.last("_began", ignorenulls=True).over(before)).alias("_began_before"),
    )
    joined = local.join(written(ends, "partition-starts"), F.col("_part") == F.col("_of"))
    rank = F.when(
        (F.col("_rank") == 1) & F.col("_began_before").isNotNull(), F.col("_began_before")
    ).otherwise(F.col("_rows_before") + F.col("_rank"))
    total = F.coalesce("_total_before", F.lit(0)) + F.col("_sum")
    running = F.lit(None).cast("decimal(38,0)") if amount is None else total
    return joined.select(
        *df.columns,
        (F.col("_rows_before") + F.col("_place")).cast("long").alias("place"),
        rank.cast("long").alias("rank"),
        running.alias("running"),
    )
