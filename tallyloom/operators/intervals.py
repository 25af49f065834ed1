"""Points in time and the intervals of the same key that they lie in.

An interval holds its start and not its end. One without key, start or end, or that
does not end after its start, holds nothing; a point without key or time lies in none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.slices import SLICE, carried_on, micros, with_carry, with_slices
from tallyloom.sources.scratch import written

# Each level's buckets are this many times as wide as the level's before: 2 ** BITS.
BITS = 2


def _held(intervals: DataFrame, on: str, span: tuple[str, str]) -> DataFrame:
    start, end = span
    return intervals.where(F.col(on).isNotNull() & (F.col(end) > F.col(start)))


def _bucket(time: Column, level: Column) -> Column:
    """The bucket of a time in microseconds, at a level's width."""
    return F.floor(time / F.pow(F.lit(2.0), BITS * level))


def covering(
    points: DataFrame,
    intervals: DataFrame,
    on: tuple[str, str],
    time: str,
    span: tuple[str, str],
    carry: Sequence[str],
) -> DataFrame:
    """One row for each point and each interval that holds it: the columns of ``points``
    and the ``carry`` columns of ``intervals``, whose names must not be in ``points``.

    ``on`` names the key of points and intervals, ``time`` the time of points, ``span``
    the start and end of intervals. Repeated rows on either side pair each on its own.

    An interval goes to the level whose buckets are as wide as it is long or up to four
    times as wide, so it lies in two buckets at most; a point goes to its one bucket of each level that
    occurs. So a pair meets once or never, long intervals are not copied into many
    buckets, and rows meet no more than a few times as many as they match. A hot key is
    divided by its buckets; a hot bucket is a skewed partition of an ordinary equi-join,
    which AQE splits. At most 30 level numbers reach the driver.
    """
    start, end = span
    length = micros(end) - micros(start)
    level = F.greatest(F.ceil(F.log(length.cast("double")) / F.log(F.lit(2.0**BITS))), F.lit(0))
    placed = _held(intervals, on[1], span).select(
        F.col(on[1]).alias("_of"),
        micros(start).alias("_start"),
        micros(end).alias("_end"),
        level.cast("int").alias("_level"),
        F.struct(*carry).alias("_carried"),
    )
    placed = written(placed, "intervals")
    levels = sorted(r[0] for r in placed.select("_level").distinct().collect())
    buckets = F.sequence(
        _bucket(F.col("_start"), F.col("_level")), _bucket(F.col("_end") - 1, F.col("_level"))
    )
    placed = placed.withColumn("_bucket", F.explode(buckets))
    listed = F.array(*[F.lit(n) for n in levels]).cast("array<int>")
    asked = points.where(F.col(on[0]).isNotNull() & F.col(time).isNotNull()).select(
        F.struct(*points.columns).alias("_point"),
        F.col(on[0]).alias("_key"),
        micros(time).alias("_time"),
        F.explode(listed).alias("_at"),
    )
    asked = asked.withColumn("_place", _bucket(F.col("_time"), F.col("_at")))
    meets = (
        (F.col("_key") == F.col("_of"))
        & (F.col("_at") == F.col("_level"))
        & (F.col("_place") == F.col("_bucket"))
    )
    inside = (F.col("_start") <= F.col("_time")) & (F.col("_time") < F.col("_end"))
    return asked.join(placed, meets & inside).select("_point.*", "_carried.*")


def covered_counts(
    points: DataFrame,
    intervals: DataFrame,
    on: tuple[str, str],
    time: str,
    span: tuple[str, str],
    name: str,
    rows: int | None = None,
) -> DataFrame:
    """All rows and columns of ``points`` with ``name``, the number of intervals that
    hold each; 0 for points without key or time. Arguments as in ``covering``.

    No pair is formed: a start counts one, an end takes one off, and a point sees the
    sum of its key so far. A key of very many rows is divided by time
    (``slices.with_slices``), and the sum of each slice is carried on.
    """
    known = F.col(on[0]).isNotNull() & F.col(time).isNotNull()
    nothing = F.lit(None).cast(points.select(F.struct(*points.columns)).schema[0].dataType)
    asked = points.where(known).select(
        F.col(on[0]).alias("_key"),
        F.col(time).alias("_time"),
        F.lit(0).alias("_step"),
        F.struct(*points.columns).alias("_point"),
    )
    steps = _held(intervals, on[1], span).select(
        F.col(on[1]).alias("_key"),
        F.explode(
            F.array(
                F.struct(F.col(span[0]).alias("_time"), F.lit(1).alias("_step")),
                F.struct(F.col(span[1]).alias("_time"), F.lit(-1).alias("_step")),
            )
        ).alias("_edge"),
    ).select("_key", "_edge.*", nothing.alias("_point"))
    both, divided = with_slices(asked.unionByName(steps), "_key", "_time", rows)
    # Starts and ends at a point's time come before it.
    until = (
        Window.partitionBy("_key", SLICE)
        .orderBy("_time", F.col("_point").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = both.withColumn(name, F.sum("_step").over(until))
    if divided:
        ends = both.groupBy("_key", SLICE).agg(F.sum("_step").alias("_sum"))
        summed = with_carry(summed, "_key", carried_on(ends, "_key", F.sum("_sum")))
        summed = summed.withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0)))
    found = summed.where("_point IS NOT NULL").select("_point.*", F.col(name).cast("long").alias(name))
    return found.unionByName(points.where(~known).withColumn(name, F.lit(0).cast("long")))
