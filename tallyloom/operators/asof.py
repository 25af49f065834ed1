"""Each row with the latest row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.slices import SLICE, carried_on, with_carry, with_slices


def as_of(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    times: tuple[str, str],
    carry: Sequence[str],
    strict: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """All rows and columns of ``left`` with the ``carry`` columns of the row of
    ``right`` that has the same key (``on``: left's and right's) and the latest time
    (``times``) at or before the left row's, or before it if ``strict``; nulls if
    there is none.

    Of right rows of the same time the last in the order of ``carry`` counts, column by
    column, nulls first; columns that must break ties belong to it. Rows of ``right``
    without key or time match nothing; rows of ``left`` without either stay, unmatched.
    Repeated left rows stay apart. Names in ``carry`` must not be in ``left``.

    Both tables become one, ordered by time within a key, and each left row takes the
    last right row before it: no pair of rows is ever formed but those returned. A key
    of very many rows is divided by time (``slices.with_slices``); the last right row
    of each slice is carried on to the slices after it.
    """
    known = F.col(on[0]).isNotNull() & F.col(times[0]).isNotNull()
    one = left.where(known).select(
        F.col(on[0]).alias("_key"),
        F.col(times[0]).alias("_time"),
        F.lit(0 if strict else 1).alias("_side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_left"),
        F.lit(None).cast(right.select(F.struct(*carry)).schema[0].dataType).alias("_right"),
    )
    two = right.where(F.col(on[1]).isNotNull() & F.col(times[1]).isNotNull()).select(
        F.col(on[1]).alias("_key"),
        F.col(times[1]).alias("_time"),
        F.lit(1 if strict else 0).alias("_side"),
        F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_left"),
        F.struct(*carry).alias("_right"),
    )
    both, divided = with_slices(one.unionByName(two), "_key", "_time", rows)
    until = Window.partitionBy("_key", SLICE).orderBy("_time", "_side", "_right").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = both.withColumn("_found", F.last("_right", ignorenulls=True).over(until))
    if divided:
        latest = F.when(F.col("_right").isNotNull(), F.struct("_time", "_right"))
        ends = both.groupBy("_key", SLICE).agg(F.max(latest).alias("_end"))
        edges = carried_on(ends, "_key", F.last(F.col("_end")["_right"], ignorenulls=True))
        found = with_carry(found, "_key", edges).withColumn(
            "_found", F.coalesce("_found", "_carry")
        )
    matched = found.where("_left IS NOT NULL").select(
        "_left.*", *[F.col("_found")[c].alias(c) for c in carry]
    )
    types = {f.name: f.dataType for f in right.schema.fields}
    alone = left.where(~known).select(
        "*", *[F.lit(None).cast(types[c]).alias(c) for c in carry]
    )
    return matched.unionByName(alone)

