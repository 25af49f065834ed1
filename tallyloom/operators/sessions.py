"""Rows of a key divided where a time without rows lies between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.slices import SLICE, carried_on, with_carry, with_slices


def with_sessions(
    df: DataFrame, key: str, time: str, gap: Column, session: str = "session", rows: int | None = None
) -> DataFrame:
    """``df`` with the number of each row's session within its key, from 1: a session
    ends where the next row of the key comes more than ``gap`` (an interval) later.

    Rows of the same time are in one session; repeated rows stay apart. Rows without
    key or time are in none: their number is null. Columns are kept; ``session`` must
    not be one of them.

    A key of very many rows is divided by time. Whether a slice begins a session follows
    from the last time before it, and its sessions are counted on from those of the
    slices before it; both come from one row per slice.
    """
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    sliced, divided = with_slices(df.where(known), key, time, rows)
    within = Window.partitionBy(key, SLICE).orderBy(time)
    before = F.lag(time).over(within)
    if divided:
        ends = sliced.groupBy(key, SLICE).agg(F.max(time).alias("_last"))
        sliced = with_carry(sliced, key, carried_on(ends, key, F.last("_last", ignorenulls=True)))
        before = F.coalesce(before, F.col("_carry"))
    sliced = sliced.withColumn("_before", before)
    begins = F.col("_before").isNull() | (F.col(time) > F.col("_before") + gap)
    sliced = sliced.withColumn("_begins", begins.cast("int")).drop("_before", "_carry")
    # Rows of the same time come together: only the first of them can begin a session.
    number = F.sum("_begins").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if divided:
        begun = sliced.groupBy(key, SLICE).agg(F.sum("_begins").alias("_begun"))
        numbered = sliced.withColumn("_number", number)
        numbered = with_carry(numbered, key, carried_on(begun, key, F.sum("_begun")))
        out = numbered.withColumn(session, F.col("_number") + F.coalesce("_carry", F.lit(0)))
    else:
        out = sliced.withColumn(session, number)
    out = out.select(*df.columns, F.col(session).cast("long").alias(session))
    return out.unionByName(df.where(~known).withColumn(session, F.lit(None).cast("long")))
