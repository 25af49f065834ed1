"""Keys with very many rows divided by time, so that no key is one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written

# Rows of a key from which on it is divided, which is also the size of a slice aimed
# at, and the stretches of equal time that a slice is put together from.
ROWS, STRETCHES = 1_000_000, 4_096
SLICE = "_slice"


def micros(time: str) -> Column:
    """A time as a number that grows with it."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def with_slices(
    df: DataFrame, key: str, time: str, rows: int | None = None
) -> tuple[DataFrame, bool]:
    """``df`` with a number ``_slice`` that does not fall as time grows within a key: 0
    for keys of up to ``rows`` rows, and about as many to a slice for others. Rows of
    the same time are in the same slice. Neither column may be null. Also whether any
    key was divided.

    Counts per key, and per stretch of a large key's time, are what is shuffled. Large
    keys are few, so they are looked up in a small table; the rows stay where they are.
    """
    rows = ROWS if rows is None else rows
    counted = df.groupBy(F.col(key).alias("_large")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(micros(time)).alias("_low"), F.max(micros(time)).alias("_high")
    )
    width = F.greatest(F.ceil((F.col("_high") - F.col("_low") + 1) / STRETCHES), F.lit(1))
    large = counted.where(F.col("_n") > rows).select("_large", "_low", width.alias("_width"))
    large = written(large, "large-keys")
    if large.isEmpty():
        return df.withColumn(SLICE, F.lit(0).cast("long")), False
    placed = df.join(large, F.col(key) == F.col("_large"), "left")
    placed = placed.withColumn(
        "_stretch", F.floor((micros(time) - F.col("_low")) / F.col("_width"))
    ).drop("_large", "_low", "_width")
    held = placed.where("_stretch IS NOT NULL").groupBy(
        F.col(key).alias("_of"), F.col("_stretch").alias("_at")
    ).agg(F.count(F.lit(1)).alias("_n"))
    # At most STRETCHES rows a key.
    before = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("_n").over(before), F.lit(0))
    slices = written(held.select("_of", "_at", F.floor(passed / rows).alias(SLICE)), "slices")
    same = (F.col(key) == F.col("_of")) & (F.col("_stretch") == F.col("_at"))
    divided = placed.join(slices, same, "left").select(
        *[placed[c] for c in df.columns], F.coalesce(SLICE, F.lit(0)).cast("long").alias(SLICE)
    )
    return divided, True


def carried_on(per_slice: DataFrame, key: str, value: Column) -> DataFrame:
    """From one row for each key and slice, what a slice takes over from those before
    it: (_carry_key, _carry_slice, _carry), where ``value`` is an aggregate that is put
    over the rows of earlier slices of the key. Slices are few per key. Written, so
    that its size is known."""
    before = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(
        F.col(key).alias("_carry_key"), F.col(SLICE).alias("_carry_slice"), value.over(before).alias("_carry")
    )
    return written(carried.where("_carry IS NOT NULL"), "carried")


def with_carry(df: DataFrame, key: str, carried: DataFrame) -> DataFrame:
    """``df`` with the ``_carry`` of each row's key and slice, or null."""
    same = (F.col(key) == F.col("_carry_key")) & (F.col(SLICE) == F.col("_carry_slice"))
    return df.join(carried, same, "left").drop("_carry_key", "_carry_slice")
