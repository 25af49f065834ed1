"""Distinct values for every combination of some columns and their subtotals."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def _totals(by: Sequence[str]) -> list[Column]:
    return [F.grouping(c).cast("boolean").alias(f"all_{c}") for c in by]


def distinct_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """How many different values each cell of the cube over ``by`` holds, exactly.

    One row per cell and subtotal: the ``by`` columns, ``all_<column>`` (true where
    the row is over all its values, which tells a subtotal from a null) and
    ``n_distinct`` (long). Nulls are no values but do make cells; an empty table has
    no rows. No column of ``df`` may begin with ``all_`` or be called n_distinct.

    Distinct counts do not add up over cells, but sets do: each task marks the values
    of a finest cell as bits, 32,768 neighbouring values to a bitmap, and subtotals
    are unions of finest bitmaps, counted last. The table's rows are shuffled as
    bitmaps once, not once for each subtotal, and a hot cell is a few bitmaps per task.
    ``value`` must be an integer and should be dense, like most surrogate keys: a
    bitmap takes 4 KB for one value or all of its own.
    """
    if not isinstance(df.schema[value].dataType, IntegralType):
        raise TypeError(f"{value} is not an integer; number its values first")
    by = list(by)
    number = F.col(value).cast("long")
    bits = (
        df.select(
            *by,
            F.bitmap_bucket_number(number).alias("_bucket"),
            F.bitmap_bit_position(number).alias("_bit"),
        )
        .groupBy(*by, "_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    sets = [[*s, "_bucket"] for k in range(len(by) + 1) for s in combinations(by, k)]
    unions = bits.groupingSets(
        [[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*by, "_bucket"]]
    ).agg(*_totals(by), F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
    flags = [f"all_{c}" for c in by]
    return unions.groupBy(*by, *flags).agg(F.sum("_n").alias("n_distinct"))


def estimated_distinct_counts(
    df: DataFrame, by: Sequence[str], value: str, log2_slots: int = 14
) -> DataFrame:
    """As ``distinct_counts`` for integers, texts or binaries however sparse, but
    estimated: the relative error is 1.04 / sqrt(2 ** ``log2_slots``) (0.8 %) by the
    sketch's design. One sketch per finest cell, merged into each subtotal."""
    by = list(by)
    finest = df.groupBy(*by).agg(F.hll_sketch_agg(value, log2_slots).alias("_sketch"))
    return finest.cube(*by).agg(
        *_totals(by),
        F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias("n_distinct"),
    )
