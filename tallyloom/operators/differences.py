"""What changed between two deliveries of a table, copies counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written


def row_balance(before: DataFrame, after: DataFrame, balance: str = "balance") -> DataFrame:
    """Each different row that the deliveries do not hold equally often, with how many
    more times ``after`` holds it (negative: fewer). Nulls are equal to nulls, NaN to
    NaN, and 0.0 to -0.0. Both have the same columns, in any order; ``balance`` is none
    of them.

    One shuffle of both, folded in each task first: a row that a third of a delivery
    repeats is one row per task.
    """
    signed = before.withColumn(balance, F.lit(-1).cast("long")).unionByName(
        after.withColumn(balance, F.lit(1).cast("long"))
    )
    folded = signed.groupBy(*before.columns).agg(F.sum(balance).alias(balance))
    return folded.where(F.col(balance) != 0)


def changes(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``key`` columns, change, copies, old and new (structs of the other columns).

    After equal rows are taken off against each other, copy by copy: if one row of a key
    is left on either side, the key is ``changed``, from old to new. Otherwise each
    different row left is ``removed`` (old, no new) or ``added``, with its number of
    copies, since nothing says which became which. Null keys are keys.

    Rows that did not change go no further than the first shuffle. Of a key only sums
    and one row of each side are held together, whatever the number of its rows.
    """
    others = [c for c in before.columns if c not in key]
    left = written(row_balance(before, after, "_n"), "differences")
    row = F.struct(*others)
    lost, won = F.greatest(-F.col("_n"), F.lit(0)), F.greatest(F.col("_n"), F.lit(0))
    per_key = left.groupBy(*key).agg(
        F.sum(lost).alias("_lost"),
        F.sum(won).alias("_won"),
        F.first(F.when(F.col("_n") < 0, row), ignorenulls=True).alias("old"),
        F.first(F.when(F.col("_n") > 0, row), ignorenulls=True).alias("new"),
    )
    changed = written(
        per_key.where("_lost = 1 AND _won = 1").select(
            *key, F.lit("changed").alias("change"), F.lit(1).cast("long").alias("copies"), "old", "new"
        ),
        "changed",
    )
    paired = changed.select(*[F.col(c).alias(f"_key{n}") for n, c in enumerate(key)])
    same = [F.col(c).eqNullSafe(F.col(f"_key{n}")) for n, c in enumerate(key)]
    rest = left.join(paired, same, "left_anti").select(
        *key,
        F.when(F.col("_n") < 0, "removed").otherwise("added").alias("change"),
        F.abs("_n").alias("copies"),
        F.when(F.col("_n") < 0, row).alias("old"),
        F.when(F.col("_n") > 0, row).alias("new"),
    )
    return changed.unionByName(rest)
