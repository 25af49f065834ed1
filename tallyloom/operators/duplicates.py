"""Removal of rows that repeat an earlier row's text or key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written


def keep_lowest(
    df: DataFrame,
    key: Column,
    row_id: str,
    carry: list[str],
    copies: str = "n_copies",
    missing: Column | None = None,
) -> DataFrame:
    """One row per ``key``: the one with the lowest ``row_id``, its ``carry``
    columns and the number of rows that shared the key. A row whose key is null is
    a copy of no other. ``row_id`` may be null: of rows with a key and no id, one is
    kept if no row of that key has an id. Of rows of a key that share the lowest id, or
    have none, one is kept: the smallest by a hash of its ``carry`` columns or, where
    ids repeat, by those columns themselves.

    ``missing`` tells which rows have no key, for keys that are costly to compute:
    with it, a key is computed once per row. Digests and ids alone are aggregated,
    by hash, each task folding its copies first; the kept rows' columns are then
    fetched by id, once.
    """
    missing = key.isNull() if missing is None else missing
    if _repeats(df, row_id):
        return _lowest_rows(df, key, row_id, carry, copies, missing)
    nameless = ~missing & F.col(row_id).isNull()
    mark = F.when(nameless, _mark(carry))
    kept = (
        df.where(~missing)
        .groupBy(key.alias("_key"))
        .agg(F.min(row_id).alias("_kept"), F.min(mark).alias("_least"), F.count(F.lit(1)).alias("_n"))
        .select("_kept", F.when(F.col("_kept").isNull(), F.col("_least")).alias("_least"), "_n")
    )
    rows = df.select(row_id, *carry, missing.alias("_missing"), mark.alias("_mark"))
    # Rows without id are found by the hash of their columns, alike ones as one.
    alike = rows.where("_mark IS NOT NULL").distinct()
    rows = rows.where("_mark IS NULL").unionByName(alike)
    same = rows[row_id].eqNullSafe(kept["_kept"]) & rows["_mark"].eqNullSafe(kept["_least"])
    found = rows.join(kept, same, "left")
    return found.where("_missing OR _n IS NOT NULL").select(
        row_id, *carry, F.coalesce("_n", F.lit(1)).alias(copies)
    )


def _repeats(df: DataFrame, row_id: str) -> bool:
    """Whether several rows have one id; ids alone are grouped."""
    ids = df.where(F.col(row_id).isNotNull()).groupBy(row_id).agg(F.count(F.lit(1)).alias("_n"))
    return not ids.where("_n > 1").isEmpty()


def _lowest_rows(
    df: DataFrame, key: Column, row_id: str, carry: list[str], copies: str, missing: Column
) -> DataFrame:
    """As :func:`keep_lowest` where an id does not name a row: whole rows are aggregated,
    each task keeping one per key."""
    row = F.struct(F.col(row_id).isNull().alias("_last"), row_id, *carry)
    lowest = (
        df.where(~missing)
        .groupBy(key.alias("_key"))
        .agg(F.min(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
    )
    kept = lowest.select("_row.*", F.col("_n").alias(copies)).drop("_last")
    return kept.unionByName(
        df.where(missing).select(row_id, *carry, F.lit(1).cast("long").alias(copies))
    )


def _mark(columns: list[str]) -> Column:
    """A hash of the values of ``columns`` as one number, which hash aggregation can hold."""
    own = [*columns, *[F.col(c).isNull() for c in columns]]
    high, low = F.xxhash64(*own), F.pmod(F.xxhash64(F.lit(1), *own), F.lit(10**18))
    return high.cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)") + low


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with one row of each ``key`` that occurs several times: the smallest by
    its other columns. Rows without a key stay. Only repeated keys are gathered."""
    repeated = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = repeated.where("_n > 1 AND _key IS NOT NULL").select("_key")
    repeated = written(repeated, "repeated-keys")
    same = df[key] == repeated["_key"]
    others = [c for c in df.columns if c != key]
    first = (
        df.join(repeated, same, "left_semi")
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select(*[c if c == key else F.col("_row")[c].alias(c) for c in df.columns])
    )
    return df.join(repeated, same, "left_anti").unionByName(first)
