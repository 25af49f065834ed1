"""Pseudo-random columns that depend only on seed, column name and row id.

``rand(seed)`` depends on how rows fall into partitions; a hash of the id does
not, so a lost task is recomputed to the same rows and any cluster size yields
the same table. md5 is used since every SQL engine has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, name: str, row_id: Column) -> Column:
    """A bigint in [0, 2^60)."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{name}|"), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def whole(seed: int, name: str, row_id: Column, low: int, high: int) -> Column:
    """A bigint in [low, high]."""
    return F.lit(low) + draw(seed, name, row_id) % F.lit(high - low + 1)


def hundredths(seed: int, name: str, row_id: Column, low: int, high: int) -> Column:
    """A double with two decimals; the bounds are in hundredths."""
    return whole(seed, name, row_id, low, high).cast("double") / F.lit(100.0)


def choice(seed: int, name: str, row_id: Column, values: Sequence[str]) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw(seed, name, row_id) % len(values) + 1).cast("int"))


def is_hot(seed: int, name: str, row_id: Column, share: float) -> Column:
    """Whether a row is one of the ``share`` that take the first key."""
    return draw(seed, f"{name}/hot", row_id) % 1_000_000 < round(share * 1_000_000)


def parent_key(
    seed: int, name: str, row_id: Column, n_parents: Column | int, hot_share: float = 0.0
) -> Column:
    """A key in [0, n_parents); with ``hot_share`` that part of the rows takes key 0."""
    n = F.lit(n_parents) if isinstance(n_parents, int) else n_parents
    key = draw(seed, name, row_id) % n
    if not hot_share:
        return key
    return F.when(is_hot(seed, name, row_id, hot_share), F.lit(0).cast("bigint")).otherwise(key)


def moment(seed: int, name: str, row_id: Column, first: str, n_days: int) -> Column:
    """Midnight of one of ``n_days`` days from ``first`` on, as timestamp_ntz."""
    day = whole(seed, name, row_id, 0, n_days - 1).cast("int")
    return F.date_add(F.lit(first).cast("date"), day).cast("timestamp_ntz")
