"""Partitioned tables and small report files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_partitioned(
    df: DataFrame, path: str, by: str, gather: bool = True, whole: bool = False, within: str = ""
) -> None:
    """Write ``df`` partitioned by ``by``, and by ``within`` below it if given. Only the partitions present in ``df``
    are replaced, so a rerun of one period leaves the others alone; with
    ``whole`` the table is replaced, so no partition of an earlier run stays.

    With ``gather`` a rebalance hint brings each partition value into few files,
    and AQE splits a value that holds much of the table over several tasks.
    Without it nothing is shuffled and each task writes a file per value it
    holds: right for a large table with few values, where such files are large.
    """
    keys = [c for c in (by, within) if c]
    rows = df.hint("rebalance", *keys) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_report(df: DataFrame, path: str, fmt: str = "csv", order: Sequence[str] = ()) -> None:
    """One file for a small result table (a report of bounded size), in ``order``.

    The rows are gathered by a shuffle of their own, so the work before it keeps
    its parallelism.
    """
    gathered = df.repartition(1)
    if order:
        gathered = gathered.sortWithinPartitions(*order)
    writer = gathered.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")
