"""Numeric profiles, outliers, correlation, histograms and cross-tabulation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.quality import finite
from tallyloom.operators.quantiles import (
    column_quantiles,
    exact_quantiles,
    group_key,
    quantiles_by_key,
)

QUARTILES = (0.25, 0.5, 0.75)


def _moments(value: str) -> list[Column]:
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def profile(df: DataFrame, value: str) -> DataFrame:
    """One row: count, mean, sample standard deviation, range and exact quartiles."""
    quartiles = exact_quantiles(df, value, QUARTILES).select(
        F.struct("p25", "p50", "p75").alias("q")
    )
    row = df.agg(*_moments(value)).withColumn("q", quartiles.scalar())
    return row.select("*", "q.*").drop("q")


def group_profile(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """:func:`profile` per group; a null group counts as one.

    Both halves are grouped by the same key, so their join needs no shuffle.
    """
    quartiles = quantiles_by_key(df, value, QUARTILES, by)
    per_group = df.groupBy(group_key(by)).agg(*_moments(value))
    return per_group.join(quartiles, "_key", "left").select(
        "_key.*", "n", "mean", "sd", "min", "max", "p25", "p50", "p75"
    )


def column_profiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`profile` of several columns, one row each.

    The moments of all columns take one scan, their quartiles two more unless a
    column has too many distinct values for a buffer.
    """
    names = ["n", "mean", "sd", "min", "max"]
    per_column = [F.struct(F.lit(c).alias("column_name"), *_moments(c)) for c in columns]
    moments = df.agg(F.array(*per_column).alias("rows")).select(F.inline("rows"))
    quartiles = column_quantiles(df, columns, QUARTILES)
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", *names, "p25", "p50", "p75"
    )


def outliers(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """Rows further than ``k`` interquartile ranges outside the quartiles.

    The quartiles are one row and enter the filter as a scalar subquery.
    """
    quartiles = exact_quantiles(df, value, (0.25, 0.75))
    fences = quartiles.select(
        F.struct(
            (F.col("p25") - k * (F.col("p75") - F.col("p25"))).alias("low"),
            (F.col("p75") + k * (F.col("p75") - F.col("p25"))).alias("high"),
        ).alias("fence")
    ).scalar()
    return df.where((F.col(value) < fences["low"]) | (F.col(value) > fences["high"]))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one scan, one row per pair."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(rows))


def histogram(df: DataFrame, value: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin ``[low, low + width)``. Values that are not finite have a row
    of their own, without ``low``; nulls are left out."""
    step = F.when(finite(value), F.floor(F.col(value) / F.lit(float(width))))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, step.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*by, (F.col("_bin") * F.lit(float(width))).alias("low"), "n")
    )


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence[str], weight: str
) -> DataFrame:
    """Sum of ``weight`` by ``row`` and ``column``.

    The column values are listed, so no extra job has to find them; what is not
    in the list is summed under ``other``.
    """
    listed = F.when(F.col(column).isin(list(values)), F.col(column)).otherwise("other")
    wide = df.withColumn("_column", listed).groupBy(row).pivot("_column", [*values, "other"])
    return wide.agg(F.sum(weight)).fillna(0, [*values, "other"])
