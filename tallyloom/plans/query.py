"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType


class Query(NamedTuple):
    """``run`` takes the session and the table folder; ``sql`` gives the same rows
    and column names when DuckDB runs it on the same tables."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: types every engine prints alike.

    Applied to results on their way out only; inside the plans sums stay decimal.
    """

    def column(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, DateType | TimestampNTZType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])
