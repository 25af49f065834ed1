"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.plans import analysis, cubes, generation, preparation, reports, timelines
from tallyloom.plans.query import Query, plain
from tallyloom.session import sized_for

FLAGSHIP = "revenue_by_region_year"

QUERIES: dict[str, Query] = {
    **preparation.QUERIES,
    **analysis.QUERIES,
    **reports.QUERIES,
    **generation.QUERIES,
    **timelines.QUERIES,
    **cubes.QUERIES,
}


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, root: str) -> DataFrame:
        sized_for(spark, root)
        return plain(QUERIES[name].run(spark, root))

    return run
