"""The four batch jobs: generate, prepare, analyse, report.

Each reads a table folder and writes one; no more than single rows of counts and
quantile marks reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text_keys import folded_key
from tallyloom.operators import duplicates, generator, quality, star
from tallyloom.plans import analysis, preparation, reports
from tallyloom.session import sized_for
from tallyloom.sources import csv_files, sinks
from tallyloom.sources.tables import read_table, schema_of, table_path

# The tables a CSV delivery holds as CSV; the rest stay Parquet.
CSV_TABLES = ("customer", "part", "orders", "lineitem", "events")
# Rows per generated file; also the work of one task.
ROWS_PER_TASK = 5_000_000


def csv_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.csv"


def generate(
    spark: SparkSession,
    out: str,
    n_orders: int,
    seed: int = 7,
    hot_share: float = 0.0,
    csv: bool = False,
    overwrite: bool = False,
) -> None:
    """Write a set of tables around ``n_orders`` orders, the others in proportion.

    With ``hot_share`` that part of the orders, lines and events belongs to one
    customer, part and user. Tables already there are kept, and the job fails,
    unless ``overwrite`` is set.
    """

    def ids(n: int) -> DataFrame:
        return spark.range(0, n, 1, max(1, -(-n // ROWS_PER_TASK)))

    n_customers, n_parts = max(1, n_orders // 10), max(1, n_orders // 8)
    n_suppliers, n_documents = max(1, n_orders // 150), max(1, n_orders // 15)
    tables = {
        "region": generator.regions(spark),
        "nation": generator.nations(spark),
        "customer": generator.customers(ids(n_customers), seed),
        "supplier": generator.suppliers(ids(n_suppliers), seed),
        "part": generator.parts(ids(n_parts), seed),
        "orders": generator.orders(ids(n_orders), seed, n_customers, hot_share),
        "lineitem": generator.lines(
            ids(4 * n_orders), seed, n_orders, n_parts, n_suppliers, hot_share
        ),
        "events": generator.events(ids(n_orders), seed, n_customers, hot_share),
        "documents": generator.documents(ids(n_documents), seed),
    }
    for name, table in tables.items():
        writer = table.to(schema_of(name)).write.mode("overwrite" if overwrite else "error")
        if csv and name in CSV_TABLES:
            writer.csv(csv_path(out, name))
        else:
            writer.parquet(table_path(out, name))


def prepare(spark: SparkSession, root: str, out: str, csv: bool = False) -> None:
    """Ingest, validate, split, clean and enrich.

    Writes under ``out``: ``ingested`` (CSV deliveries only: each table, lines
    that do not fit their schema apart), ``rule_violations``, ``customers`` by
    verdict, ``documents`` without repeats, ``events`` with parsed properties,
    and ``lines`` by match and order year. Each is replaced as a whole.

    Nothing delivered is lost: lines without an order, customer, place or part
    lie under their own ``match``; events keep the text of their properties,
    readable or not; documents without text are not taken for copies. Of orders,
    customers and parts that repeat a key one is joined (the rules count them).
    """

    sized_for(spark, root)

    def load(name: str) -> DataFrame:
        if not csv or name not in CSV_TABLES:
            return read_table(spark, root, name)
        ingested = csv_files.ingest_csv(
            spark, csv_path(root, name), schema_of(name), f"{out}/ingested/{name}"
        )
        return csv_files.good_rows(ingested)

    customer, part, orders, lineitem, events = (load(name) for name in CSV_TABLES)
    nation, region, documents = (load(name) for name in ("nation", "region", "documents"))

    parsed = preparation.parsed_events(events)
    violations = preparation.violations_in(customer, orders, lineitem, part).unionByName(
        preparation.unreadable_events(parsed)
    )
    sinks.write_report(violations, f"{out}/rule_violations", order=["rule"])

    verdict = F.coalesce("reject_reason", F.lit("pass")).alias("verdict")
    judged = quality.with_reject_reason(customer, preparation.customer_acceptance())
    sinks.write_partitioned(
        judged.select(*customer.columns, verdict), f"{out}/customers", "verdict", whole=True
    )

    carried = [c for c in documents.columns if c != "doc_id"]
    unique = duplicates.keep_lowest(
        documents, folded_key("text"), "doc_id", carried, missing=F.col("text").isNull()
    )
    unique.write.mode("overwrite").parquet(f"{out}/documents")

    parsed.write.mode("overwrite").parquet(f"{out}/events")

    lines = star.matched_lines(
        lineitem,
        duplicates.one_per_key(orders, "o_orderkey"),
        duplicates.one_per_key(customer, "c_custkey"),
        duplicates.one_per_key(part, "p_partkey"),
        nation,
        region,
    )
    by_year = lines.withColumn("order_year", F.year("o_orderdate"))
    sinks.write_partitioned(by_year, f"{out}/lines", "match", whole=True, within="order_year")


def analyse(spark: SparkSession, root: str, out: str) -> None:
    """Write every analysis under its name, as Parquet."""
    sized_for(spark, root)
    for name, query in analysis.QUERIES.items():
        query.run(spark, root).write.mode("overwrite").parquet(f"{out}/{name}")


def report(spark: SparkSession, root: str, out: str, fmt: str = "csv") -> None:
    """Write every report table under its name, as one CSV or JSON file each."""
    sized_for(spark, root)
    for name, (table, order) in reports.TABLES.items():
        sinks.write_report(table(spark, root), f"{out}/{name}", fmt, order)


JOBS: dict[str, Callable] = {
    "generate": generate,
    "prepare": prepare,
    "analyse": analyse,
    "report": report,
}
