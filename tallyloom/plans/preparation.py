"""Ingest, validate, clean and enrich."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.money import cents, total_cents, total_revenue
from tallyloom.functions.text_keys import exact_key, folded_key
from tallyloom.operators import duplicates, quality, star
from tallyloom.operators.quality import finite
from tallyloom.plans.query import Query
from tallyloom.sources import csv_files, sinks
from tallyloom.sources.scratch import scratch_path
from tallyloom.sources.tables import read_table, schema_of

# The codes the rules accept.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ORDER_STATUSES = ["F", "O", "P"]

KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}


def table_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Rows and key range of every table, read with its declared schema.

    The scans are one union under one aggregation: a single shuffle whatever
    the number of tables. A row that counts nothing keeps empty tables in.
    """
    empty = spark.createDataFrame(
        [(t, 0, None) for t in KEYS], "table_name STRING, n INT, key BIGINT"
    )
    scans = [
        read_table(spark, root, t).select(
            F.lit(t).alias("table_name"), F.lit(1).alias("n"), F.col(k).cast("bigint").alias("key")
        )
        for t, k in KEYS.items()
    ]
    return (
        reduce(DataFrame.unionByName, scans, empty)
        .groupBy("table_name")
        .agg(
            F.sum("n").alias("n_rows"),
            F.min("key").alias("min_key"),
            F.max("key").alias("max_key"),
        )
    )


TABLE_INVENTORY_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, min({k})::BIGINT AS min_key, "
    f"max({k})::BIGINT AS max_key FROM {t}"
    for t, k in KEYS.items()
)


def _orders_csv(spark: SparkSession, root: str) -> DataFrame:
    """Orders written as CSV, then read back.

    What the file says wrongly follows from the rows themselves: orders without
    a set priority carry the price ``n/a``, pending orders end after the price.
    """
    orders = read_table(spark, root, "orders")
    price = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "n/a").otherwise(
        F.format_string("%.2f", "o_totalprice")
    )
    tail = [F.col("o_orderdate").cast("date").cast("string"), F.col("o_orderpriority")]
    tail = [F.when(F.col("o_orderstatus") != "P", c) for c in tail]
    # concat_ws leaves out nulls, so a pending order's line is short.
    text = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", price, *tail)
    path = scratch_path(spark, "orders-csv")
    orders.select(text).write.text(path)
    target = scratch_path(spark, "orders-ingested")
    return csv_files.ingest_csv(spark, path, schema_of("orders"), target)


def csv_good_rows(spark: SparkSession, root: str) -> DataFrame:
    return csv_files.good_rows(_orders_csv(spark, root))


def csv_bad_lines(spark: SparkSession, root: str) -> DataFrame:
    return csv_files.bad_lines(_orders_csv(spark, root))


CSV_GOOD_ROWS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
WHERE o_orderpriority <> '4-NOT SPECIFIED' AND o_orderstatus <> 'P'
"""

CSV_BAD_LINES_SQL = """
SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a'
              ELSE printf('%.2f', o_totalprice) END,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS raw_line
FROM orders
WHERE o_orderpriority = '4-NOT SPECIFIED' OR o_orderstatus = 'P'
"""


def customer_rules() -> quality.Rules:
    return {
        "customer name set": F.length(F.trim("c_name")) > 0,
        "customer balance not negative": finite("c_acctbal") & (F.col("c_acctbal") >= 0),
        "customer segment known": F.col("c_mktsegment").isin(SEGMENTS),
    }


def order_rules() -> quality.Rules:
    return {
        "order price positive": finite("o_totalprice") & (F.col("o_totalprice") > 0),
        "order status known": F.col("o_orderstatus").isin(ORDER_STATUSES),
        "order priority set": F.col("o_orderpriority") != "4-NOT SPECIFIED",
    }


def line_rules() -> quality.Rules:
    return {
        "line quantity positive": finite("l_quantity") & (F.col("l_quantity") > 0),
        "line discount below 10 percent": finite("l_discount") & (F.col("l_discount") < 0.1),
        "line open when not returned": (F.col("l_returnflag") != "N")
        | (F.col("l_linestatus") == "O"),
    }


def rule_violations(spark: SparkSession, root: str) -> DataFrame:
    return violations_in(
        *[read_table(spark, root, t) for t in ("customer", "orders", "lineitem", "part")]
    )


def parsed_events(events: DataFrame) -> DataFrame:
    """Events with their properties parsed beside the text they came in, and whether
    that text could be read."""
    props = F.from_json(
        "props", "k BIGINT, unreadable STRING", {"columnNameOfCorruptRecord": "unreadable"}
    )
    readable = props.isNotNull() & props["unreadable"].isNull()
    return events.withColumns({"k": props["k"], "props_readable": F.coalesce(readable, F.lit(False))})


def unreadable_events(parsed: DataFrame) -> DataFrame:
    """The rule that an event's properties can be read."""
    return quality.count_violations(parsed, {"event properties readable": F.col("props_readable")})


def violations_in(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, part: DataFrame
) -> DataFrame:
    return quality.rule_report(
        [
            quality.count_violations(customer, customer_rules()),
            quality.check_reference(
                orders,
                "o_custkey",
                customer,
                "c_custkey",
                "order has customer",
                child_rules=order_rules(),
            ),
            quality.check_reference(
                lineitem,
                "l_orderkey",
                orders,
                "o_orderkey",
                "line has order",
                has_child="order has lines",
                unique="order key unique",
                child_number="l_linenumber",
                number_unique="line number unique",
            ),
            quality.check_reference(
                lineitem,
                "l_partkey",
                part,
                "p_partkey",
                "line has part",
                child_rules=line_rules(),
            ),
        ]
    )


RULE_VIOLATIONS_SQL = """
SELECT 'customer name set' AS rule, count(*) AS n_checked,
       count(*) FILTER (WHERE length(trim(c_name)) = 0) AS n_violations FROM customer
UNION ALL SELECT 'customer balance not negative', count(*),
       count(*) FILTER (WHERE NOT isfinite(c_acctbal) OR c_acctbal < 0) FROM customer
UNION ALL SELECT 'customer segment known', count(*),
       count(*) FILTER (WHERE c_mktsegment NOT IN
         ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) FROM customer
UNION ALL SELECT 'order price positive', count(*),
       count(*) FILTER (WHERE NOT isfinite(o_totalprice) OR o_totalprice <= 0) FROM orders
UNION ALL SELECT 'order status known', count(*),
       count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
UNION ALL SELECT 'order priority set', count(*),
       count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') FROM orders
UNION ALL SELECT 'line quantity positive', count(*),
       count(*) FILTER (WHERE l_quantity <= 0) FROM lineitem
UNION ALL SELECT 'line discount below 10 percent', count(*),
       count(*) FILTER (WHERE l_discount >= CAST(0.1 AS DOUBLE)) FROM lineitem
UNION ALL SELECT 'line open when not returned', count(*),
       count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus <> 'O') FROM lineitem
UNION ALL SELECT 'order has customer', count(*),
       count(*) FILTER (WHERE NOT EXISTS
         (SELECT 1 FROM customer WHERE c_custkey = o_custkey)) FROM orders
UNION ALL SELECT 'line has order', count(*),
       count(*) FILTER (WHERE NOT EXISTS
         (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) FROM lineitem
UNION ALL SELECT 'line has part', count(*),
       count(*) FILTER (WHERE NOT EXISTS
         (SELECT 1 FROM part WHERE p_partkey = l_partkey)) FROM lineitem
UNION ALL SELECT 'order has lines', count(*),
       count(*) FILTER (WHERE NOT EXISTS
         (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) FROM orders
UNION ALL SELECT 'order key unique', count(*),
       count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'line number unique', count(*),
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
"""

# Rules a customer must meet to be used further; broken ones name the reject reason.
def customer_acceptance() -> quality.Rules:
    return {
        "balance not a number": finite("c_acctbal"),
        "negative balance": F.col("c_acctbal") >= 0,
        "balance above 9000": F.col("c_acctbal") <= 9000,
        "segment not served": F.col("c_mktsegment") != "MACHINERY",
    }


def customer_verdicts(spark: SparkSession, root: str) -> DataFrame:
    customer = read_table(spark, root, "customer")
    return quality.with_reject_reason(customer, customer_acceptance()).select(
        "c_custkey", F.coalesce("reject_reason", F.lit("pass")).alias("verdict")
    )


_VERDICT_SQL = """CASE WHEN c_acctbal IS NULL OR NOT isfinite(c_acctbal) THEN 'balance not a number'
            WHEN c_acctbal < 0 THEN 'negative balance'
            WHEN c_acctbal > 9000 THEN 'balance above 9000'
            WHEN c_mktsegment = 'MACHINERY' THEN 'segment not served'
            ELSE 'pass' END"""

CUSTOMER_VERDICTS_SQL = f"SELECT c_custkey, {_VERDICT_SQL} AS verdict FROM customer"


def reject_summary(spark: SparkSession, root: str) -> DataFrame:
    customer = read_table(spark, root, "customer")
    return (
        quality.with_reject_reason(customer, customer_acceptance())
        .groupBy(F.coalesce("reject_reason", F.lit("pass")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("n"), total_cents(cents("c_acctbal")).alias("balance"))
    )


REJECT_SUMMARY_SQL = f"""
SELECT {_VERDICT_SQL} AS verdict, count(*) AS n,
       CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
FROM customer GROUP BY 1
"""


def _unique_documents(spark: SparkSession, root: str, key) -> DataFrame:
    documents = read_table(spark, root, "documents")
    return duplicates.keep_lowest(
        documents, key, "doc_id", ["lang", "source", "n_chars"], missing=F.col("text").isNull()
    )


def exact_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return _unique_documents(spark, root, exact_key("text"))


def folded_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return _unique_documents(spark, root, folded_key("text"))


def _duplicates_sql(key: str) -> str:
    return f"""
SELECT doc_id, lang, source, n_chars, n_copies
FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n_copies,
             row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS LAST, lang NULLS FIRST,
                                source NULLS FIRST, n_chars NULLS FIRST) AS nth
      FROM (SELECT *, {key} AS k FROM documents WHERE text IS NOT NULL))
WHERE nth = 1
UNION ALL SELECT doc_id, lang, source, n_chars, 1 FROM documents WHERE text IS NULL
"""


EXACT_DUPLICATES_SQL = _duplicates_sql("text")
FOLDED_DUPLICATES_SQL = _duplicates_sql(
    "lower(trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')))"
)


def event_props(spark: SparkSession, root: str) -> DataFrame:
    """The JSON text parsed once into typed fields."""
    props = F.from_json("props", "k BIGINT")
    return read_table(spark, root, "events").select("event_id", props["k"].alias("k"))


EVENT_PROPS_SQL = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"


def star_enrichment(spark: SparkSession, root: str) -> DataFrame:
    tables = [
        read_table(spark, root, t)
        for t in ("lineitem", "orders", "customer", "part", "nation", "region")
    ]
    return star.enriched_lines(*tables).select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.year("o_orderdate").cast("bigint").alias("order_year"),
        "o_orderstatus",
        "c_custkey",
        "c_mktsegment",
        "n_name",
        "r_name",
        "p_brand",
        "p_type",
    )


def lines_by_match(spark: SparkSession, root: str) -> DataFrame:
    """Order lines by what they were matched with: all of them, none lost."""
    tables = [
        read_table(spark, root, t)
        for t in ("lineitem", "orders", "customer", "part", "nation", "region")
    ]
    return (
        star.matched_lines(*tables)
        .groupBy("match")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))
    )


LINES_BY_MATCH_SQL = """
SELECT CASE WHEN o_orderkey IS NULL THEN 'no order' WHEN c_custkey IS NULL THEN 'no customer'
            WHEN r_regionkey IS NULL THEN 'no place' WHEN p_partkey IS NULL THEN 'no part'
            ELSE 'matched' END AS match,
       count(*) AS n, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey
GROUP BY 1
"""

STAR_ENRICHMENT_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
       CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderstatus, c_custkey,
       c_mktsegment, n_name, r_name, p_brand, p_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
"""


def revenue_by_region_year(spark: SparkSession, root: str) -> DataFrame:
    lineitem, orders, customer, nation, region = (
        read_table(spark, root, t) for t in ("lineitem", "orders", "customer", "nation", "region")
    )
    shipped = lineitem.where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    per_order = star.order_totals(shipped)
    # A customer's orders are one row per year and task before they meet the customer.
    per_customer = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("order_year"))
        .agg(F.sum("revenue_units").alias("revenue_units"), F.sum("n").alias("n"))
    )
    return (
        per_customer.join(customer, F.col("o_custkey") == customer.c_custkey)
        .join(star.places(nation, region), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "order_year")
        .agg(total_revenue(F.col("revenue_units")).alias("revenue"), F.sum("n").alias("n"))
    )


REVENUE_BY_REGION_YEAR_SQL = """
SELECT r_name, CAST(year(o_orderdate) AS BIGINT) AS order_year,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2))
                      * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS revenue,
       count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE l_shipdate >= TIMESTAMP '1996-01-01'
GROUP BY 1, 2
"""


def partitioned_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders written by year, 1997 written again, the table read back."""
    orders = read_table(spark, root, "orders").withColumn("order_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders-by-year")
    sinks.write_partitioned(orders, path, "order_year")
    sinks.write_partitioned(orders.where("order_year = 1997"), path, "order_year")
    return (
        spark.read.schema(orders.schema)
        .parquet(path)
        .groupBy(F.col("order_year").cast("bigint").alias("order_year"))
        .agg(F.count(F.lit(1)).alias("n"), total_cents(cents("o_totalprice")).alias("total"))
    )


PARTITIONED_ORDERS_SQL = """
SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1
"""

QUERIES = {
    "revenue_by_region_year": Query(revenue_by_region_year, REVENUE_BY_REGION_YEAR_SQL),
    "table_inventory": Query(table_inventory, TABLE_INVENTORY_SQL),
    "csv_good_rows": Query(csv_good_rows, CSV_GOOD_ROWS_SQL),
    "csv_bad_lines": Query(csv_bad_lines, CSV_BAD_LINES_SQL),
    "rule_violations": Query(rule_violations, RULE_VIOLATIONS_SQL),
    "customer_verdicts": Query(customer_verdicts, CUSTOMER_VERDICTS_SQL),
    "reject_summary": Query(reject_summary, REJECT_SUMMARY_SQL),
    "exact_duplicates": Query(exact_duplicates, EXACT_DUPLICATES_SQL),
    "folded_duplicates": Query(folded_duplicates, FOLDED_DUPLICATES_SQL),
    "event_props": Query(event_props, EVENT_PROPS_SQL),
    "star_enrichment": Query(star_enrichment, STAR_ENRICHMENT_SQL),
    "lines_by_match": Query(lines_by_match, LINES_BY_MATCH_SQL),
    "partitioned_orders": Query(partitioned_orders, PARTITIONED_ORDERS_SQL),
}
