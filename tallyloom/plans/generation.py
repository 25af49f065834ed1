"""Sample tables drawn for the ids of the tables at hand.

The row ids and the keys that rows refer to are those of the given tables, so the
work grows with them and no reference is broken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import generator
from tallyloom.plans.query import Query
from tallyloom.sources.tables import read_table

SEED = 7
HOT_SHARE = 0.333


def _ids(spark: SparkSession, root: str, table: str, key: str) -> DataFrame:
    return read_table(spark, root, table).select(F.col(key).alias("id"))


def _parents(spark: SparkSession, root: str, table: str, key: str) -> generator.Parents:
    return generator.parents_of(read_table(spark, root, table), key)


def generated_customers(spark: SparkSession, root: str) -> DataFrame:
    return generator.customers(_ids(spark, root, "customer", "c_custkey"), SEED)


def generated_suppliers(spark: SparkSession, root: str) -> DataFrame:
    return generator.suppliers(_ids(spark, root, "supplier", "s_suppkey"), SEED)


def generated_parts(spark: SparkSession, root: str) -> DataFrame:
    return generator.parts(_ids(spark, root, "part", "p_partkey"), SEED)


def generated_orders(spark: SparkSession, root: str) -> DataFrame:
    ids = _ids(spark, root, "orders", "o_orderkey")
    return generator.orders(ids, SEED, _parents(spark, root, "customer", "c_custkey"))


def generated_hot_lines(spark: SparkSession, root: str) -> DataFrame:
    """One line per order id, a third of them for one part."""
    return generator.lines(
        _ids(spark, root, "orders", "o_orderkey"),
        SEED,
        _parents(spark, root, "orders", "o_orderkey"),
        _parents(spark, root, "part", "p_partkey"),
        _parents(spark, root, "supplier", "s_suppkey"),
        HOT_SHARE,
    )


def generated_events(spark: SparkSession, root: str) -> DataFrame:
    ids = _ids(spark, root, "events", "event_id")
    return generator.events(ids, SEED, _parents(spark, root, "customer", "c_custkey"))


def generated_documents(spark: SparkSession, root: str) -> DataFrame:
    return generator.documents(_ids(spark, root, "documents", "doc_id"), SEED)


def _draw(name: str, row_id: str = "id") -> str:
    return f"CAST('0x' || substr(md5('{SEED}|{name}|' || {row_id}), 1, 15) AS BIGINT)"


def _whole(name: str, low: int, high: int) -> str:
    return f"({low} + {_draw(name)} % {high - low + 1})"


def _hundredths(name: str, low: int, high: int) -> str:
    return f"(CAST({_whole(name, low, high)} AS DOUBLE) / CAST(100 AS DOUBLE))"


def _choice(name: str, values: str, row_id: str = "id") -> str:
    options = ", ".join(f"'{v}'" for v in values.split(","))
    return f"([{options}])[{_draw(name, row_id)} % {len(values.split(','))} + 1]"


def _keys(table: str, key: str) -> str:
    """A table of the distinct keys of ``table`` with their places, from 0."""
    return f"""{table}_keys AS (
    SELECT k, row_number() OVER (ORDER BY k) - 1 AS place
    FROM (SELECT DISTINCT {key} AS k FROM {table} WHERE {key} IS NOT NULL)
)"""


def _parent(name: str, table: str, hot_share: float = 0.0) -> str:
    place = f"{_draw(name)} % (SELECT count(*) FROM {table}_keys)"
    key = f"(SELECT k FROM {table}_keys WHERE place = {place})"
    if not hot_share:
        return key
    first = f"(SELECT min(k) FROM {table}_keys)"
    return f"CASE WHEN {_draw(name + '/hot')} % 1000000 < {round(hot_share * 1_000_000)} THEN {first} ELSE {key} END"


# The words of names and texts, and the order priorities.
_WORDS = "amber,birch,cedar,delta,ember,fjord,grove,harbor,inlet,juniper"
_PRIORITIES = "1-URGENT,2-HIGH,3-MEDIUM,4-NOT SPECIFIED,5-LOW"


def _day(name: str, first: str, n_days: int) -> str:
    return f"CAST(DATE '{first}' + CAST({_whole(name, 0, n_days - 1)} AS INTEGER) AS TIMESTAMP)"


CUSTOMERS_SQL = f"""
WITH i AS (SELECT c_custkey AS id FROM customer)
SELECT id AS c_custkey, 'Customer#' || lpad(CAST(id AS VARCHAR), 9, '0') AS c_name,
       CAST({_whole("c_nationkey", 0, 24)} AS INTEGER) AS c_nationkey,
       {_hundredths("c_acctbal", -99_999, 999_999)} AS c_acctbal,
       {_choice("c_mktsegment", "AUTOMOBILE,BUILDING,FURNITURE,HOUSEHOLD,MACHINERY")} AS c_mktsegment FROM i
"""

SUPPLIERS_SQL = f"""
WITH i AS (SELECT s_suppkey AS id FROM supplier)
SELECT id AS s_suppkey, 'Supplier#' || lpad(CAST(id AS VARCHAR), 9, '0') AS s_name,
       CAST({_whole("s_nationkey", 0, 24)} AS INTEGER) AS s_nationkey,
       {_hundredths("s_acctbal", -99_999, 999_999)} AS s_acctbal FROM i
"""

PARTS_SQL = f"""
WITH i AS (SELECT p_partkey AS id FROM part)
SELECT id AS p_partkey,
       {_choice("p_name/1", _WORDS)} || ' ' || {_choice("p_name/2", _WORDS)} AS p_name,
       'Brand#' || {_whole("p_brand", 1, 25)} AS p_brand,
       {_choice("p_type", "ECONOMY,LARGE,MEDIUM,PROMO,SMALL,STANDARD")} AS p_type,
       CAST({_whole("p_size", 1, 50)} AS INTEGER) AS p_size,
       {_hundredths("p_retailprice", 90_000, 99_990)} AS p_retailprice FROM i
"""

ORDERS_SQL = f"""
WITH i AS (SELECT o_orderkey AS id FROM orders), {_keys("customer", "c_custkey")}
SELECT id AS o_orderkey, {_parent("o_custkey", "customer")} AS o_custkey,
       {_choice("o_orderstatus", "F,O,P")} AS o_orderstatus,
       {_hundredths("o_totalprice", 100_000, 49_999_999)} AS o_totalprice,
       CAST({_day("o_orderdate", "1995-01-01", 2404)} AS VARCHAR) AS o_orderdate,
       {_choice("o_orderpriority", _PRIORITIES)} AS o_orderpriority FROM i
"""

HOT_LINES_SQL = f"""
WITH i AS (SELECT o_orderkey AS id FROM orders), {_keys("orders", "o_orderkey")},
{_keys("part", "p_partkey")}, {_keys("supplier", "s_suppkey")}
SELECT {_parent("l_orderkey", "orders")} AS l_orderkey,
       {_parent("l_partkey", "part", HOT_SHARE)} AS l_partkey,
       {_parent("l_suppkey", "supplier")} AS l_suppkey,
       CAST({_whole("l_linenumber", 1, 7)} AS INTEGER) AS l_linenumber,
       CAST({_whole("l_quantity", 1, 50)} AS DOUBLE) AS l_quantity,
       {_hundredths("l_extendedprice", 90_000, 10_500_000)} AS l_extendedprice,
       {_hundredths("l_discount", 0, 10)} AS l_discount,
       {_hundredths("l_tax", 0, 8)} AS l_tax,
       {_choice("l_returnflag", "A,N,R")} AS l_returnflag,
       {_choice("l_linestatus", "F,O")} AS l_linestatus,
       CAST({_day("l_shipdate", "1995-01-01", 2499)} AS VARCHAR) AS l_shipdate FROM i
"""

EVENTS_SQL = f"""
WITH i AS (SELECT event_id AS id FROM events), {_keys("customer", "c_custkey")},
     s AS (SELECT *, {_whole("value", 0, 22_000)} AS step FROM i),
     v AS (SELECT *, step * step // 10000 AS square FROM s)
SELECT id AS event_id,
       CAST({_day("ts", "2024-01-01", 30)} + to_seconds({_whole("ts/second", 0, 86_399)}) AS VARCHAR) AS ts,
       {_parent("user_id", "customer")} AS user_id,
       {_choice("event_type", "click,error,purchase,signup,view")} AS event_type,
       CAST(square * square // 48400 AS DOUBLE) / CAST(100 AS DOUBLE) AS value,
       '{{"k": ' || {_whole("props", 0, 99)} || '}}' AS props FROM v
"""

_TEXT_WORDS = " || ' ' || ".join(_choice(f"text/{n}", _WORDS, "origin") for n in range(8))

DOCUMENTS_SQL = f"""
WITH i AS (SELECT doc_id AS id FROM documents),
     o AS (SELECT id, CASE WHEN {_draw("text/copy")} % 1000000 < 100000 THEN 0 ELSE id END AS origin FROM i),
     w AS (SELECT id, {_TEXT_WORDS} || ' ' || origin AS own, {_draw("text/style")} % 3 AS style FROM o),
     t AS (SELECT id, CASE style WHEN 0 THEN upper(own) WHEN 1 THEN own || '  ' ELSE own END AS text FROM w)
SELECT id AS doc_id, text, {_choice("lang", "de,en,es,fr")} AS lang,
       'source' || {_whole("source", 0, 19)} AS source,
       CAST(length(text) AS BIGINT) AS n_chars FROM t
"""

QUERIES = {
    "generated_customers": Query(generated_customers, CUSTOMERS_SQL),
    "generated_suppliers": Query(generated_suppliers, SUPPLIERS_SQL),
    "generated_parts": Query(generated_parts, PARTS_SQL),
    "generated_orders": Query(generated_orders, ORDERS_SQL),
    "generated_hot_lines": Query(generated_hot_lines, HOT_LINES_SQL),
    "generated_events": Query(generated_events, EVENTS_SQL),
    "generated_documents": Query(generated_documents, DOCUMENTS_SQL),
}
