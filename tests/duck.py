"""Run a query's SQL in DuckDB on the same tables and compare results strictly."""

from __future__ import annotations

import duckdb

from tallyloom.sources.tables import SCHEMAS, table_path


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{table_path(root, table)}'")
    return con


# DuckDB type -> Spark type a result column may have.
SAME_TYPE = {
    "BIGINT": {"bigint"},
    "INTEGER": {"int"},
    "DOUBLE": {"double"},
    "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"},
}


def assert_same(df, con, sql: str) -> int:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    order = sorted(names)
    assert sorted(df.columns) == order
    spark_types = dict(df.dtypes)
    for name in names:
        assert spark_types[name] in SAME_TYPE.get(types[name], ()), (
            name, spark_types[name], types[name],
        )
    left = sorted(repr(tuple(r)) for r in df.select(*order).collect())
    index = [names.index(n) for n in order]
    right = sorted(repr(tuple(r[i] for i in index)) for r in expected)
    assert len(left) == len(right), (len(left), len(right))
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    assert not wrong, wrong[:3]
    return len(left)
