"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``edges``; component is its smallest id.

    Ids are longs; rows with a null end, loops and repeated edges change nothing.
    Each round hooks every node to its smallest neighbour, shortens the hooks
    twice, and merges nodes so joined, until no edge is left between different
    nodes. A node with very many edges is one row per task in the aggregation
    (map-side minimum), and its rows in a join can be split, as both sides are
    plain tables. Each round's tables are written to the shared folder.
    """
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = written(edges.where("a IS NOT NULL AND b IS NOT NULL"), "edges")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("m"))
        hooks = written(
            hooks.select(F.col("a").alias("id"), F.least("a", "m").alias("up")), "hooks"
        )
        if labels is None and hooks.isEmpty():
            return hooks.select("id", F.col("up").alias("component"))
        for _ in range(2):
            hooks = written(_through(hooks, hooks, "up"), "hooks")
        labels = _through(hooks if labels is None else labels, hooks, "up")
        labels = written(labels, "labels")
        edges = _through(_through(edges, hooks, "a"), hooks, "b").where("a != b").distinct()
        edges = written(edges, "edges")
        if edges.isEmpty():
            return labels.select("id", F.col("up").alias("component"))


def _through(df: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` replaced by what it hooks to, if anything."""
    step = hooks.select(F.col("id").alias("_from"), F.col("up").alias("_to"))
    joined = df.join(step, df[column] == F.col("_from"), "left")
    out = [F.coalesce("_to", column).alias(c) if c == column else F.col(c) for c in df.columns]
    return joined.select(*out)
