"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, each by its own centroids, so
a pair of centroids is a cell. A query visits cells by the sum of its distances to
the two centroids, nearest first, taken from a heap over the two sorted lists, until
it has passed a share of all vectors. What lies in those cells is compared with the
query in double precision. The share is measured: the smallest that finds the wanted
part of the true neighbours of sample vectors among the sample.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.vector_dedup import usable
from tallyloom.sources.scratch import written

NEIGHBOURS = 10
# Bound of the fit: vectors, picked by hash, that reach the driver; of them, those the
# share is measured with. Every vector is indexed.
SAMPLE, PROBES = 20_000, 500
# The part of the true neighbours that the probes have to find.
RECALL = 0.95
# Vectors aimed at in a cell, and the most centroids of a half; their square bounds the
# table of cells.
PER_CELL, CENTROIDS = 50, 256
ROUNDS = 12
# Vectors and queries that meet in one task, and pairs compared at a time.
ENTRIES, QUERIES, PAIRS = 2_048, 4_096, 1 << 20


class Index(NamedTuple):
    """``halves``: the centroids of either half. ``sizes``: vectors in each cell.
    ``shard`` and ``shards``: the first group of vectors that a cell is kept in, and in
    how many. ``enough``: vectors that a query passes."""

    halves: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray
    shard: np.ndarray
    shards: np.ndarray
    enough: int


def _split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (x.shape[1] + 1) // 2
    return x[:, :middle], x[:, middle:]


def _square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * x @ c.T


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from spread out rows; a centroid that nothing is nearest to stays."""
    out = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        own = _square_distances(x, out).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(out)
        np.add.at(total, own, x)
        out[n > 0] = total[n > 0] / n[n > 0, None]
    return out


def _cells(x: np.ndarray, halves: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    one, two = (
        _square_distances(part, c).argmin(axis=1)
        for part, c in zip(_split(x), halves, strict=True)
    )
    return one * len(halves[1]) + two


def visited(
    one: np.ndarray, two: np.ndarray, sizes: np.ndarray, enough: int
) -> list[int]:
    """Cells by the sum of a query's distances to the centroids of the first half and
    the second, until ``enough`` vectors lie in them. Empty cells are passed over."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    x, y, width = one[a].tolist(), two[b].tolist(), len(two)
    a, b, left = a.tolist(), b.tolist(), enough
    heap, out = [(x[0] + y[0], 0, 0)], []
    while heap and left > 0:
        _, i, j = heapq.heappop(heap)
        # Each pair is reached once: along its row, and rows from their first pair.
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
        cell = a[i] * width + b[j]
        if sizes[cell]:
            out.append(cell)
            left -= sizes[cell]
    return out


def _measured_share(x: np.ndarray, halves: tuple[np.ndarray, np.ndarray], k: int) -> float:
    """The smallest share of the sample that probes pass until they find RECALL of
    their true ``k`` neighbours in it."""
    probes = x[np.linspace(0, len(x) - 1, min(PROBES, len(x))).astype(int)]
    cells = _cells(x, halves)
    sizes = np.bincount(cells, minlength=len(halves[0]) * len(halves[1]))
    needed = []
    one, two = (
        _square_distances(p, c) for p, c in zip(_split(probes), halves, strict=True)
    )
    apart = _square_distances(probes, x)
    for n in range(len(probes)):
        # The nearest row is the probe itself.
        near = np.argpartition(apart[n], min(k, len(x) - 1))[: k + 1]
        near = near[np.argsort(apart[n][near])][1:]
        sums = (one[n][:, None] + two[n]).ravel()
        order = np.argsort(sums, kind="stable")
        passed = np.empty(len(sums))
        passed[order] = np.cumsum(sizes[order])
        needed.append(passed[cells[near]])
    needed = np.sort(np.concatenate(needed)) if needed else np.zeros(1)
    if not len(needed):
        return 1.0
    return float(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)] / len(x))


def _matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, d)


def _in_range(x: np.ndarray, by: float) -> np.ndarray:
    """Components so small that squares do not overflow."""
    return x / by


def fit(entries: DataFrame, d: int, neighbours: int = NEIGHBOURS) -> tuple[Index, float]:
    """An index of ``entries`` (distinct vectors of ``d`` components), and the number
    that components are divided by before they are squared."""
    sample = entries.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE)
    x = np.array([r.embedding for r in sample.collect()], dtype=np.float64).reshape(-1, d)
    found = entries.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.array_max(F.transform("embedding", lambda v: F.abs(v)))).alias("top"),
    ).first()
    scale = float(found.top) if found.top and found.top > 1e100 else 1.0
    x = _in_range(x, scale)
    k = int(min(CENTROIDS, max(1, round((found.n / PER_CELL) ** 0.5)), len(x)))
    halves = tuple(_centroids(part, k) for part in _split(x))
    sizes = _cell_sizes(entries, halves, d, scale)
    share = _measured_share(x, halves, neighbours)
    # A query passes itself, and has to meet as many others as it is to find.
    enough = max(int(np.ceil(share * found.n)), neighbours + 1)
    # Cells in order fill groups of vectors; a cell too large for one has several.
    shards = np.maximum(1, -(-sizes // ENTRIES))
    shard = np.zeros(len(sizes), dtype=np.int64)
    number, room = -1, 0
    for cell, n in enumerate(sizes.tolist()):
        if shards[cell] > 1 or n > room:
            number, room = number + 1, ENTRIES
        shard[cell] = number
        room = 0 if shards[cell] > 1 else room - n
        number += int(shards[cell]) - 1
    return Index(halves, sizes, shard, shards, enough), scale


def _cell_sizes(
    entries: DataFrame, halves: tuple[np.ndarray, np.ndarray], d: int, scale: float
) -> np.ndarray:
    """How many vectors lie in each cell; at most CENTROIDS squared numbers."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(halves[0]) * len(halves[1]), dtype=np.int64)
        for batch in batches:
            own = _cells(_in_range(_matrix(batch.column(0), d), scale), halves)
            total += np.bincount(own, minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["cell", "n"])

    counted = entries.select("embedding").mapInArrow(tally, "cell long, n long")
    out = np.zeros(len(halves[0]) * len(halves[1]), dtype=np.int64)
    for row in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row.cell] = row.n
    return out


def _placed(entries: DataFrame, index: Index, d: int, scale: float) -> DataFrame:
    """Entries with their cell and the group (``shard``) they are kept in."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _cells(_in_range(_matrix(batch.column(2), d), scale), index.halves)
            spread = np.asarray(batch.column(0)) % index.shards[cells]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array(cells),
                    pa.array(index.shard[cells] + spread),
                ],
                ["ids", "embedding", "cell", "shard"],
            )

    salt = F.pmod(F.xxhash64("embedding"), F.lit(1 << 40))
    return entries.select(salt, "ids", "embedding").mapInArrow(
        place, "ids array<long>, embedding array<double>, cell long, shard long"
    )


def _routes(queries: DataFrame, index: Index, d: int, scale: float) -> DataFrame:
    """A row per query and group of vectors that it visits, with the cells there."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = index.sizes.tolist()
        for batch in batches:
            x = _in_range(_matrix(batch.column(1), d), scale)
            one, two = (
                _square_distances(p, c)
                for p, c in zip(_split(x), index.halves, strict=True)
            )
            for n in range(len(x)):
                cells = np.array(visited(one[n], two[n], sizes, index.enough), dtype=np.int64)
                # A large cell's groups are visited one and all.
                times = index.shards[cells]
                each = np.repeat(cells, times)
                step = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
                shards = index.shard[each] + step
                order = np.lexsort((each, shards))
                shards, each = shards[order], each[order]
                first = np.flatnonzero(np.diff(shards, prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(first), batch.column(0)[n].as_py())),
                        pa.array(shards[first]),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(first, len(each)), pa.int32()), pa.array(each)
                        ),
                        batch.column(1).take(pa.array(np.full(len(first), n))),
                    ],
                    ["query_id", "shard", "cells", "embedding"],
                )

    return queries.select("query_id", "embedding").mapInArrow(
        route, "query_id long, shard long, cells array<long>, embedding array<double>"
    )


def _searched(entries: DataFrame, queries: DataFrame, d: int, neighbours: int) -> DataFrame:
    """(query_id, vec_id, score): the nearest of each group of vectors that a query
    visits. ``queries`` are one length of vectors, as are ``entries``."""
    index, scale = fit(entries, d, neighbours)
    placed = _placed(entries, index, d, scale)
    routes = written(_routes(queries, index, d, scale), "routes")
    # A group that very many queries visit is met by a bounded number at a time.
    load = routes.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    load = load.select(
        F.col("shard").alias("_shard"), F.ceil(F.col("n") / QUERIES).cast("int").alias("parts")
    )
    spread = routes.join(load, F.col("shard") == F.col("_shard"))
    spread = spread.select(
        "query_id", "cells", "embedding", "shard",
        F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"),
    )
    copied = placed.join(load, F.col("shard") == F.col("_shard")).select(
        "ids", "embedding", "cell", "shard",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            x, q = _matrix(left.column("embedding"), d), _matrix(right.column("embedding"), d)
            own = left.column("cell").to_numpy()
            ids = left.column("ids").combine_chunks()
            begins, every = ids.offsets.to_numpy(), ids.values.to_numpy()
            wanted = right.column("cells").to_pylist()
            names = right.column("query_id").to_numpy()
            for n in range(len(q)):
                rows = np.flatnonzero(np.isin(own, wanted[n]))
                out.append(_best(q[n], names[n], x, rows, begins, every, neighbours))
        cast = (np.int64, np.int64, np.float64)
        columns = [
            np.concatenate([o[c] for o in out] or [np.empty(0)]).astype(kind)
            for c, kind in enumerate(cast)
        ]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return copied.groupBy("shard", "part").cogroup(spread.groupBy("shard", "part")).applyInArrow(
        meet, "query_id long, vec_id long, score double"
    )


def _best(
    q: np.ndarray, name: int, x: np.ndarray, rows: np.ndarray,
    begins: np.ndarray, every: np.ndarray, neighbours: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest ids among the vectors ``rows`` of ``x``, ties by id, never the query's."""
    scores = []
    for at in range(0, len(rows), max(1, PAIRS // max(1, len(q)))):
        apart = x[rows[at : at + max(1, PAIRS // max(1, len(q)))]] - q
        # Scaled, so that squares neither overflow nor vanish.
        most = np.abs(apart).max(axis=1, initial=0)
        safe = np.where((most > 1e100) | ((most < 1e-100) & (most > 0)), most, 1.0)
        scores.append(np.sqrt(((apart / safe[:, None]) ** 2).sum(axis=1)) * safe)
    scores = np.concatenate(scores or [np.empty(0)])
    # One vector's ids may be the query's own, so one more than is wanted.
    if len(scores) > neighbours + 1:
        last = np.partition(scores, neighbours)[neighbours]
        rows, scores = rows[scores <= last], scores[scores <= last]
    times = begins[rows + 1] - begins[rows]
    step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    ids = every[np.repeat(begins[rows], times) + step]
    scores = np.repeat(scores, times)
    other = ids != name
    ids, scores = ids[other], scores[other]
    best = np.lexsort((ids, scores))[:neighbours]
    return np.full(len(best), name), ids[best], scores[best]


def nearest(
    vectors: DataFrame, is_query: Column, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector that ``is_query`` picks by its
    vec_id, the nearest other vectors found, by Euclidean distance, ties by vec_id.

    ``vectors`` has vec_id and embedding (an array of numbers); other columns are
    ignored. Vectors that are null, empty or zero or hold null or non-finite
    components, and rows without vec_id, take no part. Vectors of different lengths
    are not compared. Repeated rows are one; of different vectors with one vec_id only
    the smallest, component by component, takes part. Fewer candidates than wanted are
    all returned. Equal vectors are one entry of the index with their ``neighbours`` + 1
    smallest ids: further copies cannot be among the nearest of any vector.
    """
    valid = vectors.where("vec_id IS NOT NULL").where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    valid = written(valid.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "search")
    order = Window.partitionBy("embedding").orderBy("vec_id")
    first = valid.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= neighbours + 1
    )
    entries = written(
        first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")),
        "entries",
    )
    size = F.size("embedding")
    found = None
    # Lengths of vectors in one table are few.
    for row in entries.select(size.alias("d")).distinct().collect():
        queries = valid.where(is_query & (size == row.d)).withColumnRenamed("vec_id", "query_id")
        part = _searched(entries.where(size == row.d), queries, row.d, neighbours)
        found = part if found is None else found.union(part)
    if found is None:
        found = valid.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score"))
    found = written(found, "found")
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
