"""Near-duplicate vectors by exact cosine, compared tile by tile.

Unit vectors are rotated to the principal axes of all of them, most energy
first. Two tiles are compared over the leading dimensions first: the partial
product plus the product of the remaining norms bounds the cosine from above, and
pairs whose bound is too low are left at once. The rest go on over more
dimensions, and what still remains is computed exactly in double precision.

Tiles are stretches of the leading axis. Unit vectors of a cosine c are sqrt(2 - 2c)
apart, so no further apart on any axis: a vector goes only to the tiles it can have a
link in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import connected_components
from tallyloom.sources.scratch import written

THRESHOLD = 0.9
# Vectors of a tile; rows of a tile compared at a time; pairs refined at a time.
TILE, BLOCK, PAIRS = 4096, 512, 100_000
# Parts of the dimensions after which the bound is taken.
STEPS = (4, 2)
# What single precision may lose of a bound.
SLACK = 1e-4


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    values = column.combine_chunks().flatten()
    return np.asarray(values, dtype=np.float64).reshape(-1, d)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, d: int) -> np.ndarray:
    """Orthonormal axes (columns) of all vectors of ``d`` components, most energy
    first. Each task sums its products; d * d sums reach the driver."""

    def products(batches):
        total = np.zeros((d, d))
        for batch in batches:
            x = _unit(_matrix(pa.chunked_array([batch.column(0)]), d))
            total += x.T @ x
        cells = pa.array(np.arange(d * d))
        yield pa.RecordBatch.from_arrays([cells, pa.array(total.ravel())], ["cell", "value"])

    sums = vectors.select("embedding").mapInArrow(products, "cell long, value double")
    total = np.zeros(d * d)
    for row in sums.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        total[row.cell] = row.value
    energy, axes = np.linalg.eigh(total.reshape(d, d))
    return axes[:, np.argsort(-energy)]


def close_blocks(
    x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes (i, j) of rows of x and y with a cosine of ``threshold`` or more, at most
    ``PAIRS`` at a time; of one tile with itself (``same``) only i < j."""
    d = x.shape[1]
    stops = sorted({max(1, d // s) for s in STEPS})
    ux, uy = _unit(x), _unit(y)
    rx, ry = ux @ axes, uy @ axes

    def rest(r: np.ndarray, k: int) -> np.ndarray:
        return np.sqrt((r[:, k:] ** 2).sum(axis=1))

    first = stops[0]
    # The remaining norms as one more dimension: the product is the bound itself.
    bx = np.column_stack([rx[:, :first], rest(rx, first)]).astype(np.float32)
    by = np.column_stack([ry[:, :first], rest(ry, first)]).astype(np.float32)
    for at in range(0, len(x), BLOCK):
        low = at if same else 0
        i, j = np.nonzero(bx[at : at + BLOCK] @ by[low:].T >= threshold - SLACK)
        i, j = i + at, j + low
        if same:
            i, j = i[i < j], j[i < j]
        for p in range(0, len(i), PAIRS):
            a, b = i[p : p + PAIRS], j[p : p + PAIRS]
            partial = np.einsum("ij,ij->i", rx[a, :first], ry[b, :first])
            done = first
            for stop in stops[1:]:
                partial += np.einsum("ij,ij->i", rx[a, done:stop], ry[b, done:stop])
                done = stop
                keep = partial + rest(rx[a], done) * rest(ry[b], done) >= threshold - SLACK
                a, b, partial = a[keep], b[keep], partial[keep]
            keep = np.einsum("ij,ij->i", ux[a], uy[b]) >= threshold
            yield a[keep], b[keep]


def close_pairs(
    x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``close_blocks`` together."""
    none = np.empty(0, dtype=np.int64)
    blocks = [(none, none), *close_blocks(x, y, axes, threshold, same)]
    return tuple(np.concatenate(part) for part in zip(*blocks, strict=True))


def _merged(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``roots`` (of each row the least row it reaches so far) with the links (i, j)
    added. Links within what is one already cost a look-up each."""
    a, b = roots[i], roots[j]
    apart = a != b
    a, b = a[apart], b[apart]
    if not len(a):
        return roots
    low = np.arange(len(roots))
    while True:
        least = low.copy()
        np.minimum.at(least, a, low[b])
        np.minimum.at(least, b, low[a])
        if (least == low).all():
            return low[roots]
        low = least


def linked_rows(
    x: np.ndarray, tile: np.ndarray, a: int, b: int, copies: np.ndarray, axes: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Of each row how many vectors it links with across tiles ``a`` and ``b`` (with
    ``copies``), and the least row it reaches. The pairs are counted as they are found:
    of all of them at most ``PAIRS`` are held."""
    left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
    links, roots = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for i, j in close_blocks(x[left], x[right], axes, threshold, a == b):
        i, j = left[i], right[j]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        roots = _merged(roots, i, j)
    return links, roots


def with_tiles(reps: DataFrame, axis: np.ndarray, threshold: float, rows: int) -> DataFrame:
    """``reps`` (embedding) with tile and a column ``near``, the tiles that can hold a
    vector linked with it, its own among them.

    The places on the ``axis`` are divided at their quantiles, so a tile has about
    ``rows`` vectors. Those at one place of the axis that fill several tiles are dealt
    over them by their hash. Some 8 bytes a tile reach the driver.
    """
    names, d = reps.columns, len(axis)
    schema = ", ".join(f"{name} {kind}" for name, kind in reps.dtypes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(pa.chunked_array([batch.column("embedding")]), d))
                columns = [batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(x @ axis)], [*names, "_place"])

    placed = written(reps.mapInArrow(place, f"{schema}, _place double"), "places")
    count = placed.count()
    tiles = max(1, -(-count // rows))
    if tiles == 1:
        return placed.withColumn("tile", F.lit(0)).withColumn("near", F.array(F.lit(0))).drop("_place")
    shares = [k / tiles for k in range(1, tiles)]
    # The error of a quantile is a small part of a tile, up to 50,000 tiles.
    accuracy = min(max(20 * tiles, 10_000), 1_000_000)
    edges = placed.select(F.percentile_approx("_place", shares, accuracy)).first()[0]
    spread = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK

    def tile_of(place: np.ndarray, side: str) -> np.ndarray:
        return np.searchsorted(edges, place, side)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, by = batch.column("_place").to_numpy(), batch.column("_hash").to_numpy()
            # Of tiles that begin and end at this place, any.
            low, high = tile_of(place, "left"), tile_of(place, "right")
            tile = low + by % (high - low + 1)
            first, last = tile_of(place - spread, "left"), tile_of(place + spread, "right")
            keep = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*keep, *(pa.array(v.astype(np.int32)) for v in (tile, first, last))],
                [*names, "tile", "_first", "_last"],
            )

    hashed = placed.withColumn("_hash", F.pmod(F.xxhash64("embedding"), F.lit(1 << 31)))
    dealt = hashed.mapInArrow(deal, f"{schema}, tile int, _first int, _last int")
    return dealt.select(*reps.columns, "tile", F.sequence("_first", "_last").alias("near"))


def _compare(reps: DataFrame, d: int, threshold: float) -> DataFrame:
    """(id, links, root) per vector and pair of tiles in which it has links."""
    axes = principal_axes(reps, d)
    own = F.col("tile")
    meetings = F.transform(
        "near", lambda t: F.struct(F.least(own, t).alias("a"), F.greatest(own, t).alias("b"))
    )
    placed = with_tiles(reps.select("id", "copies", "embedding"), axes[:, 0], threshold, TILE).select(
        "id", "copies", "embedding", "tile", F.explode(meetings).alias("m")
    )

    def meet(table: pa.Table) -> pa.Table:
        # By id, so that the least row is that of the smallest id.
        table = table.sort_by("id")
        ids, copies, tile = (table.column(c).to_numpy() for c in ("id", "copies", "tile"))
        x = _matrix(table.column("embedding"), d)
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        links, roots = linked_rows(x, tile, a, b, copies, axes, threshold)
        keep = links > 0
        return pa.table({"id": ids[keep], "links": links[keep], "root": ids[roots][keep]})

    return (
        placed.select("id", "copies", "embedding", "tile", "m.a", "m.b")
        .groupBy("a", "b")
        .applyInArrow(meet, "id long, links long, root long")
    )


def cosine_components(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of a cosine of
    ``threshold`` or more), component_id (the smallest vec_id reachable by links,
    itself included) and kept (vec_id is component_id).

    ``vectors`` has vec_id and embedding (an array of numbers); other columns are
    ignored. A vector that is null, empty or zero, or has a null, NaN or infinite
    component, links with nothing, nor do vectors of different lengths. Equal
    vectors are compared once and count as often as they occur. Rows that share a
    vec_id are one vector with the links of all. A row without vec_id links with
    nothing. Every two tiles of a bounded number of vectors that can hold a link meet in
    one task, which passes on link counts and at most one edge per vector, never the
    pairs, and does not hold them all.
    """
    valid = vectors.where("vec_id IS NOT NULL").where(usable(F.col("embedding")))
    valid = valid.select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding"
    )
    valid = written(valid, "vectors")
    reps = valid.groupBy("embedding").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")
    )
    reps = written(reps.select("id", "copies", "embedding", F.size("embedding").alias("d")), "reps")
    met = None
    # Lengths of vectors in one table are few.
    for row in reps.select("d").distinct().collect():
        part = _compare(reps.where(F.col("d") == row.d).drop("d"), row.d, threshold)
        met = part if met is None else met.union(part)
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if met is None:
        return ids.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    met = written(met, "tile-links")
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    # Copies are linked to the first of them and have its links.
    several = reps.where("copies > 1").select(
        F.col("id").alias("_rep"), F.col("copies"), F.col("embedding").alias("_vector")
    )
    copies = written(
        valid.join(several, F.col("embedding") == F.col("_vector")).select(
            "vec_id", "_rep", "copies"
        ),
        "copies",
    )
    edges = met.select(F.col("id").alias("a"), F.col("root").alias("b")).union(
        copies.select("vec_id", "_rep")
    )
    component = connected_components(edges.where("a != b"))
    # A copy's links are those of the first and the other copies.
    of_copies = copies.join(links, F.col("_rep") == F.col("id"), "left").select(
        F.col("vec_id").alias("_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
    )
    of_singles = links.join(several, F.col("id") == F.col("_rep"), "left_anti").select(
        F.col("id").alias("_id"), F.col("links").alias("n")
    )
    counts = of_copies.union(of_singles).groupBy("_id").agg(F.max("n").alias("n"))
    component = component.select(F.col("id").alias("_node"), "component")
    out = ids.join(counts, F.col("vec_id") == F.col("_id"), "left").join(
        component, F.col("vec_id") == F.col("_node"), "left"
    )
    found = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        found.alias("component_id"),
        F.coalesce(F.col("vec_id") == found, F.lit(True)).alias("kept"),
    )
