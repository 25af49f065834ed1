"""Exact Jaccard self-join of documents on word shingles.

Universe partition and pigeonhole: tokens (shingles) are hashed into segments,
as many as one more than the tokens in which two linked sets of a size band can
differ, so two linked sets agree in a whole segment. A document looks up only as
many segments as its own size needs, those with the rarest tokens; where that
leaves only common or empty segments it looks up instead, in a few segments kept
for it, all sets that differ by one token (one-deletion neighbourhoods), each of
which counts for two. Sets that meet in a lookup form candidate clusters; within
a cluster all links are verified on the sets themselves.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces
from tallyloom.llm.components import connected_components
from tallyloom.llm.words import mix, seed, shingle_sets
from tallyloom.sources.scratch import drop_path, scratch_path, written

N, PERCENT = 5, 80
# Segments of a band for which one-deletion neighbourhoods are indexed.
RESERVE, RESERVE_SHARE = 4, 0.02
# Shingles over which a task counts how common they are; signatures it gathers
# before it folds and emits them; expected signatures per byte of text and share
# of tokens that may differ; signatures per bucket; shingles that one verification
# task holds. They set the size of tasks and change no result.
COUNTED, FLUSH, PER_BYTE, BUCKET, BIN = 1_000_000, 1_500_000, 0.68, 50_000, 400_000
# A signature that no set looks up, but so many of those at hand have, goes into its
# bucket once, whatever their number.
FEW = 4
# Cost of looking up an empty segment: a share of all sets has it, whatever their tokens.
EMPTY = 1e12
LARGEST = 1 << 40

SIGNATURE_SCHEMA = (
    "kind int, doc_id long, n long, h1 long, h2 long, bucket int, keys binary, records binary"
)


class Bands:
    """Size bands: two linked sets lie in one band or in neighbouring ones."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [1]
        while self.bounds[-1] < LARGEST:
            self.bounds.append(self.bounds[-1] * 100 // percent + 1)

    def of(self, n: int) -> int:
        return bisect_right(self.bounds, n) - 1

    def difference(self, total: int) -> int:
        """The most tokens in which two linked sets of ``total`` tokens differ."""
        return (100 - self.percent) * total // (100 + self.percent)

    def segments(self, band: int) -> int:
        """One more than the most difference of a set in ``band`` and a larger one."""
        top = self.bounds[band + 1] - 1
        return self.difference(top + top * 100 // self.percent) + 1


def reserve(segments: int) -> int:
    return min(segments, max(RESERVE, int(RESERVE_SHARE * segments)))


def allocate(
    exactly: np.ndarray, nearly: np.ndarray, need: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which segments to look up, and which of those also up to one deletion.

    ``exactly`` is the expected cost of looking up each segment, ``nearly`` that of
    the first few up to a deletion. An exact lookup counts 1 towards ``need``, one
    up to a deletion 2. The cheapest exact lookups come first; then the costliest
    of them is given up as long as a deletion elsewhere costs less.
    """
    order = np.argsort(exactly, kind="stable")[:need]
    exact = np.zeros(len(exactly), dtype=bool)
    exact[order] = True
    once = np.zeros(len(exactly), dtype=bool)
    last = len(order) - 1
    for i in np.argsort(nearly, kind="stable"):
        while last >= 0 and once[order[last]]:
            last -= 1
        if last < 0 or order[last] == i or nearly[i] >= exactly[order[last]]:
            break
        if exact[i]:
            once[i], exact[order[last]] = True, False
            last -= 1
    return exact, once


def _keys(sums: np.ndarray, segment: np.ndarray, band: int, space: int, active) -> np.ndarray:
    place = mix(segment.astype(np.uint64) ^ seed(203, band, space))
    return (mix(sums + place) & ~np.uint64(1)) | np.asarray(active, dtype=np.uint64)


def _costs(others: np.ndarray, ends: np.ndarray, counts: np.ndarray, kept: int):
    """Expected cost of looking up each segment, and the first ``kept`` of them up
    to one deletion. ``others`` is, for the tokens by segment, in how many other
    sets each occurs: a segment meets at most the sets of its rarest token, and
    fewer the more tokens it has. An empty one meets more than any other, and so
    does one of a single token up to its deletion."""
    filled = counts > 0
    exactly = np.full(len(counts), EMPTY)
    exactly[filled] = np.minimum.reduceat(others, (ends - counts)[filled])
    exactly += 2.0 ** -counts.astype(float)
    nearly = np.full(kept, np.inf)
    for i in np.flatnonzero(filled[:kept]):
        rare = np.sort(others[ends[i] - counts[i] : ends[i]])
        c = len(rare)
        second = float(rare[1]) if c > 1 else EMPTY
        nearly[i] = 2 * ((c - 1) * float(rare[0]) + second) + (1 + 2 * c) * 2.0 ** (1 - c)
    return exactly, nearly


def _band_keys(
    s: np.ndarray, others: np.ndarray, band: int, m: int, need: int, index: bool
) -> list[np.ndarray]:
    """Signatures of a set in a band of ``m`` segments. The last bit tells lookups
    from what is only indexed."""
    segment = (mix(s ^ seed(201, band)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    values = mix(s ^ seed(202))[order]
    counts = np.bincount(segment, minlength=m)
    ends = np.cumsum(counts)
    total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
    sums = total[ends] - total[ends - counts]
    kept = reserve(m)
    exact, once = allocate(*_costs(others[order], ends, counts, kept), need)
    out = []
    if index:
        out.append(_keys(sums, np.arange(m), band, 0, exact))
        first = ends[kept - 1]
        owner = segment[order][:first]
        # Without its only token a segment is empty, and none is looked up from there.
        rest = counts[owner] > 1
        out.append(_keys((sums[owner] - values[:first])[rest], owner[rest], band, 1, 0))
    else:
        chosen = np.flatnonzero(exact)
        out.append(_keys(sums[chosen], chosen, band, 0, 1))
    for i in np.flatnonzero(once):
        own = np.full(counts[i], i)
        out.append(_keys(sums[i : i + 1], np.array([i]), band, 1, 1))
        out.append(_keys(sums[i] - values[ends[i] - counts[i] : ends[i]], own, band, 0, 1))
    return out


def signatures(s: np.ndarray, others: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of a set: those it is found by and those it looks up.
    ``others`` tells how many other sets seen with it hold each token; it decides
    what is looked up, never what is found."""
    n = len(s)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    band = bands.of(n)
    out = []
    m = bands.segments(band)
    if m > 1:
        out += _band_keys(s, others, band, m, bands.difference(2 * n) + 1, True)
    if band:
        below = bands.bounds[band] - 1
        m = bands.segments(band - 1)
        if m > 1 and 100 * below >= bands.percent * n:
            out += _band_keys(s, others, band - 1, m, bands.difference(n + below) + 1, False)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def fold(keys: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges from each record of a looked-up signature to the smallest of them
    (two columns), and the signatures left: one of each that was looked up, all of
    those that were not."""
    order = np.argsort(keys, kind="stable")
    keys, records = keys[order], records[order]
    group = keys >> np.uint64(1)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(keys) else order
    if not len(starts):
        return np.empty((0, 2), dtype=np.int64), keys, records
    sizes = np.diff(np.append(starts, len(keys)))
    pivot = np.minimum.reduceat(records, starts)
    active = np.maximum.reduceat(keys & np.uint64(1), starts).astype(bool)
    meets = np.repeat(active & (sizes > 1), sizes)
    edges = np.stack([records[meets], np.repeat(pivot, sizes)[meets]], axis=1)
    edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
    passive = ~np.repeat(active, sizes)
    left = (group[starts[active]] << np.uint64(1)) | np.uint64(1)
    return (
        edges,
        np.concatenate([left, keys[passive]]),
        np.concatenate([pivot[active], records[passive]]),
    )


def gathered(
    keys: np.ndarray, records: np.ndarray, few: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The signatures with those that are only indexed, and by ``few`` sets or more,
    once each: under a node of its own instead of a set. Also the nodes and the sets
    of each. A node follows from its signature, so all tasks give it the same one."""
    order = np.lexsort((records, keys))
    keys, records = keys[order], records[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (records[1:] != records[:-1]))
    keys, records = keys[new[: len(keys)]], records[new[: len(keys)]]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    sizes = np.diff(np.append(starts, len(keys)))
    many = (sizes >= few) & (keys[starts] & np.uint64(1) == 0)
    nodes = mix(keys[starts[many]] ^ seed(205)).view(np.int64)
    members = [records[a : a + k] for a, k in zip(starts[many], sizes[many], strict=True)]
    alone = ~np.repeat(many, sizes)
    return (
        np.concatenate([keys[alone], keys[starts[many]]]),
        np.concatenate([records[alone], nodes]),
        nodes,
        members,
    )


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    size = np.uint64(len(s))
    with np.errstate(over="ignore"):
        halves = np.array(
            [mix(mix(s ^ seed(204 + k)).sum(dtype=np.uint64) + size) for k in range(2)]
        )
    return tuple(halves.astype(np.uint64).view(np.int64).tolist())


def _signature_rows(documents: DataFrame, n: int, bands: Bands, buckets: int) -> DataFrame:
    """Rows of four kinds: 0, a document with its set's size and digest; 1, the
    signatures of one bucket; 2, an edge between two sets (h1, h2); 3, the sets
    (records) behind a node (h1)."""
    schema = pa.schema(
        [
            ("kind", pa.int32()),
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("h1", pa.int64()),
            ("h2", pa.int64()),
            ("bucket", pa.int32()),
            ("keys", pa.binary()),
            ("records", pa.binary()),
        ]
    )

    def batch_of(kind: int, size: int, **columns) -> pa.RecordBatch:
        arrays = [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
            for f in schema
        ]
        arrays[0] = pa.array(np.full(size, kind, dtype=np.int32))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def emit(keys: list[np.ndarray], records: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        edges, k, r = fold(np.concatenate(keys), np.concatenate(records))
        if len(edges):
            yield batch_of(2, len(edges), h1=edges[:, 0].copy(), h2=edges[:, 1].copy())
        k, r, nodes, members = gathered(k, r, FEW)
        for lo in range(0, len(nodes), 4096):
            blobs = [x.tobytes() for x in members[lo : lo + 4096]]
            yield batch_of(3, len(blobs), h1=nodes[lo : lo + 4096].copy(), records=blobs)
        bucket = ((k >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        k, r = k[order], r[order]
        found, at = np.unique(bucket[order], return_index=True)
        ends = np.append(at[1:], len(k))
        # Within a bucket 31 bits of a signature and the last bit tell enough: a chance
        # meeting is one more candidate.
        k = ((k >> np.uint64(32)) << np.uint64(1) | (k & np.uint64(1))).astype(np.uint32)
        blobs = [[x[a:b].tobytes() for a, b in zip(at, ends, strict=True)] for x in (k, r)]
        for lo in range(0, len(found), 256):
            hi = min(lo + 256, len(found))
            yield batch_of(
                1,
                hi - lo,
                bucket=found[lo:hi].astype(np.int32),
                keys=blobs[0][lo:hi],
                records=blobs[1][lo:hi],
            )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, digests, tokens = [], [], 0
        keys, records, held = [], [], 0

        def sign_sets() -> None:
            """Signatures of the sets at hand; how common a token is among them
            estimates how common it is."""
            nonlocal sets, digests, tokens, held
            flat = np.concatenate(sets)
            _, token, seen = np.unique(flat, return_inverse=True, return_counts=True)
            others = seen[token] - 1
            at = 0
            for s, a in zip(sets, digests, strict=True):
                own = signatures(s, others[at : at + len(s)], bands)
                at += len(s)
                keys.append(own)
                records.append(np.full(len(own), a, dtype=np.int64))
                held += len(own)
            sets, digests, tokens = [], [], 0

        for batch in pieces(batches):
            sizes, h1, h2 = [], [], []
            for s in shingle_sets(batch.column(1), n):
                a, b = _digest(s)
                sizes.append(len(s))
                h1.append(a)
                h2.append(b)
                if len(s):
                    sets.append(s)
                    digests.append(a)
                    tokens += len(s)
                if tokens >= COUNTED:
                    sign_sets()
                if held >= FLUSH:
                    yield from emit(keys, records)
                    keys, records, held = [], [], 0
            ids = batch.column(0).to_pylist()
            yield batch_of(0, len(sizes), doc_id=ids, n=sizes, h1=h1, h2=h2)
        if sets:
            sign_sets()
        if held:
            yield from emit(keys, records)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sign, SIGNATURE_SCHEMA)


def _candidate_edges(signed: DataFrame) -> DataFrame:
    """Edges (a, b) between sets that meet in a signature, some of them by a node.

    Of a signature that many sets share a bucket holds one row per task and fold
    of its signatures if some set there looks it up, fewer than ``FEW`` if none
    does. The sets behind a node are fetched, as plain rows, only where a set of
    another fold looked its signature up.
    """

    def meet(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype=np.uint32)
        keys = keys.astype(np.uint64)
        records = np.frombuffer(b"".join(table.column("records").to_pylist()), dtype=np.int64)
        edges, _, _ = fold(keys, records)
        return pa.table({"a": edges[:, 0].copy(), "b": edges[:, 1].copy()})

    buckets = signed.where("kind = 1").select("bucket", "keys", "records")
    met = buckets.groupBy("bucket").applyInArrow(meet, "a long, b long")
    early = signed.where("kind = 2").select(F.col("h1").alias("a"), F.col("h2").alias("b"))
    edges = written(met.union(early).distinct(), "candidates")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, blob in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                sets = np.frombuffer(blob, dtype=np.int64)
                yield pa.RecordBatch.from_pydict({"a": sets, "b": np.full(len(sets), node)})

    behind = signed.where("kind = 3").select("h1", "records")
    ends = edges.select(F.explode(F.array("a", "b")).alias("node"))
    met_nodes = behind.select(F.col("h1").alias("node")).distinct().join(ends, "node", "left_semi")
    met_nodes = written(met_nodes, "met-nodes")
    behind = behind.join(met_nodes, F.col("h1") == F.col("node"), "left_semi")
    return edges.union(written(behind.mapInArrow(unpack, "a long, b long"), "behind-nodes"))


def link_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """A component label for each set, by links of at least ``percent`` Jaccard.

    Sets are taken by size. Tokens are ordered from rare to frequent; two linked
    sets share one of their rarest, so only sets that do are compared, and only
    while they are not yet connected.
    """
    count = len(sets)
    labels = np.arange(count)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    by_size = np.argsort(sizes, kind="stable")
    sizes = sizes[by_size]
    flat = np.concatenate([sets[k] for k in by_size]) if count else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(count), sizes)
    _, token, frequency = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(frequency), dtype=np.int64)
    rank[np.argsort(frequency, kind="stable")] = np.arange(len(frequency))
    ranked = rank[token]
    ranked = ranked[np.lexsort((ranked, owner))]
    begins = np.cumsum(sizes) - sizes
    prefix = sizes - -(-percent * sizes // 100) + 1
    repeated = np.sort(frequency)[ranked] > 1
    head = (np.arange(len(ranked)) - begins[owner] < prefix[owner]) & repeated
    head_token, head_owner = ranked[head], owner[head]
    order = np.lexsort((head_owner, head_token))
    posted = head_owner[order]
    # For each set's head entries, where its token's list begins and where the set stands in it.
    list_token = head_token[order]
    list_begin = np.searchsorted(list_token, list_token, "left")
    where_first, where_own = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    where_first[order], where_own[order] = list_begin, np.arange(len(order))
    head_bounds = np.searchsorted(head_owner, np.arange(count + 1))
    marked = np.zeros(len(frequency), dtype=bool)
    for d in range(count):
        lists = [
            posted[where_first[e] : where_own[e]] for e in range(head_bounds[d], head_bounds[d + 1])
        ]
        lists = [x for x in lists if len(x)]
        if not lists:
            continue
        others = np.unique(np.concatenate(lists))
        others = others[(100 * sizes[others] >= percent * sizes[d]) & (labels[others] != labels[d])]
        own = ranked[begins[d] : begins[d] + sizes[d]]
        marked[own] = True
        while len(others):
            some, others = others[:32], others[32:]
            lengths = sizes[some]
            stops = np.cumsum(lengths)
            at = np.arange(stops[-1]) + np.repeat(begins[some] - stops + lengths, lengths)
            common = np.add.reduceat(marked[ranked[at]].astype(np.int64), stops - lengths)
            linked = 100 * common >= percent * (sizes[d] + lengths - common)
            for label in np.unique(labels[some[linked]]):
                labels[labels == label] = labels[d]
            others = others[labels[others] != labels[d]]
        marked[own] = False
    out = np.empty(count, dtype=np.int64)
    out[by_size] = labels
    return out


def _verified_edges(
    documents: DataFrame, sets: DataFrame, clusters: DataFrame, n: int, percent: int
) -> DataFrame:
    """Edges (a, b) between documents, at most one per document and task, whose
    components are those of the links.

    Each candidate cluster is verified in one task, several small ones together.
    One that is too large is cut into tiles by size band, and every two tiles of
    one band or of neighbouring bands meet in a task.
    """
    members = clusters.join(sets, F.col("id") == F.col("h1")).select(
        F.col("rep").alias("_rep"),
        F.col("component").alias("cluster"),
        "n",
        F.size(F.filter(F.lit(Bands(percent).bounds), lambda b: b <= F.col("n"))).alias("band"),
    )
    members = written(members, "members")
    # For each cluster its size and the tiles of each of its bands, which are few.
    tiles = F.ceil(F.col("size") / BIN).cast("int")
    sizes = members.groupBy("cluster", "band").agg(F.sum("n").alias("size"))
    sizes = sizes.groupBy(F.col("cluster").alias("_cluster")).agg(
        F.sum("size").alias("size"),
        F.map_from_entries(F.collect_list(F.struct("band", tiles))).alias("tiles"),
    )
    sizes = written(sizes, "cluster-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    bins = max(1, -(-total // BIN))

    def tiles_of(band: Column) -> Column:
        return F.coalesce(F.element_at("tiles", band), F.lit(0))

    band, no = F.col("band"), F.lit(-1)
    own = F.pmod(F.xxhash64("_rep", F.lit("tile")), tiles_of(band)).cast("int")

    def task(low: Column, a: Column, high: Column, b: Column) -> Column:
        return F.struct(
            F.col("cluster").alias("bin"),
            low.alias("low"),
            a.alias("tile_a"),
            high.alias("high"),
            b.alias("tile_b"),
        )

    def each(band: Column, make) -> Column:
        none = F.array().cast("array<int>")
        count = tiles_of(band)
        return F.transform(
            F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(none),
            make,
        )

    together = F.array(
        F.struct(
            F.pmod(F.xxhash64("cluster"), F.lit(bins)).alias("bin"),
            no.alias("low"),
            no.alias("tile_a"),
            no.alias("high"),
            no.alias("tile_b"),
        )
    )
    apart = F.concat(
        each(band, lambda t: task(band, F.least(own, t), band, F.greatest(own, t))),
        each(band + 1, lambda t: task(band, own, band + 1, t)),
        each(band - 1, lambda t: task(band - 1, t, band, own)),
    )
    placed = members.join(sizes, F.col("cluster") == F.col("_cluster")).select(
        "_rep", F.explode(F.when(F.col("size") <= BIN, together).otherwise(apart)).alias("task")
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(placed, F.col("doc_id") == F.col("_rep")).select("doc_id", "text", "task.*")

    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        labels = link_sets(list(shingle_sets(table.column("text"), n)), percent)
        root = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(root, labels, ids)
        root = root[labels]
        keep = ids != root
        return pa.table({"a": ids[keep], "b": root[keep]})

    return texts.groupBy("bin", "low", "tile_a", "high", "tile_b").applyInArrow(
        verify, "a long, b long"
    )


def jaccard_components(documents: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set) and component_id,
    the smallest doc_id reachable by links, itself included.

    A word is a run of bytes other than white space (space, 0x09-0x0D), A-Z in
    lower case. A set holds the distinct shingles of ``n`` words, of fewer words
    the whole run; two documents link if they share ``percent`` of a hundred or
    more of their union. Shingles are compared by 64-bit hashes. Texts that are
    null, empty or without words link with nothing. Equal sets are joined to
    their smallest doc_id first and then count as one. Rows that share a doc_id
    are one document with the links of all; a row without doc_id links with
    nothing and has no component. Only doc_id and text are read.
    """
    bands = Bands(percent)
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(size * PER_BYTE * (100 - percent) / (100 + percent) / BUCKET))
    path = scratch_path(spark, "signatures")
    _signature_rows(documents, n, bands, buckets).write.option("compression", "zstd").parquet(path)
    signed = spark.read.schema(SIGNATURE_SCHEMA).parquet(path)
    rows = written(signed.where("kind = 0").select("doc_id", "n", "h1", "h2"), "digests")
    candidates = _candidate_edges(signed)
    # The largest table by far, and of no more use.
    drop_path(spark, path)
    sets = (
        rows.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    )
    sets = written(sets, "sets")
    clusters = connected_components(candidates)
    edges = _verified_edges(documents, sets, clusters, n, percent)
    # Rows of one doc_id and different texts are one document.
    same = rows.where("n > 0 AND doc_id IS NOT NULL").join(
        sets.select("h1", "h2", "rep"), ["h1", "h2"]
    )
    same = same.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    linked = connected_components(edges.union(same))
    out = rows.join(
        linked.select(F.col("id").alias("_id"), "component"), F.col("doc_id") == F.col("_id"), "left"
    )
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
