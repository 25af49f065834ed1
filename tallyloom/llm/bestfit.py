"""Token-id matrices packed by best-fit decreasing.

Documents longer than a row are cut into whole rows and a rest; the rests of a
task's documents, longest first, go to the fullest row that still has room,
found in a segment tree over free capacity. Rows are written as fixed-width
binary with the cumulative lengths of their segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces
from tallyloom.llm.tokens import encoder, short_ids, vocabulary_paths

LENGTH = 1024
# Tokens that a task gathers before it packs them: bounds its memory.
WINDOW_TOKENS = 8_000_000
# Rows handed to Spark at a time.
OUT_ROWS = 1_000
ROW_SCHEMA = (
    "sequence_id long, ids binary, n_tokens int, doc_ids array<long>, starts array<long>, "
    "cu_seqlens array<int>, position_resets array<int>"
)


class CapacityTree:
    """Open rows by free capacity; finds the least capacity that is large enough."""

    def __init__(self, largest: int):
        self.leaves = 1 << largest.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(largest + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove a row of the smallest free capacity of at least ``need``."""
        node = need + self.leaves
        if not self.count[node]:
            # Up until a right sibling holds a row, then down to its leftmost.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Indexes of the items in each row of ``size``; lengths are 1 to ``size``.
    Ties go by index."""
    rows: list[list[int]] = []
    tree = CapacityTree(size)
    for k in np.argsort(-lengths, kind="stable"):
        n = int(lengths[k])
        free, row = tree.take(n) or (size, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(int(k))
        if free > n:
            tree.put(free - n, row)
    return rows


def position_ids(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Positions that begin at 0 in every segment; 0 in the padding."""
    out = np.zeros(width, dtype=np.int64)
    for a, b in zip(cu_seqlens, cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out


def packed_rows(
    documents: DataFrame,
    length: int = LENGTH,
    paths: tuple[str, str] | None = None,
    end_id: int | None = 0,
) -> DataFrame:
    """One row per packed sequence: sequence_id, ids (``length`` unsigned
    little-endian 16-bit ids, zero-padded), n_tokens, and for each segment its
    doc_id, its start in the document's ids, cu_seqlens (one more entry) and
    position_resets (where positions begin at 0 again).

    Each task packs what it reads, a window of tokens at a time, so nothing is
    shuffled. Every id of every document lies in one segment. Only doc_id and
    text are read; a null or empty text is the ``end_id`` alone (without one, no
    row). Repeated rows are packed each on its own.
    """
    paths = paths or vocabulary_paths()
    last = [] if end_id is None else [end_id]
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    schema = pa.schema(
        [
            ("sequence_id", pa.int64()),
            ("ids", pa.binary()),
            ("n_tokens", pa.int32()),
            ("doc_ids", longs),
            ("starts", longs),
            ("cu_seqlens", ints),
            ("position_resets", ints),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder(paths)
        next_id = TaskContext.get().partitionId() << 40
        rests: list[tuple] = []
        rows: list[tuple] = []
        held = 0

        def close(segments: list[tuple]) -> None:
            nonlocal next_id
            ids = np.zeros(length, dtype="<u2")
            ends = np.cumsum([0] + [len(s[2]) for s in segments]).tolist()
            for a, b, s in zip(ends, ends[1:], segments, strict=False):
                ids[a:b] = s[2]
            docs, starts = [s[0] for s in segments], [s[1] for s in segments]
            rows.append((next_id, ids.tobytes(), ends[-1], docs, starts, ends, ends[:-1]))
            next_id += 1

        def pack_rests() -> Iterator[pa.RecordBatch]:
            nonlocal rests, held
            lengths = np.array([len(r[2]) for r in rests], dtype=np.int64)
            for row in best_fit_decreasing(lengths, length):
                close([rests[k] for k in row])
                if len(rows) >= OUT_ROWS:
                    yield out()
            rests, held = [], 0

        def out() -> pa.RecordBatch:
            nonlocal rows
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
                schema=schema,
            )

        for batch in pieces(batches):
            ids_texts = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for doc_id, text in ids_texts:
                ids = short_ids(np.append(tokens_of(text or ""), last))
                whole = len(ids) - len(ids) % length
                for at in range(0, whole, length):
                    close([(doc_id, at, ids[at : at + length])])
                if whole < len(ids):
                    rests.append((doc_id, whole, ids[whole:].copy()))
                    held += len(ids) - whole
                if held >= WINDOW_TOKENS:
                    yield from pack_rests()
                if len(rows) >= OUT_ROWS:
                    yield out()
        yield from pack_rests()
        yield out()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pack, ROW_SCHEMA)


def write_matrices(documents: DataFrame, path: str, **options) -> None:
    """Write ``packed_rows`` as Parquet at ``path``: fixed-width binary rows."""
    packed_rows(documents, **options).write.option("compression", "zstd").parquet(path)


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROW_SCHEMA).parquet(path)
