"""Packing of documents along a space-filling curve.

Each document's token counts are hashed to a vector, the vector is projected to
a few dimensions, and its place on the Hilbert curve is its sort key. Documents
are range-sorted by it and laid end to end along the curve, cut every LENGTH
tokens: neighbours in a sequence are alike, and no sequence is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces
from tallyloom.llm.tokens import encoder, short_ids, vocabulary_paths
from tallyloom.llm.words import mix, seed
from tallyloom.sources.scratch import written

LENGTH = 1024
DIMENSIONS, BITS, BUCKETS = 3, 16, 1024
# Tokens of a range partition: what one task packs, and the unit that loses its
# remainder to shorter sequences.
TASK_TOKENS = 8_000_000
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (n, d), each coordinate of ``bits`` bits, on the
    Hilbert curve through their grid. bits * d may be 63 at most."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    high = 1 << (bits - 1)
    # Undo the rotations and reflections from the coarsest cell down.
    q = high
    while q > 1:
        low = q - 1
        for k in range(d):
            up = (x[k] & q) != 0
            x[0] = np.where(up, x[0] ^ low, x[0])
            swap = np.where(up, 0, (x[0] ^ x[k]) & low)
            x[0] ^= swap
            x[k] ^= swap
        q >>= 1
    # Gray decoding over the dimensions, then over the bits.
    for k in range(1, d):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    q = high
    while q > 1:
        flip = np.where((x[d - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(d):
            key = (key << 1) | ((x[k] >> bit) & 1)
    return key


def _signs(buckets: int, dimensions: int) -> np.ndarray:
    """A fixed random sign for every bucket and dimension."""
    cells = np.arange(buckets * dimensions, dtype=np.uint64)
    return np.where(mix(cells ^ seed(701)) & np.uint64(1), 1.0, -1.0).reshape(buckets, dimensions)


def curve_keys(documents: list[np.ndarray], dimensions: int, bits: int, buckets: int) -> np.ndarray:
    """Curve places of documents given as token ids."""
    vectors = np.zeros((len(documents), buckets))
    for k, ids in enumerate(documents):
        vectors[k] = np.log1p(np.bincount(ids % buckets, minlength=buckets))
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    projected = (vectors / np.maximum(norms, 1e-12)) @ _signs(buckets, dimensions)
    # About normal with unit variance, whatever the corpus: a fixed squash to the grid.
    grid = np.minimum((1 << bits) - 1, (1 << bits) / (1 + np.exp(-2 * projected)))
    return hilbert_keys(grid.astype(np.int64), bits)


def tokenised(documents: DataFrame, paths: tuple[str, str], end_id: int | None) -> DataFrame:
    """(row, doc_id, n, curve, ids) of every document: ids as little-endian 16-bit
    numbers, with ``end_id`` after them; a null text is empty. ``row`` tells
    repeated rows apart."""
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("curve", pa.int64()),
            ("ids", pa.binary()),
        ]
    )
    last = [] if end_id is None else [end_id]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder(paths)
        for batch in pieces(batches):
            texts = batch.column(2).to_pylist()
            ids = [short_ids(np.append(tokens_of(t or ""), last)) for t in texts]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array(curve_keys(ids, DIMENSIONS, BITS, BUCKETS), pa.int64()),
                pa.array([x.tobytes() for x in ids], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
    return rows.mapInArrow(encode, "row long, doc_id long, n long, curve long, ids binary")


class _Packer:
    """Lays pieces end to end; sequences are numbered within a task."""

    def __init__(self, length: int, first_id: int):
        self.length, self.next_id = length, first_id
        self.open: list[tuple] = []  # (doc_id, doc_tokens, start, ids) of the open sequence
        self.fill = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            part = ids[at : at + self.length - self.fill]
            self.open.append((doc_id, len(ids), at, part))
            self.fill += len(part)
            at += len(part)
            if self.fill == self.length:
                self._close(self.open)
                self.open, self.fill = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, total, start, ids in pieces:
            data = ids.astype("<u4").tobytes()
            crc = zlib.crc32(data)
            self.rows.append((doc_id, start, len(ids), crc, total, self.next_id, offset, data))
            offset += len(ids)
        self.next_id += 1

    def finish(self) -> None:
        """The rest goes to sequences of a power of two each, which need no padding."""
        while self.fill:
            size = 1 << (self.fill.bit_length() - 1)
            taken, left, need = [], [], size
            for doc_id, total, start, ids in self.open:
                cut = ids[:need]
                if len(cut):
                    taken.append((doc_id, total, start, cut))
                if len(ids) > len(cut):
                    left.append((doc_id, total, start + len(cut), ids[len(cut) :]))
                need -= len(cut)
            self._close(taken)
            self.open, self.fill = left, self.fill - size


def packed(
    documents: DataFrame,
    length: int = LENGTH,
    paths: tuple[str, str] | None = None,
    end_id: int | None = 0,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document in a sequence: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and the piece's ids (unsigned
    little-endian 32-bit; null without ``with_ids``).

    Every token lies in one piece. Sequences hold ``length`` tokens; what is left
    of a task's documents goes to sequences of a power of two. Only doc_id and
    text are read; a null or empty text is the ``end_id`` alone. Repeated rows are
    packed each on its own. Documents are encoded once, then range-partitioned by
    curve place, id and row, so equal places (copies) can lie in any number of
    tasks.
    """
    paths = paths or vocabulary_paths()
    ids = written(tokenised(documents, paths, end_id), "token-ids", "zstd")
    total = ids.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-total // TASK_TOKENS))
    order = ["curve", "doc_id", "row"]
    placed = ids.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = pa.schema(
        [(n, pa.int64()) for n in PIECE_SCHEMA.replace(" long", "").split(", ")[:-1]]
        + [("ids", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(length, TaskContext.get().partitionId() << 40)

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [[]] * len(schema)
            if not with_ids:
                columns[-1] = [None] * len(packer.rows)
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
                schema=schema,
            )

        for batch in pieces(batches):
            for doc_id, data in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                packer.add(doc_id, np.frombuffer(data, dtype="<u2"))
                if len(packer.rows) > 2_000:
                    yield rows()
        packer.finish()
        yield rows()

    return placed.select("doc_id", "ids").mapInArrow(pack, PIECE_SCHEMA)
