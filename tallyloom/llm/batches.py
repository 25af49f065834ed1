"""Arrow batches in pieces that a Python worker can hold as objects."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# Rows turned into Python objects at a time.
ROWS = 500


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in order, at most ``rows`` at a time."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
