"""Token counts of fields and sections, from one encoding of the whole document."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces
from tallyloom.llm.tokens import encoder, token_byte_lengths, vocabulary_paths

SPAN_SCHEMA = (
    "doc_id long, field string, section int, start long, end long, n_tokens long, "
    "n_crossing long"
)
RULES = ("first", "most")


def section_starts(data: np.ndarray, field_starts: np.ndarray) -> np.ndarray:
    """Where sections begin in a document's bytes: at a field's start and after
    each newline that is not a field's last byte."""
    after = np.flatnonzero(data == 10) + 1
    return np.union1d(field_starts, after[after < len(data)])


def allocate(
    starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, size: int, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """For each section, the tokens allocated to it and those of them that reach
    into another section.

    Tokens are byte spans, sections begin at ``sections`` and fill ``size``
    bytes. Rule ``first``: a token belongs to the section that holds its first
    byte. Rule ``most``: to the section that holds most of its bytes, the first
    of several.
    """
    own = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, ends - 1, "right") - 1
    crossing = last > own
    if rule == "most":
        bounds = np.append(sections, size)
        for k in np.flatnonzero(crossing):
            inside = np.arange(own[k], last[k] + 1)
            part = np.minimum(bounds[inside + 1], ends[k]) - np.maximum(bounds[inside], starts[k])
            own[k] = inside[np.argmax(part)]
    n = len(sections)
    return np.bincount(own, minlength=n), np.bincount(own[crossing], minlength=n)


def token_counts(
    documents: DataFrame,
    fields: Sequence[str] = ("text",),
    rule: str = "first",
    paths: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per section of each document: doc_id, field, section (from 0 within
    its document), start and end in characters of the whole document, n_tokens,
    and n_crossing, how many of them reach beyond the section.

    The whole document is the ``fields`` one after another, each but the last
    followed by a newline, which belongs to it; sections are the fields' lines,
    with their newlines. It is encoded once, so the counts add up to the length
    of that encoding. A null field is empty; an empty field is a section of no
    tokens. Repeated rows are counted each on its own.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    fields = list(fields)
    paths = paths or vocabulary_paths()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("field", pa.string()),
            ("section", pa.int32()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("n_tokens", pa.int64()),
            ("n_crossing", pa.int64()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of, sizes = encoder(paths), token_byte_lengths(paths)
        for batch in pieces(batches):
            out: list[list] = [[] for _ in schema]
            for doc_id, *texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [(t or "") + "\n" for t in texts]
                parts[-1] = parts[-1][:-1]
                whole = "".join(parts)
                data = np.frombuffer(whole.encode(), dtype=np.uint8)
                at = np.cumsum([0] + [len(p.encode()) for p in parts])
                begins = at[:-1]
                # Sections with bytes; a last field that is empty has none.
                sections = section_starts(data, begins[begins < len(data)])
                lengths = sizes[tokens_of(whole)]
                ends = np.cumsum(lengths)
                if len(ends) and ends[-1] != len(data):
                    raise ValueError(f"document {doc_id}: tokens do not cover the text")
                if len(sections):
                    n, crossing = allocate(ends - lengths, ends, sections, len(data), rule)
                else:
                    n = crossing = np.empty(0, dtype=np.int64)
                if begins[-1] == len(data):
                    sections = np.append(sections, len(data))
                    n, crossing = np.append(n, 0), np.append(crossing, 0)
                # Characters before each byte: all bytes that do not continue one.
                chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                bounds = chars[np.append(sections, len(data))]
                names = np.searchsorted(begins, sections, "right") - 1
                out[0] += [doc_id] * len(sections)
                out[1] += [fields[k] for k in names]
                out[2] += range(len(sections))
                out[3] += bounds[:-1].tolist()
                out[4] += bounds[1:].tolist()
                out[5] += n.tolist()
                out[6] += crossing.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, schema, strict=True)], schema=schema
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *fields)
    return rows.mapInArrow(count, SPAN_SCHEMA)
