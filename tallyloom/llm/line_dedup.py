"""Repeated lines and passages, kept where they first occur.

Texts are divided into units: paragraphs, lines, or lines divided at the ends of
sentences. Each unit is normalised (lower case, runs of white space as one space)
and hashed; digests are grouped over all documents; the earliest occurrence, by
document id and then place, stays and all others are cut out of their texts.
Sentences are the default, as a passage that documents share often lies inside
a longer line.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces
from tallyloom.llm.text_columns import free_name
from tallyloom.sources.scratch import written

# Units of fewer words are not compared: headings, list marks, closing lines.
MIN_WORDS = 5
SEPARATORS = {"sentence": "\n", "line": "\n", "paragraph": "\n\n"}
SENTENCE_END = re.compile(r"[.!?]+(?=[ \t])")
# Sentences of more words are divided after words whose hash says so (one in eight),
# into parts of so many words or more.
LONG_SENTENCE, PART_WORDS, PART_EVERY = 16, 8, 8
WORD = re.compile(r"\S+")
UNIT_SCHEMA = (
    "doc_id long, text_key long, start int, length int, h1 long, h2 int, first_in_doc boolean"
)


def unit_spans(text: str, unit: str, min_words: int) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of the units of a text that have
    ``min_words`` words or more.

    A unit that is a whole line or paragraph ends after its separator. A sentence
    ends before the next one; one of too few words is joined to the next in its
    line, so that after one long sentence two copies of a passage are divided
    alike whatever surrounds them. A long sentence is divided after words chosen by
    their hash, so that an edit in one copy costs the parts around it.
    """
    separator = SEPARATORS[unit]
    at = 0
    for line in text.split(separator):
        end = min(at + len(line) + len(separator), len(text))
        marks = [m.end() for m in SENTENCE_END.finditer(line)] if unit == "sentence" else []
        begin = 0
        for mark in marks + [len(line)]:
            words = line[begin:mark].lower().split()
            if len(words) >= min_words:
                if unit == "sentence" and len(words) > max(LONG_SENTENCE, min_words):
                    for a, b, part in _parts(line, begin, mark, max(PART_WORDS, min_words)):
                        whole = a == 0 and b == len(line)
                        yield at + a, end if whole else at + b, part
                else:
                    whole = begin == 0 and mark == len(line)
                    yield at + begin, end if whole else at + mark, words
                begin = mark
        at = end


def _parts(line: str, begin: int, end: int, least: int) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of the parts of a long sentence, each of
    ``least`` words or more."""
    found = list(WORD.finditer(line, begin, end))
    # As lower() may depend on what follows, each part is lowered on its own.
    first, start = 0, begin
    for k in range(1, len(found) - least + 1):
        if k - first >= least and zlib.crc32(found[k - 1].group().lower().encode()) % PART_EVERY == 0:
            yield start, found[k - 1].end(), line[start : found[k - 1].end()].lower().split()
            first, start = k, found[k - 1].end()
    yield start, end, line[start:end].lower().split()


def units(documents: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """Every unit of ``min_words`` words or more: where it starts and how long it
    is in characters, with a 96-bit digest of its normalised text. Null and empty
    texts have none."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.int64()),
            ("start", pa.int32()),
            ("length", pa.int32()),
            ("h1", pa.int64()),
            ("h2", pa.int32()),
            ("first_in_doc", pa.bool_()),
        ]
    )
    digest_type = np.dtype([("h1", "<i8"), ("h2", "<i4")])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, keys, starts, lengths, firsts, digests = [], [], [], [], [], []
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for doc_id, key, text in rows:
                seen = set()
                for start, end, words in unit_spans(text or "", unit, min_words):
                    digest = hashlib.blake2b(" ".join(words).encode(), digest_size=12).digest()
                    ids.append(doc_id)
                    keys.append(key)
                    starts.append(start)
                    lengths.append(end - start)
                    digests.append(digest)
                    firsts.append(digest not in seen)
                    seen.add(digest)
            halves = np.frombuffer(b"".join(digests), dtype=digest_type)
            columns = [ids, keys, starts, lengths, halves["h1"], halves["h2"], firsts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(c) if isinstance(c, np.ndarray) else c, f.type)
                    for c, f in zip(columns, schema, strict=True)
                ],
                schema=schema,
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    return rows.mapInArrow(split, UNIT_SCHEMA)


def repeated_spans(
    documents: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS
) -> DataFrame:
    """For each document with units to remove: doc_id, text_key and ``removed``, an
    array of (start, length, kept_doc_id) in the original text, by start.

    A digest is one row per task in the aggregation; its occurrences are joined
    to the first one as plain tables, so that a unit that a third of all rows
    share is split over tasks. Documents are ranked by id, then by a hash of their
    texts, so different texts of one id, or of none, are different documents; rows that
    repeat an id and its text are the same one. A null id comes last.
    """
    last = F.lit((1 << 63) - 1)
    all_units = written(units(documents, unit, min_words), "units")
    # Both in one number, which hash aggregation can hold.
    text_part = F.col("text_key").bitwiseAND(F.lit((1 << 62) - 1))
    rank = F.coalesce("doc_id", last).cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)")
    rank = (rank + text_part.cast("decimal(19,0)")).cast("decimal(38,0)")
    firsts = (
        all_units.groupBy("h1", "h2")
        .agg(
            F.min(F.coalesce("doc_id", last)).alias("kept_id"),
            F.min(rank).alias("kept_rank"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .select("h1", "h2", "kept_id", "kept_rank")
    )
    firsts = written(firsts, "first-units")
    removed = all_units.join(firsts, ["h1", "h2"]).where(
        ~F.col("first_in_doc") | (rank != F.col("kept_rank"))
    )
    span = F.struct(
        "start",
        "length",
        F.when(F.col("kept_id") != last, F.col("kept_id")).alias("kept_doc_id"),
    )
    return removed.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(span)).alias("removed")
    )


def cut(text: Column, spans: Column) -> Column:
    """``text`` without the sorted, disjoint ``spans``."""
    begins = F.concat(
        F.array(F.lit(0)), F.transform(spans, lambda s: s["start"] + s["length"])
    )
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    return F.array_join(
        F.zip_with(begins, ends, lambda b, e: F.substring(text, b + F.lit(1), e - b)), ""
    )


def without_repeats(
    documents: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS
) -> DataFrame:
    """All rows and columns of ``documents`` with repeated units cut from ``text``,
    plus ``removed`` (spans of the original text; empty if nothing was cut; with
    an underscore before it if there is such a column already) as the last one.

    Texts without repeats, null ones included, are as they were. A text all of
    whose units occur earlier may become empty; its row stays.
    """
    spans = repeated_spans(documents, unit, min_words)
    spans = spans.toDF("span_doc", "span_key", "spans")
    joined = documents.join(
        spans,
        documents["doc_id"].cast("long").eqNullSafe(spans["span_doc"])
        & (F.xxhash64(documents["text"]) == spans["span_key"]),
        "left",
    )
    none = F.array().cast("array<struct<start:int,length:int,kept_doc_id:bigint>>")
    kept = F.when(spans["spans"].isNull(), documents["text"]).otherwise(
        cut(documents["text"], spans["spans"])
    )
    return joined.select(
        *[kept.alias(c) if c == "text" else documents[c] for c in documents.columns],
        F.coalesce(spans["spans"], none).alias(free_name(documents, "removed")),
    )
