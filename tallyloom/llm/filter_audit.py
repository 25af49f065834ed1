"""How five filters interact, in every order in which they can be applied.

Each document becomes a mask of the filters it fails. Documents of one part and
mask are one cell with its counts, at most 32 cells a part. A cell is folded along
each of the 120 orders, which stand in the plan as one constant array: at every step
it is either still there, leaves, or would have left had it not gone before. The
600 steps of a part's cells are added element by element.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.text_columns import let
from tallyloom.sources.scratch import written

LETTERS = "ABCDE"
# White space between words, as a class of Java's regular expressions.
BLANKS = r"[\x20\x09-\x0D]+"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
ODD_CHARACTERS = r"[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
# All orders, as places in LETTERS.
ORDERS = [list(o) for o in permutations(range(len(LETTERS)))]


def _text_mask(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that the text fails."""

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, BLANKS), lambda w: w != "")
        return let(
            words,
            lambda w: F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
            + F.when(
                100 * F.size(F.array_distinct(w)).cast("long")
                < DISTINCT_PERCENT * F.size(w).cast("long"),
                2,
            ).otherwise(0),
        ) + (
            F.when(
                100 * F.regexp_count(t, F.lit("[A-Z]")).cast("long")
                > CAPITAL_PERCENT * F.length(t).cast("long"),
                4,
            ).otherwise(0)
            + F.when(F.rlike(t, F.lit(ODD_CHARACTERS)), 8).otherwise(0)
        )

    return let(F.coalesce(text, F.lit("")), of)


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail the same filters,
    and how many of them are labelled good and toxic.

    Texts are read once and leave the scan as digests. A text's first document is
    found by id and digest together, so the copies of one text, however many, are
    spread over all tasks.
    """
    rows = written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("source", F.lit("")).alias("part"),
            F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
            _text_mask(F.col("text")).alias("mask"),
        ),
        "audit-masks",
    )
    first = rows.where("doc_id IS NOT NULL").groupBy(F.col("digest").alias("_digest")).agg(
        F.min("doc_id").alias("_first")
    )
    marks = labels.where("doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("_labelled")
    ).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    rows = rows.join(
        first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left"
    ).join(marks, F.col("doc_id") == F.col("_labelled"), "left")
    repeats = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return rows.groupBy(
        "part", (F.col("mask") + F.when(repeats, 16).otherwise(0)).cast("int").alias("mask")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def _folded(cell: Column, orders: Column) -> Column:
    """A cell's counts at the steps of all orders, one after another."""
    zero = F.lit(0).cast("long")
    nothing = F.array().cast("array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")

    def step(acc: Column, letter: Column) -> Column:
        bit = F.element_at(F.lit([1 << k for k in range(len(LETTERS))]), letter + 1)
        fails = cell["mask"].bitwiseAND(bit) > 0
        goes = acc["here"] & fails
        counts = {
            "kept": F.when(acc["here"] & ~fails, cell["n"]),
            "removed": F.when(goes, cell["n"]),
            "redundant": F.when(~acc["here"] & fails, cell["n"]),
            "unique_fails": F.when(cell["mask"] == bit, cell["n"]),
            "good_lost": F.when(goes, cell["good"]),
            "toxic_lost": F.when(goes, cell["toxic"]),
        }
        own = F.struct(*[F.coalesce(v, zero).alias(k) for k, v in counts.items()])
        return F.struct(
            (acc["here"] & ~fails).alias("here"), F.concat(acc["steps"], F.array(own)).alias("steps")
        )

    start = F.struct(F.lit(True).alias("here"), nothing.alias("steps"))
    return F.flatten(
        F.transform(orders, lambda o: F.aggregate(o, start, step, lambda acc: acc["steps"]))
    )


def interactions(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: part, filter_order, step (from 1), the counts
    kept (after the step), removed (by it), redundant (fail its filter, but were
    removed before), unique_fails (fail no other filter), good_lost and toxic_lost
    (removed by it, labelled so), and shapley (what its filter removes, summed over
    all orders).

    Filters: A under 200 words; B under half of the words distinct; C over 2 % of the
    code points A-Z; D any of ``#$%&*|``; E the text of a document with a smaller id.
    Parts are the values of ``source``; a null source is the empty string. A null
    text is empty; empty texts are texts like others and copies of each other.
    A document without id is no copy, and none of it. Rows that share id and text are
    all the first, or all copies. Of several labels of a document any 1 counts; labels
    without id or of no document count nowhere. No documents: no rows. Other columns
    are ignored. The fold is over counts: its work is bounded by the number of parts.
    """
    orders, counts = F.lit(ORDERS), cells(documents, labels)
    # At most 32 cells a part.
    parts = counts.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    zero = F.lit(0).cast("long")
    zeros = F.array_repeat(
        F.struct(*[zero.alias(c) for c in COUNTS]), len(ORDERS) * len(LETTERS)
    )

    def plus(a: Column, b: Column) -> Column:
        return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

    summed = parts.select(
        "part",
        F.aggregate(
            "cells", zeros, lambda acc, cell: F.zip_with(acc, _folded(cell, orders), plus)
        ).alias("steps"),
    )
    letters = F.flatten(orders)

    def of_filter(letter: Column) -> Column:
        own = F.zip_with("steps", letters, lambda s, f: F.when(f == letter, s["removed"]).otherwise(0))
        return F.aggregate(own, zero, lambda total, n: total + n)

    summed = summed.withColumn(
        "shapley", F.transform(F.sequence(F.lit(0), F.lit(len(LETTERS) - 1)), of_filter)
    )
    rows = summed.select("part", "shapley", F.posexplode("steps").alias("at", "counts"))
    steps = len(LETTERS)
    names = F.lit(["".join(LETTERS[k] for k in o) for o in ORDERS])
    return rows.select(
        "part",
        F.element_at(names, (F.floor(F.col("at") / steps) + 1).cast("int")).alias("filter_order"),
        (F.col("at") % steps + 1).cast("int").alias("step"),
        *[F.col("counts")[c].alias(c) for c in COUNTS],
        F.element_at("shapley", F.element_at(letters, F.col("at") + 1) + 1).alias("shapley"),
    )
