"""Benchmark passages in documents, found by winnowing, with Spark expressions only.

Of the hashes of all runs of GRAM words, the smallest in each window of
WINDOW - GRAM + 1 neighbouring runs is a text's fingerprint. Two texts that share
WINDOW consecutive words share such a window of runs and so a fingerprint: no
shared passage of that length is missed. Documents with a fingerprint of an item
are then compared window by window, and every word inside a shared window is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.text_columns import let, words_of
from tallyloom.sources.scratch import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Consecutive words that count as a shared passage, and words per hashed run.
WINDOW, GRAM = 10, 6


def gram_hashes(hashes: Column, n: int, *salt: Column) -> Column:
    """A hash for every run of ``n`` entries of an array of hashes, in order. Other
    ``salt`` gives hashes that collide for other runs: it is hashed first."""
    return let(
        hashes,
        lambda h: F.when(F.size(h) < n, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(h) - F.lit(n - 1), F.lit(1))),
                lambda i: F.xxhash64(*salt, F.slice(h, i, n)),
            )
        ),
    )


def fingerprints(hashes: Column, window: int, gram: int) -> Column:
    """The distinct smallest run hashes of all windows of ``window`` words."""
    width = window - gram + 1
    grams = gram_hashes(hashes, gram)
    if width == 1:
        return F.array_distinct(grams)
    return let(
        grams,
        lambda g: F.when(F.size(g) < width, F.array().cast("array<bigint>")).otherwise(
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size(g) - F.lit(width - 1), F.lit(1))),
                    lambda i: F.array_min(F.slice(g, i, width)),
                )
            )
        ),
    )


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted as
    strings), contaminated, and text_key (``xxhash64`` of the text), by which rows of
    one doc_id are told apart.

    Words are runs of ASCII digits and letters and of all characters beyond
    ASCII, A-Z in lower case. An item of fewer than ``window`` words, but not
    none, is one window of its own length. Null texts have no words; items without words or id
    occur nowhere; repeated items with one id are one item, and repeated rows of documents get
    a row each. Documents are told apart by id and text, so different texts under one id do not
    mix. Other columns are ignored.

    Documents' fingerprints are exploded and joined to those of the items; Spark
    broadcasts the latter if they are small and sort-merges if not. Only documents
    with a common fingerprint are read again.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"),
        words_of(F.coalesce("text", F.lit("")), WORD).alias("words"),
    ).where("item IS NOT NULL AND size(words) > 0")
    items = written(
        items.select(
            "item",
            F.least(F.size("words"), F.lit(window)).alias("span"),
            _word_hashes(F.col("words")).alias("hashes"),
        ),
        "benchmark-words",
    )
    # At most `window` different values, whatever the benchmark's size.
    spans = sorted(r.span for r in items.select("span").distinct().collect())

    def prints(hashes: Column, span: int) -> Column:
        k = min(gram, span) if span == window else span
        return fingerprints(hashes, span, k)

    keyed = documents.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        words_of(F.coalesce("text", F.lit("")), WORD).alias("words"),
    )
    found = keyed.select(
        "doc_id",
        "text_key",
        let(
            F.transform("words", lambda w: F.xxhash64(w)),
            lambda h: F.struct(
                F.size(h).cast("long").alias("n_words"),
                *[prints(h, s).alias(f"prints_{s}") for s in spans],
            ),
        ).alias("w"),
    ).select("doc_id", "text_key", "w.*")
    found = written(found, "fingerprints")

    matched = None
    for s in spans:
        of_items = (
            items.where(F.col("span") == s)
            .select(F.explode(prints(F.col("hashes"), s)).alias("print"))
            .distinct()
        )
        of_docs = found.select(
            "doc_id", "text_key", F.explode(f"prints_{s}").alias("print")
        )
        pairs = of_docs.join(of_items, "print", "left_semi").select("doc_id", "text_key")
        matched = pairs if matched is None else matched.union(pairs)
    counts = found.select("doc_id", "text_key", "n_words")
    if matched is None:
        hit_words = counts.limit(0).select("doc_id", "text_key", F.lit(0).cast("long").alias("n_hit"))
        hit_items = counts.limit(0).select(
            "doc_id", "text_key", F.array().cast("array<string>").alias("items")
        )
    else:
        matched = written(matched.distinct(), "candidates")
        hits = written(_hits(documents, items, matched, spans), "hits")
        covered = hits.select(
            "doc_id",
            "text_key",
            F.explode(F.sequence(F.col("at"), F.col("at") + F.col("span") - 1)).alias("word"),
        ).distinct()
        hit_words = covered.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n_hit"))
        hit_items = _items_of(hits, items, spans)
    out = counts
    for part, name in ((hit_words, "_a"), (hit_items, "_b")):
        part = part.withColumnRenamed("doc_id", f"{name}_id").withColumnRenamed(
            "text_key", f"{name}_key"
        )
        out = out.join(
            part,
            F.col("doc_id").eqNullSafe(F.col(f"{name}_id"))
            & (F.col("text_key") == F.col(f"{name}_key")),
            "left",
        )
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "text_key",
    )


def _both(hashes: Column, n: int) -> Column:
    """Two independent 64-bit hashes of every run of ``n`` words."""
    return F.arrays_zip(
        gram_hashes(hashes, n).alias("x"), gram_hashes(hashes, n, F.lit(n)).alias("y")
    )


def _item_windows(items: DataFrame, span: int) -> DataFrame:
    return items.where(F.col("span") == span).select(
        "item", F.explode(_both(F.col("hashes"), span)).alias("run")
    ).select("item", F.col("run.x").alias("x"), F.col("run.y").alias("y")).distinct()


def _hits(documents: DataFrame, items: DataFrame, matched: DataFrame, spans: list[int]) -> DataFrame:
    """Where the candidates' windows are windows of items: (doc_id, text_key, at,
    span, x, y), words counted from 0."""
    candidates = matched.select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
    )
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    texts = texts.join(
        candidates,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")),
        "left_semi",
    )
    hashed = texts.select(
        "doc_id", "text_key", _word_hashes(words_of(F.col("text"), WORD)).alias("hashes")
    )
    out = None
    for s in spans:
        windows = _item_windows(items, s).select("x", "y").distinct()
        runs = hashed.select(
            "doc_id", "text_key", F.posexplode(_both(F.col("hashes"), s)).alias("at", "run")
        ).select("doc_id", "text_key", "at", F.col("run.x").alias("x"), F.col("run.y").alias("y"))
        found = runs.join(windows, ["x", "y"], "left_semi").select(
            "doc_id", "text_key", "at", F.lit(s).alias("span"), "x", "y"
        )
        out = found if out is None else out.union(found)
    return out


def _items_of(hits: DataFrame, items: DataFrame, spans: list[int]) -> DataFrame:
    """The items whose windows occur in each document, sorted as strings."""
    windows = None
    for s in spans:
        own = _item_windows(items, s).withColumn("span", F.lit(s))
        windows = own if windows is None else windows.union(own)
    distinct = hits.select("doc_id", "text_key", "span", "x", "y").distinct()
    pairs = distinct.join(windows, ["span", "x", "y"]).select("doc_id", "text_key", "item").distinct()
    return pairs.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list("item")).alias("items")
    )
