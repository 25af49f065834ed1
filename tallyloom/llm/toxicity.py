"""Toxicity scores from the nearest labelled examples.

Texts are TF-IDF vectors over the words, and the first letters of longer words,
that tell the two labels apart in a bounded sample of labelled texts; document
frequencies are counted over all documents. The examples lie in an inverted
index of blocks with each term's largest weight per block. A text's exact
nearest examples by cosine are found block by block, the most promising first,
until no block left can hold a nearer one. Their votes, weighted by similarity,
are turned into a probability that was fitted on the examples themselves, each
judged by the others. No document is judged by its own label.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces
from tallyloom.llm.text_columns import free_name
from tallyloom.sources.scratch import written

# Bound of the fit: examples of each label. Every feature of theirs is a term that is in
# MIN_EXAMPLES of them and tells the labels apart: its share among one is RATIO times
# that among the other or more, and chance does not explain that, by a G of BAR or more,
# which one feature in a thousand reaches by chance.
EXAMPLES, MIN_EXAMPLES, RATIO, BAR = 4_000, 3, 2, 10.83
NEIGHBOURS, BLOCK = 16, 32
# Blocks looked into before the bounds are compared again; twice as many each time.
FIRST_BLOCKS = 4
# Lengths of the beginnings of longer words that are features too.
PREFIXES = (2, 3, 4, 5, 6, 7, 8)
THRESHOLD = 0.7
# Cosines that are equal after so many digits are ties; what summing may lose of one.
DIGITS, ROUNDING = 10, 1e-9
# Runs between white space whose terms a task remembers at a time, and their longest:
# they bound its memory and change no result.
REMEMBERED, LONGEST = 200_000, 40
WORD = re.compile(r"[^\W\d_]+")


def forms(word: str) -> list[str]:
    """The features of a word: itself and, if it is longer, its beginnings (marked by a star)."""
    return [word, *[word[:k] + "*" for k in PREFIXES if len(word) > k]]


def features(text: str | None) -> set[str]:
    """Those of all words of a text, in lower case."""
    return {f for word in set(WORD.findall((text or "").lower())) for f in forms(word)}


class Lookup:
    """Counts the terms of texts. White space is in no word, so each run between is
    looked into once, however often it comes back."""

    def __init__(self, terms: dict[str, int]):
        self.terms = terms
        # All features of a word begin as it does.
        self.head = min(PREFIXES)
        self.heads = {t.rstrip("*")[: self.head] for t in terms}
        self.known: dict[str, list[int]] = {}

    def _terms_of(self, run: str) -> list[int]:
        words = [run] if run.isalpha() else WORD.findall(run)
        found = [f for w in words if w[: self.head] in self.heads for f in forms(w)]
        return [self.terms[f] for f in found if f in self.terms]

    def counts(self, text: str | None) -> dict[int, int]:
        found: dict[int, int] = {}
        for run, n in Counter((text or "").lower().split()).items():
            own = self.known.get(run)
            if own is None:
                own = self._terms_of(run)
                if len(run) <= LONGEST:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    self.known[run] = own
            for term in own:
                found[term] = found.get(term, 0) + n
        return found


def training_rows(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from: (doc_id, toxic), one per document, the
    higher of several."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out("doc_id"))
    return usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


class Model:
    """Examples with their block-max index, and the calibration of votes.

    ``vectors`` are the examples' (term to weight), ``names`` their doc_ids: examples
    of one id are left out together when that document is judged.
    """

    def __init__(self, terms: dict[str, int], idf: np.ndarray, vectors: list[dict], toxic, weight, names):
        self.terms, self.idf, self.lookup = terms, idf, Lookup(terms)
        filled = [k for k, v in enumerate(vectors) if v]
        # Examples with the same strongest term lie together, so blocks are alike.
        filled.sort(key=lambda k: (max(vectors[k], key=vectors[k].get), -max(vectors[k].values()), k))
        self.order = filled
        self.toxic = np.array([toxic[k] for k in filled], dtype=float)
        self.ids = [names[k] for k in filled]
        self.names = np.array(self.ids, dtype=np.int64)
        self.own: dict[int, list[int]] = {}
        for place, name in enumerate(self.ids):
            self.own.setdefault(name, []).append(place)
        self.blocks = max(1, -(-len(filled) // BLOCK))
        # All entries by term and place, where those of a term in a block begin, and
        # the largest weight among them.
        sizes = np.array([len(vectors[k]) for k in filled], dtype=np.int64)
        places = np.repeat(np.arange(len(filled)), sizes)
        ids = np.array([t for k in filled for t in vectors[k]], dtype=np.int64)
        weights = np.array([w for k in filled for w in vectors[k].values()], dtype=float)
        by_term = np.lexsort((places, ids))
        self.places, self.weights = places[by_term], weights[by_term]
        cells = ids[by_term] * self.blocks + self.places // BLOCK
        self.begins = np.searchsorted(cells, np.arange(len(terms) * self.blocks + 1))
        self.largest = np.zeros(len(terms) * self.blocks)
        np.maximum.at(self.largest, cells, self.weights)
        self.largest = self.largest.reshape(len(terms), self.blocks)
        # Labels of the examples without any term, and the calibration of the others.
        toxic, weight = np.array(toxic, dtype=float), np.array(weight, dtype=float)
        self.share = float((toxic * weight).sum() / weight.sum()) if len(weight) else 0.5
        self.empty = {
            names[k]: (toxic[k] * weight[k], weight[k]) for k, v in enumerate(vectors) if not v
        }
        self.empty_sums = np.sum([(0.0, 0.0), *self.empty.values()], axis=0)
        self.curve = None
        if filled:
            seen = [self.nearest(vectors[k], names[k]) for k in filled]
            x = np.array([self._votes(*s) for s in seen])
            weight = np.array([weight[k] for k in filled])
            self.curve = _logistic(x, self.toxic, weight, self.share)

    def vector(self, text: str | None) -> dict[int, float]:
        return self.weighted(self.lookup.counts(text))

    def weighted(self, counts: dict[int, int]) -> dict[int, float]:
        """The TF-IDF weights of counted terms, of length 1."""
        found = {term: (1 + math.log(n)) * self.idf[term] for term, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in found.values()))
        return {t: w / norm for t, w in found.items()}

    def nearest(self, vector: dict, name: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the nearest examples, ties by doc_id; those of the
        document ``name`` are left out."""
        return self.search(vector, name)[:2]

    def search(
        self, vector: dict, name: int | None = None
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """As :meth:`nearest`, and how many blocks were looked into."""
        held = np.array(sorted(vector), dtype=np.int64)
        weights = np.array([vector[t] for t in held], dtype=float)
        bounds = weights @ self.largest[held]
        order = np.argsort(-bounds, kind="stable")
        bounds = bounds[order]
        places, scores = np.empty(0, dtype=int), np.empty(0)
        left = int(np.searchsorted(-bounds, 0.0))
        at, step = 0, FIRST_BLOCKS
        while at < left:
            blocks = np.sort(order[at : min(at + step, left)])
            cells = (held * self.blocks)[:, None] + blocks
            begins, ends = self.begins[cells].ravel(), self.begins[cells + 1].ravel()
            times = ends - begins
            entries = np.repeat(begins - np.cumsum(times) + times, times) + np.arange(times.sum())
            own = np.bincount(
                self.places[entries],
                weights=self.weights[entries] * np.repeat(np.repeat(weights, len(blocks)), times),
                minlength=len(self.order),
            )
            if name is not None:
                own[self.own.get(name, [])] = 0
            some = np.flatnonzero(own > 0)
            places, scores = np.append(places, some), np.append(scores, own[some])
            if len(scores) > NEIGHBOURS:
                last = np.partition(scores, -NEIGHBOURS)[-NEIGHBOURS]
                near = scores >= last - ROUNDING
                places, scores = places[near], scores[near]
            at, step = at + len(blocks), 2 * step
            if len(scores) >= NEIGHBOURS:
                # Blocks that can hold nothing as near as the last one are done with.
                left = min(left, int(np.searchsorted(-bounds, ROUNDING - scores.min(), "right")))
        best = np.lexsort((places, self.names[places], -scores.round(DIGITS)))[:NEIGHBOURS]
        return places[best], scores[best], at

    def _votes(self, places: np.ndarray, scores: np.ndarray) -> tuple[float, float, float]:
        total = scores.sum()
        vote = (scores * self.toxic[places]).sum() / total if total else 0.5
        return 1.0, 2 * vote - 1, total / NEIGHBOURS * (2 * vote - 1)

    def score(self, text: str | None, name: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability that the text of document ``name`` is toxic; its nearest
        examples and cosines."""
        return self.judge(self.vector(text), name)

    def judge(self, vector: dict, name: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """As :meth:`score`, of a text's vector."""
        places, scores = (
            self.nearest(vector, name) if vector else (np.empty(0, int), np.empty(0))
        )
        if not len(places):
            toxic, all_of_them = self.empty_sums - self.empty.get(name, (0.0, 0.0))
            return float((toxic + self.share) / (all_of_them + 1)), places, scores
        z = float(np.dot(self.curve, self._votes(places, scores)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), places, scores


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> np.ndarray:
    """Weighted logistic regression by Newton steps, held towards the prior."""
    at = np.zeros(x.shape[1])
    at[0] = math.log((prior + 1e-6) / (1 - prior + 1e-6))
    start, ridge = at.copy(), np.full(x.shape[1], 0.1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * (at - start)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return at


def _sample(documents: DataFrame, labels: DataFrame, examples: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``examples`` documents of each label, in
    the order of a hash of their ids."""
    rows = training_rows(labels)
    picked = None
    for toxic in (0, 1):
        part = rows.where(F.col("toxic") == toxic)
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
        picked = part if picked is None else picked.union(part)
    # At most twice ``examples`` rows of two numbers.
    picked = F.broadcast(picked.withColumnRenamed("doc_id", "_id"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(
        texts.join(picked, F.col("doc_id") == F.col("_id")).select("doc_id", "toxic", "text"),
        "examples",
    )


def _vocabulary(sample: DataFrame) -> list[str]:
    """The features that tell the labels apart, by their shares of the examples of
    either label and the G statistic, however common they are: idf weighs them."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Few texts at a time, as each has many features.
        for batch in pieces(batches, 20):
            rows = [
                (f, t)
                for text, t in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
                )
                for f in features(text)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                ["feature", "toxic"],
            )

    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    n, t = totals.n, totals.t or 0
    if not 0 < t < n:
        return []
    held = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        spread, "feature string, toxic int"
    )
    counted = held.groupBy("feature").agg(
        F.count(F.lit(1)).cast("double").alias("a"), F.sum("toxic").cast("double").alias("b")
    )

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    g = 2 * (
        part(b, a * t / n)
        + part(a - b, a * (n - t) / n)
        + part(t - b, (n - a) * t / n)
        + part(n - t - a + b, (n - a) * (n - t) / n)
    )
    toxic, other = b / t, (a - b) / (n - t)
    apart = F.greatest(toxic, other) >= RATIO * F.least(toxic, other)
    best = counted.where(a >= MIN_EXAMPLES).where(apart & (g >= BAR)).select("feature")
    return sorted(r.feature for r in best.collect())


TERMS_AND_COUNTS = "terms array<int>, counts array<int>"


def _counted(documents: DataFrame, columns: list[str], terms: dict[str, int]) -> DataFrame:
    """``columns`` of the documents and, as two more, the terms of each text and how
    often it holds them."""
    names = free_name(documents, "terms"), free_name(documents, "counts")

    @F.pandas_udf(TERMS_AND_COUNTS)
    def count(texts: pd.Series) -> pd.DataFrame:
        lookup = Lookup(terms)
        found = [lookup.counts(text) for text in texts]
        return pd.DataFrame(
            {"terms": [list(c) for c in found], "counts": [list(c.values()) for c in found]}
        )

    rows = documents.select(*columns, count("text").alias("_found"))
    return rows.select(
        *columns, F.col("_found")["terms"].alias(names[0]), F.col("_found")["counts"].alias(names[1])
    )


def _document_frequencies(counted: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms + 1, dtype=np.int64)
        for batch in batches:
            found[-1] += len(batch)
            found[:-1] += np.bincount(np.asarray(batch.column(0).flatten()), minlength=terms)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(found))), pa.array(found)], ["term", "n"]
        )

    column = counted.columns[-2]
    sums = counted.select(column).mapInArrow(count, "term long, n long")
    out = np.zeros(terms + 1, dtype=np.int64)
    for row in sums.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row.term] = row.n
    return out[:-1], int(out[-1])


def _learned(
    documents: DataFrame, labels: DataFrame, columns: list[str], examples: int
) -> tuple[Model, DataFrame]:
    """A model, and the documents with their terms counted, which it was weighted by.
    Each text is looked into once."""
    sample = _sample(documents, labels, examples)
    of_label = Counter({r.toxic: r.n for r in _label_counts(labels)})
    vocabulary = {f: k for k, f in enumerate(_vocabulary(sample))}
    counted = written(_counted(documents, columns, vocabulary), "terms")
    frequency, total = _document_frequencies(counted, len(vocabulary))
    idf = np.log((1 + total) / (1 + frequency)) + 1
    of_sample = _counted(sample, ["doc_id", "toxic"], vocabulary)
    rows = of_sample.orderBy("doc_id", "terms", "counts").collect()
    vectors = []
    for r in rows:
        raw = {t: (1 + math.log(c)) * idf[t] for t, c in zip(r.terms, r.counts, strict=True)}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    # What an example stands for, as one label may be sampled more than the other.
    sampled = Counter(r.toxic for r in rows)
    weights = [of_label[r.toxic] / sampled[r.toxic] for r in rows]
    names = [r.doc_id for r in rows]
    return Model(vocabulary, idf, vectors, [r.toxic for r in rows], weights, names), counted


def fit(
    documents: DataFrame, labels: DataFrame, examples: int = EXAMPLES
) -> tuple[Model, list[int]]:
    """A model of the labels' ``toxic``, and the ids of its examples by place.

    Learned from at most ``examples`` labelled documents of each kind and the
    features that tell them apart, both of which reach the driver; only labels that
    are not held out are read. Without labels of both kinds every score is their
    share, or one half.
    """
    model, _ = _learned(documents, labels, [], examples)
    return model, model.ids


def _label_counts(labels: DataFrame) -> list:
    return training_rows(labels).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()


EVIDENCE = 3
VERDICT = "score double, predicted int, examples array<long>, cosines array<double>"


def judged(
    documents: DataFrame,
    labels: DataFrame,
    columns: list[str] | None = None,
    examples: int = EXAMPLES,
) -> DataFrame:
    """``columns`` of the documents (all, unless given) and as last one a struct
    ``verdict``: score, predicted (a score of THRESHOLD or more), and as evidence the
    nearest examples' ids and cosines.

    Every row is judged by its own text. What is labelled under its doc_id is no
    example for it; copies of its text under other ids are. A text without any term,
    null and empty ones included, has the share of toxic ones among such examples and
    no evidence. Rows without id are judged like others; labels without id, or with a
    ``toxic`` other than 0 and 1, are not read, and of several labels of an id the
    higher counts. The examples and the index, which reach the driver and every task,
    are bounded by ``examples``.
    """
    columns = documents.columns if columns is None else columns
    model, counted = _learned(documents.withColumn("_name", F.col("doc_id").cast("long")), labels,
                              ["_name", *columns], examples)

    @F.pandas_udf(VERDICT)
    def judge(names: pd.Series, terms: pd.Series, counts: pd.Series) -> pd.DataFrame:
        def rows() -> Iterator[tuple]:
            nameless = names.isna()
            for name, none, own, times in zip(names, nameless, terms, counts, strict=True):
                vector = model.weighted(dict(zip(own.tolist(), times.tolist(), strict=True)))
                score, places, cosines = model.judge(vector, None if none else int(name))
                near = [model.ids[k] for k in places[:EVIDENCE]]
                yield score, int(score >= THRESHOLD), near, list(cosines[:EVIDENCE])

        return pd.DataFrame(rows(), columns=["score", "predicted", "examples", "cosines"])

    verdict = judge("_name", *[F.col(c) for c in counted.columns[-2:]])
    return counted.select(*columns, verdict.alias(free_name(documents, "verdict")))
