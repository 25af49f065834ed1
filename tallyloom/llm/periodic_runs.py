"""Stretches of a text that repeat with a period, found by multi-scale minimizers.

A run is a longest stretch of words with smallest period q that holds q at least
twice. Periods under SHORT are found by comparing the text with itself at every such
lag. Periods from Q to 2Q are found by the words that begin a run: of each window of
Q words, the smallest hash of Q/2 words is kept, and as a run looks the same q words
later, two kept hashes a period apart are equal. Equal kept hashes at a distance of Q
to 2Q are seeds, and a seed is extended word by word to both sides.

Hashes inside a run of a period of Q/6 or less would be equal at every such period.
They are left out: what lies between two different runs of that kind follows from
their borders and their common period, one seed for each lag.

Texts of a batch are worked on together, one after another in an array of word
numbers, with a number of its own after each, which no run can cross. Hashes only
propose seeds; all that is returned was compared word by word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import mix, seed

# Words that a run has at least.
LEAST = 12
# Periods below are compared directly; a power of two, 32 or more.
SHORT = 32
# Bytes of texts worked on together; longer texts are alone. Bounds memory, changes no result.
CHUNK_BYTES = 1 << 20
# Words compared at a time while a seed is extended.
STRIDE = 1024
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Texts:
    """Word numbers of several texts in one array, numbers of no word between them."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray):
        self.sizes = sizes
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        total = int(sizes.sum()) + len(sizes)
        self.at = np.full(total, -1, dtype=np.int32)
        ends = self.begins + sizes
        inside = np.ones(total, dtype=bool)
        inside[ends] = False
        self.at[inside] = numbers
        self.at[ends] = -1 - np.arange(len(sizes), dtype=np.int32)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, positions, "right") - 1


def _by_lag(texts: _Texts, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of all longest stretches whose words equal those ``lag`` later,
    if the run they make is long enough."""
    at = texts.at
    if len(at) <= lag:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    # The last number is of no word, so the last comparison fails.
    unlike = np.flatnonzero(at[lag:] != at[:-lag])
    unlike = np.concatenate([[-1], unlike])
    long = np.flatnonzero(np.diff(unlike) > max(least, 2 * lag) - lag)
    return unlike[long] + 1, unlike[long + 1] + lag


def _leftmost_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest value of some window of ``width``, the first
    of several."""
    best, value, reach = np.arange(len(hashes)), hashes, 1
    while reach < width:
        step = min(reach, width - reach)
        later = value[step:] < value[:-step]
        best = np.where(later, best[step:], best[:-step])
        value = np.where(later, value[step:], value[:-step])
        reach += step
    held = np.zeros(len(hashes), dtype=bool)
    held[best] = True
    return np.flatnonzero(held)


def _equal_words(at: np.ndarray, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
    """How many words from ``x`` on (or before ``x``) equal those from ``y`` on."""
    found = np.zeros(len(x), dtype=np.int64)
    going, width, last = np.arange(len(x)), 16, len(at) - 1
    while len(going):
        offsets = np.arange(width)
        ahead = found[going][:, None] + offsets
        a = x[going][:, None] - 1 - ahead if back else x[going][:, None] + ahead
        b = y[going][:, None] - 1 - ahead if back else y[going][:, None] + ahead
        unlike = at[np.clip(a, 0, last)] != at[np.clip(b, 0, last)]
        unlike |= (a < 0) | (b > last)
        stops = unlike.any(axis=1)
        found[going] += np.where(stops, unlike.argmax(axis=1), width)
        going = going[~stops]
        width = min(2 * width, STRIDE, max(16, (1 << 20) // max(1, len(going))))
    return found


def _extended(
    texts: _Texts, low: np.ndarray, high: np.ndarray, lag: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest stretches of words equal to those ``lag`` later that hold the seeds
    (positions from low to high are known to), each once: begins, ends, lags."""
    own = texts.text_of(low)
    order = np.lexsort((low, lag, own))
    own, low, high, lag = own[order], low[order], high[order], lag[order]
    out = []
    while len(low):
        new = np.ones(len(low), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (lag[1:] != lag[:-1])
        first = np.flatnonzero(new)
        x, y, q = low[first], high[first], lag[first]
        begin = x - _equal_words(texts.at, x, x + q, True)
        end = y + _equal_words(texts.at, y, y + q, False)
        out.append((begin, end, q))
        # Seeds of the same text and lag that lie in the stretch are of that stretch.
        left = low >= np.repeat(end, np.diff(np.append(first, len(low))))
        left[first] = False
        own, low, high, lag = own[left], low[left], high[left], lag[left]
    if not out:
        return (np.empty(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def _between_runs(
    at: np.ndarray, runs: np.ndarray, scale: int, shortest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds (low, high, lag) between two different runs of the same short period:
    at each lag at which their words agree over ``shortest`` words or more. ``runs``
    are rows (text, begin, end, period) in order."""
    found = []
    for k in range(1, len(runs)):
        one, two = runs[:-k], runs[k:]
        near = (one[:, 0] == two[:, 0]) & (two[:, 1] < one[:, 2] + 2 * scale - shortest)
        if not near.any():
            break
        for (_, a1, b1, r), (_, a2, b2, s) in zip(one[near], two[near], strict=True):
            if r != s:
                continue
            needle, hay = at[a1 : a1 + r].tobytes(), at[a2 : a2 + 2 * r - 1].tobytes()
            place = hay.find(needle)
            while place > 0 and place % at.itemsize:
                place = hay.find(needle, place + 1)
            if place < 0:
                continue
            shift = a2 + place // at.itemsize - a1
            lags = np.arange(scale + (shift - scale) % r, 2 * scale, r)
            low, high = np.maximum(a1, a2 - lags), np.minimum(b1, b2 - lags)
            keep = high - low >= shortest
            found.append((low[keep], high[keep], lags[keep]))
    if not found:
        return (np.empty(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _minimizer_seeds(
    hashes: np.ndarray, scale: int, shortest: int, runs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose kept hash comes back ``scale`` to twice ``scale`` words later,
    and the distance; hashes of words inside one of ``runs`` are left out."""
    held = _leftmost_minima(hashes, scale - shortest + 1)
    if len(runs):
        # Two such runs share too few words for a hash to lie in both.
        last = np.searchsorted(runs[:, 1], held, "right") - 1
        held = held[(last < 0) | (runs[np.maximum(last, 0), 2] < held + shortest)]
    values = hashes[held]
    order = np.argsort(values, kind="stable")
    values, places = values[order], held[order]
    low, lag = [], []
    going, k = np.arange(len(places)), 0
    while len(going):
        k += 1
        going = going[going + k < len(places)]
        apart = places[going + k] - places[going]
        near = (values[going + k] == values[going]) & (apart < 2 * scale)
        going, apart = going[near], apart[near]
        far = apart >= scale
        low.append(places[going[far]])
        lag.append(apart[far])
    empty = [np.empty(0, dtype=np.int64)]
    return np.concatenate(low or empty), np.concatenate(lag or empty)


def find_runs(numbers: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs of ``least`` words or more in texts of word numbers (not negative) laid
    end to end: rows (text, start, length, period) in this order, words counted from 0
    in each text."""
    texts = _Texts(numbers, sizes)
    found = []

    def add(begins: np.ndarray, ends: np.ndarray, lags: np.ndarray | int) -> None:
        own = kept[texts.text_of(begins)]
        start = begins - texts.begins[texts.text_of(begins)]
        found.append(np.column_stack([own, start, ends - begins, np.broadcast_to(lags, len(own))]))

    kept = np.arange(len(sizes))
    for lag in range(1, SHORT):
        add(*_by_lag(texts, lag, least), lag)
    found = [_smallest_periods(np.concatenate(found))]
    scale, hashes = SHORT, None
    while True:
        # Only texts that can hold such a period go on.
        stay = texts.sizes >= 2 * scale
        if not stay.any():
            return _smallest_periods(np.concatenate(found))
        mask = np.repeat(stay, texts.sizes + 1)
        words = mask.copy()
        words[texts.begins + texts.sizes] = False
        texts, at = _Texts(texts.at[words], texts.sizes[stay]), texts.at
        kept = kept[stay]
        shortest = scale // 2
        if hashes is None:
            hashes, reach = mix(texts.at.astype(np.int64).view(np.uint64) ^ seed(701)), 1
        else:
            hashes, reach = hashes[mask], shortest // 2
        while reach < shortest:
            beyond = mix(np.arange(reach, dtype=np.uint64) ^ seed(702, reach))
            with np.errstate(over="ignore"):
                hashes = mix(hashes * np.uint64(3) + np.append(hashes[reach:], beyond)[: len(hashes)])
            reach *= 2
        known = np.concatenate(found)
        place = np.full(len(sizes), -1)
        place[kept] = np.arange(len(kept))
        known = known[
            (place[known[:, 0]] >= 0) & (known[:, 2] >= shortest) & (3 * known[:, 3] <= shortest)
        ]
        own = place[known[:, 0]]
        begin = texts.begins[own] + known[:, 1]
        inner = np.column_stack([own, begin, begin + known[:, 2], known[:, 3]])
        inner = inner[np.argsort(inner[:, 1], kind="stable")]
        low, lag = _minimizer_seeds(hashes, scale, shortest, inner)
        a, b, c = _between_runs(texts.at, inner, scale, shortest)
        begins, ends, lags = _extended(
            texts, np.concatenate([low, a]), np.concatenate([low, b]), np.concatenate([lag, c])
        )
        long = ends - begins + lags >= np.maximum(least, 2 * lags)
        add(begins[long], ends[long] + lags[long], lags[long])
        found = [_smallest_periods(np.concatenate(found))]
        scale *= 2


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, in order of text, start, period."""
    order = np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))
    runs = runs[order]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, of each run the first period only, joined by a blank."""
    if len(runs):
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[k] for k in np.flatnonzero(keep)]
    return b" ".join(words)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, CHUNK_BYTES of texts at a time or one longer text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), dtype=np.int64)
    ends, at = np.cumsum(sizes + 1), 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def periodic_runs(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_words, ``runs`` (start, length and
    period in words, ordered by start and period) and ``collapsed``, the words that are
    left if of each run only the first period stays, joined by single blanks.

    Words are what stands between white space (0x20, 0x09 to 0x0D), case-sensitive. A
    run is a stretch whose words equal those one period later, has ``least`` words and
    two periods at least, and goes on in neither direction; its period is the smallest
    one it has. A null, empty or blank text has no words, no runs and collapses to the
    empty string. Rows stay apart whatever their ids, null and repeated ones included.
    Other columns are ignored. Nothing is shuffled; a text is worked on in one task,
    whose memory grows with its longest text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch):
                column = pc.fill_null(part.column(1), "").cast(pa.binary())
                texts = [text.split() for text in column.to_pylist()]
                sizes = np.array([len(t) for t in texts], dtype=np.int64)
                known: dict[bytes, int] = defaultdict(count().__next__)
                numbers = np.fromiter(
                    (known[w] for t in texts for w in t), dtype=np.int32, count=int(sizes.sum())
                )
                runs = find_runs(numbers, sizes, least)
                at = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
                fields = [pa.array(runs[:, k], pa.int64()) for k in (1, 2, 3)]
                entries = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                left = [
                    _collapsed(t, runs[at[k] : at[k + 1], 1:]) for k, t in enumerate(texts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), entries),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
