"""Periodic runs, nearest neighbours and the filter audit against brute force."""

from __future__ import annotations

import collections
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import filter_audit, multi_index, periodic_runs, queries

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank string, cell string"
LABELS = "doc_id long, quality int, toxic int, part string, mask string"


def all_runs(words, least=12):
    """Every lag, every position."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at < len(words) - q:
            begin = at
            while at < len(words) - q and words[at] == words[at + q]:
                at += 1
            if at - begin + q >= max(least, 2 * q):
                found.setdefault((begin, at - begin + q), q)
            at += 1
    return sorted((s, q, n) for (s, n), q in found.items())


def _periodic_words(rng: random.Random) -> list[int]:
    """Words of few kinds, in ways that repeat: nested periods, adjoining ones, almost
    periodic sequences."""
    n = rng.choice([0, 1, 11, 12, 13, 40, 100, 300, 700])
    kind = rng.randrange(7)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 2:
        return [bin(k).count("1") % 2 for k in range(n)]
    out = []
    root = [rng.randrange(3) for _ in range(rng.randrange(1, 6))]
    while len(out) < n:
        if kind == 3:
            at = rng.randrange(len(root))
            out += [root[(at + k) % len(root)] for k in range(rng.randrange(1, 120))]
        elif kind == 4:
            out += [rng.randrange(2) for _ in range(rng.randrange(1, 90))] * rng.randrange(1, 5)
        elif kind == 5:
            out += [0, 1] * rng.randrange(5, 150) + [0]
        else:
            out += ([0] * rng.randrange(1, 80) + [1] + [0] * rng.randrange(60)) * 6
    return out[:n]


@pytest.mark.parametrize("start", range(3))
def test_runs_equal_every_lag(start):
    rng = random.Random(start)
    checked = 0
    for _ in range(120):
        texts = [_periodic_words(rng) for _ in range(rng.randrange(1, 7))]
        sizes = np.array([len(t) for t in texts])
        numbers = np.array([w for t in texts for w in t], dtype=np.int32)
        got = periodic_runs.find_runs(numbers, sizes)
        for k, text in enumerate(texts):
            mine = [(int(s), int(q), int(n)) for d, s, n, q in got if d == k]
            assert mine == all_runs(text)
            checked += len(mine)
    assert checked > 1000


def test_runs_of_odd_documents(spark, odd_documents):
    more = spark.createDataFrame(
        [(20, "ha " * 40 + "Ha"), (21, "a b " * 5 + "a b"), (22, "a b " * 6), (20, "x")],
        "doc_id long, text string",
    )
    df = odd_documents.unionByName(more, allowMissingColumns=True)
    rows = periodic_runs.periodic_runs(df).collect()
    texts = df.select("doc_id", "text").collect()
    assert len(rows) == len(texts)

    def expected(text):
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
        runs, keep = all_runs(words) if len(words) < 5000 else [], [True] * len(words)
        for s, q, n in runs:
            keep[s + q : s + n] = [False] * (n - q)
        left = " ".join(itertools.compress(words, keep))
        return len(words), [(s, n, q) for s, q, n in runs], left

    want = collections.Counter(
        (r.doc_id, repr(expected(r.text)[:2]), expected(r.text)[2]) for r in texts
    )
    got = collections.Counter(
        (r.doc_id, repr((r.n_words, [tuple(x) for x in r.runs])), r.collapsed) for r in rows
    )
    assert got == want
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    # No runs, one run, and 12 words of two periods: each its own row of the query.
    found = {r.doc_id: r for r in rows if r.doc_id in (21, 22)}
    assert [tuple(r) for r in found[21].runs] == [(0, 12, 2)] == [tuple(r) for r in found[22].runs]


def _true_nearest(rows, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=float)
    out = {}
    for at in np.flatnonzero(ids % 100 == 0):
        apart = np.array([math.dist(x[at], v) for v in x])
        order = [j for j in np.lexsort((ids, apart)) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), apart[j]) for j in order]
    return out


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_neighbours_found(spark, size):
    root = f"/root/testdata/{size}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()]
    true = _true_nearest(rows, 10)
    vectors = dict(rows)
    got = collections.defaultdict(list)
    for r in queries.op12_multi_index(spark, root).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(true)
    found = 0
    for query, near in got.items():
        near.sort()
        assert [n for n, _, _ in near] == list(range(1, 11))
        assert [(s, v) for _, v, s in near] == sorted((s, v) for _, v, s in near)
        for _, v, s in near:
            assert v != query and math.isclose(s, math.dist(vectors[query], vectors[v]), abs_tol=1e-12)
        found += len({v for _, v, _ in near} & {v for v, _ in true[query]})
    assert found / (10 * len(true)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, []),
        (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, inf]), (None, [1.0, 0.1]), (9, [1.0, 2.0, 3.0]),
        (100, [1.0, 0.0]), (200, [1.0, 2.0, 4.0]), (300, [1.0]), (400, [0.0, 0.0]), (2, [0.0, 1.0]),
        (10, [3e38, 3e38]), (500, [-3e38, 3e38]), (600, [1e-30, 0.0]), (11, [2e-30, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 0, "x", "x", "x") for r in rows], VECTORS)
    is_query = F.col("vec_id") % 100 == 0
    got = collections.defaultdict(list)
    for r in multi_index.nearest(df, is_query).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert [v for v, _ in got[0]][:2] == [1, 100] and got[0][0][1] == 0
    assert [v for v, _ in got[100]][:2] == [0, 1]
    assert [v for v, _ in got[200]] == [9] and math.isclose(got[200][0][1], 1.0)
    assert not {3, 4, 5, 6, 7, 8, 300, 400, None} & {v for near in got.values() for v, _ in near}
    assert set(got) == {0, 100, 200, 500, 600}
    assert len(got[0]) == 7 and math.isclose(dict(got[500])[10], 2 * float(np.float32(3e38)))
    assert got[600][0][0] == 11 and math.isclose(got[600][0][1], 1e-30, rel_tol=1e-6)
    assert multi_index.nearest(df.limit(0), is_query).count() == 0


def test_common_vectors_and_full_cells(spark, monkeypatch):
    """A third of the rows are one vector, another third lie close together."""
    monkeypatch.setattr(multi_index, "ENTRIES", 50)
    monkeypatch.setattr(multi_index, "QUERIES", 3)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 8))
    x[500:1000] = x[500]
    x[1000:] = x[1000] + 1e-3 * rng.normal(size=(500, 8))
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 0, "x", "x", "x") for r in rows], VECTORS)
    true = _true_nearest(rows, 10)
    got = collections.defaultdict(list)
    for r in multi_index.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].append(r.vec_id)
    found = sum(len(set(got[q]) & {v for v, _ in near}) for q, near in true.items())
    assert all(len(near) == 10 for near in got.values()) and found >= 0.9 * 10 * len(true)
    for q in (500, 600, 700, 800, 900):
        assert set(got[q]) == {v for v, _ in true[q]}


def test_cells_come_by_summed_distance():
    rng = np.random.default_rng(4)
    for _ in range(50):
        one, two = rng.random(6), rng.random(5).round(1)
        sizes = rng.integers(0, 4, 30).tolist()
        enough = int(rng.integers(1, 50))
        sums = (one[:, None] + two).ravel()
        cells = multi_index.visited(one, two, sizes, enough)
        assert len(set(cells)) == len(cells) and all(sizes[c] for c in cells)
        assert (np.diff(sums[cells]) >= 0).all()
        passed = sum(sizes[c] for c in cells)
        assert passed >= min(enough, sum(sizes)) and passed - sizes[cells[-1]] < enough
        rest = [c for c in range(30) if c not in cells and sizes[c]]
        assert passed >= sum(sizes) or min(sums[rest]) >= sums[cells[-1]]


def _audit(documents, labels):
    """Each order walked through, document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in documents:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    failing = []
    for d, text, _ in documents:
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": d is not None and first[text] < d,
        }
        failing.append({k for k, v in fails.items() if v})
    out = {}
    for part in {s or "" for _, _, s in documents}:
        own = [(d, f) for (d, _, s), f in zip(documents, failing) if (s or "") == part]
        for order in itertools.permutations("ABCDE"):
            here = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in own if x not in here and letter in x[1]]
                removed = [x for x in here if letter in x[1]]
                here = [x for x in here if letter not in x[1]]
                out[part, "".join(order), step] = [
                    len(here), len(removed), len(gone), sum(f == {letter} for _, f in own),
                    sum(d in good for d, _ in removed), sum(d in bad for d, _ in removed),
                ]
        for letter in "ABCDE":
            keys = [k for k in out if k[0] == part and k[1][k[2] - 1] == letter]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k].append(total)
    return out


def test_filter_audit_by_walking(spark, odd_documents):
    rng = random.Random(5)
    documents = [(r.doc_id, r.text, r.source) for r in odd_documents.collect()]
    for k in range(30, 90):
        text = " ".join(rng.choice(["aa", "B", "c#", "d", f"w{k}"]) for _ in range(rng.choice([3, 250])))
        documents.append((k, text, rng.choice(["x", "y", "", None])))
    documents += [(200 + k, documents[-1 - k % 2][1], "y") for k in range(5)]
    labels = [(k, k % 2, k % 3 // 2) for k in range(40)] + [(4, 0, 1), (4, None, None), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame(
        [(*d, "x", "x", "x", "x") for d in documents],
        "doc_id long, text string, source string, part string, mask string, digest string, n string",
    )
    marks = spark.createDataFrame([(*x, "x", "x") for x in labels], LABELS)
    rows = filter_audit.interactions(df, marks).collect()
    got = {(r.part, r.filter_order, r.step): [r[c] for c in (*filter_audit.COUNTS, "shapley")] for r in rows}
    assert len(got) == len(rows) and got == _audit(documents, labels)
    assert filter_audit.interactions(df.limit(0), marks).count() == 0
    no_labels = filter_audit.interactions(df, marks.limit(0))
    assert no_labels.agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0] == 0
