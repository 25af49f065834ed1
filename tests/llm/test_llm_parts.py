"""The parts that operators are made of, against brute force."""

from __future__ import annotations

import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import bestfit, curve_packing, decontamination, ngram_join, token_spans, toxicity, words
from tallyloom.llm.components import connected_components
from tallyloom.llm.tokens import encoder, vocabulary_paths
from tallyloom.llm.vector_dedup import close_pairs, linked_rows, principal_axes, with_tiles


@given(st.lists(st.text(alphabet="aAbB é漢 \t\n\x0b\x1c\x85\xa0", max_size=30), max_size=8))
@settings(deadline=None)
def test_shingle_sets_are_those_of_the_words(texts):
    found = list(words.shingle_sets(pa.array(texts, pa.string()), 3))
    lists = [t.encode().lower().split() for t in texts]
    expected = [
        {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
        for w in lists
    ]
    assert [len(s) for s in found] == [len(s) for s in expected]
    for a, x in zip(found, expected, strict=True):
        for b, y in zip(found, expected, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_chunks_do_not_change_hashes(monkeypatch):
    texts = pa.array([None, "", "a b c d e f"] * 20 + ["x " * 300])
    before = [s.tolist() for s in words.shingle_sets(texts, 4)]
    monkeypatch.setattr(words, "CHUNK_BYTES", 16)
    assert [s.tolist() for s in words.shingle_sets(texts.slice(0), 4)] == before


def test_components_of_random_graphs(spark):
    random.seed(2)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(300)]
    edges += [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5200)]
    edges += [(3, None), (None, 4), (7, 7)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    assert {r.id: r.component for r in found} == {k: root(k) for k in parent}


def near_copies(seed: int) -> dict[int, str]:
    rng = random.Random(seed)
    out = {}
    for size in [1, 2, 3, 5, 6, 8, 10, 14, 20, 30, 50, 90, 200] * 2:
        base = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}" for _ in range(size + 3)]
        for _ in range(10):
            w = list(base)
            for _ in range(rng.randrange(max(2, size // 14))):
                at = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.4:
                    w[at] = f"x{rng.randrange(10**6)}"
                elif kind < 0.7:
                    w.insert(at, f"y{rng.randrange(10**6)}")
                elif len(w) > 1:
                    del w[at]
            out[len(out)] = " ".join(w)
    return out


def linked(texts: dict[int, str], n: int, percent: int) -> dict[int, int]:
    sets = {}
    for k, t in texts.items():
        w = t.split()
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {k: root(k) for k in sets}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_jaccard_components_of_near_copies(spark, monkeypatch, n, percent):
    texts = near_copies(percent)
    expected = linked(texts, n, percent)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = ngram_join.jaccard_components(df, n, percent).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    # The same with clusters cut into many tiles, buckets and folds.
    for name, value in (("BIN", 150), ("BUCKET", 50), ("FLUSH", 500), ("COUNTED", 300)):
        monkeypatch.setattr(ngram_join, name, value)
    found = ngram_join.jaccard_components(df, n, percent).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


def test_a_signature_of_many_sets_is_one_row_of_its_bucket(spark):
    """Unlike sets of 7 shingles often have an empty segment, the same for all."""
    bands = ngram_join.Bands(80)
    largest = []
    for count in (500, 4000):
        texts = [(k, " ".join(f"w{k}x{i}" for i in range(11))) for k in range(count)]
        df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
        rows = ngram_join._signature_rows(df, 5, bands, 1).collect()
        keys = np.concatenate([np.frombuffer(r.keys, np.uint32) for r in rows if r.kind == 1])
        largest.append(np.unique(keys, return_counts=True)[1].max())
    behind = [np.frombuffer(r.records, np.int64) for r in rows if r.kind == 3]
    assert max(map(len, behind)) > 10
    assert max(largest) < ngram_join.FEW


def test_sets_behind_a_node_are_found_from_another_task(spark):
    """One document looks up what many others only have."""
    keys = np.array([8, 8, 8, 8, 8, 8, 20, 20, 31], dtype=np.uint64)
    records = np.array([1, 2, 3, 4, 4, 4, 5, 6, 7], dtype=np.int64)
    k, r, nodes, members = ngram_join.gathered(keys, records, 4)
    assert [m.tolist() for m in members] == [[1, 2, 3, 4]]
    assert sorted(zip(k.tolist(), r.tolist())) == sorted(
        [(8, int(nodes[0])), (20, 5), (20, 6), (31, 7)]
    )
    none = np.empty(0, dtype=np.uint64)
    assert ngram_join.gathered(none, none.astype(np.int64), 4)[3] == []
    rows = [
        (1, None, keys[:1].astype(np.uint32).tobytes(), nodes.tobytes()),
        (3, int(nodes[0]), None, members[0].tobytes()),
        (3, 77, None, np.array([90, 91], dtype=np.int64).tobytes()),
    ]
    looked_up = np.array([9], dtype=np.uint32).tobytes(), np.array([50], dtype=np.int64).tobytes()
    signed = spark.createDataFrame(
        [(kind, None, None, h1, None, 0, a, b) for kind, h1, a, b in [*rows, (1, None, *looked_up)]],
        ngram_join.SIGNATURE_SCHEMA,
    )
    found = connected_components(ngram_join._candidate_edges(signed)).collect()
    assert {1, 2, 3, 4, 50} <= {x.id for x in found} <= {1, 2, 3, 4, 50, int(nodes[0])}
    assert len({x.component for x in found}) == 1


@given(st.data())
@settings(deadline=None, max_examples=200)
def test_allocations_add_up(data):
    m = data.draw(st.integers(1, 12))
    costs = np.array(data.draw(st.lists(st.floats(0, 9), min_size=m, max_size=m)))
    kept = data.draw(st.integers(0, m))
    nearly = np.array(data.draw(st.lists(st.floats(0, 9), min_size=kept, max_size=kept)))
    need = data.draw(st.integers(1, m))
    exact, once = ngram_join.allocate(costs, nearly, need)
    assert exact.sum() + once.sum() == need
    assert not (once & ~exact).any()


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    bands = ngram_join.Bands(80)
    for size in [6, 9, 13, 25, 60, 150, 400]:
        for _ in range(40):
            both = rng.integers(1, 2**62, size=size + size // 4).astype(np.uint64)
            a = np.unique(both[: size + rng.integers(0, size // 8 + 1)])
            drop = rng.permutation(len(a))[: rng.integers(0, size // 8 + 1)]
            b = np.unique(np.append(np.delete(a, drop), both[size + size // 8 :][: len(drop) // 2]))
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common) or np.array_equal(a, b):
                continue
            # Whatever the tokens' frequencies say.
            ka = ngram_join.signatures(a, rng.integers(0, 5, len(a)), bands)
            kb = ngram_join.signatures(b, rng.integers(0, 5, len(b)), bands)
            shared = np.intersect1d(ka >> np.uint64(1), kb >> np.uint64(1))
            active = {int(k >> np.uint64(1)) for k in np.append(ka, kb) if k & np.uint64(1)}
            assert any(int(k) in active for k in shared)


@given(st.lists(st.integers(1, 32), max_size=60))
@settings(deadline=None)
def test_best_fit_decreasing_equals_a_scan(lengths):
    rows = bestfit.best_fit_decreasing(np.array(lengths, dtype=np.int64), 32)
    free: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(32 - n)
    assert sorted(32 - sum(lengths[k] for k in r) for r in rows) == sorted(free)
    assert sorted(k for r in rows for k in r) == list(range(len(lengths)))


@pytest.mark.parametrize(("d", "bits"), [(2, 4), (3, 3)])
def test_hilbert_neighbours_are_adjacent(d, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d), axis=-1).reshape(-1, d)
    keys = curve_packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_ids_are_those_of_the_vocabulary(ids_of):
    rng = random.Random(1)
    encode = encoder(vocabulary_paths())
    letters = [*map(chr, range(256)), "<|endoftext|>", "漢", "🙂", "œ", " ", "'s", " the"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        assert encode(text).tolist() == ids_of(text)


def test_boundary_tokens_follow_the_rule():
    starts, ends = np.array([0, 2, 7]), np.array([2, 7, 9])
    sections = np.array([0, 3, 8])
    for rule, expected in (("first", ([2, 1, 0], [1, 1, 0])), ("most", ([1, 2, 0], [0, 2, 0]))):
        n, crossing = token_spans.allocate(starts, ends, sections, 9, rule)
        assert (n.tolist(), crossing.tolist()) == expected


def test_close_pairs_equal_all_pairs():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(5, 24))
    x = np.array([base[k % 5] + rng.normal(size=24) * rng.choice([0.1, 0.3, 0.5]) for k in range(900)])
    axes = np.linalg.svd(x)[2].T
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    i, j = close_pairs(x, x, axes, 0.9, True)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(np.triu(near, 1)))))
    i, j = close_pairs(x[:300], x[300:], axes, 0.9, False)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(near[:300, 300:]))))


def test_links_are_counted_as_they_are_found():
    """Two tiles of near-equal vectors link every row with every other; their pairs are
    never all held."""
    rng = np.random.default_rng(1)
    n = 1_500
    x = np.ones((2 * n, 16)) + rng.normal(size=(2 * n, 16)) * 0.01
    tile, copies = np.repeat([0, 1], n), rng.integers(1, 4, 2 * n)
    tracemalloc.start()
    links, roots = linked_rows(x, tile, 0, 1, copies, np.eye(16), 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (links[:n] == copies[n:].sum()).all() and (links[n:] == copies[:n].sum()).all()
    assert not roots.any()
    # The pairs alone, as two numbers each, are 36 MB; one block of rows is 12 MB.
    assert peak < 36e6 * 1.5, peak


def test_chains_across_blocks_have_one_root(monkeypatch):
    monkeypatch.setattr("tallyloom.llm.vector_dedup.BLOCK", 3)
    monkeypatch.setattr("tallyloom.llm.vector_dedup.PAIRS", 2)
    turn = np.random.default_rng(2).permutation(41)
    angle = np.where(turn < 20, turn, turn + 30) * 0.4
    x = np.column_stack([np.cos(angle / 10), np.sin(angle / 10)])
    links, roots = linked_rows(x, np.zeros(41, int), 0, 0, np.ones(41, int), np.eye(2), 0.999)
    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ x.T >= 0.999
    expected = np.arange(41)
    for _ in range(41):
        expected = np.array([expected[row].min() for row in near])
    assert (roots == expected).all() and len(set(roots.tolist())) == 2
    assert (links == near.sum(axis=1) - 1).all()


@pytest.mark.parametrize("kind", ["clusters", "one place", "even"])
def test_linked_vectors_meet_in_one_pair_of_tiles(spark, kind):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 4))
    if kind == "even":
        x = rng.normal(size=(1200, 4))
    else:
        x = centres[np.arange(1200) % 12] + rng.normal(size=(1200, 4)) * 0.05
    if kind == "one place":
        # Most vectors at one place of the axis, more than fill a tile.
        x[:700] = np.column_stack([np.ones(700), np.zeros(700), rng.normal(size=(700, 2))])
    data = [(k, 1, v) for k, v in enumerate(x.tolist())]
    reps = spark.createDataFrame(data, "id long, copies long, embedding array<double>").repartition(5)
    axis = np.eye(4)[0] if kind == "one place" else principal_axes(reps, 4)[:, 0]
    rows = {r.id: r for r in with_tiles(reps, axis, 0.9, 60).collect()}
    assert len(rows) == 1200
    sizes = collections.Counter(r.tile for r in rows.values())
    assert len(sizes) == 20
    if kind != "one place":
        assert max(sizes.values()) <= 70
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i, j in zip(*map(list, np.nonzero(unit @ unit.T >= 0.9))):
        assert rows[j].tile in rows[i].near
    assert all(r.tile in r.near for r in rows.values())
    if kind == "clusters":
        sent = sum(len(r.near) for r in rows.values())
        assert sent < 0.5 * 1200 * 20


def test_every_shared_window_has_a_common_fingerprint(spark):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        vocabulary = 2 if k % 3 == 0 else 500
        shared = [rng.randrange(vocabulary) for _ in range(10)]
        a, b = ([rng.randrange(vocabulary) for _ in range(rng.randrange(40))] for _ in range(2))
        at, to = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        rows.append((a[:at] + shared + a[at:], b[:to] + shared + b[to:]))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    prints = [decontamination.fingerprints(F.col(c), 10, 6) for c in "ab"]
    assert df.select(F.arrays_overlap(*prints).alias("x")).where("NOT x").count() == 0


def test_terms_are_counted_alike_run_by_run(monkeypatch):
    texts = ["one two, two-three THREE_four 5six İstanbul a\x1cb\x85c", "", None, "one " * 3 + "x" * 99, "ab"]
    terms = {}
    for text in texts[:4:3]:
        for k, feature in enumerate(sorted(toxicity.features(text))):
            if k % 2:
                terms.setdefault(feature, len(terms))
    terms.setdefault("a", len(terms))
    monkeypatch.setattr(toxicity, "REMEMBERED", 2)
    lookup = toxicity.Lookup(terms)
    for text in texts * 2:
        expected = collections.Counter(
            terms[f]
            for word in toxicity.WORD.findall((text or "").lower())
            for f in toxicity.forms(word)
            if f in terms
        )
        assert lookup.counts(text) == expected
    assert lookup.counts("a") and len(lookup.known) <= 2
