"""Every query of the subpackage against its SQL or a brute-force version."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from duck import assert_same, connect
from tallyloom.llm import line_dedup, queries, token_spans, toxicity
from tallyloom.llm.bestfit import position_ids


@pytest.fixture(scope="module")
def duck(sf01):
    con = connect(sf01)
    yield con
    con.close()


def test_all_are_registered():
    registered = contract.queries()
    numbers = [n for n in registered if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in numbers) == list(range(1, 14))
    assert "pipeline" in registered
    assert set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf01, duck, name):
    assert assert_same(queries.QUERIES[name](spark, sf01), duck, queries.SQL[name]) > 0


def test_best_fit_rows_hold_every_token_once(spark, sf01, texts, ids_of):
    from tallyloom.llm import bestfit
    from tallyloom.sources.scratch import scratch_path
    from tallyloom.sources.tables import read_table

    path = scratch_path(spark, "test")
    bestfit.write_matrices(read_table(spark, sf01, "documents"), path)
    rows = bestfit.read_matrices(spark, path).collect()
    expected = {k: [*ids_of(t), 0] for k, t in texts.items()}
    seen = collections.Counter()
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u2")
        assert len(ids) == 1024 and not ids[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1] and r.cu_seqlens[-1] == r.n_tokens
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert ids[a:b].tolist() == expected[d][s : s + b - a]
            seen[d] += b - a
    assert seen == {k: len(v) for k, v in expected.items()}
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert sum(r.n_tokens for r in rows) / (1024 * len(rows)) > 0.98
    out = queries.op3_best_fit_packing(spark, sf01)
    assert out.count() == len(rows)
    assert position_ids([0, 2, 5], 6).tolist() == [0, 1, 0, 1, 2, 0]


def test_curve_packing_holds_every_token_once(spark, sf01, texts, ids_of):
    expected = {k: np.array([*ids_of(t), 0]) for k, t in texts.items()}
    seen, sequences = collections.Counter(), collections.defaultdict(list)
    for r in queries.op7_curve_packing(spark, sf01).collect():
        piece = expected[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(expected[r.doc_id]) and len(piece) == r.length > 0
        assert zlib.crc32(piece.astype("<u4").tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert seen == {k: len(v) for k, v in expected.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 1024 or (at < 1024 and at & (at - 1) == 0)


def test_token_counts_add_up(spark, sf01, texts, ids_of):
    rows = queries.op8_token_attribution(spark, sf01).collect()
    total, sections = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        total[r.doc_id] += r.n_tokens
        sections[r.doc_id].append((r.section, r.start, r.end))
    assert total == {k: len(ids_of(t)) for k, t in texts.items()}
    for k, t in texts.items():
        found = [t[a:b] for _, a, b in sorted(sections[k])]
        assert "".join(found) == t
        assert found == t.splitlines(keepends=True) or "\r" in t or not t or set(t) & set(
            "\x0b\x0c\x1c\x1d\x1e\x85  "
        )


@pytest.mark.parametrize("rule", token_spans.RULES)
def test_tokens_are_attributed_by_the_offsets_of_the_library(spark, sf01, texts, rule):
    """Sections by a pattern, spans by the vocabulary's own library, token by token. No
    token of the texts as they are reaches into another line, so every other text has
    its sentences set apart by blank lines."""
    import public_tokenizers
    from tokenizers import Tokenizer, processors

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    given = {k: t.replace(". ", "\n\n\n \n") if k % 2 else t for k, t in texts.items()}
    expected = {}
    for k, text in given.items():
        lines = [m.span() for m in re.finditer(r"[^\n]*\n|[^\n]+\Z", text)] or [(0, 0)]
        tokens, crossing, at = [0] * len(lines), [0] * len(lines), 0
        for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
            while a >= lines[at][1]:
                at += 1
            to, reaches = at, b > lines[at][1]
            if reaches and rule == "most":
                parts = []
                for n in range(at, len(lines)):
                    part = text[max(a, lines[n][0]) : min(b, lines[n][1])]
                    parts.append((-len(part.encode()), n))
                    if lines[n][1] >= b:
                        break
                to = min(parts)[1]
            tokens[to] += 1
            crossing[to] += reaches
        for n, (low, high) in enumerate(lines):
            expected[k, n] = (low, high, tokens[n], crossing[n])
    documents = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    rows = token_spans.token_counts(documents, rule=rule).collect()
    found = {(r.doc_id, r.section): (r.start, r.end, r.n_tokens, r.n_crossing) for r in rows}
    assert len(found) == len(rows) and found == expected
    assert sum(r.n_crossing for r in rows) > 0


def test_line_dedup_equals_a_loop(spark, sf01, texts):
    seen: set[str] = set()
    expected = {}
    for k in sorted(texts):
        out, at, n = [], 0, 0
        for a, b, words in line_dedup.unit_spans(texts[k], "sentence", 5):
            if " ".join(words) in seen:
                out.append(texts[k][at:a])
                at, n = b, n + 1
            seen.add(" ".join(words))
        expected[k] = ("".join([*out, texts[k][at:]]), n)
    got = queries.op6_line_dedup(spark, sf01).collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in got} == expected
    assert sum(n for _, n in expected.values()) > 100


def test_toxicity_is_right_on_held_out_rows(spark):
    root = "/root/testdata/sf0.1"
    labels = {
        r.doc_id: r.toxic for r in spark.read.parquet(f"{root}/labels.parquet").collect()
    }
    rows = queries.op4_toxicity(spark, root).collect()
    assert len(rows) == spark.read.parquet(f"{root}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(a == b for a, b in judged) / len(judged)
    caught = sum(b for a, b in judged if a) / sum(a for a, _ in judged)
    false = sum(b for a, b in judged if not a) / sum(1 - a for a, _ in judged)
    assert right > 0.97 and caught > 0.78 and false < 0.01


def test_neighbours_equal_a_whole_scan(spark):
    root = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{root}/documents.parquet")
    model, ids = toxicity.fit(documents, spark.read.parquet(f"{root}/labels.parquet"))
    assert len(ids) > toxicity.BLOCK
    texts = {r.doc_id: r.text for r in documents.where("doc_id < 3000").collect()}
    held = {r.doc_id: r.text for r in documents.collect() if r.doc_id in set(ids)}
    whole = [model.vector(held[k]) for k in ids]
    tried = 0
    for text in texts.values():
        vector = model.vector(text)
        if not vector:
            continue
        tried += 1
        scores = [sum(w * v.get(t, 0) for t, w in vector.items()) for v in whole]
        best = sorted((s for s in scores if s > 0), reverse=True)[: toxicity.NEIGHBOURS]
        places, found = model.nearest(vector)
        assert np.allclose(found, best, atol=1e-9)
        assert all(math.isclose(scores[p], s, abs_tol=1e-9) for p, s in zip(places, found))
    assert tried > 50
