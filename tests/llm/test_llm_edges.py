"""Nulls, empty tables, ties, repeated rows, clashing names and planted cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyloom.llm import (
    bestfit,
    chat,
    curve_packing,
    decontamination,
    line_dedup,
    ngram_join,
    token_spans,
    toxicity,
    vector_dedup,
    warc,
)
from tallyloom.sources.scratch import scratch_path
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string"
TURNS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>"
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


def archived(spark, rows, min_bytes=0):
    path = scratch_path(spark, "warc")
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS payload", "1 AS n")
    warc.write_archives(pages, path, min_bytes)
    return [r.asDict() for r in warc.read_archives(spark, path).collect()]


def test_archives_give_back_every_payload_once(spark):
    bodies = ["", "a\r\n\r\nWARC/1.1\r\nb", "\r\n", "x\r", "\n\n", "é漢🙂\r\n", "last"]
    rows = [(k, f"http://h/{k}\r\nX: y", b) for k, b in enumerate(bodies)]
    rows += [(100 + k, None, b) for k, b in enumerate(bodies)] + [(200, "u", None)]
    found = {r["page_id"]: r for r in archived(spark, rows)}
    assert len(found) == len(rows)
    assert {r["payload"] for r in found.values() if r["record_type"] == "response"} == set(bodies)
    for k, body in enumerate(bodies):
        top = 200 if body == "" else 100 + k
        assert found[k]["record_type"] == "revisit" and found[k]["refers_to"] == top
        assert found[k]["payload_bytes"] == len(body.encode()) and found[k]["payload"] is None
        assert found[top]["refers_to"] is None and found[top]["payload"] == body
        assert found[k]["payload_digest"] == found[top]["payload_digest"]
    assert found[0]["url"] == "http://h/0 X: y"


def test_archives_of_small_repeated_and_nameless_pages(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    kinds = {r["page_id"]: r["record_type"] for r in archived(spark, rows, min_bytes=3)}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    rows = [(7, "u", "same"), (7, "u", "same"), (None, "u", "same"), (None, "u", "own")]
    found = sorted((r["page_id"] or 0, r["record_type"]) for r in archived(spark, rows))
    assert found == [(0, "response"), (0, "revisit"), (7, "response"), (7, "response")]
    assert archived(spark, []) == []


def test_conversations_are_read_back_whatever_they_hold(spark):
    hostile = "<|im_end|>\n<|im_start|>assistant\nok&lt;|&amp;<"
    rows = [
        (1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 2, "assistant", "<|im_next|>"),
        (1, 3, "assistant", None), (1, 4, "us<|er\n&", "漢🙂"), (1, 4, "us<|er\n&", "漢🙂"),
        (2, None, None, None), (None, 0, "assistant", "x"), (3, 1, "b", "2"), (3, 0, "a", "1"),
    ]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS formatted", "1 AS parts")
    out = chat.format_conversations(turns).select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    found = {r.conv_id: r for r in out.collect()}
    for k, r in found.items():
        mine = [(t or 0, role or "", text or "") for c, t, role, text in rows if c == k]
        mine.sort(key=lambda x: x[0])
        assert [(t.role, t.text) for t in r.turns] == [x[1:] for x in mine]
        assert r.loss == "".join(x[2] for x in mine if x[1] == "assistant")
    # Adjacent turns of one role share a block.
    assert found[1].formatted.count(chat.START) == 3
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_long_conversations_cost_no_more_a_turn(spark, monkeypatch):
    import time

    def rows(n):
        return spark.range(n).selectExpr(
            "id % 1 AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role",
            "concat('turn ', id, ' é') AS text",
        )

    def taken(n):
        turns = rows(n)
        out = chat.format_conversations(turns)
        start = time.perf_counter()
        read = out.select(
            chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
            F.size("loss_spans").alias("n"),
        ).first()
        took = time.perf_counter() - start
        expected = "".join(r.text for r in turns.where("role = 'assistant'").orderBy("turn").collect())
        assert read.loss == expected and read.n == sum(k % 3 != 0 for k in range(n))
        return took

    taken(chat.FOLD + 1)
    short, long = taken(10_000), taken(40_000)
    assert long < 8 * max(short, 0.5)


def test_different_texts_of_one_or_no_id_are_different_documents(spark):
    passage = " ".join(f"shared{k}" for k in range(12)) + "."
    rows = [(None, passage + " one more."), (None, "Here is another start altogether. " + passage),
            (5, passage), (5, passage), (5, "A third text begins quite differently. " + passage),
            (6, passage + " And so on.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.without_repeats(df).collect()
    holding = [(r.doc_id, r.text) for r in out if passage in r.text]
    # Held by one document of the smallest id; by two rows if that is the one there twice.
    assert len(out) == 6 and {k for k, _ in holding} == {5} and len(set(holding)) == 1
    none = line_dedup.without_repeats(df.where("doc_id IS NULL")).collect()
    assert sum(passage in r.text for r in none) == 1


def test_ids_beyond_16_bits_are_refused(spark):
    from tallyloom.llm.tokens import short_ids

    import numpy as np

    assert short_ids(np.array([0, 65535])).tolist() == [0, 65535]
    with pytest.raises(ValueError):
        short_ids(np.array([70000]))


def test_odd_documents_pass_every_operator(spark, odd_documents):
    n = odd_documents.count()
    found = ngram_join.jaccard_components(odd_documents).collect()
    assert len(found) == n
    component = {r.doc_id: r.component_id for r in found}
    assert component[1] == 1 and component[2] == 2 and component[3] == 3
    assert component[4] == component[5] == 4 and component[6] == component[7] == 6
    assert component[None] is None
    assert {r.n_shingles for r in found if r.doc_id in (1, 2, 3)} == {0}

    cut = line_dedup.without_repeats(odd_documents)
    assert cut.columns == [*odd_documents.columns, "_removed"]
    texts = {(r.doc_id, r.n_chars): r.text for r in cut.collect()}
    assert texts[1, 0] is None and texts[2, 0] == ""
    assert len(texts) == len({(r.doc_id, r.n_chars) for r in odd_documents.collect()})
    first = next(t for (i, _), t in texts.items() if i == 9 and t.startswith("a b"))
    assert first == "a b c d e f g. h i j k l m. n o p q r s.\n x"

    benchmark = spark.createDataFrame(
        [(1, "漢字 🙂"), (2, None), (3, "..."), (None, "one"), (4, "w1 v1 w2 v2 w3 v3 w4 v4 w5 v5")],
        BENCHMARK,
    )
    hits = decontamination.contamination(odd_documents, benchmark).collect()
    assert len(hits) == n
    by_id = {r.doc_id: r for r in hits}
    assert by_id[8].items == ["1"] and by_id[8].n_hit == 2 and by_id[4].n_hit == 10
    assert not by_id[1].contaminated and by_id[1].n_words == 0

    pieces = curve_packing.packed(odd_documents).collect()
    assert sum(r.length for r in pieces if r.doc_id in (1, 2)) == 2
    assert sum(r.n_tokens for r in bestfit.packed_rows(odd_documents).collect()) == sum(
        r.length for r in pieces
    )
    counts = token_spans.token_counts(odd_documents, fields=("lang", "text"), rule="most")
    assert counts.where("doc_id = 1").count() == 2
    total = token_spans.token_counts(odd_documents).agg(F.sum("n_tokens")).first()[0]
    assert total == sum(r.length for r in pieces) - n

    labels = spark.createDataFrame([(2, 1, 1), (4, 1, 0), (None, 0, 1), (4, 1, None)], LABELS)
    scored = toxicity.judged(odd_documents, labels)
    assert scored.columns == [*odd_documents.columns, "_verdict"]
    scored = scored.collect()
    assert len(scored) == n and all(0 <= r._verdict.score <= 1 for r in scored)


def test_empty_tables(spark, odd_documents):
    none = odd_documents.limit(0)
    empty = spark.createDataFrame([], BENCHMARK)
    for out in (
        ngram_join.jaccard_components(none),
        line_dedup.without_repeats(none),
        decontamination.contamination(none, empty),
        curve_packing.packed(none),
        bestfit.packed_rows(none),
        token_spans.token_counts(none),
        vector_dedup.cosine_components(spark.createDataFrame([], VECTORS)),
    ):
        assert out.count() == 0
    assert not decontamination.contamination(odd_documents, empty).where("contaminated").count()
    model, ids = toxicity.fit(none, spark.createDataFrame([], LABELS))
    assert model.score("anything")[0] == 0.5 and ids == []


def test_vectors_of_every_kind(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, []),
        (7, [0.0, 0.0]), (8, [1.0, None]), (9, [1.0, nan]), (10, [1.0, inf]), (11, [1.0]),
        (12, [3e38, 3e38]), (13, [1e-38, 1e-38]), (None, [1.0, 0.0]), (14, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS id", "1 AS copies")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.cosine_components(df).collect()}
    assert len(found) == len(rows)
    assert found[1] == found[2] == found[3] == (2, 1)
    assert found[12] == found[13] == (1, 12)
    assert all(found[k] == (0, k) for k in (4, 5, 6, 7, 8, 9, 10, 11, 14))


def test_vectors_in_many_tiles_equal_all_pairs(spark, monkeypatch):
    """Clusters across tiles, equal vectors, every length from 1e-200 to 1e200."""
    monkeypatch.setattr(vector_dedup, "TILE", 40)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 6))[np.arange(500) % 30] + rng.normal(size=(500, 6)) * 0.15
    x[400:420] = x[3]
    x *= 10.0 ** rng.choice([-200, 0, 200], 500)[:, None]
    ids = rng.permutation(1000)[:500]
    df = spark.createDataFrame([(int(k), v) for k, v in zip(ids, x.tolist())], "vec_id long, embedding array<double>")
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    low = ids.copy()
    for _ in ids:
        least = np.array([low[row].min() for row in near])
        if (least == low).all():
            break
        low = least
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.cosine_components(df).collect()}
    assert found == {
        int(k): (int(n) - 1, int(c), k == c) for k, n, c in zip(ids, near.sum(axis=1), low)
    }


def test_planted_passage_is_cut_from_the_later_document(spark):
    passage = ". ".join(f"Satz {k} hat genug verschiedene Wörter hier" for k in range(10)) + "."
    rows = [
        (1, "Anfang ohne Punkt " + passage + " und ein Ende."),
        (2, "Etwas ganz anderes davor " + passage + " sonst nichts weiter."),
        (3, "Ein sauberer Text, den es nur einmal gibt, bleibt ganz."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.without_repeats(df).collect()}
    assert out[1].text == rows[0][1] and out[3].text == rows[2][1]
    assert "Satz 5" not in out[2].text and len(out[2].text.split()) < 20
    assert all(s.kept_doc_id == 1 for s in out[2].removed)
    for unit in ("line", "paragraph"):
        whole = spark.createDataFrame([(1, passage + "\n\nx"), (2, "y\n\n" + passage)], df.schema)
        out = {r.doc_id: r.text for r in line_dedup.without_repeats(whole, unit).collect()}
        assert out == {1: passage + "\n\nx", 2: "y\n\n"}


def test_a_run_shared_inside_long_sentences_is_cut(spark):
    run = " ".join(f"word{k} thing{k * 7}" for k in range(40))
    rows = [(1, f"Here begins the first {run} and there it ends."), (2, f"Other start, {run} other end.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.without_repeats(df).collect()}
    assert out[1] == rows[0][1]
    assert len(out[2].split()) < 50 and out[2].startswith("Other start,")


def labelled(spark, n, toxic, marker):
    """Documents of words of their own, of which those of a ``toxic`` id hold the marker."""
    rows = [(k, f"q{k}a z{k}b " + (marker if toxic(k) else "gentle")) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(k, 1, int(toxic(k))) for k in range(n)], LABELS)


def test_a_common_marker_of_toxic_texts_is_a_term(spark):
    docs, labels = labelled(spark, 240, lambda k: k % 3 == 0, "trash")
    model, _ = toxicity.fit(docs, labels)
    assert "trash" in model.terms
    assert model.score("what trash")[0] >= toxicity.THRESHOLD > model.score("gentle talk")[0]


def test_a_marker_of_three_examples_is_a_term_at_any_size(spark):
    learned = [k for k in range(0, 400, 2) if zlib.crc32(str(k).encode()) % 3 != 1]
    docs, labels = labelled(spark, 400, lambda k: k in learned[:3], "trash")
    for n in (30, 400):
        model, _ = toxicity.fit(docs.where(f"doc_id < {n}"), labels.where(f"doc_id < {n}"))
        assert "trash" in model.terms
    assert model.score("what trash")[0] > model.score("gentle talk")[0]


def test_neighbours_are_the_same_block_by_block_and_at_once(spark, sf01, texts, monkeypatch):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    model, ids = toxicity.fit(docs, spark.read.parquet(f"{sf01}/labels.parquet"))
    found = []
    for at_once in (1, 10**6):
        monkeypatch.setattr(toxicity, "FIRST_BLOCKS", at_once)
        vectors = [v for t in texts.values() if (v := model.vector(t))]
        found.append([model.search(v, ids[k % 9]) for k, v in enumerate(vectors)])
    for (places, scores, passed), (others, same, whole) in zip(*found, strict=True):
        assert places.tolist() == others.tolist() and scores.tolist() == same.tolist()
        assert passed <= whole
    # The bounds end most searches before the last block that shares a term.
    assert sum(p for _, _, p in found[0]) < 0.7 * sum(p for _, _, p in found[1])


def test_toxicity_equals_plain_counting(spark, sf01, texts):
    """Weights, neighbours, votes and scores written out once more."""
    import math
    from collections import Counter

    import numpy as np

    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    learned = sorted(k for k in labels if zlib.crc32(str(k).encode()) % 3 != 1)
    held = {}
    for k, text in texts.items():
        counts = Counter()
        for word, n in Counter(toxicity.WORD.findall(text.lower())).items():
            for feature in [word, *[word[:m] + "*" for m in range(2, 9) if len(word) > m]]:
                counts[feature] += n
        held[k] = counts
    n, t = len(learned), sum(labels[k] for k in learned)
    in_all, in_toxic = Counter(), Counter()
    for k in learned:
        in_all.update(held[k].keys())
        if labels[k]:
            in_toxic.update(held[k].keys())

    def g(a, b):
        cells = [(b, a * t / n), (a - b, a * (n - t) / n), (t - b, (n - a) * t / n),
                 (n - t - a + b, (n - a) * (n - t) / n)]
        return 2 * sum(x * math.log(x / e) for x, e in cells if x > 0)

    def apart(a, b):
        low, high = sorted([b / t, (a - b) / (n - t)])
        return high >= 2 * low

    terms = {
        f for f, a in in_all.items()
        if a >= 3 and apart(a, in_toxic[f]) and g(a, in_toxic[f]) >= 10.83
    }
    frequency = Counter(f for c in held.values() for f in c.keys() & terms)

    def vector(k):
        v = {
            f: (1 + math.log(m)) * (math.log((1 + len(texts)) / (1 + frequency[f])) + 1)
            for f, m in held[k].items()
            if f in terms
        }
        length = math.sqrt(sum(w * w for w in v.values()))
        return {f: w / length for f, w in v.items()}

    vectors = {k: vector(k) for k in texts}
    examples = [k for k in learned if vectors[k]]

    def near(k):
        every = [(sum(w * vectors[e].get(f, 0) for f, w in vectors[k].items()), e) for e in examples]
        every = [(s, e) for s, e in every if s > 1e-15 and e != k]
        return sorted(every, key=lambda x: (-round(x[0], 10), x[1]))[:16]

    def inputs(found):
        total = sum(s for s, _ in found)
        vote = sum(s * labels[e] for s, e in found) / total if total else 0.5
        return [1.0, 2 * vote - 1, total / 16 * (2 * vote - 1)]

    x = np.array([inputs(near(e)) for e in examples])
    curve = toxicity._logistic(x, np.array([labels[e] for e in examples], float), np.ones(len(x)), t / n)
    # The fitted curve has no slope left.
    p = 1 / (1 + np.exp(-x @ curve))
    start = np.array([math.log((t / n + 1e-6) / (1 - t / n + 1e-6)), 0, 0])
    assert np.abs(x.T @ (np.array([labels[e] for e in examples]) - p) - 0.1 * (curve - start)).max() < 1e-6
    empty = [k for k in learned if not vectors[k]]
    rows = {r.doc_id: r.verdict for r in toxicity.judged(docs, spark.read.parquet(f"{sf01}/labels.parquet"), ["doc_id"]).collect()}
    for k in texts:
        found = near(k) if vectors[k] else []
        if found:
            score = 1 / (1 + math.exp(-float(np.dot(curve, inputs(found)))))
        else:
            others = [labels[e] for e in empty if e != k]
            score = (sum(others) + t / n) / (len(others) + 1)
        assert math.isclose(rows[k].score, score, abs_tol=1e-6), k
        assert rows[k].predicted == int(rows[k].score >= 0.7)
        assert k not in rows[k].examples
        assert np.allclose(rows[k].cosines, [s for s, _ in found[:3]], atol=1e-9)
    assert len(terms) > 20 and sum(1 for k in texts if vectors[k]) > 100


def test_a_document_is_not_judged_by_its_own_label(spark):
    rows = [(k, f"plain words number {k % 5} " + ("trash" if k % 2 else "gentle")) for k in range(60)]
    rows.append((100, "rare thing of its own trash gentle"))
    learned = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 != 1]
    assert 100 in learned
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = []
    for own in (0, 1):
        marks = [(k, 1, k % 2) for k in learned if k != 100] + [(100, 1, own)]
        out = toxicity.judged(docs, spark.createDataFrame(marks, LABELS)).collect()
        verdict = next(r.verdict for r in out if r.doc_id == 100)
        assert 100 not in verdict.examples
        scores.append({e for e in verdict.examples})
    assert scores[0] == scores[1]


def dirty(spark, rows):
    rows = [(k, t, "en", "s", len(t or "")) for k, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def tables(spark, tmp_path, **frames):
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


LEAK = "the quick brown fox jumps over a lazy dog while seven green owls watch"
CLEAN = "nothing of note is written here that any other text would hold as well"


def test_leaks_take_no_clean_row_with_them(spark, tmp_path):
    root = tables(spark, tmp_path, benchmark=spark.createDataFrame([(1, LEAK)], BENCHMARK))
    rows = [(None, "x " + LEAK), (None, CLEAN), (3, LEAK + " y"), (3, CLEAN), (4, CLEAN), (5, None)]
    out = corpus_pipeline.decontamination_stage(spark, dirty(spark, rows), root)
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [
        (0, CLEAN), (3, CLEAN), (4, CLEAN), (5, ""),
    ]


def test_copies_take_no_other_text_with_them(spark):
    other = "a text of its own that shares its id with a copy and shall stay where it is now"
    rows = [
        (1, CLEAN), (5, CLEAN), (5, other), (None, CLEAN), (None, CLEAN), (None, LEAK), (None, LEAK),
        (7, ""), (7, ""), (None, None), (8, "lone"), (9, LEAK), (9, LEAK),
    ]
    out = corpus_pipeline.near_duplicate_stage(spark, dirty(spark, rows), "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out if r.text not in (LEAK,)) == [
        (0, ""), (1, CLEAN), (5, other), (7, ""), (8, "lone"),
    ]
    assert [r.text for r in out].count(LEAK) == 1


def test_pipeline_of_empty_tables_and_of_rows_without_id(spark, tmp_path, sf01):
    from tallyloom.sources.tables import SCHEMAS

    none = {n: spark.createDataFrame([], SCHEMAS[n]) for n in ("documents", "labels", "benchmark")}
    assert corpus_pipeline.run(spark, tables(spark, tmp_path / "none", **none)).count() == 0
    words = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    rows = [(None, t) for t in words] + [(None, words[0]), (2, words[1]), (2, words[2] + " more")]
    frames = none | {"documents": dirty(spark, rows)}
    out = corpus_pipeline.run(spark, tables(spark, tmp_path / "nameless", **frames)).collect()
    # Six texts, each once: that of id 2 in place of its copy without id, or either.
    assert sum(r.start == 0 for r in out) == 6


def test_pipeline_equals_its_stages_by_hand(spark, sf01, texts, ids_of):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    model, _ = toxicity.fit(docs, spark.read.parquet(f"{sf01}/labels.parquet"))
    left = {k: t for k, t in texts.items() if model.score(t)[0] < toxicity.THRESHOLD}
    assert len(left) < len(texts)
    sets = {}
    for k, t in left.items():
        w = t.encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {k: k for k in left}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders: dict = {}
    for k in sorted(sets):
        for s in sets[k]:
            holders.setdefault(s, []).append(k)
    tried = set()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        low, high = sorted((root(a), root(b)))
                        parent[high] = low
    left = {k: t for k, t in left.items() if root(k) == k}
    seen: set[str] = set()
    for k in sorted(left):
        out, at = [], 0
        for a, b, words in line_dedup.unit_spans(left[k], "sentence", 5):
            if " ".join(words) in seen:
                out.append(left[k][at:a])
                at = b
            seen.add(" ".join(words))
        left[k] = "".join([*out, left[k][at:]])
    import re

    def words(t):
        t = "".join(c.lower() if c.isascii() else c for c in t or "")
        return re.findall(decontamination.WORD, t)

    windows = set()
    for r in spark.read.parquet(f"{sf01}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
    clean = {}
    for k, t in left.items():
        w = words(t)
        if not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9)):
            clean[k] = t
    assert len(clean) < len(left)
    pieces: dict = {}
    for r in corpus_pipeline.run(spark, sf01).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    import numpy as np

    got = {
        k: np.frombuffer(b"".join(x for _, x in sorted(v)), dtype="<u4").tolist()
        for k, v in pieces.items()
    }
    assert got == {k: [*ids_of(t), 0] for k, t in clean.items()}


def test_stages_keep_the_columns(spark, odd_documents, sf01):
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf01)
        assert docs.columns == odd_documents.columns, name
        docs.write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("name", ["text", "bytes"])
def test_scratch_only_drops_its_own(spark, name):
    from tallyloom.sources.scratch import drop_path

    with pytest.raises(ValueError):
        drop_path(spark, f"/data/{name}")
