"""Near-duplicate joins, substring dedup, language-model scores and components on small inputs."""

from __future__ import annotations

import itertools
import math
import random

import brute
import numpy as np
import pytest

from stagewise.llm import embedding_dedup, jaccard_join
from stagewise.llm import words as words_module
from stagewise.llm.components import connected_components
from stagewise.llm.embedding_dedup import join_sequences, link_vectors
from stagewise.llm.exchange import Chunk, bucket_of, join_parts, pack, split_parts, unpack
from stagewise.llm.jaccard_join import link_documents, plan_bands
from stagewise.llm.language_model import learn_weights, score_texts
from stagewise.llm.substring_dedup import _sorted_windows, dedup_substrings, runs_of

SCHEMA = "doc_id long, text string, chunk string, node int, keys string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "c", 1, "k") for d, t in rows], SCHEMA).repartition(4)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: tuple((x is not None, x) for x in row))


def test_packing_gives_back_what_was_packed():
    for values in ([], [7], [3, 3, 9, 2**64 - 1, 1]):
        assert unpack(pack(np.array(values, np.uint64)), np.uint64).tolist() == values
    assert unpack(pack(np.array([-5, 9, 0])), np.int64).tolist() == [-5, 9, 0]
    assert split_parts(join_parts([b"", b"ab", b"c"])) == [b"", b"ab", b"c"]


# --- components ---


def test_components_are_those_of_plain_python(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(20)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5), (7, 8), (8, 7)]
    want = brute.roots({n for a, b in links if a != b for n in (a, b)}, links)
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted(want.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Jaccard join ---


def _near_copies():
    rng = random.Random(2)
    word = lambda: f"{rng.choice('Ab')}{rng.randrange(5000)}"
    docs, bases = {}, [[word() for _ in range(n)] for n in (11, 14, 30, 60, 150, 400, 900)]
    for d in range(110):
        text = list(rng.choice(bases))
        for _ in range(rng.randrange(0, max(2, len(text) // 25))):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = [word()] * rng.randrange(3)
        docs[d * 3 % 151] = " ".join(text)
    docs |= {200: None, 201: "", 202: " \n ", 203: "One", 204: "one", 205: "a b", 206: "a b", 207: "a b c", 208: "b a"}
    docs |= {209: "a b c d " * 3000, 210: "A b c d " * 4000, 211: "x " * 9, 212: "x x x"}
    return docs


@pytest.mark.parametrize("double_all", [False, True])
def test_jaccard_components_are_those_of_all_pairs(spark, double_all):
    docs = _near_copies()
    found = link_documents(frame(spark, docs.items()), double_all)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute.jaccard_components(docs)


def test_jaccard_join_of_repeated_rows_null_ids_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    found = link_documents(frame(spark, [(4, text), (4, text), (9, text), (None, text), (6, None), (None, None)]))
    assert ordered(found.collect()) == [(None, 0, None), (None, 38, None), (4, 38, 4), (4, 38, 4), (6, 0, 6), (9, 38, 4)]
    assert link_documents(frame(spark, [])).count() == 0


def test_links_through_a_copy_that_is_not_the_pivot_are_found(spark):
    """A chain of documents, each linked with its neighbours only, and a group with several components."""
    words = [f"w{i}" for i in range(400)]
    docs = {i: " ".join(words[i * 6 : i * 6 + 120]) for i in range(40)}
    docs |= {100 + i: " ".join([*words[:118], *(f"q{i}x{k}" for k in range(i))]) for i in range(30)}
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_documents(frame(spark, docs.items())).collect()}
    assert found == brute.jaccard_components(docs)


def test_bands_hold_what_their_pairs_can_differ_in():
    for double_all in (False, True):
        bands = plan_bands({9: 10**9, 100: 10**7, 5000: 10}, double_all)
        for size, partner in itertools.product(range(9, 3000, 7), range(9, 3000, 13)):
            if size <= partner and 10 * size >= 9 * partner:
                band = next(b for b in bands if b.low <= size <= b.high)
                assert partner <= band.reach
                assert 2 * band.double + (band.segments - band.double) > (size + partner) // 19
    # Deletions pay where sets have few segments to leave out and are many; larger sets leave their longest lists out.
    few, many = plan_bands({9: 10}), plan_bands({9: 10**10, 200: 10**10})
    assert few[0].double == 0 and many[0].double > 0
    assert many[7].double == 0 and many[7].segments > max((many[7].high + many[7].reach) // 19 + 1, 40)


# --- embeddings ---


def _vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    rows = []
    for i in range(420):
        vector = centres[rng.integers(12)] + rng.normal(size=8) * rng.choice([0.02, 0.1, 0.2])
        rows.append((i, vector.tolist() if i % 9 else centres[0].tolist(), int(rng.integers(2))))
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 0.0]]
    odd += [[1e-200] * 8, [1e200] * 8, [-0.0, 1.0], [0.0, 2.0], [1.0, 0.0]]
    rows += [(500 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(600, rows[0][1], None), (7, rows[1][1], 0), (None, rows[1][1], 0)]
    return rows


def _usable(row):
    doc, vector, label = row
    good = vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
    return doc is not None and label is not None and bool(good)


def test_vector_links_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 50)
    rows = _vectors()
    links = []
    for i, j in itertools.combinations([i for i, r in enumerate(rows) if _usable(r)], 2):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        if la == lb and len(a) == len(b):
            a, b = (np.array(v) / max(map(abs, v)) for v in (a, b))
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.98:
                links.append((i, j))
    root = brute.roots(range(len(rows)), links)
    lowest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            lowest[root[i]] = min(lowest.get(root[i], r[0]), r[0])
    degree = [sum(i in link for link in links) for i in range(len(rows))]
    want = [(r[0], degree[i], c := lowest.get(root[i]), r[0] is None or r[0] == c) for i, r in enumerate(rows)]
    table = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    assert ordered(link_vectors(table.repartition(5)).collect()) == ordered(want)
    assert link_vectors(table.where("vec_id < -1")).count() == 0


def test_interval_recursion_skips_only_what_is_far():
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(700, 4))
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    unit = unit[np.lexsort(np.floor(unit[:, ::-1] / 0.2).T)]
    left, right = join_sequences(unit, unit[:, :2], unit, unit[:, :2], 0.2, 0.98, True)
    want = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.98), strict=True) if i < j}
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == want and len(left) == len(want)


# --- substrings ---


def _passages():
    rng = random.Random(8)
    vocabulary = [f"W{i}" for i in range(4000)] + ["É"]
    passages = [rng.choices(vocabulary, k=n) for n in (49, 50, 51, 80, 300)]
    docs = {}
    for d in range(60):
        parts = [rng.choices(vocabulary, k=rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            at = rng.randrange(max(1, len(passage) - 60))
            parts += [passage[at:], rng.choices(vocabulary, k=rng.randrange(40))]
        docs[d * 7 % 61] = rng.choice([" ", "\n", " \t "]).join(w for p in parts for w in p)
    docs |= {100: None, 101: "", 102: " \x0b ", 103: "x " * 300, 104: "x " * 120, 105: " ".join(passages[1]).lower()}
    docs |= {106: " ".join(vocabulary * 4), 107: " ".join(vocabulary[:60]) + " tail"}
    return docs


@pytest.mark.parametrize("hot_runs", [10_000, 0])
def test_removed_substrings_are_those_of_plain_python(spark, hot_runs):
    docs = _passages()
    found = dedup_substrings(frame(spark, docs.items()), hot_runs=hot_runs)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()}
    assert got == brute.substring_dedup(docs)


def test_substrings_of_repeated_rows_null_ids_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(55))
    found = dedup_substrings(frame(spark, [(4, text), (4, text), (9, text + " end"), (None, text)]))
    want = [(None, 55, 0, text), (4, 55, 0, text), (4, 55, 0, text), (9, 56, 55, "end")]
    assert ordered(found.collect()) == want
    assert dedup_substrings(frame(spark, [])).count() == 0


# --- language model ---


def test_base_scores_are_those_of_plain_python_and_the_model_is_better(spark):
    rng = random.Random(9)
    follow = {w: rng.choices(range(40), k=3) for w in range(40)}
    docs = {}
    for d in range(120):
        text, at = [], rng.randrange(40)
        for _ in range(rng.randrange(120)):
            text.append(f"{'W' if rng.random() < 0.3 else 'w'}{at}")
            at = rng.choice(follow[at])
        docs[d] = " ".join(text)
    docs |= {500: None, 501: "", 502: "unheard words", 503: "w1\x1cw2 É"}
    rows = {r["doc_id"]: r for r in score_texts(frame(spark, docs.items())).collect()}
    for d, (held, tokens, known, total, base) in brute.language_model_base(docs).items():
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_weights_favour_the_estimate_that_fits():
    levels = 20 * 15 + 2
    cells = np.array([(3 * levels + 2) * levels + 60, (5 * levels + 0) * levels + 2])
    weights = learn_weights(cells, np.array([100, 100]), 50)
    assert weights[3].argmax() == 0 and weights[5].argmax() == 1
    assert np.allclose(weights.sum(axis=1), 1) and (weights > 0).all()


def test_scores_without_training_documents_and_of_odd_rows(spark):
    held = [d for d in range(100) if brute.remainder(d, 7) == 2][:2]
    rows = score_texts(frame(spark, [(d, "a b") for d in held] + [(None, "a")])).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in rows} == {(0, 0, 0.0, 0.0)}
    learned = next(d for d in range(100) if brute.remainder(d, 7) != 2)
    again = frame(spark, [(learned, "a b"), (learned, "a b"), (None, "a c")])
    found = ordered(score_texts(again).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens").collect())
    assert found == [(None, False, 3, 2, 6), (learned, False, 3, 3, 6), (learned, False, 3, 3, 6)]
    assert score_texts(frame(spark, [])).count() == 0


def test_jaccard_similarity_is_exact_at_the_border():
    assert jaccard_join.similar(90, 95, 95) and not jaccard_join.similar(89, 95, 95)


def test_minimisers_spread_over_the_buckets():
    rng = random.Random(6)
    text = " ".join(f"w{rng.randrange(50_000)}" for _ in range(60_000)).encode()
    data = np.frombuffer(text, np.uint8)
    runs = runs_of(Chunk(0, "c", np.array([1]), np.array([True]), data, np.array([0, len(data)])))
    shares = np.bincount(bucket_of(np.unique(runs.keys), 36), minlength=36) / len(np.unique(runs.keys))
    assert len(runs.keys) > 2000 and shares.max() < 0.05 and shares.min() > 0.01


def test_sorted_windows_are_compared_word_for_word(monkeypatch):
    rng = random.Random(7)
    strings = {" ".join(rng.choices("ab", k=rng.randrange(4, 30))).encode(): n for n in (5, 3, 9, 1, 7, 8)}
    want, lowest = {}, {}
    windows = lambda s: [b" ".join(s.split(b" ")[i : i + 4]) for i in range(s.count(b" ") - 2)]
    for s, doc in strings.items():
        for w in windows(s):
            lowest[w] = min(doc, lowest.get(w, doc))
    want = {s: [lowest[w] for w in windows(s)] for s in strings}
    assert {s: x.tolist() for s, x in _sorted_windows(strings, 4).items()} == want
    # The same if hashes say nothing.
    monkeypatch.setattr(words_module, "gram_hashes", lambda hashes, n: np.zeros(max(0, len(hashes) - n + 1), np.uint64))
    assert {s: x.tolist() for s, x in _sorted_windows(strings, 4).items()} == want
