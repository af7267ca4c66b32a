"""Line dedup, decontamination, license scans, toxicity and byte pairs on small inputs."""

from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stagewise.llm import bpe
from stagewise.llm.decontamination import find_windows, hit_words
from stagewise.llm.license_scan import NOTICES, PHRASES, scan_licenses
from stagewise.llm.line_dedup import dedup_lines
from stagewise.llm.toxicity import fit_toxicity, is_held_out, score_toxicity
from stagewise.llm.words import KINDS, HashSet, word_slices

SCHEMA = "doc_id long, text string, n_lines string, score int, ids string, items int"
WORD_FILE = bpe.public_file("word_bpe_49k.json")


def frame(spark, rows):
    """Documents with extra columns that are named like outputs; the ids may be null or repeated."""
    return spark.createDataFrame([(d, t, "x", 7, "y", 3) for d, t in rows], SCHEMA).repartition(3)


def by_id(df, *columns):
    return {row[0]: tuple(row)[1:] for row in df.select("doc_id", *columns).collect()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=60) | st.none(), max_size=8))
def test_words_are_those_of_the_patterns(texts):
    column = pa.array(texts, pa.string())
    for kind, pattern in (("letters", brute.LETTERS), ("spaced", brute.SPACED)):
        # Words of letters are always taken from lower-cased text.
        for lower in (True,) if kind == "letters" else (True, False):
            got = []
            for _, _, w in word_slices(column, kind, lower, limit=40):
                for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
                    got.append([w.data[w.starts[i] : w.ends[i]].tobytes().decode() for i in range(a, b)])
            assert got == [brute.words(t, pattern, lower) for t in texts]
    assert set(KINDS) == {"letters", "spaced"}


def test_equal_words_have_equal_hashes_and_others_do_not():
    texts = [" ".join(f"{p}{i}" * (1 + i % 9) for i in range(300)) for p in ("a", "word", "a")]
    hashes = {}
    for _, _, w in word_slices(pa.array(texts), "spaced", False):
        for s, e, h in zip(w.starts, w.ends, w.hashes.tolist(), strict=True):
            hashes.setdefault(w.data[s:e].tobytes(), set()).add(h)
    assert all(len(v) == 1 for v in hashes.values()) and len(set.union(*hashes.values())) == len(hashes)
    members = np.array([5, 9, 2**63], np.uint64)
    places, numbers = HashSet(members).find(np.array([9, 1, 2**63, 2**64 - 1], np.uint64))
    assert places.tolist() == [0, 2] and numbers.tolist() == [1, 2]


# --- line dedup ---


def _line_cases():
    rng = random.Random(3)
    docs = {1: "a\nb\nc\nd\ne", 2: "x\nb\nc\nd\ny", 3: "q\na\nb\nc\nd\ne\nr", 4: "a\nb", 5: "", 6: None, 7: "a\na\na\na\na"}
    docs |= {8: "\n\n\n\n \n\n", 9: "\n\n\n\n", 10: "a\nb\na\nb\na\nb\na", 11: "a\nb\nc\nd\ne", 12: "x\nb\nc\nd\ny\n"}
    for d in range(20, 60):
        docs[d] = "\n".join(rng.choice("mnop") for _ in range(rng.randrange(9)))
    docs[70] = "\n".join(f"line {i % 700}" for i in range(3000))
    return docs


def test_line_dedup_is_what_plain_python_gives(spark):
    docs = _line_cases()
    found = dedup_lines(frame(spark, docs.items()))
    assert found.columns == ["doc_id", "text", "n_lines", "score", "ids", "items", "n_removed"]
    want = {d: (lines, gone, text) for d, (lines, gone, text) in brute.line_dedup(docs).items()}
    assert by_id(found, "n_lines", "n_removed", "text") == want


def test_line_dedup_of_repeated_rows_null_ids_and_no_rows(spark):
    text = "a\nb\nc"
    found = dedup_lines(frame(spark, [(2, text), (2, text), (None, text), (3, text + "\nd")]))
    rows = sorted((r["doc_id"] or 0, r["n_removed"], r["text"]) for r in found.collect())
    assert rows == [(0, 0, text), (2, 3, ""), (2, 3, ""), (3, 3, "d")]
    assert dedup_lines(frame(spark, [])).count() == 0


# --- decontamination ---


def _contaminated():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "x1", "Don't"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([30, 12, 10, 9, 4, 2, 1, 25, 25])]
    items += [(7, items[7][1]), (20, items[0][1]), (None, "null item words here"), (30, None), (31, ""), (32, "w1 w2")]
    docs = []
    for _ in range(60):
        text = rng.choices(vocabulary, k=rng.randrange(5, 60))
        _, inner = rng.choice(items[:9])
        inner = inner.split()
        a = rng.randrange(len(inner))
        docs.append(" ".join([*text[:9], *inner[a : a + rng.randrange(1, 30)], *text[9:]]).upper())
    docs += [items[0][1], items[0][1], "Null ITEM, words-here!", None, "", "nothing of it", " ".join(["w1 w2"] * 4000)]
    return docs, items


@pytest.mark.parametrize("block_windows", [10_000, 25])
def test_decontamination_is_what_plain_python_gives(spark, block_windows):
    docs, items = _contaminated()
    ids = [None if i == 3 else i // 2 for i in range(len(docs))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_windows(frame(spark, zip(ids, docs, strict=True)), benchmark, block_windows=block_windows)
    assert set(found.columns) == {"doc_id", "text", "n_lines", "score", "ids", "n_words", "spans", "items"}
    rows = found.select("doc_id", "text", "n_words", hit_words(F.col("spans")), "items").collect()
    want = brute.decontamination(docs, items)
    key = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(map(tuple, rows), key=key) == sorted(
        ((i, d, *w) for i, d, w in zip(ids, docs, want, strict=True)), key=key
    )


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = find_windows(frame(spark, [(1, "some words")]), none).first()
    assert (found["n_words"], found["spans"], found["items"]) == (2, [], [])
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert find_windows(frame(spark, []), items).count() == 0


# --- licenses ---


def test_license_base_is_what_plain_python_gives(spark):
    rng = random.Random(7)
    pieces = [*PHRASES, "cc", "by", "license", "MIT", "apache", "Éa", "gnu general public", "K", "İ", "x", "mit-license"]
    texts = [" ".join(rng.choices(pieces, k=rng.randrange(12))).upper() for _ in range(80)]
    texts += [None, "", "  ", "cc by " * 3000, "cc by " * 3000, "MIT  License/Apache\nLicense"]
    rows = [(None if i == 5 else i // 2, t) for i, t in enumerate(texts)]
    found = scan_licenses(frame(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    key = lambda row: tuple((x is not None, x) for x in row)
    want = [(d, *brute.license_base(t, PHRASES)) for d, t in rows]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert scan_licenses(frame(spark, [])).count() == 0


def test_license_votes_are_those_of_plain_python(spark):
    rng = random.Random(12)
    templates = [*PHRASES, *NOTICES]
    rows = []
    for d in range(150):
        parts = []
        for template in rng.choices(templates, k=rng.randrange(0, 3)):
            words = template.split(" ")
            for _ in range(rng.choice([0, 0, 1, 3, len(words) // 10])):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = rng.choice([[], ["other"], ["the", "x"]])
            parts += words + rng.choices(["the", "license", "of", "software", "and"], k=rng.randrange(12))
        rows.append((d, " ".join(parts)))
    found = by_id(scan_licenses(frame(spark, rows)), "labels", "score")
    assert found == {d: brute.license_votes(t, PHRASES, NOTICES) for d, t in rows}
    assert sum(labels != "" for labels, _ in found.values()) > 60


def test_license_templates_of_any_length(spark):
    rng = random.Random(13)
    long = {n: [f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(n)] for n in (2, 63, 64, 80, 125, 1500)}
    notices = {" ".join(w): f"n{n}" for n, w in long.items()}
    noisy = {n: [w if rng.random() > 0.1 else "changed" for w in ws] for n, ws in long.items() if n >= 80}
    rows = [(n, " ".join(["before", *w, "after"])) for n, w in long.items()] + [(-n, " ".join(w)) for n, w in noisy.items()]
    found = by_id(scan_licenses(frame(spark, rows), phrases={" ".join(long[64]): "whole"}, notices=notices), "labels", "score")
    assert {n: found[n][0] for n in long} == {n: f"n{n}" if n != 64 else "n64,whole" for n in long}
    assert all(found[n][1] == 1.0 for n in long) and all(found[-n][0] == f"n{n}" and 0.75 <= found[-n][1] < 1 for n in noisy)
    assert found == {d: brute.license_votes(t, {" ".join(long[64]): "whole"}, notices) for d, t in rows}
    for wrong in ("one", "two  spaces", ""):
        with pytest.raises(ValueError, match="template"):
            scan_licenses(frame(spark, rows), notices={wrong: "x"})


def test_license_notices_add_labels_and_survive_small_changes(spark):
    grant = next(n for n, label in NOTICES.items() if label == "mit-notice")
    words = grant.split()
    changed = " ".join([*words[:8], "quite", *words[8:]])
    rows = [(1, f"Foreword. {grant.upper()}, etc."), (2, changed), (3, " ".join(words[:9])), (4, " ".join(words[::-1]))]
    rows += [(5, "Licensed under the GNU General Public License, version 3."), (6, "released under the MIT license")]
    found = by_id(scan_licenses(frame(spark, rows)), "base_labels", "labels", "score")
    assert found[1] == ("", "mit-notice", 1.0)
    assert found[2][1] == "mit-notice" and 0.9 <= found[2][2] < 1
    assert found[3] == ("", "", 0.0) and found[4] == ("", "", 0.0)
    assert found[5] == ("gpl", "gpl,gpl-3.0", 1.0) and found[6] == ("mit", "mit,mit-release", 1.0)


# --- toxicity ---


def _toxic_corpus(n=700):
    """Neither word is toxic by itself; both together are. Only pairwise weights can tell."""
    rng = random.Random(13)
    rows, labels = [], []
    for d in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = rng.choices([f"filler{i}" for i in range(300)], k=30) + ["grobian"] * a + ["northerner"] * b
        rng.shuffle(text)
        rows.append((d, " ".join(text)))
        labels.append((d, 1, int(a and b)))
    return rows, labels


def test_toxicity_learns_pairs_and_keeps_labels_of_held_out_rows_apart(spark):
    rows, labels = _toxic_corpus()
    wrong = [(d, q, t if brute.remainder(d, 5) else 1 - t) for d, q, t in labels]
    docs = frame(spark, rows + [(None, "grobian northerner"), (9_001, None), (9_002, ""), (9_002, "")])
    found = []
    for given in (labels, wrong):
        table = spark.createDataFrame(given + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
        scored = score_toxicity(docs, fit_toxicity(docs, table)).withColumn("held_out", is_held_out(F.col("doc_id")))
        found.append(sorted(map(tuple, scored.select("doc_id", "held_out", "score", "predicted", "text").collect()), key=str))
    assert found[0] == found[1]
    truth = {d: t for d, _, t in labels}
    held = [r for r in found[0] if r[1] and r[0] in truth]
    assert sum(r[3] == truth[r[0]] for r in held) >= 0.97 * len(held) > 0
    assert all(r[1] == (brute.remainder(r[0], 5) == 0) for r in found[0] if r[0] is not None)
    blank = {r[2] for r in found[0] if not r[4]}
    assert len(blank) == 1 and 0 < blank.pop() < 0.5 and all(0 <= r[2] <= 1 for r in found[0])


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    for given in ([], [(1, 1, 0), (2, 1, 0)]):
        model = fit_toxicity(docs, spark.createDataFrame(given, "doc_id long, quality int, toxic int"))
        assert score_toxicity(docs, model).select("score").distinct().count() == 1
    assert score_toxicity(frame(spark, []), model).count() == 0


# --- byte pairs ---


def test_ids_and_texts_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_FILE)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(17)
    anything = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["", None, " \n", "aaaa aaaaaaa", "it's we'LL 'S", "a<|endoftext|>B <|startoftext|>", "<|ENDOFTEXT|>", "ΣΑΣ İ"]
    texts += [f"ab{c}cd 1{c}! {c}{c} x'{c}" for c in anything[:0x600]]
    texts += ["".join(rng.choices(anything, k=25)) for _ in range(200)] + ["long words " * 20_000, "repeated", "repeated"]
    rows = [(None if i == 4 else i, t) for i, t in enumerate(texts)]
    encoded = bpe.encode_texts(frame(spark, rows), WORD_FILE)
    decoded = bpe.decode_ids(encoded.withColumnRenamed("score", "decoded"), WORD_FILE)
    got = {r["doc_id"]: (list(r["ids"]), r["decoded"], r["d"]) for r in decoded.select("*", bpe.joined_digest("ids").alias("d")).collect()}
    for (doc, text), want in zip(rows, library.encode_batch([t or "" for t in texts], add_special_tokens=False), strict=True):
        ids = " ".join(map(str, want.ids))
        assert got[doc] == (want.ids, library.decode(want.ids, skip_special_tokens=False), hashlib.sha256(ids.encode()).hexdigest())
    nothing = spark.createDataFrame([(1, None)], "doc_id int, ids array<int>")
    assert bpe.decode_ids(nothing, WORD_FILE).first()["decoded"] == ""
    assert bpe.encode_texts(frame(spark, []), WORD_FILE).count() == 0


def test_merges_must_follow_the_merges_of_their_parts():
    symbols = bpe._byte_symbols()
    vocab = {s: i for i, s in enumerate([*symbols, *(s + "_" for s in symbols), "ab", "abc"])}
    assert bpe.PairMerger(vocab, [("a", "b"), ("ab", "c")], "_").encode([b"abcab"]) == [[vocab["abc"], vocab["a"], vocab["b_"]]]
    with pytest.raises(ValueError):
        bpe.PairMerger(vocab, [("ab", "c"), ("a", "b")], "_")
