"""Filter audit, quality classifier and tokenizer alignment against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from stagewise.llm import filter_audit, quality_classifier, tokenizer_alignment
from stagewise.llm.filter_audit import FilterRules, audit_filters, gallop, merged_sizes
from stagewise.llm.quality_classifier import QualityParams, fit_quality, grams_of, is_held_out, score_quality
from stagewise.llm.tokenizer_alignment import PairEncoder, align, align_tokenizers, group_labels

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id long, text string, source string, part string, rows int, bits int, ids string, score string, predicted string"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, rows):
    """Rows of (doc_id, text, source), with more columns that are named like outputs and inner columns."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y", "z", "w") for r in rows], SCHEMA).repartition(4)


# --- filter interaction audit ---


def fails_of(rows, rules=FilterRules()):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    found = []
    for d, t, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        found.append(
            "A" * (len(words) < rules.min_words)
            + "B" * (100 * len(set(words)) < rules.distinct_percent * len(words))
            + "C" * (100 * len(re.findall("[A-Z]", t)) > rules.capitals_percent * len(t))
            + "D" * any(m in t for m in rules.marks)
            + "E" * (d is not None and d > first[t])
        )
    return found


def audited(rows, labels, rules=FilterRules()):
    """The report by applying every order to every row."""
    good, toxic = ({d for d, *two in labels if two[k] == 1 and d is not None} for k in (0, 1))
    parts = {}
    for (d, _, source), failed in zip(rows, fails_of(rows, rules), strict=True):
        parts.setdefault(source or "", []).append((d, failed))
    out = {}
    for part, members in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                gone, kept = [m for m in left if name in m[1]], [m for m in left if name not in m[1]]
                all_fail = sum(name in m[1] for m in members)
                only = sum(m[1] == name for m in members)
                shapley[name] += len(gone)
                lost = [sum(m[0] in tagged for m in gone) for tagged in (good, toxic)]
                out[part, "".join(order), step] = (len(kept), len(gone), all_fail - len(gone), only, *lost)
                left = kept
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step] += (shapley[name],)
    return out


def reported(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def audit_rows():
    rng, rows = random.Random(5), []
    for d in range(240):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.choice([0, 3, 150, 260]))]
        text = " ".join(words) + rng.choice(["", " A", "A" * 40, " #", "\t\n", " é|É"])
        rows.append((d, text, rng.choice(["hot"] * 5 + ["a", "b", None, ""])))
    rows += [(rng.randrange(300), rng.choice(rows)[1], "hot") for _ in range(160)]
    rows += [(None, "no id", "hot"), (None, "no id", None), (7, None, "a"), (8, "", "a"), (9, None, None), (9, None, None)]
    rows += [(500, "again", "only once"), (500, "again", "only once"), (501, "again", "only once"), (502, "x " * 20_000, "long")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in range(0, 520, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    return rows, labels


def test_audit_is_what_every_order_does_row_by_row(spark):
    rows, labels = audit_rows()
    got = reported(audit_filters(documents(spark, rows), spark.createDataFrame(labels, LABELS)))
    assert got == audited(rows, labels)
    rules = FilterRules(min_words=10, distinct_percent=90, capitals_percent=1, marks="w")
    other = audit_filters(documents(spark, rows), spark.createDataFrame(labels, LABELS), rules, part="part")
    assert reported(other) == audited([(d, t, "x") for d, t, _ in rows], labels, rules)


def test_audit_of_clean_and_of_no_rows(spark):
    text = " ".join(f"word{i}" for i in range(300))
    clean = [(d, f"{text} {d}", "s") for d in range(5)]
    got = reported(audit_filters(documents(spark, clean), spark.createDataFrame([], LABELS)))
    assert len(got) == 600 and set(got.values()) == {(5, 0, 0, 0, 0, 0, 0)}
    assert audit_filters(documents(spark, clean).limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_posting_lists_are_sorted_and_bounded_even_if_one_id_repeats(spark):
    rows = [(1, "short", "hot")] * 700 + [(d, "short too", "cold") for d in range(40)]
    judged = filter_audit.judge_rows(documents(spark, rows))
    failing = filter_audit.failing_rows(judged, spark.createDataFrame([(1, 1, 0)], LABELS))
    blocks = filter_audit.posting_lists(failing, block_rows=64).collect()
    assert max(len(b["ids"]) for b in blocks) <= 64 and sum(len(b["ids"]) for b in blocks) == 740
    assert len({(b["part"], b["block"]) for b in blocks}) == len(blocks) >= 12
    for b in blocks:
        assert list(b["ids"]) == sorted(b["ids"]) and all(x == sorted(set(x)) for x in b["lists"])
        assert b["lists"][0] == list(range(len(b["ids"]))) and (b["part"] == "cold" or b["lists"][5] == b["lists"][0])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 60)), max_size=7), st.integers(0, 60))
def test_galloping_merge_counts_the_cells_of_the_diagram(sets, value):
    want = Counter(sum(1 << n for n, s in enumerate(sets) if x in s) for x in set().union(*sets))
    assert merged_sizes([sorted(s) for s in sets]) == want
    entries = sorted(set().union(*sets))
    for at in range(len(entries)):
        assert gallop(entries, at, value) == max(at, sum(e < value for e in entries))


# --- quality classifier ---


def quality_rows(n=900, seed=3):
    """Bad texts have marks behind words, capitals, or one word many times; good ones are plain."""
    rng, rows = random.Random(seed), []
    for d in range(n):
        words = [f"{rng.choice('abcdefg')}{rng.choice('lmnop')}{rng.randrange(400)}" for _ in range(rng.randrange(20, 60))]
        kind = d % 6
        text = " ".join(w + "%%%" for w in words) if kind == 0 else " ".join(words).upper() if kind == 1 else " ".join(words)
        rows.append((d, text, int(kind > 1)))
    return rows


def test_quality_is_told_on_texts_that_were_held_out(spark):
    rows = quality_rows()
    frame = documents(spark, [(d, t, "s") for d, t, _ in rows])
    labels = spark.createDataFrame([(d, q, 0) for d, _, q in rows], LABELS)
    scored = score_quality(frame, fit_quality(frame, labels))
    assert scored.columns == [c for c in frame.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    got = {r["doc_id"]: r for r in scored.collect()}
    held = [d for d, _, _ in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(held) > 150 and all(got[d]["predicted"] == rows[d][2] for d in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_labels_of_held_out_rows_are_never_learned_from(spark):
    rows = quality_rows()
    frame = documents(spark, [(d, t, "s") for d, t, _ in rows])
    held = {r["doc_id"] for r in frame.where(is_held_out(frame["doc_id"])).collect()}
    assert held == {d for d, *_ in rows if zlib.crc32(str(d).encode()) % 4 == 2}
    models = [
        fit_quality(frame, spark.createDataFrame([(d, 1 - q if d in held and turned else q, 0) for d, _, q in rows], LABELS))
        for turned in (False, True)
    ]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].slope == models[1].slope


def test_quality_of_odd_rows(spark):
    rows = [(d, t) for d, t, _ in quality_rows(300)]
    odd = [(None, "plain words here"), (1000, None), (1001, ""), (1002, " \n"), (1003, "!!! ???"), (1004, "x" * 300_000)]
    frame = documents(spark, [(d, t, "s") for d, t in [*rows, *odd, *odd]])
    labels = [(d, q, 0) for d, _, q in quality_rows(300)]
    labels += [(0, 1, 0), (None, 1, 0), (5, None, 0), (2, 7, 0)]
    model = fit_quality(frame, spark.createDataFrame(labels, LABELS))
    got = [(r["doc_id"], r["score"]) for r in score_quality(frame, model).collect()]
    assert len(got) == len(rows) + 12 and all(0 <= s <= 1 for _, s in got)
    assert len({s for d, s in got if d in (1000, 1001, 1002)}) == 1
    one_kind = fit_quality(frame, spark.createDataFrame([(d, 1, 0) for d in range(40)], LABELS))
    assert {r["predicted"] for r in score_quality(frame, one_kind).collect()} == {1}
    nothing = fit_quality(frame.limit(0), spark.createDataFrame([], LABELS))
    assert {r["score"] for r in score_quality(frame, nothing).collect()} == {0.5}
    assert score_quality(frame.limit(0), model).count() == 0


def test_dual_descent_reaches_the_least_of_the_hinge_loss():
    rng = np.random.default_rng(2)
    rows, size = 60, 12
    held = [np.flatnonzero(rng.random(size) < 0.4) for _ in range(rows)]
    signs = np.where(np.arange(rows) % 3 == 0, 1.0, -1.0)
    bounds, numbers = np.concatenate([[0], np.cumsum([len(h) for h in held])]), np.concatenate(held)
    ratios = rng.normal(size=size)
    params = QualityParams(tolerance=1e-9, max_rounds=4000)
    weights, bias = quality_classifier.dual_descent(bounds, numbers, ratios, signs, np.arange(rows), params)
    share = (signs > 0).mean()
    prices = params.price / (2 * np.where(signs > 0, share, 1 - share))
    x = np.zeros((rows, size))
    for i, h in enumerate(held):
        x[i, h] = ratios[h] / max(np.linalg.norm(ratios[h]), 1e-300)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (prices * np.maximum(0, 1 - signs * (x @ w + b))).sum()

    least = loss(weights, bias)
    for _ in range(2000):
        step = rng.normal(size=size + 1) * rng.choice([1e-4, 1e-2, 0.3])
        assert loss(weights + step[:-1], bias + step[-1]) >= least - 1e-6


def test_grams_are_those_of_each_text():
    texts = ["One one  two!! TWO", "", "a", "one two", " é9 x\n"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    grams, bounds = grams_of(np.frombuffer(b"".join(raw), np.uint8), offsets, 22)
    for i, r in enumerate(raw):
        alone, _ = grams_of(np.frombuffer(r, np.uint8), np.array([0, len(r)]), 22)
        assert np.array_equal(alone, grams[bounds[i] : bounds[i + 1]])
    assert bounds[2] == bounds[1] and grams_of(np.empty(0, np.uint8), np.array([0]), 22)[0].size == 0


# --- cross-tokenizer alignment ---


@pytest.fixture(scope="module")
def tools():
    return PairEncoder(*FILES)


def aligned(tools, texts):
    """n_a, n_b, groups and links of each text, by sets of ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tool, b_tool = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a_tool.encode_special_tokens = True
    letters = tokenizer_alignment.byte_of_letter()
    out = []
    for text in texts:
        a = a_tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tool.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_tool.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_tool.id_to_piece(i)[3:5], 16)]) if b_tool.is_byte(i) else b_tool.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            out.append((0, 0, [], []))
            continue
        a_ends, b_ends = (list(itertools.accumulate(map(len, x))) for x in (a_bytes, b_bytes))
        cuts = sorted(set(a_ends) & set(b_ends))
        groups, low = [], 0
        for cut in cuts:
            sides = [[i for i, e in zip(ids, ends, strict=True) if low < e <= cut] for ids, ends in ((a, a_ends), (b, b_ends))]
            groups.append("|".join(",".join(map(str, s)) for s in sides))
            low = cut
        links = [(a[a_ends.index(c)], b[b_ends.index(c)]) for c in cuts]
        out.append((len(a), len(b), groups, links))
    return out


def whole_corpus(tools, rows):
    found = aligned(tools, [t or "" for _, t in rows])
    counts = Counter(pair for *_, links in found for pair in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (d, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[p] == highest[p[1]] for p in links)
        out.append((d, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignment_rows():
    rng = random.Random(8)
    words = ["the", "Zürich", "naïve", "don't", "I'll", "x=1;", "日本語", "🙂👍🏽", "Ωμέγα", "12345", "<|endoftext|>", "<s>", "</s>", "<0x41>", "▁"]
    texts = [" ".join(rng.choices(words[:-1], k=rng.randrange(1, 40))) for _ in range(80)]
    texts += [" two  spaces ", "\n\n\ttabs\r\n", "▁ changed", "", None, " ", "\x00 nul", "é x", "ﬁ", "a" * 3000, "the " * 4000, "the " * 4000]
    texts += [rng.choice(texts) for _ in range(30)]
    rows = list(enumerate(texts))
    return rows + [(None, "without id"), (None, "without id"), (3, "same id"), (3, "same id, other text")]


def test_alignment_is_that_of_plain_python(spark, tools, monkeypatch):
    rows = alignment_rows()
    frame = documents(spark, [(d, t, "s") for d, t in rows])
    want = sorted(whole_corpus(tools, rows), key=str)
    assert sorted((tuple(r) for r in align_tokenizers(frame, *FILES).select(*COLUMNS).collect()), key=str) == want
    assert align_tokenizers(frame.limit(0), *FILES).count() == 0


def test_long_texts_are_cut_where_no_token_goes_on(tools, monkeypatch):
    rng = random.Random(4)
    words = ["the", "word", "Straße", "don't", "9", "!?", "", "it", "日本"]
    texts = [" ".join(rng.choices(words, k=900)) for _ in range(6)] + ["no-space" * 500, "a b"]
    whole = tools.encode([t.encode() for t in texts])
    monkeypatch.setattr(tokenizer_alignment, "CUT_BYTES", 50)
    assert tools.cuttable and all(len(list(tools.parts(t.encode()))) > 20 for t in texts[:6])
    for x, y in zip(whole, tools.encode([t.encode() for t in texts]), strict=True):
        assert np.array_equal(x[0], y[0]) and np.array_equal(x[1], y[1])


def test_texts_with_more_links_than_a_chunk_row_takes(tools, monkeypatch):
    monkeypatch.setattr(tokenizer_alignment, "CHUNK_LINKS", 100)
    texts = ["the cat sat " * 60, "", "x", "a dog " * 90]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    found = list(tokenizer_alignment._chunk_rows(tools, [0, 1, 2, 3], [5, None, 5, 6], data, offsets))
    found = [f | tokenizer_alignment.unpacked(f["packed"]) for f in found]
    assert len(found) > 3 and all(len(f["links"]) <= 100 for f in found)
    assert found[0]["known"].tolist() == [True, False, True, True]
    want = aligned(tools, texts)
    for row in range(4):
        links = []
        for f in found:
            for at, number in enumerate(f["rows"].tolist()):
                if number == row:
                    packed = f["pairs"].view(np.uint32)[f["links"][f["bounds"][at] : f["bounds"][at + 1]]]
                    links += [(p >> 16, p & 0xFFFF) for p in packed.tolist()]
        assert links == want[row][3]
        assert sum(int(f["n_a"][f["rows"] == row].sum()) for f in found) == want[row][0]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.sets(st.integers(1, 39)), st.sets(st.integers(1, 39)))
def test_pointer_jumping_labels_the_groups_between_common_ends(size, a, b):
    a_ends, b_ends = (np.array(sorted({e for e in x if e < size} | {size})) for x in (a, b))
    a_label, b_label = group_labels(a_ends, b_ends)
    cuts = np.array(sorted(set(a_ends.tolist()) & set(b_ends.tolist())))
    for ends, label in ((a_ends, a_label), (b_ends, b_label)):
        assert np.array_equal(a_ends[label], cuts[np.searchsorted(cuts, ends)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \n'sdtl9"), st.characters(codec="utf-8")), max_size=30), max_size=5))
def test_both_encoders_of_the_byte_level_side_agree(texts):
    tools = tokenizer_alignment.encoder(*FILES)
    want = [e.ids for e in tools.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert tools.byte_level([" " + t for t in texts]) == want
    found = tools.encode([t.encode() for t in texts])
    assert all(f is None for f, t in zip(found, texts, strict=True) if not t)
    align(found, (tools.a_bytes, tools.b_bytes))
