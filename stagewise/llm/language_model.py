"""Language-model scores by deleted interpolation of unigram and bigram estimates.

``P(w | h) = l2 * c(h w) / c(h) + l1 * c(w) / N + l0 / (V + 1)``. The weights (l2, l1, l0) depend on the frequency bucket
of the context h (powers of two, and unseen). They are learned by expectation-maximisation on held-out counts: every
training token is held out in turn, which deletes one from the counts of itself, its context and their pair. A text's
tokens are its words (white space separates; A-Z lower-cased) and one end; the end is also the context of the first word.

Counts of words and pairs are exact sums over all training documents: each chunk of documents sends its distinct words
and pairs with their counts, and gets back the counts in the whole corpus (see ``exchange``). Words are known by 64-bit
hashes. For the weights, tokens are counted in cells of (context bucket, log of the pair's estimate, log of the word's
estimate), a table of bounded size, in which the iterations then run on the driver.

Defined cases: null and empty texts are a single end. Rows with a null id are scored, not learned from and not held out.
Repeated rows each count and each get a row. Without any training document all counts are 0 and every token gets
``1 / (V + 1)`` with V = 0. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.exchange import (
    Chunk,
    answered,
    by_bucket,
    each_told,
    id_remainders,
    join_parts,
    messages,
    notes,
    pack,
    split_parts,
    stage_chunks,
    told,
    unpack,
)
from stagewise.llm.words import mix
from stagewise.session import settle

DIVISOR, HELD_OUT = 7, 2
BUCKETS = 48  # of context frequencies: unseen, 1, 2-3, 4-7, ...
STEPS_PER_DECADE, DECADES = 20, 15  # cells of estimates, down to 1e-15
ITERATIONS = 60

_END = np.uint64(0x5851F42D4C957F2D)
_BEFORE, _AFTER = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xD1B54A32D192ED03)


@dataclass
class Tokens:
    """The tokens of a chunk; ``bounds[i]:bounds[i+1]`` are those of document i."""

    words: np.ndarray
    pairs: np.ndarray
    bounds: np.ndarray
    learned: np.ndarray  # by token: is it in a training document
    held_out: np.ndarray  # by document


@dataclass
class Interpolation:
    weights: np.ndarray  # by context bucket: pair, word, uniform
    tokens: int
    types: int


def tokens_of(chunk: Chunk) -> Tokens:
    found = chunk.words("spaced", True)
    words = np.insert(found.hashes, found.bounds[1:], _END)
    bounds = found.bounds + np.arange(len(found.bounds))
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[bounds[:-1]] = _END
    held = (id_remainders(chunk.ids, DIVISOR) == HELD_OUT) & chunk.known
    learned = np.repeat(~held & chunk.known, np.diff(bounds))
    return Tokens(words, mix(before * _BEFORE + words * _AFTER), bounds, learned, held)


def score_texts(documents: DataFrame) -> DataFrame:
    """A row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    chunks = stage_chunks(documents)
    buckets = chunks.buckets
    answers = settle(answered(chunks, messages(chunks, lambda c: _counts_by_bucket(c, buckets)), _sums), "counts")
    tokens, types = map(int, sum((np.frombuffer(n, np.int64) for n in notes(answers)), np.zeros(2, np.int64)))
    rows = told(chunks, answers)
    cells = each_told(
        rows, lambda chunk, got: _cells(chunk, got, tokens), "cell bigint, n bigint"
    ).groupBy("cell").agg(F.sum("n").alias("n"))
    # At most BUCKETS * (STEPS_PER_DECADE * DECADES + 2) ** 2 cells, a few thousand of which occur.
    found = np.array([(r["cell"], r["n"]) for r in cells.collect()], np.int64).reshape(-1, 2)
    model = Interpolation(learn_weights(found[:, 0], found[:, 1], types), tokens, types)
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return each_told(rows, lambda chunk, got: _scores(chunk, got, model), schema)


def _counts_by_bucket(chunk: Chunk, buckets: int) -> Iterator[tuple[int, bytes]]:
    """For each bucket: words and their counts, pairs and their counts."""
    tokens = tokens_of(chunk)
    parts: dict[int, list[bytes]] = {}
    for kind, keys in enumerate((tokens.words, tokens.pairs)):
        distinct, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place[tokens.learned], minlength=len(distinct))
        for bucket, first, end in by_bucket(distinct, buckets):
            both = parts.setdefault(bucket, [pack(np.empty(0, np.uint64)), pack(np.empty(0, np.int64))] * 2)
            both[2 * kind : 2 * kind + 2] = [pack(distinct[first:end]), pack(counts[first:end].astype(np.int64))]
    for bucket, found in parts.items():
        yield bucket, join_parts(found)


def _sums(sent: list[bytes]) -> tuple[list[bytes], bytes]:
    """For each message the corpus counts of its words and pairs; and how many tokens and types the bucket has."""
    opened = [split_parts(m) for m in sent]
    replies: list[list[bytes]] = [[] for _ in sent]
    note = np.zeros(2, np.int64)
    for kind in (0, 1):
        keys = [unpack(parts[2 * kind], np.uint64) for parts in opened]
        counts = [unpack(parts[2 * kind + 1], np.int64) for parts in opened]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, place, np.concatenate(counts))
        if kind == 0:
            note += (sums.sum(), np.count_nonzero(sums))
        ends = np.cumsum([len(k) for k in keys])
        for reply, end, own in zip(replies, ends, keys, strict=True):
            reply.append(pack(sums[place[end - len(own) : end]]))
    return [join_parts(r) for r in replies], note.tobytes()


def _token_counts(chunk: Chunk, got: dict[int, bytes]) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray]:
    """For every token the corpus counts of its pair, its context and itself."""
    tokens = tokens_of(chunk)
    opened = [split_parts(got[b]) for b in sorted(got)]
    counts = []
    for kind, keys in enumerate((tokens.words, tokens.pairs)):
        known = np.concatenate([unpack(parts[kind], np.int64) for parts in opened])
        counts.append(known[np.unique(keys, return_inverse=True)[1]])
    word, pair = counts
    context = np.empty_like(word)
    context[1:] = word[:-1]
    # Every document ends with the same token, which is also the context it begins with.
    context[tokens.bounds[:-1]] = word[tokens.bounds[1:] - 1]
    return tokens, pair, context, word


def _context_bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.astype(float))[1], BUCKETS - 1)


def _level(p: np.ndarray) -> np.ndarray:
    """0 for an estimate of 0, else 1 and more, the higher the smaller the estimate."""
    with np.errstate(divide="ignore"):
        level = 1 - np.round(np.log10(p) * STEPS_PER_DECADE)
    return np.where(p > 0, np.minimum(level, STEPS_PER_DECADE * DECADES + 1), 0).astype(np.int64)


_LEVELS = STEPS_PER_DECADE * DECADES + 2


def _cells(chunk: Chunk, got: dict[int, bytes], total: int) -> pa.RecordBatch:
    tokens, pair, context, word = _token_counts(chunk, got)
    pair, context, word = ((x - 1)[tokens.learned] for x in (pair, context, word))
    by_pair = _level(pair / np.maximum(context, 1))
    by_word = _level(word / max(total - 1, 1))
    cells = (_context_bucket(context) * _LEVELS + by_pair) * _LEVELS + by_word
    distinct, counts = np.unique(cells.astype(np.int64), return_counts=True)
    return pa.RecordBatch.from_pydict({"cell": distinct, "n": counts.astype(np.int64)})


def learn_weights(cells: np.ndarray, counts: np.ndarray, types: int) -> np.ndarray:
    """The weights of each context bucket that make the held-out tokens likeliest."""
    rest, by_word = np.divmod(cells, _LEVELS)
    buckets, by_pair = np.divmod(rest, _LEVELS)
    known = [np.where(x > 0, 10.0 ** (-(x - 1) / STEPS_PER_DECADE), 0.0) for x in (by_pair, by_word)]
    estimates = np.stack([*known, np.full(len(cells), 1 / (types + 1))], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ITERATIONS):
        shares = estimates * weights[buckets]
        shares *= (counts / np.maximum(shares.sum(axis=1), 1e-300))[:, None]
        # A little of each keeps every weight above 0, also in buckets that were never held out.
        gained = np.stack([np.bincount(buckets, shares[:, k], BUCKETS) for k in range(3)], axis=1) + 1e-3
        weights = gained / gained.sum(axis=1, keepdims=True)
    return weights


def _scores(chunk: Chunk, got: dict[int, bytes], model: Interpolation) -> pa.RecordBatch:
    tokens, pair, context, word = _token_counts(chunk, got)
    weights = model.weights[_context_bucket(context)]
    likelihood = (
        weights[:, 0] * (pair / np.maximum(context, 1))
        + weights[:, 1] * (word / max(model.tokens, 1))
        + weights[:, 2] / (model.types + 1)
    )
    # An unseen context says nothing about what follows: its share goes to the other two.
    likelihood = np.where(context > 0, likelihood, likelihood / (weights[:, 1] + weights[:, 2]))
    if not model.tokens:
        likelihood = np.full(len(word), 1 / (model.types + 1))
    base = np.log10((word + 1) / (model.tokens + model.types + 1))
    first = tokens.bounds[:-1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunk.ids, pa.int64(), mask=~chunk.known),
            pa.array(tokens.held_out),
            pa.array(np.diff(tokens.bounds), pa.int64()),
            pa.array(np.add.reduceat((word > 0).astype(np.int64), first)),
            pa.array(np.full(len(chunk), model.tokens, np.int64)),
            pa.array(np.add.reduceat(base, first)),
            pa.array(np.add.reduceat(np.log10(likelihood), first)),
        ],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )
