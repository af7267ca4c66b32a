"""Toxicity scores from a factorization machine over hashed terms.

The score of a text is ``sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>)`` over the distinct terms i of the whole text that
carry weights. The pairwise part learns combinations, such as an insult beside the name of a group, that no sum of
single weights can tell from their parts.

Fitting uses a bounded sample: at most ``max_rows`` labelled documents with at most ``max_cells`` terms in all, chosen by
a hash of their id. Terms are words (digits, ASCII letters in any case, all characters beyond ASCII), hashed to
``2**bits`` buckets; those in fewer than ``min_rows`` documents of the sample are left out. Others come in by what the
model still gets wrong, not by their own counts:

1. A term comes in when the slope of the loss in its weight, given all terms that are in, exceeds the deviations that
   chance gives it; the strongest come first, and the model is learned again each time.
2. When there are no more, words that stand beside a term with a weight come in where the errors of the texts with both
   do not cancel out, so also words that tell nothing by themselves. From then on factors are learned as well.

Each time the log loss is minimised until it stops falling, whatever the number of rows. There is a price on squared
factors, and a small one on squared deviations of what a term alone would score from the log odds of its own label
counts: where toxic texts hold several toxic words, each of them is to tell by itself.

Defined cases: a null or empty text has no terms and gets the score of the intercept. Rows with a null id are scored but
not learned from. Repeated rows are scored one by one. Several labels for one id: any 1 makes it 1; null labels are
ignored. Without labels of both kinds the model is an intercept. Columns ``score`` and ``predicted`` of the input are
replaced, all other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm.words import HashSet, word_slices
from stagewise.session import settle, ship_package


@dataclass(frozen=True)
class ToxicityParams:
    max_rows: int = 20_000
    max_cells: int = 16_000_000
    bits: int = 26
    min_rows: int = 3
    factors: int = 8
    # How many deviations, and how much at least, lets in a term, and a word beside a term.
    deviations: float = 4.0
    floor: float = 2.0
    pair_deviations: float = 5.0
    pair_floor: float = 3.0
    # The price of squared deviations of single terms, and of squared factors.
    weight_price: float = 0.05
    factor_price: float = 1.0
    tolerance: float = 1e-6
    seed: int = 11


@dataclass
class FactorizationMachine:
    """``terms`` are the sorted buckets with weights; ``pairs`` has a row of factors for each."""

    intercept: float
    terms: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray
    bits: int

    def margins(self, owners: np.ndarray, numbers: np.ndarray, rows: int) -> np.ndarray:
        """The log odds of ``rows`` texts whose weighted terms are (owner, number of the term) pairs."""
        sums, squares = _pair_sums(owners, self.pairs[numbers], rows)
        single = np.bincount(owners, self.weights[numbers], rows)
        return self.intercept + single + 0.5 * ((sums**2).sum(axis=1) - squares)


def is_held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()
) -> FactorizationMachine:
    """Learn from the labelled rows that are not held out."""
    ship_package(documents.sparkSession)
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(params.max_rows)
    )
    # At most max_rows rows of two numbers: this side is small whatever the corpus.
    texts = documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(known), "id")
    bits = params.bits
    sample = settle(
        texts.mapInArrow(lambda batches: _term_rows(batches, bits), "id bigint, label int, terms array<bigint>"),
        "toxicity-sample",
    )
    return _train(*_collected(sample, params), params)


def score_toxicity(documents: DataFrame, model: FactorizationMachine) -> DataFrame:
    """The rows of ``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    spark = documents.sparkSession
    ship_package(spark)
    # Size bounded by max_cells.
    shared = spark.sparkContext.broadcast(model)
    kept = [f for f in documents.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType(
        [*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    names = [f.name for f in kept]
    return documents.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(
        lambda batches: _scored(batches, shared.value, names), schema
    )


def _buckets(words, bits: int) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - bits)).astype(np.int64)


def _term_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("terms", pa.list_(pa.int64()))])
    for batch in batches:
        for first, end, words in word_slices(batch.column("text"), "letters", True):
            terms = _buckets(words, bits)
            lists = [np.unique(terms[a:b]) for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array(lists, pa.list_(pa.int64()))], schema=schema
            )


def _collected(sample: DataFrame, params: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, how many terms each text has, and the terms of all texts: at most max_rows and max_cells."""
    hashed = sample.select(F.xxhash64("id").alias("key"), F.size("terms").alias("size"), "label", "terms")
    sizes = hashed.groupBy("key").agg(F.sum("size").alias("size")).toArrow().sort_by("key")
    over = np.cumsum(sizes["size"].to_numpy()) > params.max_cells
    if over.any():
        hashed = hashed.where(F.col("key") < int(sizes["key"][int(np.argmax(over))].as_py()))
    rows = hashed.select("key", "label", F.col("terms").cast("array<int>").alias("terms")).toArrow().combine_chunks()
    keys, labels = rows["key"].to_numpy(), rows["label"].to_numpy().astype(float)
    lists = rows["terms"].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    bounds, terms = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    counts = np.diff(bounds)
    totals = np.concatenate([[0], np.cumsum(terms, dtype=np.int64)])
    # The same order whatever partitions the rows came from.
    order = np.lexsort((totals[bounds[1:]] - totals[bounds[:-1]], counts, labels, keys))
    return labels[order], counts[order], terms[_ranges(bounds[:-1][order], counts[order])]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of all runs one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _pair_sums(owners: np.ndarray, pairs: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.stack([np.bincount(owners, pairs[:, f], rows) for f in range(pairs.shape[1])], axis=1)
    return sums, np.bincount(owners, (pairs**2).sum(axis=1), rows)


def _train(labels: np.ndarray, counts: np.ndarray, terms: np.ndarray, params: ToxicityParams) -> FactorizationMachine:
    rows, toxic = len(labels), labels.sum()
    prior = (toxic + 0.5) / (rows + 1.0)
    start = float(np.log(prior / (1 - prior)))
    nothing = np.empty(0, np.int64)
    model = FactorizationMachine(start, nothing, np.zeros(0), np.zeros((0, params.factors)), params.bits)
    if not 0 < toxic < rows:
        return model
    owners = np.repeat(np.arange(rows, dtype=np.int32), counts)
    names, numbers, seen = np.unique(terms, return_inverse=True, return_counts=True)
    often = seen >= params.min_rows
    numbers, owners = (np.cumsum(often) - 1).astype(np.int32)[numbers[often[numbers]]], owners[often[numbers]]
    names, seen = names[often].astype(np.int64), seen[often]
    bounds = np.searchsorted(owners, np.arange(rows + 1))
    held = np.bincount(numbers, labels[owners], len(names))
    odds = np.log((held + 0.5) / (seen - held + 0.5))
    rng = np.random.default_rng(params.seed)

    def solved(model: FactorizationMachine, chosen: np.ndarray, factors: bool) -> FactorizationMachine:
        """The model of the chosen terms, from the weights it has."""
        place = np.full(len(names), -1)
        place[chosen] = np.arange(len(chosen))
        old = np.flatnonzero(place[model.terms] >= 0)
        weights = odds[chosen] - model.intercept
        weights[place[model.terms[old]]] = model.weights[old]
        pairs = rng.normal(0, 0.2, (len(chosen), params.factors)) if factors else np.zeros((len(chosen), params.factors))
        learned = old[np.abs(model.pairs[old]).max(axis=1, initial=0.0) > 1e-3]
        pairs[place[model.terms[learned]]] = model.pairs[learned]
        at = np.flatnonzero(place[numbers] >= 0)
        having, own = np.unique(owners[at], return_inverse=True)
        bare = (toxic - labels[having].sum(), rows - len(having))
        next_model = FactorizationMachine(model.intercept, chosen, weights, pairs, params.bits)
        return _minimised(next_model, own, place[numbers[at]], labels[having], bare, odds[chosen], factors, params)

    def errors(model: FactorizationMachine) -> tuple[np.ndarray, np.ndarray]:
        """What each label is above its text's score, and the scores."""
        place = np.full(len(names), -1)
        place[model.terms] = np.arange(len(model.terms))
        at = np.flatnonzero(place[numbers] >= 0)
        scores = _sigmoid(model.margins(owners[at], place[numbers[at]], rows))
        return labels - scores, scores

    factors, partners = False, nothing
    while True:
        above, scores = errors(model)
        spread = scores * (1 - scores)
        chance = params.deviations * np.sqrt(np.bincount(numbers, spread[owners], len(names)))
        lead = np.abs(np.bincount(numbers, above[owners], len(names))) / np.maximum(params.floor, chance)
        lead[model.terms] = 0
        fresh = np.flatnonzero(lead >= max(1.0 + 1e-6, min(2.0, lead.max(initial=0.0) / 2)))
        fresh = fresh[np.argsort(-lead[fresh], kind="stable")][: max(64, len(model.terms))]
        if not len(fresh):
            telling = model.terms[(np.abs(model.weights) > 0.1) | np.isin(model.terms, partners)]
            beside = np.zeros(len(names), bool)
            for term in telling.tolist():
                texts = owners[numbers == term]
                near = _ranges(bounds[texts], (bounds[1:] - bounds[:-1])[texts])
                error = np.bincount(numbers[near], above[owners[near]], len(names))
                limit = params.pair_deviations * np.sqrt(np.bincount(numbers[near], spread[owners[near]], len(names)))
                beside |= np.abs(error) > np.maximum(params.pair_floor, limit)
            beside[model.terms] = False
            fresh = np.flatnonzero(beside)
            if factors and not len(fresh):
                break
            factors, partners = True, np.union1d(partners, fresh)
        model = solved(model, np.union1d(model.terms, fresh), factors)
    return FactorizationMachine(model.intercept, names[model.terms], model.weights, model.pairs, params.bits)


def _minimised(
    model: FactorizationMachine,
    owners: np.ndarray,
    numbers: np.ndarray,
    labels: np.ndarray,
    bare: tuple[float, int],
    odds: np.ndarray,
    factors: bool,
    params: ToxicityParams,
) -> FactorizationMachine:
    """The model at the least loss; ``bare`` has the toxic and all texts without any of its terms."""
    size = len(model.weights)
    shape = model.pairs.shape

    def opened(x: np.ndarray) -> FactorizationMachine:
        pairs = x[1 + size :].reshape(shape) if factors else model.pairs
        return FactorizationMachine(float(x[0]), model.terms, x[1 : 1 + size], pairs, model.bits)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        at = opened(x)
        margins = at.intercept + np.bincount(owners, at.weights[numbers], len(labels))
        if factors:
            own = at.pairs[numbers]
            sums, squares = _pair_sums(owners, own, len(labels))
            margins += 0.5 * ((sums**2).sum(axis=1) - squares)
        off = _sigmoid(margins) - labels
        apart = at.intercept + at.weights - odds
        value = (np.logaddexp(0, margins) - margins * labels).sum() + 0.5 * params.weight_price * (apart**2).sum()
        value += bare[1] * np.logaddexp(0, at.intercept) - bare[0] * at.intercept
        slope = np.empty_like(x)
        slope[0] = off.sum() + bare[1] * _sigmoid(at.intercept) - bare[0] + params.weight_price * apart.sum()
        slope[1 : 1 + size] = np.bincount(numbers, off[owners], size) + params.weight_price * apart
        if factors:
            value += 0.5 * params.factor_price * (at.pairs**2).sum()
            turn = off[owners][:, None] * (sums[owners] - own)
            turned = np.stack([np.bincount(numbers, turn[:, f], size) for f in range(shape[1])], axis=1)
            slope[1 + size :] = (turned + params.factor_price * at.pairs).ravel()
        return float(value), slope

    parts = [[model.intercept], model.weights, *([model.pairs.ravel()] if factors else [])]
    return opened(_least(loss, np.concatenate(parts), params.tolerance))


def _least(loss, x: np.ndarray, tolerance: float, memory: int = 10) -> np.ndarray:
    """Where the loss stops falling (five steps in turn gain next to nothing), by limited-memory quasi-Newton steps."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    idle = 0
    while idle < 5:
        way, turns = -slope, []
        for step, change in reversed(past):
            share = (step @ way) / (step @ change)
            turns.append(share)
            way = way - share * change
        if past:
            step, change = past[-1]
            way = way * ((step @ change) / (change @ change))
        else:
            way = way / max(1.0, float(np.linalg.norm(slope)))
        for (step, change), share in zip(past, reversed(turns), strict=True):
            way = way + (share - (change @ way) / (step @ change)) * step
        down, length = float(slope @ way), 1.0
        if down >= 0:
            if not past:
                break
            past = []
            continue
        while True:
            new_value, new_slope = loss(x + length * way)
            if new_value <= value + 1e-4 * length * down or length < 1e-9:
                break
            length /= 2
        if new_value > value:
            if not past:
                break
            past = []
            continue
        step, change = length * way, new_slope - slope
        if step @ change > 1e-12:
            past = [*past[1 - memory :], (step, change)]
        idle = idle + 1 if value - new_value <= tolerance * max(1.0, abs(value)) else 0
        x, value, slope = x + step, new_value, new_slope
    return x


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _scored(
    batches: Iterator[pa.RecordBatch], model: FactorizationMachine, names: list[str]
) -> Iterator[pa.RecordBatch]:
    lookup = HashSet(model.terms.astype(np.uint64) << np.uint64(64 - model.bits))
    drop = ~np.uint64((1 << (64 - model.bits)) - 1)
    for batch in batches:
        for first, end, words in word_slices(batch.column("text"), "letters", True):
            places, numbers = lookup.find(words.hashes & drop)
            owners = np.searchsorted(words.bounds, places, side="right") - 1
            # A term counts once in a text.
            each = np.unique(owners * max(1, len(model.terms)) + numbers)
            owners, numbers = np.divmod(each, max(1, len(model.terms)))
            scores = _sigmoid(model.margins(owners, numbers, end - first))
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )
