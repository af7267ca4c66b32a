"""Quality scores from naive Bayes support vectors.

Every n-gram of a text is an indicator, scaled by the log-count ratio of its n-gram: how much more of the good texts have it
than of the bad ones, both smoothed by one. A linear model with the hinge loss is fitted to the scaled indicators by dual
coordinate descent, one dual variable for each text, and its weights are drawn towards their mean size by ``trust``, so
that n-grams the fit has not decided about keep some of their naive Bayes weight. Texts are scaled to unit length, so long
ones score like short ones. A margin becomes a score by a logistic curve that is fitted to margins of texts that the model
had not seen: the sample is dealt into ``folds`` by hash, and each is scored by a model of the others.

n-grams are of two kinds: one and two consecutive tokens as they are, and one to three of their shapes. A token is a run of
letters and digits, or a run of other characters but white space. The shape of a word says which of upper case, lower case,
digits and other letters it has, how it begins, and whether it is the word before it once more; marks are their own shape.
So words that only one text has still count by what they look like.

Fitting uses a bounded sample, at most ``max_rows`` labelled texts with at most ``max_cells`` n-grams in all, chosen by a
hash of their id; n-grams are hashed to ``2**bits`` buckets, those in fewer than ``min_rows`` texts of the sample are left
out. Scoring reads whole texts, in parallel, by one broadcast table whose size ``bits`` bounds.

Defined cases: a null or empty text has no n-grams and gets the score of a zero margin. Rows with a null id are scored but
not learned from. Repeated rows are scored one by one. Several labels for one id: any 0 makes it 0; null labels are
ignored. Without labels of both kinds the score is the share of 1 among the labels, smoothed. Columns ``score`` and
``predicted`` of the input are replaced, all other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm.words import KINDS, gram_hashes, hash_words, mix, text_slices
from stagewise.session import settle, ship_package


@dataclass(frozen=True)
class QualityParams:
    max_rows: int = 12_000
    max_cells: int = 10_000_000
    bits: int = 22
    min_rows: int = 3
    # The share of a weight that is the fit's own, and the price of a unit of loss.
    trust: float = 0.75
    price: float = 4.0
    folds: int = 4
    # Descent ends when no gradient of a round is further from its bound than this.
    tolerance: float = 0.05
    max_rounds: int = 60
    keep_from: float = 0.7
    seed: int = 12


@dataclass
class SupportVectors:
    """``buckets`` are sorted; an n-gram adds ``weights`` to the margin and the square of ``ratios`` to the length."""

    buckets: np.ndarray
    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    level: float
    bits: int
    keep_from: float

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margins + self.level)


def is_held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> SupportVectors:
    """Learn from the labelled rows that are not held out."""
    ship_package(documents.sparkSession)
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(params.max_rows)
    )
    # At most max_rows rows of two numbers: this side is small whatever the corpus.
    texts = documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(known), "id")
    bits = params.bits
    rows = texts.select(F.xxhash64("id").alias("key"), "label", "text").mapInArrow(
        lambda batches: _gram_rows(batches, bits), "key bigint, label int, grams array<int>"
    )
    return train(*_collected(settle(rows, "quality-sample"), params), params)


def score_quality(documents: DataFrame, model: SupportVectors) -> DataFrame:
    """The rows of ``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from the model's ``keep_from`` on)."""
    spark = documents.sparkSession
    ship_package(spark)
    # Size bounded by 2**bits buckets.
    shared = spark.sparkContext.broadcast(model)
    kept = [f for f in documents.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    names = [f.name for f in kept]
    return documents.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(
        lambda batches: _scored(batches, shared.value, names), schema
    )


_WORD = KINDS["letters"]
_ALL = np.arange(256)
# What a byte adds to the shape of its word.
_TRAITS = np.select(
    [(_ALL >= 0x41) & (_ALL <= 0x5A), (_ALL >= 0x61) & (_ALL <= 0x7A), (_ALL >= 0x30) & (_ALL <= 0x39), _ALL >= 0x80],
    [1, 2, 4, 8],
    0,
).astype(np.uint8)
_CLASSES = np.where(_WORD, 1, np.where((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)), 0, 2)).astype(np.int8)


def grams_of(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text: all of them, sorted within each text, and the bounds of the texts."""
    classes = _CLASSES[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = classes[1:] != classes[:-1]
    fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
    edges = np.flatnonzero(fresh)
    inked = classes[edges] > 0
    starts, ends = edges[inked], np.append(edges[1:], len(data))[inked]
    owners = np.searchsorted(offsets, starts, side="right") - 1
    words = hash_words(data, starts, ends)
    rows, buckets = [], []

    def add(hashes: np.ndarray, places: np.ndarray, salt: int) -> None:
        rows.append(owners[places])
        buckets.append((mix(hashes + np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64))

    everywhere = np.arange(len(words))
    shapes = _shapes(data, starts, ends, owners, words, classes)
    for salt, hashes, longest in ((1, words, 2), (11, shapes, 3)):
        for size in range(1, longest + 1):
            grams = gram_hashes(hashes, size)
            same = owners[size - 1 :] == owners[: len(owners) - size + 1] if len(grams) else np.empty(0, bool)
            add(grams[same], everywhere[: len(grams)][same], salt * 100 + size)
    cells = np.unique((np.concatenate(rows) << bits) + np.concatenate(buckets))
    return cells & ((1 << bits) - 1), np.searchsorted(cells, np.arange(len(offsets), dtype=np.int64) << bits)


def _shapes(data, starts, ends, owners, words, classes) -> np.ndarray:
    """A number for the look of each token."""
    if not len(starts):
        return np.empty(0, np.uint64)
    traits = np.bitwise_or.reduceat(_TRAITS[data], np.stack([starts, np.minimum(ends, len(data) - 1)], 1).ravel())[::2]
    shape = traits.astype(np.uint64) * np.uint64(16) + _TRAITS[data[starts]]
    is_word = classes[starts] == 1
    at = np.flatnonzero(is_word)
    again = np.zeros(len(starts), bool)
    again[at[1:]] = (words[at[1:]] == words[at[:-1]]) & (owners[at[1:]] == owners[at[:-1]])
    return np.where(is_word, shape * np.uint64(2) + again, words)


def _gram_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("label", pa.int32()), ("grams", pa.list_(pa.int32()))])
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            grams, bounds = grams_of(data, offsets, bits)
            lists = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(grams.astype(np.int32)))
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("label"), lists], schema=schema)


def _collected(sample: DataFrame, params: QualityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, labels, and the bounds and n-grams of all texts of the sample: at most max_rows and max_cells."""
    sizes = sample.groupBy("key").agg(F.sum(F.size("grams")).alias("size")).toArrow().sort_by("key")
    over = np.cumsum(sizes["size"].to_numpy()) > params.max_cells
    if over.any():
        sample = sample.where(F.col("key") < int(sizes["key"][int(np.argmax(over))].as_py()))
    # Rows that share a key are told apart by what they hold, so the order does not depend on partitions.
    rows = sample.withColumn("held", F.xxhash64("grams")).toArrow().sort_by([("key", "ascending"), ("held", "ascending")])
    lists = rows["grams"].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return rows["key"].to_numpy(), rows["label"].to_numpy(), bounds, lists.flatten().to_numpy(zero_copy_only=False)


def train(
    keys: np.ndarray, labels: np.ndarray, bounds: np.ndarray, grams: np.ndarray, params: QualityParams
) -> SupportVectors:
    """The model of a sample: texts ``grams[bounds[i]:bounds[i + 1]]`` with their labels."""
    good, rows = int((labels == 1).sum()), len(labels)
    none = np.empty(0, np.int32)
    if not 0 < good < rows:
        share = (good + 0.5) / (rows + 1.0)
        level = float(np.log(share / (1 - share)))
        return SupportVectors(none, none.astype(float), none.astype(float), 0.0, 0.0, level, params.bits, params.keep_from)
    names, numbers, seen = np.unique(grams, return_inverse=True, return_counts=True)
    often = seen >= params.min_rows
    owners = np.repeat(np.arange(rows), np.diff(bounds))[often[numbers]]
    numbers = (np.cumsum(often) - 1)[numbers[often[numbers]]].astype(np.int32)
    names = names[often]
    bounds = np.searchsorted(owners, np.arange(rows + 1))
    signs = np.where(labels == 1, 1.0, -1.0)

    def fitted(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        ratios = log_count_ratios(owners, numbers, signs, chosen, len(names))
        weights, bias = dual_descent(bounds, numbers, ratios, signs, np.flatnonzero(chosen), params)
        mean = np.abs(weights).mean()
        return ratios, ratios * ((1 - params.trust) * mean + params.trust * weights), bias

    # Texts with equal keys are in one fold, so none is scored by a model that has seen its id.
    fold = (mix(keys.view(np.uint64)) % np.uint64(params.folds)).astype(np.int64)
    margins, unseen = np.zeros(rows), np.zeros(rows, bool)
    for k in range(params.folds):
        rest, asked = fold != k, fold == k
        if asked.any() and 0 < (signs[rest] > 0).sum() < rest.sum():
            ratios, weights, bias = fitted(rest)
            found = _margins(owners, numbers, ratios, weights, bias, rows)
            margins[asked], unseen[asked] = found[asked], True
    ratios, weights, bias = fitted(np.ones(rows, bool))
    if not 0 < (signs[unseen] > 0).sum() < unseen.sum():
        margins, unseen = _margins(owners, numbers, ratios, weights, bias, rows), np.ones(rows, bool)
    slope, level = logistic_curve(margins[unseen], signs[unseen])
    return SupportVectors(names, weights, ratios, bias, slope, level, params.bits, params.keep_from)


def log_count_ratios(
    owners: np.ndarray, numbers: np.ndarray, signs: np.ndarray, chosen: np.ndarray, size: int
) -> np.ndarray:
    """The log of each n-gram's share of all n-grams of good texts, less that of bad ones, among the chosen texts."""
    good, bad = (1.0 + np.bincount(numbers, (chosen & (signs == s))[owners], size) for s in (1.0, -1.0))
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_descent(
    bounds: np.ndarray, numbers: np.ndarray, ratios: np.ndarray, signs: np.ndarray, chosen: np.ndarray, params: QualityParams
) -> tuple[np.ndarray, float]:
    """Weights and bias at the least of half their squares and the hinge losses, both classes weighing the same.

    One dual variable after another is set to its best value between 0 and its price, in an order that changes each round.
    """
    weights, bias = np.zeros(len(ratios)), 0.0
    # Prices make the classes weigh the same, however rare one is.
    share = (signs[chosen] > 0).mean()
    prices = params.price / (2 * np.where(signs > 0, share, 1 - share))
    texts = {}
    for i in chosen.tolist():
        own = numbers[bounds[i] : bounds[i + 1]]
        values = ratios[own]
        length = float(np.sqrt(values @ values))
        # With the constant of the bias, a text of n-grams has the square 2.
        texts[i] = (own, values * (signs[i] / length) if length else values, 2.0 if length else 1.0)
    dual = np.zeros(len(signs))
    rng = np.random.default_rng(params.seed)
    for _ in range(params.max_rounds):
        worst = 0.0
        for i in rng.permutation(chosen).tolist():
            own, values, square = texts[i]
            slope = float(weights[own] @ values) + signs[i] * bias - 1.0
            old = dual[i]
            if (old == 0.0 and slope >= 0) or (old == prices[i] and slope <= 0):
                continue
            worst = max(worst, abs(slope))
            dual[i] = min(max(old - slope / square, 0.0), prices[i])
            if dual[i] != old:
                weights[own] += (dual[i] - old) * values
                bias += (dual[i] - old) * signs[i]
        if worst < params.tolerance:
            break
    return weights, bias


def _margins(owners, numbers, ratios, weights, bias: float, rows: int) -> np.ndarray:
    length = np.sqrt(np.bincount(owners, ratios[numbers] ** 2, rows))
    return np.bincount(owners, weights[numbers], rows) / np.where(length > 0, length, 1.0) + bias


def logistic_curve(margins: np.ndarray, signs: np.ndarray) -> tuple[float, float]:
    """Slope and level of the curve that makes margins probabilities, by damped Newton steps on smoothed targets."""
    good, bad = (signs > 0).sum(), (signs < 0).sum()
    targets = np.where(signs > 0, (good + 1.0) / (good + 2.0), 1.0 / (bad + 2.0))
    x = np.array([1.0, 0.0])
    columns = np.stack([margins, np.ones(len(margins))], axis=1)

    def loss(at: np.ndarray) -> float:
        z = columns @ at
        return float((np.logaddexp(0, z) - targets * z).sum())

    value = loss(x)
    for _ in range(100):
        scores = _sigmoid(columns @ x)
        slope = columns.T @ (scores - targets)
        bend = (columns * (scores * (1 - scores))[:, None]).T @ columns + 1e-9 * np.eye(2)
        step, length = np.linalg.solve(bend, slope), 1.0
        while (fresh := loss(x - length * step)) > value and length > 1e-10:
            length /= 2
        if value - fresh <= 1e-10 * max(1.0, value):
            break
        x, value = x - length * step, fresh
    # More margin is never less likely.
    return max(float(x[0]), 0.0), float(x[1])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _scored(batches: Iterator[pa.RecordBatch], model: SupportVectors, names: list[str]) -> Iterator[pa.RecordBatch]:
    weights, squares = (np.zeros(1 << model.bits, np.float64) for _ in range(2))
    weights[model.buckets], squares[model.buckets] = model.weights, model.ratios**2
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            grams, bounds = grams_of(data, offsets, model.bits)
            owners = np.repeat(np.arange(end - first), np.diff(bounds))
            length = np.sqrt(np.bincount(owners, squares[grams], end - first))
            margins = np.bincount(owners, weights[grams], end - first) / np.where(length > 0, length, 1.0)
            scores = model.scores(margins + np.where(length > 0, model.bias, 0.0))
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(scores), pa.array((scores >= model.keep_from).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )
