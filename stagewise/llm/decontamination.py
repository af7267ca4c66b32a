"""Benchmark decontamination: documents that contain windows of benchmark items, by a prefix-filtered set join.

Texts are lower-cased (A-Z) and cut into words of digits, ASCII letters and characters beyond ASCII. A window is ``width``
consecutive words of an item; an item with fewer words, but at least one, is a single window. A document is hit where all
words of a window stand consecutively.

The join. A window is a set of shingles of up to three words. Containment asks for all of them, so the prefix that has to
be looked up is a single shingle: its rarest, by counts over all documents. Each document place with such a shingle gives
candidates, at the start the shingle's position in the window implies (positional bound), if the document has room for
the window there (length bound). What is left is compared word by word, byte for byte.

Windows are dealt by hash into blocks of about ``block_windows``, so that what a block broadcasts is bounded however large
the benchmark is; all documents are streamed past each block. With one block no document text is shuffled; with more, the
blocks give numbers of rows, and the texts are joined to what was found once.

Defined cases: null and empty texts have no words, so nothing hits. Items with a null id hit words, but are not counted
or listed as items. Repeated items count once by id. Repeated documents, null ids and equal ids with different texts are
separate rows. Columns of the input named like an output are replaced, all others stay.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm.names import free_names
from stagewise.llm.words import HashSet, Words, gram_hashes, split_words, word_slices
from stagewise.session import settle, ship_package

WIDTH = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


@dataclass
class WindowIndex:
    """The windows of one block, found by their rarest shingle. Shingles of 1, 2 and 3 words are kept apart."""

    windows: list[list[bytes]]
    items: list[list[int]]  # ids of the items that have the window
    prefixes: dict[int, HashSet]  # by words in a shingle
    holders: dict[int, list[list[tuple[int, int]]]]  # per prefix: (window, position of the shingle in it)


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The distinct windows of the items, as words joined by a space, with the ids of their items."""
    ship_package(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [w.decode() for w in _WORD.findall((text or "").encode().lower())]
                for at in range(max(1, len(words) - width + 1) if words else 0):
                    ids.append(item)
                    windows.append(" ".join(words[at : at + width]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(windows, pa.string())], names=["item_id", "window"]
            )

    rows = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id bigint, window string")
    return rows.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def find_windows(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """The rows of ``documents`` with ``n_words``, ``spans`` (merged [first, end) runs of hit words) and ``items``."""
    ship_package(documents.sparkSession)
    windows = settle(item_windows(benchmark, width), "item-windows")
    blocks = max(1, -(-windows.count() // block_windows))
    kept = [f"`{c}`" for c in documents.columns if c not in _ADDED.names]
    rows = documents.select(*kept)
    if blocks == 1:
        return _search(rows, windows)
    # Written with a number for each row: the blocks' searches then give rows of numbers only, and the texts are joined
    # back once, however many blocks there are.
    (number,) = free_names(documents.columns, "row_number")
    named = settle(rows.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    parts = [
        _search(named.select(number, "text"), windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)).drop("text")
        for b in range(blocks)
    ]
    merged = reduce(DataFrame.unionAll, parts).groupBy(number).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return named.join(merged, number).select(*kept, "n_words", _merge_spans(F.col("spans")).alias("spans"), "items")


def hit_words(spans: Column) -> Column:
    """How many words the spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])


def items_digest(items: Column) -> Column:
    """SHA-256 of the item ids, sorted as strings and joined by a comma."""
    return F.sha2(F.array_join(F.array_sort(items.cast("array<string>")), ","), 256)


def _merge_spans(spans: Column) -> Column:
    """Sorted spans with touching and overlapping ones joined."""

    def step(done, span):
        last = F.element_at(done, -1)
        joined = F.array(last[0], F.greatest(last[1], span[1]))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))[1] >= span[0]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast("array<array<bigint>>"), step)


def _search(documents: DataFrame, windows: DataFrame) -> DataFrame:
    spark = documents.sparkSession
    rows = sorted((r["window"], r["items"]) for r in windows.collect())  # one block
    words = [w.encode().split(b" ") for w, _ in rows]
    counts = _corpus_counts(documents, words)
    index = _build_index(words, [list(items) for _, items in rows], counts)
    shared = spark.sparkContext.broadcast(index)
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for first, end, words in word_slices(batch.column("text"), "letters", True):
                spans, items = _hits(words, index)
                none: list = []
                columns = [
                    pa.array(words.counts(), pa.int64()),
                    pa.array([spans.get(i, none) for i in range(end - first)], pa.list_(pa.list_(pa.int64()))),
                    pa.array([sorted(items.get(i, none)) for i in range(end - first)], pa.list_(pa.int64())),
                ]
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*names, *_ADDED.names])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, *_ADDED.fields]))


def _shingles(windows: list[list[bytes]]) -> list[np.ndarray]:
    """The shingle hashes of each window, with the hashing that documents get."""
    flat = [word for window in windows for word in window]
    data = np.frombuffer(b" ".join(flat), np.uint8)
    words = split_words(data, np.array([0, len(data)]), "letters", True)
    out, at = [], 0
    for window in windows:
        out.append(gram_hashes(words.hashes[at : at + len(window)], min(SHINGLE, len(window))))
        at += len(window)
    return out


def _corpus_counts(documents: DataFrame, windows: list[list[bytes]]) -> dict[int, dict[int, int]]:
    """How often each shingle of the windows occurs in all documents, by words in a shingle."""
    wanted: dict[int, list[np.ndarray]] = defaultdict(list)
    for window, hashes in zip(windows, _shingles(windows), strict=True):
        wanted[min(SHINGLE, len(window))].append(hashes)
    sets = {n: HashSet(np.concatenate(h)) for n, h in wanted.items()}
    shared = documents.sparkSession.sparkContext.broadcast(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = shared.value
        counts = {n: np.zeros(len(s.members), np.int64) for n, s in sets.items()}
        for batch in batches:
            for _, _, words in word_slices(batch.column(0), "letters", True):
                for n, members in sets.items():
                    hashes, inside = words.grams(n)
                    places, numbers = members.find(hashes)
                    counts[n] += np.bincount(numbers[inside[places]], minlength=len(members.members))
        for n, found in counts.items():
            seen = np.flatnonzero(found)
            size = np.full(len(seen), n, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(size), pa.array(seen, pa.int64()), pa.array(found[seen])], names=["n", "number", "count"]
            )

    rows = documents.select("text").mapInArrow(run, "n int, number bigint, count bigint")
    totals: dict[int, dict[int, int]] = defaultdict(dict)
    for row in rows.groupBy("n", "number").agg(F.sum("count").alias("total")).collect():  # at most the block's shingles
        totals[row["n"]][int(sets[row["n"]].members[row["number"]])] = row["total"]
    return totals


def _build_index(
    windows: list[list[bytes]], items: list[list[int]], counts: dict[int, dict[int, int]]
) -> WindowIndex:
    prefixes: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for number, (window, hashes) in enumerate(zip(windows, _shingles(windows), strict=True)):
        n = min(SHINGLE, len(window))
        seen = counts.get(n, {})
        ordered = sorted((seen.get(int(h), 0), int(h), at) for at, h in enumerate(hashes))
        count, rarest, at = ordered[0]
        if count:  # a window with a shingle that no document has is in none
            prefixes[n][rarest].append((number, at))
    sets = {n: HashSet(np.array(list(p), np.uint64)) for n, p in prefixes.items()}
    holders = {n: [prefixes[n][int(h)] for h in s.members] for n, s in sets.items()}
    return WindowIndex(windows, items, sets, holders)


def _hits(words: Words, index: WindowIndex) -> tuple[dict[int, list], dict[int, set]]:
    """Merged spans of hit words and the items found, by text."""
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    items: dict[int, set[int]] = defaultdict(set)
    raw = None
    for n, prefixes in index.prefixes.items():
        hashes, inside = words.grams(n)
        places, numbers = prefixes.find(hashes)
        good = inside[places]
        places, numbers = places[good], numbers[good]
        if not len(places):
            continue
        texts = np.searchsorted(words.bounds, places, side="right") - 1
        raw = raw if raw is not None else words.data.tobytes()
        for place, number, text in zip(places.tolist(), numbers.tolist(), texts.tolist(), strict=True):
            low, high = int(words.bounds[text]), int(words.bounds[text + 1])
            for window, at in index.holders[n][number]:
                want = index.windows[window]
                start = place - at
                if start < low or start + len(want) > high:
                    continue
                if all(
                    raw[words.starts[start + k] : words.ends[start + k]] == word for k, word in enumerate(want)
                ):
                    runs[text].append((start - low, start - low + len(want)))
                    items[text].update(index.items[window])
    return {text: _merged(found) for text, found in runs.items()}, items


def _merged(runs: list[tuple[int, int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for first, end in sorted(runs):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    return merged
