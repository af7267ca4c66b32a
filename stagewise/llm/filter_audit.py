"""Filter interaction audit: what five filters remove from each part, alone, together and in every order.

Sorted posting lists. Every part keeps, for ranges of its ids, the sorted list of the rows that fail each filter, and the
lists of failing rows that are labelled good or toxic. A galloping k-way merge of the lists of a range finds which rows
stand in exactly which lists: from the lowest head, the list that has it alone runs on in doubling steps to the next head
of another list, and the run is counted as one. Sums over ranges give the sizes of all unions of lists, 32 a part, and
all figures of the report are differences of these: what an order removes at a step is the union with the step's filter
less the union of the filters before it. So 120 orders cost no more than one, and rows that fail nothing have no entry.

The filters, on whole texts, words being what white space separates:

* A: fewer than ``min_words`` words;
* B: fewer than ``distinct_percent`` in a hundred words are distinct (compared by 64-bit hashes, case-sensitively);
* C: more than ``capitals_percent`` in a hundred code points are A-Z;
* D: any of ``marks``;
* E: the text is that of a smaller doc_id somewhere in the table, whether that row stays or not (by 128 bits of a SHA-256).

At scale: texts are read once and leave a row of some fifty bytes each. Groups of copies are reduced to their smallest id
before the shuffle; the join that brings it back, and the one with the labels, are split by adaptive execution where a
key is hot. Ranges of ids are Spark's own range partitions of part, id and row, so a part with a third of all rows has
many, even if its ids repeat, and a range is cut into lists of at most ``BLOCK_ROWS`` rows.

Defined cases: a null text is empty and equal to empty ones; an empty text fails A and no other of A to D. A null part is
the empty string. Rows with a null id count, but fail E never, are no smaller id, and have no labels. Rows with equal ids
are separate documents, neither the smaller one. Several labels for one id: one of 1 is enough. Tables without rows give
no rows. Other columns are not read.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.words import Words, word_slices
from stagewise.session import settle, ship_package

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
GOOD, TOXIC = ALL + 1, 2 * (ALL + 1)
# Rows of one block of posting lists at most.
BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class FilterRules:
    min_words: int = 200
    distinct_percent: int = 50
    capitals_percent: int = 2
    marks: str = "#$%&*|"


def audit_filters(
    documents: DataFrame, labels: DataFrame, rules: FilterRules = FilterRules(), part: str = "source"
) -> DataFrame:
    """A row for each part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley."""
    judged = judge_rows(documents, rules, part)
    unions = union_sizes(posting_lists(failing_rows(judged, labels)))
    return report(judged.groupBy("part").agg(F.count("*").alias("rows")), unions)


def judge_rows(documents: DataFrame, rules: FilterRules = FilterRules(), part: str = "source") -> DataFrame:
    """Each row's part, doc_id, a number of its own, a digest of its text, and the filters A to D that it fails, as bits."""
    ship_package(documents.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest"),
        text.alias("text"),
    )
    schema = "part string, doc_id bigint, row bigint, digest binary, fails int"
    # Written: read again for the smallest ids and by the joins, and row numbers stay the same from here on.
    return settle(rows.mapInArrow(lambda batches: _judged(batches, rules), schema), "judged-rows")


def _judged(batches: Iterator[pa.RecordBatch], rules: FilterRules) -> Iterator[pa.RecordBatch]:
    names = ["part", "doc_id", "row", "digest"]
    for batch in batches:
        for first, end, words in word_slices(batch.column("text"), "spaced", False):
            part = batch.slice(first, end - first).select(names)
            lengths = _lengths(batch.column("text").slice(first, end - first))
            fails = text_fails(words, np.concatenate([[0], np.cumsum(lengths)]), rules)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fails, pa.int32())], names=[*names, "fails"])


def _lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def text_fails(words: Words, offsets: np.ndarray, rules: FilterRules) -> np.ndarray:
    """Which of the filters A to D each text fails."""
    counts = words.counts()
    bounds = words.bounds.tolist()
    pairs = zip(bounds[:-1], bounds[1:], strict=True)
    distinct = np.array([len(np.unique(words.hashes[a:b])) for a, b in pairs], np.int64)
    data = words.data
    marks = np.isin(np.arange(256), list(rules.marks.encode("ascii")))

    def inside(flags: np.ndarray) -> np.ndarray:
        totals = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return totals[offsets[1:]] - totals[offsets[:-1]]

    points = inside((data & 0xC0) != 0x80)
    capitals = inside((data >= 0x41) & (data <= 0x5A))
    return (
        (counts < rules.min_words) * 1
        + (100 * distinct < rules.distinct_percent * counts) * 2
        + (100 * capitals > rules.capitals_percent * points) * 4
        + (inside(marks[data]) > 0) * 8
    )


def failing_rows(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that fail any filter, E included, with bits for their labels: part, doc_id, row and bits."""
    copies = (
        judged.where(F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("digest", "first")
    )
    again = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    failing = (
        judged.join(settle(copies, "first-copies"), "digest", "left")
        .select("part", "doc_id", "row", F.col("fails").bitwiseOR(again).alias("fails"))
        .where(F.col("fails") > 0)
    )
    tags = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(_any_one("quality", GOOD).alias("good"), _any_one("toxic", TOXIC).alias("toxic"))
        .where(F.col("good") + F.col("toxic") > 0)
    )
    bits = F.col("fails") + F.coalesce(F.col("good") + F.col("toxic"), F.lit(0))
    return failing.join(tags, "doc_id", "left").select("part", "doc_id", "row", bits.alias("bits"))


def _any_one(name: str, bit: int) -> Column:
    return F.max(F.when(F.col(name) == 1, F.lit(bit)).otherwise(F.lit(0)))


def posting_lists(failing: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each range of a part's ids: part, block, ids (sorted, of all failing rows of the range) and lists.

    ``lists`` has the sorted places in ``ids`` of the rows that fail each filter, then of those labelled good and toxic.
    """
    # Written first, as Spark takes a sample of what it is to cut into ranges.
    rows = settle(failing, "failing-rows").repartitionByRange("part", "doc_id", "row")
    ordered = rows.sortWithinPartitions("part", "doc_id", "row").select("part", "doc_id", "bits")
    schema = "part string, block bigint, ids array<bigint>, lists array<array<int>>"
    return settle(ordered.mapInArrow(lambda batches: _posted(batches, block_rows), schema), "posting-lists")


_POSTED = pa.schema(
    [
        ("part", pa.string()),
        ("block", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("lists", pa.list_(pa.list_(pa.int32()))),
    ]
)


def _posted(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    part, held, size, block = None, [], 0, TaskContext.get().partitionId() << 32

    def posted() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        bits = rows["bits"].to_numpy()
        lists = [np.flatnonzero(bits & (1 << b)).astype(np.int32) for b in range(len(FILTERS) + 2)]
        row = {"part": [part], "block": [block], "ids": [rows["doc_id"].to_pylist()], "lists": [lists]}
        return pa.RecordBatch.from_pydict(row, _POSTED)

    for batch in batches:
        starts = _changes(batch.column("part"))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            name = batch.column("part")[a].as_py()
            while a < b:
                if held and (name != part or size == block_rows):
                    yield posted()
                    held, size, block = [], 0, block + 1
                part, taken = name, min(b - a, block_rows - size)
                held.append(batch.slice(a, taken).select(["doc_id", "bits"]))
                size, a = size + taken, a + taken
    if held:
        yield posted()


def _changes(parts: pa.Array) -> list[int]:
    """Where a sorted column takes another value."""
    codes = parts.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.diff(codes, prepend=-1)).tolist() if len(codes) else []


def merged_sizes(lists: Sequence[Sequence[int]]) -> Counter[int]:
    """How many entries stand in exactly which of several sorted lists (bits of the key), by a galloping merge."""
    lists = [(1 << n, list(entries)) for n, entries in enumerate(lists) if len(entries)]
    places = [0] * len(lists)
    sizes: Counter[int] = Counter()
    while lists:
        heads = [entries[at] for (_, entries), at in zip(lists, places, strict=True)]
        lowest = min(heads)
        holders = [n for n, head in enumerate(heads) if head == lowest]
        if len(holders) > 1:
            sizes[sum(lists[n][0] for n in holders)] += 1
            for n in holders:
                places[n] += 1
        else:
            (n,) = holders
            bit, entries = lists[n]
            others = heads[:n] + heads[n + 1 :]
            stop = gallop(entries, places[n], min(others)) if others else len(entries)
            sizes[bit] += stop - places[n]
            places[n] = stop
        if any(places[n] == len(lists[n][1]) for n in holders):
            left = [n for n, (_, entries) in enumerate(lists) if places[n] < len(entries)]
            lists, places = [lists[n] for n in left], [places[n] for n in left]
    return sizes


def gallop(entries: list[int], at: int, value: int) -> int:
    """The first place from ``at`` on whose entry is not below a value: doubling steps, then halving ones."""
    step, end = 1, len(entries)
    while at + step < end and entries[at + step] < value:
        step *= 2
    return bisect_left(entries, value, at + step // 2, min(at + step, end))


def union_sizes(postings: DataFrame) -> DataFrame:
    """The size of every union of filters' lists in each part: part, subset (bits), size, good and toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, cells, sizes = [], [], []
            for part, lists in zip(batch.column("part").to_pylist(), batch.column("lists"), strict=True):
                found = merged_sizes(lists.as_py())
                parts += [part] * len(found)
                cells += found.keys()
                sizes += found.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.string()), pa.array(cells, pa.int32()), pa.array(sizes, pa.int64())],
                names=["part", "cell", "n"],
            )

    cells = postings.select("part", "lists").mapInArrow(run, "part string, cell int, n bigint")
    summed = cells.groupBy("part", "cell").agg(F.sum("n").alias("n"))
    subsets = summed.select("part", "cell", "n", F.explode(F.sequence(F.lit(0), F.lit(ALL))).alias("subset"))
    met = subsets.where(F.col("cell").bitwiseAND(F.col("subset")) > 0)

    def tagged(bit: int) -> Column:
        return F.sum(F.when(F.col("cell").bitwiseAND(F.lit(bit)) > 0, F.col("n")).otherwise(F.lit(0)))

    return met.groupBy("part", "subset").agg(
        F.sum("n").alias("size"), tagged(GOOD).alias("good"), tagged(TOXIC).alias("toxic")
    )


def report(totals: DataFrame, unions: DataFrame) -> DataFrame:
    """Every order and step for each part, from its number of rows and the sizes of its unions."""
    by_subset = unions.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("subset", F.struct("size", "good", "toxic")))).alias("unions")
    )

    def size(subset: Column | int, field: str = "size") -> Column:
        key = F.lit(subset) if isinstance(subset, int) else subset
        return F.coalesce(F.try_element_at("unions", key)[field], F.lit(0).cast("long"))

    def share(number: int) -> Column:
        """What a filter removes, summed over all orders: those with the same filters before it count together."""
        bit, total = 1 << number, F.lit(0).cast("long")
        for before in range(ALL + 1):
            if not before & bit:
                earlier = before.bit_count()
                orders = factorial(earlier) * factorial(len(FILTERS) - 1 - earlier)
                total = total + orders * (size(before | bit) - size(before))
        return total

    steps = [
        {"filter_order": "".join(order), "step": k + 1, "number": FILTERS.index(name), "before": sum(1 << FILTERS.index(x) for x in order[:k])}
        for order in permutations(FILTERS)
        for k, name in enumerate(order)
    ]
    kind = "array<struct<filter_order: string, step: int, number: int, before: int>>"
    rows = (
        totals.join(by_subset, "part", "left")
        .withColumn("shares", F.array(*[share(n) for n in range(len(FILTERS))]))
        .select("part", "rows", "unions", "shares", F.explode(F.from_json(F.lit(json.dumps(steps)), kind)).alias("s"))
        .select("part", "rows", "unions", "shares", "s.*")
        .withColumn("bit", F.expr("shiftleft(1, number)"))
    )
    after = F.col("before").bitwiseOR(F.col("bit"))
    removed = size(after) - size(F.col("before"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - size(after)).alias("kept"),
        removed.alias("removed"),
        (size(F.col("bit")) - removed).alias("redundant"),
        (size(ALL) - size(F.lit(ALL).bitwiseXOR(F.col("bit")))).alias("unique_fails"),
        (size(after, "good") - size(F.col("before"), "good")).alias("good_lost"),
        (size(after, "toxic") - size(F.col("before"), "toxic")).alias("toxic_lost"),
        F.element_at("shares", F.col("number") + 1).alias("shapley"),
    )
