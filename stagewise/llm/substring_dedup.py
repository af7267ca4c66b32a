"""Substring dedup: windows of 50 consecutive words that an earlier document has as well are removed.

Super-k-mer partitioning. The minimiser of a window is the smallest hash of the ``GRAM`` consecutive words in it. Windows
that follow each other mostly share it; such a run travels as one string, its words packed with single spaces, to the
bucket of its minimiser. Equal windows have equal minimisers, so they meet there, where sorting the windows finds equal
ones exactly, word for word, and the smallest document that has each. The chunk that sent a run gets back that document
for each of its windows, and removes what stands in windows of smaller ones.

What is not worth sending is found out first, with hashes alone: a minimiser that only one document has cannot belong to
a repeated window. A run that occurs many times in a chunk is sent once, with its smallest document. Minimisers with
very many different runs (a passage that a third of all documents quote in different surroundings) would still fill one
bucket; their windows are sent one by one to the buckets of their own hashes, so they spread evenly.

Words are what white space separates, compared as they are. Windows are judged on the input. Defined cases: null and
empty texts have no words; texts of fewer than ``width`` words have no windows. Rows with a null id are left alone and
are never the earlier document; rows with equal ids are one document as to order, so neither removes from the other.
Every row gets a row. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stagewise.llm.exchange import (
    Chunk,
    answered,
    answers_of,
    bucket_of,
    by_bucket,
    each_told,
    join_parts,
    messages,
    pack,
    split_parts,
    stage_chunks,
    told,
    unpack,
)
from stagewise.llm.words import Words, mix, split_words
from stagewise.session import settle

WIDTH = 50
GRAM = 8
# Different runs from which on the windows of a minimiser are dealt out by their own hashes.
HOT_RUNS = 2_000

# Bytes of strings whose windows are sorted together; a larger group is sorted by itself.
SORT_BYTES = 500_000

_ONE_DOCUMENT, _REPEATED, _HOT = 0, 1, 2
_FIRST_UNKNOWN = np.iinfo(np.int64).max


@dataclass
class Runs:
    """Runs of windows with one minimiser: their first and last window, and the document of each."""

    words: Words
    keys: np.ndarray
    first: np.ndarray
    last: np.ndarray
    documents: np.ndarray
    marks: np.ndarray  # tells most different runs of a minimiser apart


def runs_of(chunk: Chunk, width: int = WIDTH) -> Runs:
    words = chunk.words("spaced", False)
    counts = words.counts() * chunk.known
    gram = min(GRAM, width)
    grams, _ = words.grams(gram)
    lowest = _sliding_minimum(grams, width - gram + 1)
    owners = words.owners()[: len(lowest)]
    starts = np.arange(len(lowest))
    usable = (starts + width <= words.bounds[1:][owners]) & (counts[owners] >= width)
    at = np.flatnonzero(usable)
    if not len(at):
        none = np.empty(0, np.int64)
        return Runs(words, np.empty(0, np.uint64), none, none, none, np.empty(0, np.uint64))
    # A minimum is a small hash: mixed, minimisers spread evenly over the buckets, and equal ones stay equal.
    keys, docs = mix(lowest[at]), owners[at]
    heads = np.flatnonzero(
        np.concatenate([[True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1]) | (at[1:] != at[:-1] + 1)])
    )
    tails = np.append(heads[1:], len(at)) - 1
    first, last = at[heads], at[tails]
    marks = mix(grams[first] + np.uint64(3) * grams[last + width - gram] + (last - first).astype(np.uint64))
    return Runs(words, keys[heads], first, last, docs[heads], marks)


def _sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` neighbours."""
    if len(values) < size:
        return values[:0]
    span = 1
    while span * 2 <= size:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = size - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def dedup_substrings(documents: DataFrame, width: int = WIDTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """A row for each document: doc_id, n_words, n_removed and kept (the words that stay, joined by a space)."""
    chunks = stage_chunks(documents)
    buckets = chunks.buckets
    asked = messages(chunks, lambda c: _minimisers(c, buckets, width))
    flags = settle(answered(chunks, asked, lambda sent: _flags(sent, hot_runs)), "flags")
    sent = messages(chunks, lambda c, got: _packed_runs(c, answers_of(got), buckets, width), told(chunks, flags))
    lowest = settle(answered(chunks, sent, lambda found: _first_documents(found, width)), "first-documents")
    # The second round's buckets are numbered behind the first's.
    rows = told(chunks, flags.unionByName(lowest))
    return each_told(
        rows,
        lambda chunk, got: _kept(chunk, got, buckets, width),
        "doc_id bigint, n_words bigint, n_removed bigint, kept string",
    )


def _minimisers(chunk: Chunk, buckets: int, width: int) -> Iterator[tuple[int, bytes]]:
    """Each distinct minimiser, its smallest and largest document, and how many different runs it has."""
    runs = runs_of(chunk, width)
    if not len(runs.keys):
        return
    ids = chunk.ids[runs.documents]
    order = np.argsort(runs.keys, kind="stable")
    keys, heads = np.unique(runs.keys[order], return_index=True)
    low, high = np.minimum.reduceat(ids[order], heads), np.maximum.reduceat(ids[order], heads)
    by_mark = np.lexsort((runs.marks, runs.keys))
    fresh = np.ones(len(by_mark), np.int64)
    fresh[1:] = (runs.marks[by_mark][1:] != runs.marks[by_mark][:-1]) | (
        runs.keys[by_mark][1:] != runs.keys[by_mark][:-1]
    )
    kinds = np.add.reduceat(fresh, heads)
    for bucket, a, b in by_bucket(keys, buckets):
        yield bucket, join_parts([pack(keys[a:b]), pack(low[a:b]), pack(high[a:b]), pack(kinds[a:b])])


def _flags(sent: list[bytes], hot_runs: int) -> tuple[list[bytes], bytes]:
    opened = [split_parts(m) for m in sent]
    keys = [unpack(p[0], np.uint64) for p in opened]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    high = np.full(len(distinct), np.iinfo(np.int64).min)
    kinds = np.zeros(len(distinct), np.int64)
    np.minimum.at(low, place, np.concatenate([unpack(p[1], np.int64) for p in opened]))
    np.maximum.at(high, place, np.concatenate([unpack(p[2], np.int64) for p in opened]))
    np.add.at(kinds, place, np.concatenate([unpack(p[3], np.int64) for p in opened]))
    flags = np.where(low < high, np.where(kinds > hot_runs, _HOT, _REPEATED), _ONE_DOCUMENT).astype(np.uint8)
    ends = np.cumsum([len(k) for k in keys])
    return [pack(flags[place[e - len(k) : e]]) for k, e in zip(keys, ends, strict=True)], b""


def _flag_of_runs(runs: Runs, got: dict[int, bytes], buckets: int) -> np.ndarray:
    if not len(runs.keys):
        return np.empty(0, np.uint8)
    flags = np.concatenate([unpack(got[b], np.uint8) for b in sorted(got) if b < buckets])
    return flags[np.unique(runs.keys, return_inverse=True)[1]]


class _Packed:
    """The words of a chunk with single spaces between them."""

    def __init__(self, words: Words):
        lengths = words.ends - words.starts
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.full(int(self.starts[-1]), 0x20, np.uint8)
        inside = np.zeros(len(words.data) + 1, np.int8)
        inside[words.starts] += 1
        np.subtract.at(inside, words.ends, 1)
        filled = np.cumsum(inside[:-1]).astype(bool)
        text[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = words.data[filled]
        self.raw = text.tobytes()

    def between(self, first: int, end: int) -> bytes:
        """Words ``first`` to ``end - 1``."""
        return self.raw[self.starts[first] : self.starts[end] - 1]


def _sendings(
    chunk: Chunk, runs: Runs, flags: np.ndarray, buckets: int, width: int
) -> Iterator[tuple[int, int, bytes, int, int, int]]:
    """What each run that matters sends: (bucket, key, string, document id, first window, windows)."""
    import xxhash

    packed = _Packed(runs.words)
    homes = bucket_of(runs.keys, buckets)
    for at in np.flatnonzero(flags).tolist():
        first, last, doc = int(runs.first[at]), int(runs.last[at]), int(chunk.ids[runs.documents[at]])
        if flags[at] == _REPEATED:
            string = packed.between(first, last + width)
            yield int(homes[at]), int(runs.keys[at]), string, doc, first, last - first + 1
        else:
            for start in range(first, last + 1):
                string = packed.between(start, start + width)
                key = xxhash.xxh64_intdigest(string)
                yield (key >> 40) * buckets >> 24, key, string, doc, start, 1


def _packed_runs(chunk: Chunk, got: dict[int, bytes], buckets: int, width: int) -> Iterator[tuple[int, bytes]]:
    import zstandard

    runs = runs_of(chunk, width)
    parts: dict[int, dict[bytes, list[int]]] = {}
    for bucket, key, string, doc, _, _ in _sendings(chunk, runs, _flag_of_runs(runs, got, buckets), buckets, width):
        known = parts.setdefault(bucket, {}).setdefault(string, [key, doc])
        known[1] = min(known[1], doc)
    packer = zstandard.ZstdCompressor(level=3)
    for bucket, found in parts.items():
        keys = np.array([k for k, _ in found.values()], np.uint64)
        docs = np.array([d for _, d in found.values()], np.int64)
        # Words hold no line feed, so it can stand between the strings.
        yield buckets + bucket, join_parts([packer.compress(b"\n".join(found)), pack(keys), pack(docs)])


def _first_documents(sent: list[bytes], width: int) -> tuple[list[bytes], bytes]:
    """For each window of each string the smallest document that has it."""
    import zstandard

    strings: list[bytes] = []
    keys, docs, ends = [], [], []
    for message in sent:
        raw, own_keys, own_docs = split_parts(message)
        strings += zstandard.ZstdDecompressor().decompress(raw).split(b"\n")
        keys.append(unpack(own_keys, np.uint64))
        docs.append(unpack(own_docs, np.int64))
        ends.append(len(strings))
    keys, docs = np.concatenate(keys), np.concatenate(docs)
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    lowest: list[np.ndarray] = [np.empty(0, np.int64)] * len(strings)
    # Groups are sorted some at a time: equal windows have equal keys, so none meets another group's.
    batch: dict[bytes, int] = {}
    waiting: list[int] = []
    size = 0

    def sort() -> None:
        found = _sorted_windows(batch, width)
        for m in waiting:
            lowest[m] = found[strings[m]]

    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
        members = order[a:b].tolist()
        first: dict[bytes, int] = {}
        for m in members:
            doc = int(docs[m])
            if doc < first.get(strings[m], _FIRST_UNKNOWN):
                first[strings[m]] = doc
        if len(first) == 1:
            found = _sorted_windows(first, width)
            for m in members:
                lowest[m] = found[strings[m]]
            continue
        batch |= first
        waiting += members
        size += sum(map(len, first))
        if size > SORT_BYTES:
            sort()
            batch, waiting, size = {}, [], 0
    if batch:
        sort()
    replies = []
    for begin, end in zip([0, *ends[:-1]], ends, strict=True):
        replies.append(pack(np.concatenate([np.empty(0, np.int64), *lowest[begin:end]])))
    return replies, b""


def _sorted_windows(strings: dict[bytes, int], width: int) -> dict[bytes, np.ndarray]:
    """Sort the windows of different strings; equal ones come to lie side by side.

    What is sorted are hashes of the windows with their places. Neighbours with one hash are compared word for word.
    """
    if len(strings) == 1:
        (string, doc), *_ = strings.items()
        return {string: np.full(string.count(b" ") - width + 2, doc, np.int64)}
    raw = b"\n".join(strings) + b"\n"
    offsets = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])]).astype(np.int64)
    words = split_words(np.frombuffer(raw, np.uint8), offsets, "spaced", False)
    hashes, inside = words.grams(width)
    at = np.flatnonzero(inside)
    docs = np.array(list(strings.values()), np.int64)[words.owners()[at]]
    order = np.argsort(hashes[at], kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(hashes[at][order]) != 0]))
    ends = np.append(heads[1:], len(order))
    lowest = np.empty(len(at), np.int64)
    lowest[order] = np.repeat(np.minimum.reduceat(docs[order], heads), ends - heads)
    starts, stops = words.starts[at], words.ends[at + width - 1]
    for a, b in zip(heads[ends - heads > 1].tolist(), ends[ends - heads > 1].tolist(), strict=True):
        members = order[a:b].tolist()
        first = raw[starts[members[0]] : stops[members[0]]]
        if any(raw[starts[m] : stops[m]] != first for m in members[1:]):
            # Different windows with one hash: each text by itself.
            own: dict[bytes, list[int]] = {}
            for m in members:
                own.setdefault(raw[starts[m] : stops[m]], []).append(m)
            for same in own.values():
                lowest[same] = docs[same].min()
    bounds = np.searchsorted(at, words.bounds)
    return {s: lowest[x:y] for s, x, y in zip(strings, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)}


def _kept(chunk: Chunk, got: dict[int, bytes], buckets: int, width: int) -> pa.RecordBatch:
    runs = runs_of(chunk, width)
    words = runs.words
    cover = np.zeros(len(words) + 1, np.int64)
    order: dict[int, dict[bytes, int]] = {}
    sendings = list(_sendings(chunk, runs, _flag_of_runs(runs, got, buckets), buckets, width))
    sizes: dict[int, list[int]] = {}
    for bucket, _, string, _, _, count in sendings:
        known = order.setdefault(bucket, {})
        if string not in known:
            known[string] = len(known)
            sizes.setdefault(bucket, [0]).append(count)
    starts = {bucket: np.cumsum(counts) for bucket, counts in sizes.items()}
    replies = {bucket: unpack(got[buckets + bucket], np.int64) for bucket in sizes}
    for bucket, _, string, doc, first, count in sendings:
        at = starts[bucket][order[bucket][string]]
        gone = first + np.flatnonzero(replies[bucket][at : at + count] < doc)
        cover[gone] += 1
        cover[gone + width] -= 1
    removed = np.cumsum(cover[:-1]) > 0
    packed = _Packed(words)
    texts = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        gone = removed[a:b]
        if not gone.any():
            texts.append(packed.between(a, b) if b > a else b"")
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
        pieces = [packed.between(a + x, a + y) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        texts.append(b" ".join(pieces))
    counts = words.counts()
    totals = np.concatenate([[0], np.cumsum(removed)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunk.ids, pa.int64(), mask=~chunk.known),
            pa.array(counts, pa.int64()),
            pa.array(totals[words.bounds[1:]] - totals[words.bounds[:-1]], pa.int64()),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "kept"],
    )
