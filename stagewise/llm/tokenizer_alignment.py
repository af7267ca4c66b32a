"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often they do so in a corpus.

Each text is encoded as a space and the text by a byte-level pair vocabulary (A), and by a piece vocabulary that adds the
space itself (B). Where the bytes of both token sequences are those of space and text, the tokens of both are intervals
of the same bytes, and the places where tokens of both end cut them into groups.

Pointer jumping. Every token points to the farthest-right token that overlaps it: the one of the other side that holds its
last byte, if that one ends further right, else none is further. Where both end together, the token of B points to that of
A, which points to itself. Successors are then doubled, all tokens of many texts at once (``next = next[next]``), until
nothing changes: every token has reached the last A token of its group, which labels the group. The number of rounds is
the logarithm of the longest chain.

A link is a pair of an A and a B token that end together; the count of an id pair is how many links of the whole corpus
have it. Texts are packed into chunks, each chunk counts its own pairs first, and only distinct pairs of chunks go through
the shuffle, to be counted and, in a join, to get their counts back. So a pair that is everywhere is one row of each chunk,
and nothing is as long as the corpus. Chunks are written, compressed, so lost
executors repeat tasks, not encodings.

A long text is cut before single spaces between ASCII letters, where neither vocabulary has a token that goes on (its
pre-tokenizer starts a new word there, and no piece has a space behind another character), and its links go into as many
chunk rows as they need. Memory then follows ``CUT_BYTES``, but for texts without any such space.

Defined cases: null and empty texts, and texts whose bytes a tokenizer changes, have no tokens: zeros and an empty
``groups_sha256``. Strings of special tokens are plain text. Rows with a null or repeated id are rows like all others.
Extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagewise.llm.exchange import join_parts, pack, split_parts, unpack
from stagewise.llm.words import text_slices
from stagewise.session import settle, ship_package

# Text bytes of a chunk, of the part of a long text that is encoded at once, and links of a chunk row.
CHUNK_BYTES = 2_000_000
CUT_BYTES = 200_000
CHUNK_LINKS = 1_000_000
# Texts of so many bytes are aligned together.
ALIGN_BYTES = 300_000

# Latin letters end here.
STABLE = "\u0250"

_CUT = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every token id, one after another."""

    data: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), bounds)

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.bounds[ids + 1] - self.bounds[ids]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.data, self.bounds[ids], self.sizes(ids))


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``data[start:start + size]``, one after another."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return data[:0]
    return data[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]


def byte_of_letter() -> dict[str, int]:
    """Which byte a letter of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class PairEncoder:
    """Both tokenizers of a Python worker. The files are named by full paths."""

    def __init__(self, byte_file: str, piece_file: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.byte_file = byte_file
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        with open(byte_file, encoding="utf-8") as file:
            described = json.load(file)
        names, letters = described["model"]["vocab"], byte_of_letter()
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        tokens = {i: bytes(letters[c] for c in n) for n, i in names.items() if n not in special}
        self.plain = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={}
        )
        tokens |= {i: n.encode() for n, i in special.items()}
        self.a_bytes = Vocabulary.of([tokens.get(i, b"") for i in range(max(tokens) + 1)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = Vocabulary.of(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        )
        if max(len(tokens), len(pieces)) > 1 << 16:
            raise ValueError("id pairs are packed into 32 bits: vocabularies have at most 65,536 ids")
        # Cutting texts before spaces rests on this.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides for each text, or nothing for a text that is empty or whose bytes either side changes."""
        parts = [list(self.parts(raw)) if raw else [] for raw in raws]
        texts = [part.decode() for own in parts for part in own]
        sides_a = self.byte_level([" " + t for t in texts])
        sides_b = self.b.encode(texts, num_threads=1)
        found, at = [], 0
        for raw, own in zip(raws, parts, strict=True):
            a = np.array([i for ids in sides_a[at : at + len(own)] for i in ids], np.int64)
            b = np.array([i for ids in sides_b[at : at + len(own)] for i in ids], np.int64)
            at += len(own)
            want = np.frombuffer(b" " + raw, np.uint8)
            same = np.array_equal(self.a_bytes.joined(a), want) and np.array_equal(self.b_bytes.joined(b), want)
            found.append((a, b) if raw and same else None)
        return found

    def byte_level(self, texts: list[str]) -> list[list[int]]:
        """Ids of side A. Below ``STABLE`` all Unicode versions class characters alike, so the faster library may do it."""
        stable = [not t or max(t) < STABLE for t in texts]
        others = [t for t, plain in zip(texts, stable, strict=True) if not plain]
        found = iter(self.a.encode_batch_fast(others, add_special_tokens=False) if others else ())
        return [
            self.plain.encode_ordinary(t) if plain else next(found).ids for t, plain in zip(texts, stable, strict=True)
        ]

    @functools.cached_property
    def a(self):
        """The library's own encoder of side A, loaded only where it is needed."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are what runs side by side
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.byte_file)
        found.no_truncation()
        found.no_padding()
        found.encode_special_tokens = True
        return found

    def parts(self, raw: bytes) -> Iterator[bytes]:
        """A long text in parts, each without the space before it."""
        at = 0
        while self.cuttable and len(raw) - at > CUT_BYTES and (found := _CUT.search(raw, at + CUT_BYTES)):
            yield raw[at : found.start()]
            at = found.end()
        yield raw[at:]


@functools.lru_cache(maxsize=2)
def encoder(byte_file: str, piece_file: str) -> PairEncoder:
    return PairEncoder(byte_file, piece_file)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A and each B token the number of the A token that ends its group, by pointer jumping.

    Both cover the same bytes, and the last ones end together.
    """
    count = len(a_ends)
    over = np.searchsorted(b_ends, a_ends)  # the B token that holds an A token's last byte
    under = np.searchsorted(a_ends, b_ends)
    successor = np.concatenate(
        [np.where(b_ends[over] > a_ends, count + over, np.arange(count)), under]
    )
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor[:count], successor[count:]
        successor = further


@dataclass
class Aligned:
    """Groups and links of several texts; ``bounds`` are those of the links of each text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    links: np.ndarray
    bounds: np.ndarray


# Decimal ids with the character behind them, for writing many of them at once.
@functools.lru_cache(maxsize=1)
def _decimals() -> Vocabulary:
    return Vocabulary.of([b"%d" % i + mark for i in range(65_536) for mark in (b",", b"|", b";")])


def align(found: list[tuple[np.ndarray, np.ndarray] | None], vocabularies: tuple[Vocabulary, Vocabulary]) -> Aligned:
    """Align the tokens of several texts; texts without tokens have none."""
    pairs = [f for f in found if f is not None]
    n_a, n_b = (np.array([0 if f is None else len(f[k]) for f in found], np.int64) for k in (0, 1))
    none = [np.empty(0, np.int64)]
    a, b = (np.concatenate([*none, *(p[k] for p in pairs)]) for k in (0, 1))
    a_ends, b_ends = (np.cumsum(v.sizes(ids)) for v, ids in zip(vocabularies, (a, b), strict=True))
    a_label, b_label = group_labels(a_ends, b_ends) if len(a) else (a, b)
    last_a = np.flatnonzero(a_label == np.arange(len(a)))
    # The B token that ends with the group is the last one with its label.
    last_b = np.searchsorted(b_label, last_a, side="right") - 1
    a_bounds = np.concatenate([[0], np.cumsum(n_a)])
    bounds = np.searchsorted(last_a, a_bounds)
    # Where tokens go: those of A, then those of B, group by group.
    a_place = np.arange(len(a)) + np.searchsorted(b_label, a_label)
    b_place = np.arange(len(b)) + np.searchsorted(a_label, b_label, side="right")
    written = np.empty(len(a) + len(b), np.int64)
    written[a_place], written[b_place] = 3 * a, 3 * b
    written[a_place[last_a]] += 1
    written[b_place[last_b]] += 2
    decimals = _decimals()
    text = decimals.joined(written).tobytes()
    ends = np.concatenate([[0], np.cumsum(decimals.sizes(written))])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    # The mark behind the last group is left out.
    digests = [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(ends[:-1], ends[1:], strict=True)]
    return Aligned(n_a, n_b, np.diff(bounds), digests, (a[last_a] << 16) | b[last_b], bounds)


# A chunk row: its distinct id pairs, how many links have each, and, packed, its documents by a number of their row, with
# what is known of each, and the place of each link's pair among the distinct ones. A row that goes on with a text's links
# repeats its number with zeros.
_CHUNK = "chunk bigint, pairs array<int>, times array<int>, packed binary"
_CHUNK_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("pairs", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
        ("packed", pa.binary()),
    ]
)
_NUMBERS = ("rows", "ids", "n_a", "n_b", "n_groups", "bounds")
_RESULT = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def align_tokenizers(documents: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    chunks = aligned_chunks(documents, byte_file, piece_file)
    asked = chunks.select("chunk", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    asked = asked.select("chunk", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times"))
    counts = pair_counts(asked)
    answers = (
        asked.join(counts, "pair")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("pair", "count", "best")).alias("counts"))
    )
    told = chunks.select("chunk", "packed").join(answers, "chunk", "left")
    parts = told.mapInArrow(_totals, _RESULT)
    # Only a text with very many links has several rows; the others go through as they are.
    return (
        parts.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
            F.max("groups_sha256").alias("groups_sha256"),
        )
        .drop("row")
    )


def pair_counts(asked: DataFrame) -> DataFrame:
    """Every id pair with its links in the whole corpus, and whether no pair of its B id has more: pair, count, best."""
    counted = settle(asked.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    # Distinct pairs of one B id are no more than the ids of A.
    highest = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFF))))
    return settle(counted.select("pair", "count", (F.col("count") == highest).alias("best")), "best-pairs")


def aligned_chunks(documents: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Encode and align all texts, once: a written table of chunk rows."""
    ship_package(documents.sparkSession)
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, number = encoder(byte_file, piece_file), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), CHUNK_BYTES):
                part = batch.slice(first, end - first)
                for packed in _chunk_rows(tools, part.column("row").to_pylist(), part.column("doc_id").to_pylist(), data, offsets):
                    yield pa.RecordBatch.from_pydict({"chunk": [number], **{k: [v] for k, v in packed.items()}}, _CHUNK_ARROW)
                    number += 1

    return settle(rows.mapInArrow(run, _CHUNK), "aligned-chunks")


def _chunk_rows(
    tools: PairEncoder, rows: list[int], ids: list[int | None], data: np.ndarray, offsets: np.ndarray
) -> Iterator[dict]:
    """The rows of one chunk; texts are aligned some at a time."""
    raw, at = data.tobytes(), offsets.tolist()
    aligned, first = [], 0
    while first < len(rows):
        end = first + 1
        while end < len(rows) and at[end + 1] - at[first] <= ALIGN_BYTES:
            end += 1
        found = tools.encode([raw[at[i] : at[i + 1]] for i in range(first, end)])
        aligned.append(align(found, (tools.a_bytes, tools.b_bytes)))
        first = end
    known = {k: np.concatenate([getattr(x, k) for x in aligned]) for k in ("n_a", "n_b", "n_groups")}
    digests = [d for x in aligned for d in x.digests]
    links = np.concatenate([x.links for x in aligned]).astype(np.int64)
    counts = np.concatenate([np.diff(x.bounds) for x in aligned])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if len(links) <= CHUNK_LINKS:
        yield _packed(rows, ids, known, digests, bounds, links)
        return
    # Links beyond the limit go into further rows of the texts that have them.
    zero = {k: np.zeros(len(rows), np.int64) for k in known}
    for begin in range(0, len(links), CHUNK_LINKS):
        stop = min(begin + CHUNK_LINKS, len(links))
        cut = np.clip(bounds, begin, stop) - begin
        fresh = begin == 0
        held = np.arange(len(rows)) if fresh else np.flatnonzero(np.diff(cut))
        some = known if fresh else zero
        edges = np.concatenate([cut[held], [stop - begin]])
        yield _packed(
            [rows[h] for h in held],
            [ids[h] for h in held],
            {k: v[held] for k, v in some.items()},
            [digests[h] if fresh else "" for h in held],
            edges,
            links[begin:stop],
        )


def _packed(rows, ids, known: dict[str, np.ndarray], digests: list[str], bounds: np.ndarray, links: np.ndarray) -> dict:
    pairs, places, times = np.unique(links, return_inverse=True, return_counts=True)
    numbers = {"rows": np.array(rows), "ids": np.array([i or 0 for i in ids]), **known, "bounds": bounds}
    parts = [pack(numbers[n].astype(np.int64)) for n in _NUMBERS]
    parts += [pack(np.array([i is not None for i in ids], np.uint8)), "\n".join(digests).encode(), pack(places.astype(np.int32))]
    return {
        "pairs": pairs.astype(np.uint32).view(np.int32),
        "times": times.astype(np.int32),
        "packed": join_parts(parts),
    }


def unpacked(raw: bytes) -> dict:
    """What ``_packed`` has packed, by name."""
    *numbers, known, digests, links = split_parts(raw)
    found = {n: unpack(x, np.int64) for n, x in zip(_NUMBERS, numbers, strict=True)}
    return found | {
        "known": unpack(known, np.uint8).astype(bool),
        "digests": digests.decode().split("\n"),
        "links": unpack(links, np.int32),
    }


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for batch in batches:
        for packed, told in zip(batch.column("packed"), batch.column("counts"), strict=True):
            chunk = unpacked(packed.as_py())
            bounds, links = chunk["bounds"], chunk["links"]
            n_best = count_sum = np.zeros(len(bounds) - 1, np.int64)
            if len(links):
                pair, count, best = (told.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
                # In the order of the chunk's own pairs.
                order = np.argsort(pair.view(np.uint32))
                sums = [np.concatenate([[0], np.cumsum(x[order][links], dtype=np.int64)]) for x in (best, count)]
                n_best, count_sum = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk["rows"]),
                    pa.array(chunk["ids"], mask=~chunk["known"]),
                    *(pa.array(chunk[k]) for k in ("n_a", "n_b", "n_groups")),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(n_best, pa.int64()),
                    pa.array(count_sum, pa.int64()),
                    pa.array(chunk["digests"], pa.string()),
                ],
                names=names,
            )
