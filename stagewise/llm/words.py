"""Words of many texts at once: their byte spans and 64-bit hashes, found with whole-array operations.

Texts are UTF-8. Only ASCII bytes separate words, so a word never ends inside a character. Equal words have equal
hashes; two different words share one with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000

_MIX_1, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S29, _S32 = np.uint64(29), np.uint64(32)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)

_ALL = np.arange(256)
_UPPER = (_ALL >= 0x41) & (_ALL <= 0x5A)
_LOWERED = np.where(_UPPER, _ALL + 32, _ALL).astype(np.uint8)
_SPACES = (_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D))
_LETTERS = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80) | _UPPER

# What a word is made of: anything but white space, or digits, letters and all characters beyond ASCII.
KINDS = {"spaced": ~_SPACES, "letters": _LETTERS}


@dataclass
class Words:
    """Words of the texts of one slice. ``bounds[i]:bounds[i+1]`` are the words of text i."""

    data: np.ndarray  # bytes, lower-cased if asked for
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n consecutive words, and for each place whether they are of one text."""
        if len(self) < n:
            return np.empty(0, np.uint64), np.empty(0, bool)
        room = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self))
        return gram_hashes(self.hashes, n), (room >= n)[: len(self) - n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S32)) * _MIX_1
    x = (x ^ (x >> _S29)) * _MIX_2
    return x ^ (x >> _S32)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n neighbours of an array of hashes."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    if n == 1:
        return mix(hashes + _MIX_2)
    total = np.zeros(size, np.uint64)
    factor = 0x9E3779B97F4A7C15
    for i in range(n):
        total += hashes[i : i + size] * np.uint64(factor)
        factor = (factor * 0xD1342543DE82EF95 + 2) % 2**64 | 1
    return mix(total)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash the byte spans of ``data``, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data) + 1, 8), (1, 1))
    lengths = ends - starts
    hashes = lengths.astype(np.uint64) * _MIX_1
    alive, at, left = None, starts, lengths
    while len(at):
        block = np.ascontiguousarray(eights[at]).view(np.uint64).ravel() & _KEEP[np.minimum(left, 8)]
        if alive is None:
            hashes = mix(hashes ^ block)
        else:
            hashes[alive] = mix(hashes[alive] ^ block)
        more = np.flatnonzero(left > 8)
        alive = more if alive is None else alive[more]
        at, left = at[more] + 8, left[more] - 8
    return hashes


def split_words(data: np.ndarray, offsets: np.ndarray, kind: str, lower: bool) -> Words:
    """The words of the texts ``data[offsets[i]:offsets[i+1]]``."""
    inside = KINDS[kind][data]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[:-1] = inside
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    opens[first] = inside[first]
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if lower:
        data = _LOWERED[data]
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hash_words(data, starts, ends))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with their bytes and offsets: (first row, end row, bytes, offsets from 0). Null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    rows = len(texts)
    if not rows:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + rows + 1]
    raw = buffers[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    row = 0
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        lo, hi = int(offsets[row]), int(offsets[end])
        yield row, end, data[lo:hi], offsets[row : end + 1] - lo
        row = end


def word_slices(texts: pa.Array, kind: str, lower: bool, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Runs of rows with the words of their texts."""
    for row, end, data, offsets in text_slices(texts, limit):
        yield row, end, split_words(data, offsets, kind, lower)


class HashSet:
    """Membership of many hashes in a fixed set: a bitmap turns most away before the search."""

    def __init__(self, members: np.ndarray):
        self.members = np.unique(members)
        self.bits = max(16, int(len(self.members) * 16).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._slot(self.members)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``hashes`` that are members, and their numbers among the sorted members."""
        if not len(self.members):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        places = np.flatnonzero(self.seen[self._slot(hashes)])
        found = hashes[places]
        numbers = np.searchsorted(self.members, found)
        numbers[numbers == len(self.members)] = 0
        same = self.members[numbers] == found
        return places[same], numbers[same]
