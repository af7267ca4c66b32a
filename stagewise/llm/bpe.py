"""Byte-pair encoding and decoding with a public tokenizer file, merging through an index of pair occurrences.

The distinct words of a run of texts are laid out as one linked list of symbols. An index maps each pair of neighbours
that has a merge to all its positions. Ranks that occur are taken in ascending order; each merges its positions from
left to right and adds the pairs that arise to the index. So a rank is looked up once for all words, and a word is
merged once however often it occurs.

The file must describe a BPE model whose words end with a suffix and are spelled in byte-level symbols. Ids are those of
``Tokenizer.encode(text, add_special_tokens=False).ids``; decoding is ``decode(ids, skip_special_tokens=False)`` of a file
without a decoder: the tokens, joined by spaces.

Defined cases: a null or empty text, and one of white space only, has no ids and decodes to an empty text. Null ids
decode to an empty text. Rows are encoded one by one, so repeated rows and null ids of documents need nothing. Columns
of the input named like an output are replaced, all others stay.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm.words import text_slices
from stagewise.session import ship_package

# Distinct words whose ids one Python worker remembers.
MAX_WORDS = 300_000

# Texts made of these code points only are split by a plain pattern; all others by the library's own splitter.
_PLAIN_END = 0x250


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, free = [], 256
    for byte in range(256):
        symbols.append(chr(byte if byte in own else free))
        free += byte not in own
    return symbols


class PairMerger:
    """Encodes words given as byte strings."""

    def __init__(self, vocab: dict[str, int], merges: Iterable, suffix: str):
        symbols = _byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + suffix] for s in symbols]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        self.pairs: list[tuple[int, int]] = []
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = (vocab[left], vocab[right])
            self.ranks.setdefault(key, (rank, vocab[left + right]))
            self.pairs.append(key)
        made = {new: rank for rank, new in reversed(self.ranks.values())}
        for (left, right), (rank, _) in self.ranks.items():
            if made.get(left, -1) > rank or made.get(right, -1) > rank:
                raise ValueError("a merge comes before the merge that makes its part")

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        symbols: list[int] = []
        heads: list[int] = []
        for word in words:
            heads.append(len(symbols))
            symbols += [self.inner[b] for b in word[:-1]]
            symbols.append(self.final[word[-1]])
            symbols.append(-1)  # a gap that no pair crosses
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        ranks, index = self.ranks, {}
        for at in range(len(symbols) - 1):
            pair = (symbols[at], symbols[at + 1])
            if pair in ranks:
                index.setdefault(pair, []).append(at)
        active = [ranks[pair][0] for pair in index]
        active.sort()
        while active:
            pair = self.pairs[heappop(active)]
            places = index.pop(pair)
            places.sort()
            left, right = pair
            new = ranks[pair][1]
            for at in places:
                other = after[at]
                if symbols[at] != left or symbols[other] != right:
                    continue  # a merge to the left has taken one of the two
                beyond = after[other]
                symbols[at], symbols[other] = new, -2
                after[at], before[beyond] = beyond, at
                for place, arisen in ((before[at], (symbols[before[at]], new)), (at, (new, symbols[beyond]))):
                    rank = ranks.get(arisen)
                    if rank is not None:
                        if arisen not in index:
                            index[arisen] = []
                            heappush(active, rank[0])
                        index[arisen].append(place)
        encoded = []
        for at in heads:
            ids = []
            while symbols[at] != -1:
                ids.append(symbols[at])
                at = after[at]
            encoded.append(ids)
        return encoded


class Codec:
    """A tokenizer file, opened once in each Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec.get("decoder"):
            raise ValueError("the file must hold a BPE model with word ends and no decoder")
        self.library = Tokenizer.from_file(path)
        self.merger = PairMerger(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.tokens = {i: t for t, i in model["vocab"].items()}
        self.ids_of: dict[str, str] = {}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must stand for themselves")
        self.tokens |= {i: t for t, i in self.special.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.plain, self.odd = _plain_patterns()
        self.from_symbol = {s: b for b, s in enumerate(_byte_symbols())}

    def pieces(self, text: str) -> list[str]:
        """The words of a text and its added tokens, in order."""
        if self.cut and "<" in text:
            parts = self.cut.split(text)
            if len(parts) > 1:
                return [p for k, part in enumerate(parts) for p in ([part] if k % 2 else self._words(part))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if not self.odd.search(text):
            return self.plain.findall(text.lower())
        # The library's own normaliser and splitter; it spells bytes as symbols, which are turned back here.
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        split = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.from_symbol[c] for c in word).decode("utf-8") for word, _ in split]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        lists = [self.pieces(t) for t in texts]
        if len(self.ids_of) > MAX_WORDS:
            self.ids_of.clear()
        self.ids_of.update((t, str(i)) for t, i in self.special.items())
        fresh = list(set().union(*lists).difference(self.ids_of))
        for word, ids in zip(fresh, self.merger.encode([w.encode("utf-8") for w in fresh]), strict=True):
            self.ids_of[word] = " ".join(map(str, ids))
        for pieces in lists:
            yield np.fromstring(" ".join([self.ids_of[p] for p in pieces]), dtype=np.int32, sep=" ")

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


def _plain_patterns() -> tuple[re.Pattern, re.Pattern]:
    """How plain texts are split, and what makes a text not plain.

    Fixed values, the splitting rule of the tokenizer file: contractions, runs of letters, single numerals, runs of
    anything else.
    """
    kinds: dict[str, list[str]] = {"L": [], "N": [], "other": []}
    plain = []
    for code in range(_PLAIN_END):
        char = chr(code)
        kind = unicodedata.category(char)
        if char.isspace() or kind in ("Cc", "Zs", "Cn"):
            continue
        plain.append(char)
    # Texts are split after lower-casing, which leaves this range for some letters.
    for char in sorted(set("".join([*plain, *map(str.lower, plain)]))):
        kind = unicodedata.category(char)[0]
        kinds[kind if kind in "LN" else "other"].append(char)
    sets = {k: "".join(map(re.escape, v)) for k, v in kinds.items()}
    words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{sets['L']}]+|[{sets['N']}]|[{sets['other']}]+")
    return words, re.compile(f"[^ \t\n\r{''.join(map(re.escape, plain))}]")


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


def encode_texts(documents: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows of ``documents`` with the ids of a text column. ``path`` must be readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(text)):
                raw = data.tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                lists = list(codec.encode(texts))
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                column = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *lists]))
                yield _with_column(batch.slice(first, end - first), ids, column)

    return _map_rows(documents, run, ids, T.ArrayType(T.IntegerType()))


def decode_ids(documents: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows of ``documents`` with the text that an id column stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for first in range(0, max(1, batch.num_rows), 500):
                part = batch.slice(first, 500)
                texts = [codec.decode(x.tolist() if x is not None else ()) for x in _id_lists(part.column(ids))]
                yield _with_column(part, decoded, pa.array(texts, pa.string()))

    return _map_rows(documents, run, decoded, T.StringType())


def encode_and_decode(
    documents: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """The rows of ``documents`` with the ids of their text, and what these stand for, in the place of the text.

    One pass, so that a task needs one Python worker with the vocabulary, not two.
    """
    kept = [f for f in documents.schema.fields if f.name not in (text, ids, decoded)]
    names = [f.name for f in kept]
    made = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(text)):
                raw = data.tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                lists = list(codec.encode(texts))
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                column = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *lists]))
                back = pa.array([codec.decode(x.tolist()) for x in lists], pa.string())
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column, back], names=[*names, ids, decoded])

    ship_package(documents.sparkSession)
    return documents.mapInArrow(run, T.StructType([*kept, *made]))


def _id_lists(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    for value in column:
        yield value.values.to_numpy(zero_copy_only=False) if value.is_valid else None


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != name]
    return pa.RecordBatch.from_arrays([*(c for _, c in kept), column], names=[*(n for n, _ in kept), name])


def _map_rows(documents: DataFrame, run, name: str, kind: T.DataType) -> DataFrame:
    ship_package(documents.sparkSession)
    kept = [f for f in documents.schema.fields if f.name != name]
    return documents.mapInArrow(run, T.StructType([*kept, T.StructField(name, kind)]))


def public_file(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def joined_digest(ids: str) -> Column:
    """The SHA-256 of the decimal ids, joined by a space."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
