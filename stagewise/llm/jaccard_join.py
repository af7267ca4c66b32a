"""N-gram Jaccard join: documents whose sets of word shingles have at least a given Jaccard similarity, exactly.

A ``Rule`` has the words of a shingle and the least similarity in hundredths, t. Op7 takes three words and 0.9.

Universe-partition pigeonhole. If ``100 |x & y| >= t |x | y|``, the sets differ in at most
``(|x| + |y|) (100 - t) / (100 + t)`` shingles, at 0.9 a nineteenth of their sizes. A size band bounds that by some H for
all its pairs. Shingles are hashed into the segments of the band, and each segment is given 0, 1 (its subset is indexed as
it is) or 2 (its subset and all subsets with one shingle less are). If what the segments are given sums up to H + 1,
linked sets agree in the index of at least one segment: else every segment would differ in as much as it was given, more
than H in all. What a segment is given is decided by cost:

* A band has ``SPARE`` times as many segments as it needs. Each set gives 1 to those whose lists are shortest, as many as
  it needs, and 0 to the others, so frequent and empty subsets are not looked up. The order by the length of the list, then
  by the key, is the same for all sets; so of sets that agree in more segments than may be left out, both give 1 to one of
  those (as in prefix filtering).
* Where the number of documents makes fewer and larger segments with deletions cheaper, a band gives 2 to some of just as
  many segments as it needs, and no set leaves any out.

A set is indexed in its own band and, if a partner there can be smaller, in the band below.

From the index to components, without all pairs of a group:

1. Equal sets are one class, named by its smallest document.
2. Each signature's classes are paired with one of them, the pivot: the class with most shared signatures. All classes
   with one pivot are its family. Pairs of pivot and member are verified exactly. The links so far make components.
3. In families whose members are in several components, members of different components are paired.

Most of these pairs share long passages and are still far from linked, and families grow with the corpus. So before any
shingles are fetched for a pair, its sketches are compared. A sketch has one bit for each of some places: whether an odd
number of the shingles hash there. A shingle in which two sets differ changes one bit, so they differ in at least as many
shingles as their sketches do in bits, and no link is lost. Sketches are a small part of the sets, so families are dealt
into blocks, and each two blocks of a family meet once. Blocks of members that are connected with the pivot need not meet
each other. What the sketches leave is verified by intersecting the shingles.

So components are those of all links. Shingles are known by 64-bit hashes, a set by two sums of hashes.

Words are what white space separates, A-Z lower-cased; a shingle is so many words as the rule says, and a text of fewer
words has itself as its only shingle. Defined cases: null and empty texts have no shingles and link with nothing, nor do
rows with a null id (their component is null). Rows with equal ids are separate documents that share a name. Extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.components import connected_components
from stagewise.llm.exchange import (
    Chunk,
    Chunks,
    answered,
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
from stagewise.llm.words import gram_hashes, mix
from stagewise.session import settle

# Bands grow by this factor.
BAND_GROWTH = 1.5
# What a candidate pair costs, in index rows.
PAIR_COST = 50.0
# Segments of a band without deletions, as a multiple of those that have to be looked up.
SPARE = 1.5
# Bits of a sketch for each shingle: at least so many, less than twice as many but for the smallest sets.
SKETCH_BITS = 4
# Members in a block of a family: so many, in large families this times the root of their number ...
BLOCK_ROWS = 256
BLOCK_GROWTH = 16
# ... but no more than have about so many bytes of sketches.
BLOCK_BYTES = 8_000_000

_OTHER = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Rule:
    """Sets of shingles of ``words`` words link from a similarity of ``least`` hundredths on (1 to 99)."""

    words: int = 3
    least: int = 90

    def first_band(self) -> int:
        """Sets of fewer shingles link only if they are equal."""
        return -(-self.least // (100 - self.least))

    def reach(self, size: int) -> int:
        """The largest set that one of this size can link with."""
        return 100 * size // self.least

    def apart(self, sizes: int) -> int:
        """In how many shingles linked sets can differ whose sizes sum up to this."""
        return sizes * (100 - self.least) // (100 + self.least)

    def lookups(self, sizes: np.ndarray, band: Band) -> np.ndarray:
        """How many segments sets of these sizes have to look up: one more than a partner in the band can differ in."""
        largest = np.minimum(100 * sizes // self.least, band.reach)
        return (sizes + largest) * (100 - self.least) // (100 + self.least) + 1

    def similar(self, common, a, b):
        """Do two sets of sizes a and b with so many shingles in common link?"""
        return 100 * common >= self.least * (a + b - common)


OP7 = Rule()


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` to ``high`` shingles, with partners of up to ``reach``; the first ``double`` segments get 2."""

    number: int
    low: int
    high: int
    reach: int
    double: int
    segments: int


@dataclass
class Sets:
    """Sorted distinct shingles of each document of a chunk."""

    shingles: np.ndarray
    bounds: np.ndarray
    first: np.ndarray  # two sums of hashes name a set
    second: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def plan_bands(
    counts: dict[int, int], double_all: bool = False, rule: Rule = OP7, largest: int | None = None
) -> list[Band]:
    """Bands for all sizes up to ``largest`` (if not given, the largest in ``counts``: documents by the lower bound of
    their band)."""
    bands, low = [], rule.first_band()
    if largest is None:
        largest = max(counts, default=0)
    while low <= largest:
        high = math.ceil(low * BAND_GROWTH) - 1
        reach = rule.reach(high)
        need = rule.apart(high + reach) + 1
        rows = sum(n for at, n in counts.items() if low <= at <= reach)
        choices = {-(-need // 2)} if double_all else {0, need // 4, -(-need // 2)}
        best = min(choices, key=lambda double: _cost(low, need, double, rows))
        segments = best + max(0, need - 2 * best) if best else math.ceil(need * SPARE)
        bands.append(Band(len(bands), low, high, reach, best, segments))
        low = high + 1
    return bands


def _cost(low: int, need: int, double: int, rows: int) -> float:
    """Index rows, and pairs of unrelated sets that become candidates by what is empty in both."""
    segments = double + max(0, need - 2 * double) if double else math.ceil(need * SPARE)
    each = low * (1 + BAND_GROWTH) / 2 / segments
    empty = math.exp(-2 * min(each, 350.0))
    if double:
        return rows * (segments + double * each) + PAIR_COST * segments * empty * rows * rows / 2
    # Sets leave out their longest lists, so they have to agree in more segments than can be left out.
    share = (segments - need + 1) / segments
    chance = 1.0
    if share > empty:
        rest = (1 - share) * math.log((1 - share) / (1 - empty)) if share < 1 else 0.0
        chance = math.exp(-segments * (share * math.log(share / empty) + rest))
    return rows * segments + PAIR_COST * chance * rows * rows / 2


def sets_of(chunk: Chunk, shingle: int) -> Sets:
    words = chunk.words("spaced", True)
    counts = words.counts()
    hashes, inside = words.grams(shingle)
    owners = words.owners()[: len(hashes)][inside]
    shingles = [hashes[inside]]
    owned = [owners]
    for size in range(1, shingle):
        docs = np.flatnonzero(counts == size)
        if len(docs):
            at = words.bounds[docs]
            table = words.hashes[at[:, None] + np.arange(size)]
            shingles.append(np.array([gram_hashes(row, size)[0] for row in table], np.uint64))
            owned.append(docs)
    values, owners = np.concatenate(shingles), np.concatenate(owned)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[fresh], owners[fresh]
    bounds = np.searchsorted(owners, np.arange(len(chunk) + 1))
    return Sets(values, bounds, _sums(mix(values), owners, len(chunk)), _sums(mix(values ^ _OTHER), owners, len(chunk)))


def _sums(values: np.ndarray, owners: np.ndarray, size: int) -> np.ndarray:
    """Sums by owner, modulo 2**64. Owners are sorted."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    bounds = np.searchsorted(owners, np.arange(size + 1))
    return total[bounds[1:]] - total[bounds[:-1]]


def signatures(sets: Sets, bands: list[Band]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The index keys of all sets: (document, key, number of the band)."""
    sizes = sets.sizes()
    owners = np.repeat(np.arange(len(sizes)), sizes)
    documents, keys, numbers = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for band in bands:
        chosen = np.flatnonzero((sizes >= band.low) & (sizes <= band.reach))
        if not len(chosen):
            continue
        member = np.zeros(len(sizes), np.int64)
        member[chosen] = np.arange(1, len(chosen) + 1)
        place = member[owners]
        values, place = sets.shingles[place > 0], place[place > 0] - 1
        salt = mix(np.array([band.number + 1], np.uint64))[0]
        hashed = mix(values ^ salt)
        part = ((hashed >> np.uint64(32)) * np.uint64(band.segments) >> np.uint64(32)).astype(np.int64)
        cell = place * band.segments + part
        order = np.argsort(cell, kind="stable")
        cell, hashed = cell[order], mix(hashed[order])
        sums = _sums(hashed, cell, len(chosen) * band.segments)
        marks = mix(np.arange(band.segments, dtype=np.uint64) + salt)
        documents.append(np.repeat(chosen, band.segments))
        keys.append(mix(sums ^ np.tile(marks, len(chosen))))
        twice = cell % band.segments < band.double
        if twice.any():
            # Without one shingle the sum is less by its hash.
            documents.append(chosen[cell[twice] // band.segments])
            keys.append(mix((sums[cell[twice]] - hashed[twice]) ^ marks[cell[twice] % band.segments]))
        numbers.append(np.full(sum(map(len, keys)) - sum(map(len, numbers)), band.number))
    return np.concatenate(documents), np.concatenate(keys), np.concatenate(numbers)


def looked_up(
    owners: np.ndarray, keys: np.ndarray, numbers: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, bands: list[Band], rule: Rule
) -> np.ndarray:
    """Which keys a set looks up: in each band those with the shortest lists, as many as it needs."""
    order = np.lexsort((keys, lengths, numbers, owners))
    groups = owners[order] * (len(bands) + 1) + numbers[order]
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.empty(0, np.int64)
    ranks = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    need = np.full(len(order), np.iinfo(np.int64).max)
    for band in bands:
        if not band.double:
            mine = numbers[order] == band.number
            need[mine] = rule.lookups(sizes[owners[order][mine]], band)
    chosen = np.empty(len(order), bool)
    chosen[order] = ranks < need
    return chosen


def similar(common, a, b):
    """Do two sets of sizes a and b with so many shingles in common link?"""
    return OP7.similar(common, a, b)


def link_documents(documents: DataFrame, double_all: bool = False, rule: Rule = OP7) -> DataFrame:
    """A row for each document: doc_id, n_shingles and component_id. ``double_all`` gives 2 to all segments it can."""
    chunks = stage_chunks(documents)
    counts, largest = _size_counts(documents)
    bands = plan_bands(counts, double_all, rule, largest)
    buckets = chunks.buckets
    asked = messages(chunks, lambda c: _asked(c, bands, buckets, rule.words))
    answers = settle(answered(chunks, asked, _told_apart), "signature-counts")
    members = settle(
        each_told(
            told(chunks, answers),
            lambda chunk, got: _members(chunk, got, bands, rule),
            "slot int, chunk string, doc_id bigint, n_shingles bigint, node bigint, keys array<bigint>",
        ),
        "set-classes",
    )
    links = _class_links(chunks, members, rule)
    roots = connected_components(links.select("a", "b")).withColumnRenamed("root", "component")
    return members.join(roots, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id")
    )


def _size_counts(documents: DataFrame) -> tuple[dict[int, int], int]:
    """About how many documents have how many shingles, from their bytes, and a size that no set can exceed.

    Only the allocation depends on the counts. Words are a byte at least and have a byte between them, so a text of n
    bytes has at most (n + 1) / 2 words, and no more shingles than words.
    """
    words = F.octet_length("text") / 6
    step = F.floor(F.log(F.greatest(words, F.lit(1.0))) / math.log(BAND_GROWTH))
    top = F.max(F.octet_length("text")).alias("top")
    found = documents.groupBy(step.alias("step")).agg(F.count("*").alias("n"), top).collect()
    rows = [r for r in found if r["step"] is not None]
    largest = max((((r["top"] or 0) + 1) // 2 for r in rows), default=0)
    return {math.ceil(BAND_GROWTH ** r["step"]): r["n"] for r in rows}, largest


def _asked(chunk: Chunk, bands: list[Band], buckets: int, shingle: int) -> Iterator[tuple[int, bytes]]:
    """For each bucket: the sets' names with their smallest document, and the index keys with how many sets have them."""
    sets = sets_of(chunk, shingle)
    usable = chunk.known & (sets.sizes() > 0)
    parts: dict[int, list[bytes]] = {}

    def part(bucket: int) -> list[bytes]:
        return parts.setdefault(bucket, [pack(np.empty(0, np.uint64))] * 2 + [pack(np.empty(0, np.int64))] + [b""] * 2)

    docs = np.flatnonzero(usable)
    order = docs[np.lexsort((chunk.ids[docs], sets.second[docs], sets.first[docs]))]
    names = np.stack([sets.first[order], sets.second[order]], axis=1)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (names[1:] != names[:-1]).any(axis=1)
    names, lowest, order = names[fresh], chunk.ids[order][fresh], order[fresh]
    for bucket, a, b in by_bucket(names[:, 0], buckets):
        part(bucket)[:3] = [pack(names[a:b, 0]), pack(names[a:b, 1]), pack(lowest[a:b])]
    # Equal sets of the chunk have equal keys: only one of them asks.
    asks = np.zeros(len(chunk), bool)
    asks[order] = True
    distinct, counts = np.unique(_one_each(*signatures(sets, bands), asks)[1], return_counts=True)
    for bucket, a, b in by_bucket(distinct, buckets):
        part(bucket)[3:] = [pack(distinct[a:b]), pack(counts[a:b].astype(np.int32))]
    for bucket, found in parts.items():
        yield bucket, join_parts(found)


def _one_each(
    owners: np.ndarray, keys: np.ndarray, numbers: np.ndarray, asks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of the documents that ask, each once for its document."""
    mine = asks[owners]
    owners, keys, numbers = owners[mine], keys[mine], numbers[mine]
    order = np.lexsort((owners, keys))
    owners, keys, numbers = owners[order], keys[order], numbers[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return owners[fresh], keys[fresh], numbers[fresh]


def _told_apart(sent: list[bytes]) -> tuple[list[bytes], bytes]:
    """For each set the smallest document of all that have it; for each key, how many sets of chunks have it."""
    opened = [split_parts(m) for m in sent]
    first, second = (np.concatenate([unpack(p[k], np.uint64) for p in opened]) for k in (0, 1))
    lowest = np.concatenate([unpack(p[2], np.int64) for p in opened])
    order = np.lexsort((lowest, second, first))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    named = np.empty(len(order), np.int64)
    named[order] = lowest[order][fresh][np.cumsum(fresh) - 1] if len(order) else lowest
    keys = [unpack(p[3], np.uint64) if p[3] else np.empty(0, np.uint64) for p in opened]
    held = [unpack(p[4], np.int32) if p[4] else np.empty(0, np.int32) for p in opened]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    lengths = np.bincount(place, np.concatenate(held), len(distinct))
    lengths = np.minimum(lengths, np.iinfo(np.int32).max).astype(np.int32)
    replies, at, key_at = [], 0, 0
    for parts, own in zip(opened, keys, strict=True):
        size = len(unpack(parts[2], np.int64))
        own_lengths = lengths[place[key_at : key_at + len(own)]]
        replies.append(join_parts([pack(named[at : at + size]), pack(own_lengths)]))
        at, key_at = at + size, key_at + len(own)
    return replies, b""


_MEMBERS = pa.schema(
    [
        ("slot", pa.int32()),
        ("chunk", pa.string()),
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("node", pa.int64()),
        ("keys", pa.list_(pa.int64())),
    ]
)


def _members(chunk: Chunk, got: dict[int, bytes], bands: list[Band], rule: Rule) -> pa.RecordBatch:
    """Every document with its class, and one document of each class with the keys that it looks up and others have."""
    sets = sets_of(chunk, rule.words)
    usable = chunk.known & (sets.sizes() > 0)
    opened = [split_parts(got[b]) for b in sorted(got)]
    none = [np.empty(0, np.int64)]
    named = np.concatenate([*none, *(unpack(p[0], np.int64) for p in opened)])
    lengths = np.concatenate([np.empty(0, np.int32), *(unpack(p[1], np.int32) for p in opened)])
    docs = np.flatnonzero(usable)
    order = docs[np.lexsort((chunk.ids[docs], sets.second[docs], sets.first[docs]))]
    names = np.stack([sets.first[order], sets.second[order]], axis=1)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (names[1:] != names[:-1]).any(axis=1)
    nodes = np.where(chunk.known, chunk.ids, 0)
    if len(order):
        nodes[order] = named[np.cumsum(fresh) - 1]
    asks = np.zeros(len(chunk), bool)
    asks[order[fresh]] = True
    owners, keys, numbers = _one_each(*signatures(sets, bands), asks)
    lengths = lengths[np.unique(keys, return_inverse=True)[1]]
    chosen = looked_up(owners, keys, numbers, lengths, sets.sizes(), bands, rule)
    # Only the class's own document hands its keys on.
    mine = chosen & (lengths > 1) & (nodes == chunk.ids)[owners]
    owners, keys = owners[mine], keys[mine]
    order = np.argsort(owners, kind="stable")
    ends = np.searchsorted(owners[order], np.arange(len(chunk) + 1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk.slot] * len(chunk), pa.int32()),
            pa.array([chunk.name] * len(chunk), pa.string()),
            pa.array(chunk.ids, pa.int64(), mask=~chunk.known),
            pa.array(sets.sizes(), pa.int64()),
            pa.array(nodes, pa.int64(), mask=~chunk.known),
            pa.ListArray.from_arrays(ends.astype(np.int32), keys[order].view(np.int64)),
        ],
        schema=_MEMBERS,
    )


def _class_links(chunks: Chunks, members: DataFrame, rule: Rule) -> DataFrame:
    """Links between classes that connect all that are linked: a and b."""
    keyed = members.where(F.size("keys") > 0).select(
        "node", F.size("keys").alias("shared"), F.col("n_shingles").alias("n"), F.explode("keys").alias("key")
    )
    # The pivot has most shared keys; of those with as many, it is the smallest.
    groups = (
        keyed.groupBy("key")
        .agg(
            F.max(F.struct("shared", (-F.col("node")).alias("low"))).alias("top"),
            F.min("node").alias("least"),
            F.max("node").alias("most"),
        )
        .where(F.col("least") != F.col("most"))
        .select("key", (-F.col("top.low")).alias("pivot"))
    )
    families = (
        keyed.join(groups, "key").where(F.col("node") != F.col("pivot")).select("pivot", "node").distinct()
    )
    families = settle(families, "families")
    sets = _candidate_sets(chunks, members, families, rule.words)
    links = settle(_verified(_pivot_pairs(families, sets, rule), sets, rule), "pivot-links")
    pairs = settle(_family_pairs(families, sets, connected_components(links), rule), "member-pairs")
    return links.unionAll(_verified(pairs, sets, rule))


def _pivot_pairs(families: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of a pivot and a member, a and b, but for those that by their sketches do not link."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot_n, node_n = (batch.column(c).to_numpy() for c in ("pivot_n", "node_n"))
            sketches = zip(batch.column("pivot_sketch").to_pylist(), batch.column("node_sketch").to_pylist(), strict=True)
            apart = np.array([sketches_apart(x, y) for x, y in sketches], np.int64)
            ends = batch.select(["pivot", "node"]).rename_columns(["a", "b"])
            yield ends.filter(pa.array(apart <= rule.apart(pivot_n + node_n)))

    both = families.join(side("node"), "node").join(side("pivot"), "pivot")
    columns = ("pivot", "pivot_n", "pivot_sketch", "node", "node_n", "node_sketch")
    return both.select(*columns).mapInArrow(run, "a bigint, b bigint")


def _family_pairs(families: DataFrame, sets: DataFrame, roots: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of members of one family, a and b, in different components so far, but for those that do not link by their
    sketches.

    Members in the pivot's component are at home. They have blocks of their own, which meet the others' blocks only.
    """
    around = roots.select(F.col("node").alias("pivot"), F.col("root").alias("home"))
    root = F.coalesce("root", "node")
    placed = families.join(roots, "node", "left").join(around, "pivot", "left").select(
        "pivot", "node", root.alias("root"), (root == F.coalesce("home", "pivot")).alias("at_home")
    )
    placed = settle(placed.join(sets.select("node", "n"), "node"), "placed-members")
    rows = F.greatest(F.lit(float(BLOCK_ROWS)), BLOCK_GROWTH * F.sqrt(F.count("*")))
    rows = F.greatest(F.least(rows, BLOCK_BYTES / F.avg("n")), F.lit(1.0))
    others = F.sum((~F.col("at_home")).cast("long"))
    torn = (
        placed.groupBy("pivot")
        .agg(
            F.ceil(others / rows).cast("int").alias("others"),
            F.ceil((F.count("*") - others) / rows).cast("int").alias("homes"),
            F.min("root").alias("x"),
            F.max("root").alias("y"),
        )
        .where(F.col("x") != F.col("y"))
        .select("pivot", "others", "homes")
    )
    dealt = F.xxhash64("node")
    own = F.when(F.col("at_home"), F.col("others") + F.pmod(dealt, "homes")).otherwise(F.pmod(dealt, "others")).cast("int")
    last = F.when(F.col("at_home"), F.col("others")).otherwise(F.col("others") + F.col("homes")) - 1
    dealt = placed.join(torn, "pivot").select("pivot", "node", "root", own.alias("block"), last.alias("last"))
    meeting = dealt.join(sets.select("node", "n", "sketch"), "node").select(
        "pivot",
        F.struct("node", "n", "root", "block", "sketch").alias("member"),
        "block",
        F.explode(F.sequence(F.lit(0), "last")).alias("other"),
    )
    met = meeting.groupBy("pivot", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")).agg(
        F.collect_list("member").alias("members")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            ends, members, apart = lists.offsets.to_numpy(), lists.values, batch.column("same").to_numpy(zero_copy_only=False)
            nodes, sizes, found, blocks = (
                members.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "root", "block")
            )
            for at in range(len(lists)):
                own = slice(ends[at], ends[at + 1])
                sketches = members.field("sketch").slice(ends[at], ends[at + 1] - ends[at]).to_pylist()
                sides = np.arange(len(sketches)) if apart[at] else blocks[own]
                x, y = near_pairs(sizes[own], sketches, found[own], sides, rule)
                ab = np.sort([nodes[own][x], nodes[own][y]], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(ab[0], pa.int64()), pa.array(ab[1], pa.int64())], names=["a", "b"])

    return met.select((F.col("x") == F.col("y")).alias("same"), "members").mapInArrow(run, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs a and b that link."""
    both = pairs
    for name in ("a", "b"):
        both = both.join(sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set")), name)
    common, a, b = (F.size(c).cast("long") for c in (F.array_intersect("a_set", "b_set"), F.col("a_set"), F.col("b_set")))
    return both.where(rule.similar(common, a, b)).select("a", "b")


def sketch(shingles: np.ndarray) -> bytes:
    """For each of some places whether an odd number of the shingles hash there, as bits."""
    size = 64
    while size < SKETCH_BITS * len(shingles):
        size *= 2
    places = (mix(shingles ^ _OTHER) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, a row of 64-bit words each, as they would be with so many words."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)


def sketches_apart(x: bytes, y: bytes) -> int:
    """A number of shingles in which two sets differ at least."""
    x, y = (np.frombuffer(s, np.uint64)[None] for s in (x, y))
    width = min(x.shape[1], y.shape[1])
    return int(np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum())


def near_pairs(
    sizes: np.ndarray, sketches: list[bytes], roots: np.ndarray, sides: np.ndarray, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of sets with different roots and different sides that may link by their sizes and sketches."""
    order = np.argsort(sizes, kind="stable")
    sizes, roots, sides = sizes[order], roots[order], sides[order]
    widths = np.array([len(sketches[k]) // 8 for k in order.tolist()], np.int64)
    ends = np.searchsorted(sizes, rule.reach(sizes), "right")
    pairs = [np.empty((2, 0), np.int64)]
    for width in np.unique(widths).tolist():
        first, last = np.searchsorted(widths, [width, width + 1]).tolist()
        # Larger sets have sketches of as many words or a multiple.
        rows = np.empty((ends[last - 1] - first, width), np.uint64)
        for wide in np.unique(widths[first : ends[last - 1]]).tolist():
            own = np.flatnonzero(widths[first : ends[last - 1]] == wide)
            raw = b"".join([sketches[k] for k in order[first + own].tolist()])
            rows[own] = _folded(np.frombuffer(raw, np.uint64).reshape(len(own), wide), width)
        for a in range(first, last):
            near = np.arange(a + 1, ends[a])
            near = near[(roots[near] != roots[a]) & (sides[near] != sides[a])]
            apart = np.bitwise_count(rows[near - first] ^ rows[a - first]).sum(axis=1, dtype=np.int64)
            near = near[apart <= rule.apart(sizes[near] + sizes[a])]
            pairs.append(np.stack([np.full(len(near), a), near]))
    return tuple(order[np.concatenate(pairs, axis=1)])


def _candidate_sets(chunks: Chunks, members: DataFrame, families: DataFrame, shingle: int) -> DataFrame:
    """The sets of all pivots and members, made from their chunks: node, n (the size), sketch and shingles."""
    named = families.select("node").unionAll(families.select("pivot")).distinct()
    wanted = (
        members.where(F.size("keys") > 0)
        .join(named, "node", "left_semi")
        .groupBy("slot", "chunk")
        .agg(F.collect_set("node").alias("nodes"))
        .select(
            F.lit(0).alias("bucket"),
            "slot",
            "chunk",
            F.encode(F.array_join(F.col("nodes").cast("array<string>"), ","), "UTF-8").alias("answer"),
        )
    )
    sets = each_told(
        told(chunks, wanted),
        lambda chunk, got: _sets_of_nodes(chunk, got, shingle),
        "node bigint, n bigint, sketch binary, shingles array<bigint>",
    )
    return settle(sets, "candidate-sets")


def _sets_of_nodes(chunk: Chunk, got: dict[int, bytes], shingle: int) -> pa.RecordBatch:
    nodes, lists = [], []
    if got:
        wanted = np.array([int(x) for x in got[0].split(b",")], np.int64)
        docs = np.flatnonzero(chunk.known & np.isin(chunk.ids, wanted))
        # Only the wanted texts are cut into words again.
        lengths = (chunk.offsets[1:] - chunk.offsets[:-1])[docs]
        parts = [chunk.data[chunk.offsets[d] : chunk.offsets[d + 1]] for d in docs.tolist()]
        few = Chunk(
            chunk.slot,
            chunk.name,
            chunk.ids[docs],
            chunk.known[docs],
            np.concatenate([np.empty(0, np.uint8), *parts]),
            np.concatenate([[0], np.cumsum(lengths)]),
        )
        sets = sets_of(few, shingle)
        nodes = few.ids
        lists = [sets.shingles[a:b] for a, b in zip(sets.bounds[:-1], sets.bounds[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(nodes, pa.int64()),
            pa.array([len(x) for x in lists], pa.int64()),
            pa.array([sketch(x) for x in lists], pa.binary()),
            pa.array([x.view(np.int64) for x in lists], pa.list_(pa.int64())),
        ],
        names=["node", "n", "sketch", "shingles"],
    )
