"""Embedding near-dedup by an epsilon grid order join: vectors of a label with a cosine of at least a threshold.

For unit vectors a cosine of t is a distance of ``sqrt(2 - 2 t)``, here called epsilon. Vectors are sorted by the grid
cells of width epsilon that their leading principal components fall into, and the sorted sequence is cut into blocks.
Pairs of blocks whose boxes of components are further apart than epsilon cannot hold a link and are left out; within the
others, intervals of the sequences are halved and compared in the same way, until small intervals are compared vector by
vector in double precision. Principal components are fitted on a sample of at most ``SAMPLE_ROWS`` vectors; they only
steer what is skipped, as a projection never lengthens a distance, so no link is lost.

Equal vectors of a label are one class before the join, so a vector that a third of all rows have is compared once.
Block pairs return sums and spanning links, never all pairs.

Defined cases: rows with a null id, a null label, or a vector that is null, empty, all zero or holds null or non-finite
numbers link with nothing. Vectors of different lengths do not link. Rows with the same id are separate vectors. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.components import connected_components
from stagewise.session import settle, ship_package

THRESHOLD = 0.98
SAMPLE_ROWS = 20_000
DIMENSIONS = 6
BLOCK = 1024
LEAF = 128

_VECTORS = "label int, dims int, node bigint, weight bigint, vector array<double>, cells array<int>, spots array<double>"


def link_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each vector: vec_id, n_links, component_id (the smallest id that links reach) and kept."""
    spark = embeddings.sparkSession
    ship_package(spark)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    values = F.col("embedding").cast("array<double>")
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("label").cast("int").alias("label"), values.alias("vector")
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & ~F.coalesce(odd, F.lit(True))
        & F.exists("vector", lambda x: x != 0)
    )
    marked = rows.select("vec_id", "label", F.when(usable, F.col("vector")).alias("vector")).select(
        "*",
        F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")).alias("node"),
        F.when(F.col("vector").isNotNull(), F.xxhash64("vector", F.lit("second"), "label")).alias("check"),
    )
    classes = settle(
        marked.where(F.col("node").isNotNull())
        .groupBy("node", "check")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.count("*").alias("weight"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        ),
        "vector-classes",
    )
    found = settle(_links(classes, epsilon, threshold), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(links, "node", "left").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    known = settle(
        known.select("node", "check", "first_id", "root", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n")),
        "linked-classes",
    )
    lowest = known.groupBy("root").agg(F.min("first_id").alias("lowest"))
    by_class = known.join(lowest, "root").select("node", "check", "n", "lowest")
    component = F.coalesce("lowest", "vec_id")
    return (
        marked.select("vec_id", "node", "check")
        .join(by_class, ["node", "check"], "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )


def _links(classes: DataFrame, epsilon: float, threshold: float) -> DataFrame:
    """Spanning links and linked weights of the classes: node, links, root."""
    bases = _principal_axes(classes)
    spots = classes.select("label", F.size("vector").alias("dims"), "node", "weight", "vector").mapInArrow(
        lambda batches: _placed(batches, bases, epsilon), _VECTORS
    )
    order = ["label", "dims", *[F.col("cells")[i] for i in range(DIMENSIONS)], "node"]
    blocks = settle(
        spots.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _cut_blocks,
            "block string, label int, dims int, low array<double>, high array<double>, nodes binary, weights binary, "
            "vectors binary, spots binary",
        ),
        "vector-blocks",
    )

    def cells(side: str, wider: int) -> DataFrame:
        """The blocks of one side, once for each cell of the first two components that they may meet in."""

        def span(i: int):
            return F.sequence(
                F.floor(F.col("low")[i] / epsilon).cast("int") - wider,
                F.floor(F.col("high")[i] / epsilon).cast("int") + wider,
            )

        rows = blocks.select("block", "label", "dims", "low", "high", F.explode(span(0)).alias("x"))
        rows = rows.select("block", "label", "dims", "low", "high", "x", F.explode(span(1)).alias("y"))
        return rows.select("label", "dims", "x", "y", *[F.col(c).alias(f"{side}_{c}") for c in ("block", "low", "high")])

    def gap(i: int):
        return F.greatest(
            F.lit(0.0), F.col("a_low")[i] - F.col("b_high")[i], F.col("b_low")[i] - F.col("a_high")[i]
        )

    near = sum((gap(i) * gap(i) for i in range(1, DIMENSIONS)), gap(0) * gap(0)) <= epsilon**2
    # Rows of this join are blocks, not vectors.
    pairs = (
        cells("a", 0)
        .join(cells("b", 1), ["label", "dims", "x", "y"])
        .where((F.col("a_block") <= F.col("b_block")) & near)
        .select("a_block", "b_block")
        .distinct()
    )
    mirrored = (
        cells("a", 1)
        .join(cells("b", 0), ["label", "dims", "x", "y"])
        .where((F.col("a_block") < F.col("b_block")) & near)
        .select("a_block", "b_block")
        .distinct()
    )
    chosen = settle(pairs.unionAll(mirrored).distinct(), "block-pairs")
    content = ["dims", "nodes", "weights", "vectors", "spots"]

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(f"{name}_block"), *[F.col(c).alias(f"{name}_{c}") for c in content])

    joined = chosen.join(side("a"), "a_block").join(side("b"), "b_block")
    return joined.mapInArrow(
        lambda batches: _join_blocks(batches, epsilon, threshold), "node bigint, links bigint, root bigint"
    )


def _principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions of unit vectors, by length, from a sample chosen by hash."""
    sample = classes.select("vector", "node").orderBy("node").limit(SAMPLE_ROWS).select("vector").toArrow()
    by_length: dict[int, list] = {}
    for vector in sample.column(0).to_pylist():
        by_length.setdefault(len(vector), []).append(vector)
    bases = {}
    for length, vectors in by_length.items():
        unit = _unit(np.array(vectors, float))
        _, axes = np.linalg.eigh(np.cov(unit.T).reshape(length, length) if len(unit) > 1 else np.eye(length))
        bases[length] = axes[:, ::-1][:, :DIMENSIONS]
    return bases


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling by the largest number first keeps squares of huge and tiny numbers in range.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _placed(batches: Iterator[pa.RecordBatch], bases: dict[int, np.ndarray], epsilon: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column(1).to_numpy()
        for length in np.unique(lengths):
            part = batch.filter(pa.array(lengths == length))
            unit = _unit(part.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, length))
            spots = np.zeros((len(unit), DIMENSIONS))
            axes = bases.get(int(length), np.zeros((length, 0)))
            spots[:, : axes.shape[1]] = unit @ axes
            cells = np.floor(spots / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(list(cells), pa.list_(pa.int32())), pa.array(list(spots), pa.list_(pa.float64()))],
                names=["label", "dims", "node", "weight", "vector", "cells", "spots"],
            )


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most BLOCK vectors of one label and length."""
    for batch in batches:
        label, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        heads = np.flatnonzero((np.diff(label, prepend=label[:1] - 1) != 0) | (np.diff(dims, prepend=0) != 0))
        for head, tail in zip(heads, [*heads[1:], len(label)], strict=True):
            for first in range(head, tail, BLOCK):
                part = batch.slice(first, min(BLOCK, tail - first))
                nodes = part.column(2).to_numpy()
                spots = part.column(6).flatten().to_numpy().reshape(-1, DIMENSIONS)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [f"{label[first]}/{dims[first]}/{nodes.min()}/{nodes[0]}"],
                        "label": pa.array([label[first]], pa.int32()),
                        "dims": pa.array([dims[first]], pa.int32()),
                        "low": [spots.min(axis=0)],
                        "high": [spots.max(axis=0)],
                        "nodes": [nodes.tobytes()],
                        "weights": [part.column(3).to_numpy().tobytes()],
                        "vectors": [part.column(4).flatten().to_numpy(zero_copy_only=False).tobytes()],
                        "spots": [np.ascontiguousarray(spots).tobytes()],
                    }
                )


def _join_blocks(batches: Iterator[pa.RecordBatch], epsilon: float, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            sides = []
            for name in "ab":
                nodes = np.frombuffer(row[f"{name}_nodes"], np.int64)
                vectors = np.frombuffer(row[f"{name}_vectors"]).reshape(len(nodes), -1)
                spots = np.frombuffer(row[f"{name}_spots"]).reshape(len(nodes), -1)
                sides.append((nodes, np.frombuffer(row[f"{name}_weights"], np.int64), _unit(vectors), spots))
            alone = row["a_block"] == row["b_block"]
            left, right = join_sequences(*sides[0][2:], *sides[1][2:], epsilon, threshold, alone)
            if not len(left):
                continue
            (a_nodes, a_weights, *_), (b_nodes, b_weights, *_) = sides
            ends = np.concatenate([a_nodes[left], b_nodes[right]])
            linked = np.concatenate([b_weights[right], a_weights[left]])
            nodes, place = np.unique(ends, return_inverse=True)
            roots = _roots(place[: len(left)], place[len(left) :], len(nodes))
            sums = np.zeros(len(nodes), np.int64)
            np.add.at(sums, place, linked)
            yield pa.RecordBatch.from_pydict({"node": nodes, "links": sums, "root": nodes[roots]})


def join_sequences(
    a: np.ndarray, a_spots: np.ndarray, b: np.ndarray, b_spots: np.ndarray, epsilon: float, threshold: float, alone: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked unit vectors in two sorted sequences; if they are the same one, each pair once."""
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if alone and a0 >= b1:
            continue
        gaps = np.maximum(
            0,
            np.maximum(
                a_spots[a0:a1].min(axis=0) - b_spots[b0:b1].max(axis=0),
                b_spots[b0:b1].min(axis=0) - a_spots[a0:a1].max(axis=0),
            ),
        )
        if (gaps**2).sum() > epsilon**2:
            continue
        if max(a1 - a0, b1 - b0) > LEAF:
            if a1 - a0 >= b1 - b0:
                middle = (a0 + a1) // 2
                todo += [(a0, middle, b0, b1), (middle, a1, b0, b1)]
            else:
                middle = (b0 + b1) // 2
                todo += [(a0, a1, b0, middle), (a0, a1, middle, b1)]
            continue
        i, j = np.nonzero(a[a0:a1] @ b[b0:b1].T >= threshold)
        i, j = i + a0, j + b0
        if alone:
            i, j = i[i < j], j[i < j]
        lefts.append(i)
        rights.append(j)
    return np.concatenate(lefts), np.concatenate(rights)


def _roots(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The smallest place that links reach from each place."""
    roots = np.arange(size)
    while True:
        before = roots.copy()
        low = np.minimum(roots[left], roots[right])
        np.minimum.at(roots, left, low)
        np.minimum.at(roots, right, low)
        np.minimum.at(roots, before[left], low)
        np.minimum.at(roots, before[right], low)
        roots = roots[roots]
        if (roots == before).all():
            return roots
