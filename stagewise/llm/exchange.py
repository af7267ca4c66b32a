"""Asking all of a corpus about the keys of each part of it, with packed messages instead of a row for each key.

Word windows, n-grams and signatures are as many as the words of the corpus. Shuffling a row for each takes several times
the corpus in disk. Here documents are first written as chunks, compressed, in a table bucketed by a slot. Then

* ``ask`` lets each chunk send its distinct keys, sorted and packed, one message for each bucket of keys. A key that is
  frequent everywhere is still a single entry of each chunk's message, so no bucket gets hot rows;
* all messages of a bucket are answered together, and each sender gets one answer for each of its messages;
* ``told`` brings the answers back. The chunk table is bucketed, so this join moves answers, never text.

Buckets grow in number with the corpus, so what one task holds is bounded: the messages of a bucket, or one chunk. Chunks
are a written table in the shared folder; losing an executor repeats tasks, and the names of chunks stay the same.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.words import Words, split_words, text_slices
from stagewise.session import scratch_path, ship_package

# Text bytes of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 3_000_000
# Text bytes for each bucket of keys.
BUCKET_BYTES = 24_000_000

_CHUNKS = "slot int, chunk string, size bigint, ids binary, text binary, bounds binary"
_MESSAGES = "bucket int, home int, slot int, chunk string, message binary"
_ANSWERS = "bucket int, slot int, chunk string, answer binary, note binary"


@dataclass
class Chunk:
    """Some documents: their ids (with a mask of those that are not null) and texts."""

    slot: int
    name: str
    ids: np.ndarray
    known: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def words(self, kind: str, lower: bool) -> Words:
        return split_words(self.data, self.offsets, kind, lower)


@dataclass
class Chunks:
    table: DataFrame
    slots: int
    homes: list[int]  # by bucket: a number that Spark's hash puts into a partition of its own

    @property
    def buckets(self) -> int:
        return len(self.homes)

    @property
    def spark(self) -> SparkSession:
        return self.table.sparkSession


def pack(values: np.ndarray) -> bytes:
    """An array as bytes, its columns of bytes side by side and compressed; sorted 64-bit values lose their upper bytes."""
    import zstandard

    values = np.ascontiguousarray(values)
    if values.dtype == np.uint64 and len(values) > 1:
        values = np.concatenate([values[:1], np.diff(values)])
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T if len(values) else values.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes, dtype) -> np.ndarray:
    """What ``pack`` has packed. 64-bit unsigned values are taken for sums of differences."""
    import zstandard

    dtype = np.dtype(dtype)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    values = np.ascontiguousarray(flat.reshape(dtype.itemsize, -1).T).view(dtype).ravel()
    return np.cumsum(values, dtype=np.uint64) if dtype == np.uint64 else values


def join_parts(parts: Iterable[bytes]) -> bytes:
    """Several byte strings as one."""
    parts = list(parts)
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def split_parts(raw: bytes) -> list[bytes]:
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, count, 8)
    ends = 8 * (count + 1) + np.cumsum(sizes)
    return [raw[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]


def stage_chunks(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Chunks:
    """Write id and text of all documents as chunks. A task writes one slot, so no shuffle is needed before."""
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = _slot_names(spark, slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = names[TaskContext.get().partitionId() % slots]
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), CHUNK_BYTES):
                yield _packed_chunk(slot, batch.column("doc_id").slice(first, end - first), data, offsets)

    label = f"llm_chunks_{uuid.uuid4().hex[:12]}"
    (
        rows.mapInArrow(run, _CHUNKS)
        .write.bucketBy(slots, "slot")
        .option("path", scratch_path(spark, "chunks"))
        .option("compression", "uncompressed")
        .saveAsTable(label)
    )
    written = spark.table(label)
    size = written.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return Chunks(written, slots, _slot_names(spark, max(4, -(-size // BUCKET_BYTES))))


def _slot_names(spark: SparkSession, slots: int) -> list[int]:
    """For each bucket of the chunk table a number that falls into it."""
    tried = spark.range(slots * 40 + 400).select(F.col("id").cast("int").alias("name"))
    place = F.pmod(F.hash("name"), F.lit(slots))
    found = tried.groupBy(place.alias("place")).agg(F.min("name").alias("name")).collect()
    return sorted(row["name"] for row in found)


def _packed_chunk(slot: int, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    import zstandard

    known = np.array(pc.is_valid(ids).to_numpy(zero_copy_only=False), np.uint8)
    values = np.array(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), np.int64)
    packer = zstandard.ZstdCompressor(level=3)
    columns = {
        "slot": pa.array([slot], pa.int32()),
        "chunk": [uuid.uuid4().hex],
        "size": [len(data)],
        "ids": [join_parts([pack(values), pack(known)])],
        "text": [packer.compress(data.tobytes())],
        "bounds": [pack(np.asarray(offsets, np.int64))],
    }
    return pa.RecordBatch.from_pydict(columns)


def _opened(row: dict) -> Chunk:
    import zstandard

    ids, known = split_parts(row["ids"])
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=row["size"]), np.uint8)
    return Chunk(
        row["slot"],
        row["chunk"],
        unpack(ids, np.int64),
        unpack(known, np.uint8).astype(bool),
        data,
        unpack(row["bounds"], np.int64),
    )


def _each_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, dict]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            yield _opened(row), row


# Replies to the messages of a bucket, and what is to be known about the bucket as a whole.
Answering = Callable[[list[bytes]], tuple[list[bytes], bytes]]


def messages(
    chunks: Chunks, send: Callable[..., Iterable[tuple[int, bytes]]], rows: DataFrame | None = None
) -> DataFrame:
    """What every chunk sends: a message to each of some buckets. ``rows`` are chunks that were told: ``send`` gets their
    answers as well.
    """
    source, homes = chunks.table if rows is None else rows, chunks.homes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row in _each_chunk(batches):
            sent = list(send(chunk, row["answers"]) if "answers" in row else send(chunk))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([b for b, _ in sent], pa.int32()),
                    "home": pa.array([homes[b % len(homes)] for b, _ in sent], pa.int32()),
                    "slot": pa.array([chunk.slot] * len(sent), pa.int32()),
                    "chunk": pa.array([chunk.name] * len(sent), pa.string()),
                    "message": pa.array([m for _, m in sent], pa.binary()),
                }
            )

    return source.mapInArrow(run, _MESSAGES)


def answered(chunks: Chunks, sent: DataFrame, answer: Answering) -> DataFrame:
    """An answer for each message, worked out from all messages of its bucket; one of them carries the bucket's note.

    Every bucket is a partition of its own: messages are packed, so their bytes say little about the work in them.
    """

    def run(table: pa.Table) -> pa.Table:
        replies, note = answer([m.as_py() for m in table.column("message")])
        notes = pa.array([note, *[None] * (len(replies) - 1)], pa.binary())
        return pa.table(
            [*table.select(["bucket", "slot", "chunk"]).columns, pa.array(replies, pa.binary()), notes],
            names=["bucket", "slot", "chunk", "answer", "note"],
        )

    return sent.repartition(chunks.buckets, "home").groupBy("home", "bucket").applyInArrow(run, _ANSWERS)


def notes(answers: DataFrame) -> list[bytes]:
    """The notes of all buckets: a few numbers each."""
    return [bytes(row["note"]) for row in answers.where(F.col("note").isNotNull()).select("note").collect()]


def told(chunks: Chunks, answers: DataFrame) -> DataFrame:
    """The chunks, each with its answers: an array of (bucket, answer).

    The join is on the slot, by which the chunk table is bucketed, so that only answers are shuffled; chunk names, of
    equal length, are compared besides.
    """
    own = (
        answers.repartition(chunks.slots, "slot")
        .groupBy("slot", "chunk")
        .agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
        .select(F.col("slot").alias("to_slot"), F.col("chunk").alias("to_chunk"), "answers")
        .hint("shuffle_merge")
    )
    same = (F.col("slot") == F.col("to_slot")) & F.contains(F.col("chunk"), F.col("to_chunk"))
    return chunks.table.join(own, same, "left").drop("to_slot", "to_chunk")


def each_told(rows: DataFrame, run: Callable[[Chunk, dict[int, bytes]], pa.RecordBatch], schema) -> DataFrame:
    """Map every told chunk to rows."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row in _each_chunk(batches):
            yield run(chunk, answers_of(row["answers"]))

    return rows.mapInArrow(mapped, schema)


def answers_of(found: list[dict] | None) -> dict[int, bytes]:
    return {a["bucket"]: a["answer"] for a in found or ()}


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit hash: equal ranges of their values, so that sorted keys are sorted by bucket."""
    return ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of the runs of sorted keys."""
    if not len(keys):
        return
    places = bucket_of(keys, buckets)
    heads = np.flatnonzero(np.diff(places, prepend=-1))
    for first, end in zip(heads.tolist(), [*heads[1:].tolist(), len(keys)], strict=True):
        yield int(places[first]), first, end


def id_remainders(ids: np.ndarray, divisor: int) -> np.ndarray:
    """crc32 of each id as text, modulo ``divisor``."""
    return np.array([zlib.crc32(b"%d" % i) % divisor for i in ids.tolist()], np.int64)
