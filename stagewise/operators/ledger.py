"""A written ledger of the files that were processed, so that a late file in a processed partition is found.

Comparing partitions cannot see a file that lands in a day that was loaded before. The ledger keeps a row for each file:
its place, size, time of change, digest, landing partition and run. A file is looked up by place, size and time first,
which reads nothing; only what that does not find is opened, once and in parallel, for a digest of its bytes. Bytes that
the ledger has are no new data, so a file that was renamed, touched or moved in from a processed partition chooses nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.session import settle
from stagewise.sources.files import path_exists
from stagewise.sources.inventory import file_inventory, file_system

SEEN, NEW = 1, 2
_READ_BYTES = 1 << 20


def ledger_schema(partition: str) -> str:
    return f"file string, size long, modified timestamp, {partition} long, digest string, run long"


def read_ledger(spark: SparkSession, ledger: str, partition: str) -> DataFrame:
    """All rows of a ledger; none if it has not been started."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], ledger_schema(partition))
    return spark.read.schema(ledger_schema(partition)).parquet(ledger)


def stage_files(spark: SparkSession, path: str, partition: str, ext: str | None = None, **options: str) -> DataFrame:
    """The files of a stage with their landing partition; ``file`` is the place below the stage."""
    root = path.rstrip("/").rsplit("/", 1)[1]
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"file string, path string, size long, modified timestamp, {partition} long")
    below = F.regexp_extract("path", f"/\\Q{root}\\E/(.*)$", 1).alias("file")
    return file_inventory(spark, path, partition, ext, **options).select(below, "path", "size", "modified", partition)


def unseen(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files that the ledger does not have with this place, size and time: one grouped pass over both."""
    keys = ["file", "size", "modified"]
    tagged = files.select(*keys, "path", *_partition(files), F.lit(NEW).alias("side")).unionByName(
        known.select(*keys, F.lit(None).cast("string").alias("path"), *_partition(files), F.lit(SEEN).alias("side"))
    )
    sides = tagged.groupBy(*keys).agg(
        F.bit_or("side").alias("sides"), *[F.max(c).alias(c) for c in ("path", *_partition(files))]
    )
    return sides.where(F.col("sides") == NEW).drop("sides")


def _partition(files: DataFrame) -> list[str]:
    return [c for c in files.columns if c not in ("file", "path", "size", "modified")]


def with_digests(files: DataFrame) -> DataFrame:
    """Files with a digest of their bytes, which are read as a stream, in parallel over the files."""
    columns = [f"{name} {kind}" for name, kind in files.dtypes]
    tasks = 4 * files.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(digest=[_digest(p) for p in batch["path"]])

    return files.repartition(tasks).mapInPandas(run, ", ".join([*columns, "digest string"]))


def _digest(path: str) -> str:
    system, inner = file_system(path)
    found = hashlib.sha256()
    with system.open_input_stream(inner, compression=None) as source:
        while block := source.read(_READ_BYTES):
            found.update(block)
    return found.hexdigest()


def take_stock(
    spark: SparkSession, path: str, partition: str, ledger: str, ext: str | None = None, **options: str
) -> DataFrame:
    """Files that the ledger lacks, with their digests and whether they are ``fresh``, that is, new data. A written table.

    Not fresh is a file whose bytes the ledger has in its own partition, or, if that partition is in the ledger at all,
    in any partition: it was renamed, touched or moved. In a partition that is new, all files are fresh, also those that
    equal an earlier day's.
    """
    known = settle(read_ledger(spark, ledger, partition), "ledger")
    files = with_digests(unseen(stage_files(spark, path, partition, ext, **options), known))
    files = settle(files, "unseen-files")
    bytes_of = ["digest", "size"]
    anywhere = known.select(*bytes_of).distinct().withColumn("anywhere", F.lit(True))
    here = known.select(*bytes_of, partition).distinct().withColumn("here", F.lit(True))
    begun = known.select(partition).distinct().withColumn("begun", F.lit(True))
    looked = files.join(anywhere, bytes_of, "left").join(here, [*bytes_of, partition], "left").join(begun, partition, "left")
    old = F.col("here").isNotNull() | (F.col("begun").isNotNull() & F.col("anywhere").isNotNull())
    return settle(looked.select(*files.columns, (~old).alias("fresh")), "stock")


def fresh_partitions(stock: DataFrame, partition: str) -> list[int]:
    """The work list: partitions with fresh files, newest first."""
    found = stock.where("fresh").select(partition).where(F.col(partition).isNotNull()).distinct()
    return [r[partition] for r in found.orderBy(F.desc(partition)).collect()]


def record_files(stock: DataFrame, ledger: str, partition: str, run: int) -> None:
    """Add files to the ledger, after what they hold has been published.

    A job that ends in between chooses the same partitions again, and replaces what it wrote of them.
    """
    names = [c.split()[0] for c in ledger_schema(partition).split(", ")]
    rows = stock.withColumn("run", F.lit(int(run)).cast("long")).select(*names)
    rows.hint("rebalance").write.mode("append").parquet(ledger)


def start_ledger(
    spark: SparkSession, path: str, partition: str, ledger: str, done: DataFrame, run: int = 0, **options: str
) -> None:
    """Begin a ledger for a stage that was loaded without one: files of partitions that are done count as processed."""
    files = stage_files(spark, path, partition, **options)
    done = done.select(F.col(partition).cast("long").alias(partition)).distinct()
    stock = with_digests(files.join(done, partition, "left_semi").select(*files.columns))
    record_files(stock, ledger, partition, run)


def files_fingerprint(files: DataFrame) -> str:
    """A digest of a set of files, whatever order they come in: sums over a hash of each one's name, size and time.

    Spark adds them up, so the driver sees one row, however many files there are.
    """
    columns = [F.col(c).cast("string") for c in files.columns]
    found = files.select(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("other"), *columns).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("a"), F.bit_xor("b").alias("b")
    )
    row = found.first()
    return f"{row['n']}:{row['a'] or 0}:{row['b'] or 0}"
