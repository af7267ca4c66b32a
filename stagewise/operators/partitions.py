"""Which landing partitions exist, and which are still to be processed.

Sets of partitions are compared with one tagged union and one grouped pass: the union is reduced to its distinct
(partition, source) pairs before anything is shuffled, however many rows stand behind a partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ContractError
from stagewise.functions.tokens import epoch_day, file_name_timestamp
from stagewise.session import settle
from stagewise.sources.files import delete_path, marks, merge_folder, partition_folders, path_exists, rename_path
from stagewise.sources.inventory import Window, file_inventory, window_options
from stagewise.spec import Pipeline


# Frames whose marks fit into one column of bits.
WORD_BITS = 62


def list_partitions(df: DataFrame, partition: str, tokens: bool = False) -> DataFrame:
    """Distinct landing partitions of a frame, as longs or as ``name=value`` tokens."""
    found = df.select(F.col(partition).cast("long").alias(partition)).distinct()
    return found.select(F.concat(F.lit(f"{partition}="), partition).alias(partition)) if tokens else found


def stage_partitions(spark: SparkSession, path: str, partition: str, **options: str) -> DataFrame:
    """Distinct landing partitions with at least one non-empty file below a path, or marked as processed without rows.

    No data is read. Reader options, such as ``window_options``, narrow the listing.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{partition} long")
    found = list_partitions(file_inventory(spark, path, partition, **options), partition)
    values = [(int(m.partition("=")[2]),) for m in marks(spark, path, "processed") if m.startswith(f"{partition}=")]
    return found.union(spark.createDataFrame(values, f"{partition} long")).distinct() if values else found


def _sources_mask(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys with a bit set for each frame they occur in; a column of bits for every ``WORD_BITS`` frames."""
    words = range(-(-len(frames) // WORD_BITS))

    def bits(frame: int, word: int) -> Column:
        return F.lit(1 << frame % WORD_BITS if frame // WORD_BITS == word else 0).cast("long")

    tagged = [f.select(*keys, *[bits(i, w).alias(f"seen_in_{w}") for w in words]) for i, f in enumerate(frames)]
    found = reduce(DataFrame.union, tagged).groupBy(*keys)
    return found.agg(*[F.bit_or(f"seen_in_{w}").alias(f"seen_in_{w}") for w in words])


def _only(frames: Sequence[int], total: int) -> Column:
    """Keys that occur in exactly these of ``total`` frames."""
    masks = [0] * -(-total // WORD_BITS)
    for frame in frames:
        masks[frame // WORD_BITS] |= 1 << frame % WORD_BITS
    return reduce(Column.__and__, [F.col(f"seen_in_{w}") == mask for w, mask in enumerate(masks)])


def unprocessed(given: DataFrame, done: DataFrame, partition: str) -> DataFrame:
    """Partitions of the input that the output lacks, newest first.

    A late, older partition is still found; a late file in a partition that the output has is not.
    """
    frames = [f.select(F.col(partition).cast("long").alias(partition)) for f in (given, done)]
    return _sources_mask(frames, [partition]).where(_only([0], 2)).select(partition).orderBy(F.desc(partition))


def unprocessed_many(given: DataFrame, done: DataFrame, partition: str, table: str = "table_name") -> DataFrame:
    """The same for (table, partition) pairs of many tables in one pass."""
    return _sources_mask([given.select(table, partition), done.select(table, partition)], [table, partition]).where(
        _only([0], 2)
    ).select(table, partition)


def table_partitions(
    spark: SparkSession, pipeline: Pipeline, names: Sequence[str], stage: str, **options: str
) -> DataFrame:
    """(table, partition) rows of several tables at one stage."""
    frames = [
        stage_partitions(spark, pipeline.path(n, stage), pipeline.partition, **options).select(
            F.lit(n).alias("table_name"), pipeline.partition
        )
        for n in names
        if stage in pipeline.table(n).formats
    ]
    empty = spark.createDataFrame([], f"table_name string, {pipeline.partition} long")
    return reduce(DataFrame.union, frames, empty)


def unprocessed_all(
    spark: SparkSession,
    pipeline: Pipeline,
    tables: list[str] | None = None,
    given: str = "raw_hist",
    done: str = "curated",
    kinds: Sequence[str] = ("default", "custom"),
    window: Window = (None, None),
) -> dict[str, list[int]]:
    """Partitions to process for every matching table, newest first.

    Only input files that were modified inside the run's ``window`` (``day_window``) count; the output counts as a whole.

    The values are the run's work list; like Spark's own file index, it is bounded by the number of folders.
    """
    names = [s.name for s in pipeline.select(tables, [given, done], list(kinds))]
    todo = unprocessed_many(
        table_partitions(spark, pipeline, names, given, **window_options(*window)),
        table_partitions(spark, pipeline, names, done),
        pipeline.partition,
    )
    work: dict[str, list[int]] = {n: [] for n in names}
    for row in todo.orderBy("table_name", F.desc(pipeline.partition)).collect():
        work[row["table_name"]].append(row[pipeline.partition])
    return work


def cutoff(partition: str, low: int = 0, high: int | None = None) -> Column:
    """Inclusive bounds on the landing partition; on a partition column they prune folders."""
    col = F.col(partition)
    return col >= F.lit(low) if high is None else col.between(low, high)


def only_partitions(df: DataFrame, partition: str, values: Sequence[int]) -> DataFrame:
    """Rows of the listed partitions; on a partition column only their folders are read."""
    return df.where(F.col(partition).isin([int(v) for v in values]))


def common_new(
    inputs: Sequence[DataFrame], done: DataFrame, partition: str, low: int = 0, high: int | None = None
) -> DataFrame:
    """Partitions inside the cutoff that every input has and the output lacks, newest first."""
    if not inputs:
        raise ContractError("a derived table needs at least one input")
    frames = [f.select(partition).where(cutoff(partition, low, high)) for f in inputs] + [done.select(partition)]
    found = _sources_mask(frames, [partition]).where(_only(range(len(inputs)), len(frames)))
    return found.select(F.col(partition).cast("long").alias(partition)).orderBy(F.desc(partition))


def compare_partitions(found: DataFrame, expected: DataFrame, partition: str) -> DataFrame:
    """One row: how many expected partitions are missing, how many are extra, and whether the sets are equal."""
    mask = _sources_mask([found.select(partition), expected.select(partition)], [partition])
    missing, extra = F.count_if(_only([1], 2)), F.count_if(_only([0], 2))
    return mask.agg(missing.alias("missing"), extra.alias("extra"), (missing + extra == 0).alias("is_equal"))


def same_partitions(found: DataFrame, expected: Sequence[int], partition: str) -> bool:
    """Was this intermediate built from exactly the expected partitions?"""
    spark = found.sparkSession
    wanted = spark.createDataFrame([(int(v),) for v in expected], f"{partition} long")
    return bool(compare_partitions(found, wanted, partition).first()["is_equal"])


def newer_than_existing(
    new: DataFrame, existing: DataFrame, keys: Sequence[str], ts: str = "ts", one_a_day: bool = False
) -> DataFrame:
    """New files that are later than the latest existing one of their key; all of them where none exists.

    ``one_a_day`` compares UTC days, so a later file of the same day is refused. Without keys, all files are of one
    kind. The latest times are one row per key and are settled first: their size is then known, so the new files are
    only shuffled if it is large.
    """
    if keys:
        latest = settle(existing.groupBy(*keys).agg(F.max(ts).alias("latest")), "latest")
        joined, since = new.join(latest, list(keys), "left"), F.coalesce(F.col("latest"), F.lit(0))
    else:
        joined, since = new, F.lit(existing.agg(F.max(ts)).first()[0] or 0)
    newer = epoch_day(since) < epoch_day(F.col(ts)) if one_a_day else since < F.col(ts)
    return joined.where(newer).select(*new.columns)


def gate_files(
    new: DataFrame, existing: DataFrame, path: str = "path", keys: Sequence[str] = (), one_a_day: bool = True
) -> DataFrame:
    """The same for file paths that carry their landing time in the name; a bad name fails the job."""
    stamped = [f.withColumn("ts", file_name_timestamp(F.col(path))) for f in (new, existing)]
    return newer_than_existing(stamped[0], stamped[1], keys, one_a_day=one_a_day).drop("ts")


def restamp(df: DataFrame, partition: str, run_ts: int) -> DataFrame:
    """Put rows that must all be of one landing partition under the run's own timestamp."""
    column = F.col(partition)
    bounds = df.agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count_if(column.isNull()).alias("unknown")
    ).first()
    if bounds["unknown"]:
        raise ContractError(f"{bounds['unknown']} rows have no {partition}")
    if bounds["low"] != bounds["high"]:
        raise ContractError(f"more than one {partition}: {bounds['low']} to {bounds['high']}")
    return df.withColumn(partition, F.lit(int(run_ts)).cast("long"))


def promote(spark: SparkSession, staged: str, target: str, partition: str, run_ts: int) -> str | None:
    """Move the one landing partition of a staging area to the target under the run's timestamp.

    The value lives in the folder name, so this renames a folder and reads no data. If the target has the partition
    already, as after a run that is repeated, the staged files join those there. Nothing staged: None.
    """
    folders = partition_folders(spark, staged, partition)
    if not folders:
        return None
    if len(folders) > 1:
        raise ContractError(f"more than one landing partition is staged: {', '.join(folders)}")
    destination = f"{target}/{partition}={int(run_ts)}"
    if path_exists(spark, destination):
        merge_folder(spark, f"{staged}/{folders[0]}", destination)
        return destination
    rename_path(spark, f"{staged}/{folders[0]}", destination)
    return destination


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Sequence[int]) -> list[str]:
    """Delete the folders of landing partitions below a path; gives the deleted ones."""
    gone = []
    for value in values:
        folder = f"{path.rstrip('/')}/{partition}={int(value)}"
        if delete_path(spark, folder):
            gone.append(folder)
    return gone


def drop_table_partitions(
    spark: SparkSession, table: str, path: str, partition: str, values: Sequence[int]
) -> list[str]:
    """The same for a registered external table: its catalog entries go with the files."""
    for value in values:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = {int(value)})")
    return drop_partitions(spark, path, partition, values)
