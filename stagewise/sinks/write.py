"""Partitioned writes, and publishing only what has been checked."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import Contract, ContractError
from stagewise.operators.nested import as_type
from stagewise.operators.quality import conforms
from stagewise.session import settle
from stagewise.sources.files import (
    adopt_files,
    delete_path,
    partition_folders,
    path_exists,
    rename_path,
    renames_cheaply,
    replace_folders,
    set_mark,
)
from stagewise.sources.inventory import file_inventory, file_system, headers, path_below, schema_inventory

# The kind of mark that a unit without rows gets.
PROCESSED = "processed"

# Formats a stage can be written in.
WRITE_FORMATS = ("parquet", "csv", "json")
TEXT_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def under_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns with its types, partitions first; a missing column is an error, a null-typed one goes.

    Fields of structs are matched by name, like columns.
    """
    contract = contract.without(contract.null_typed())
    missing = [c for c in contract.column_names if c not in df.columns]
    if missing:
        raise ContractError(f"columns {missing} of '{contract.name}' are not in the data")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in contract.partitions_first:
        cols.append(as_type(F.col(f"`{c.name}`"), kinds[c.name], c.spark_type, c.name).alias(c.name))
    return df.select(*cols)


def write_partitioned(
    df: DataFrame,
    path: str,
    contract: Contract,
    fmt: str = "parquet",
    mode: str = "overwrite",
    gather: bool = True,
    max_records: int = 0,
    fresh: bool = False,
) -> str:
    """Write a frame below a path, one folder per partition value; other partitions there are kept.

    ``gather`` brings the rows of a partition together first, so that a partition has few files instead of one per
    task. Adaptive execution splits a partition that is too large for one task, so a hot one is written by many.
    Leave it off when each input split already holds one partition, as after a scan of partition folders. ``fresh``
    says that nothing is at the path, so that the commit has no partitions to replace one by one.
    """
    if fmt not in WRITE_FORMATS:
        raise ContractError(f"cannot write '{fmt}' files")
    out = under_contract(df, contract)
    if gather and contract.partitions:
        out = out.hint("rebalance", *contract.partitions)
    writer = out.write.format(fmt).mode(mode).option("partitionOverwriteMode", "static" if fresh else "dynamic")
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    else:
        writer = writer.option("timestampNTZFormat", TEXT_TIMESTAMP)
    if fmt == "csv":
        writer = writer.option("header", True)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if contract.partitions:
        writer = writer.partitionBy(*contract.partitions)
    writer.save(path)
    return path


def check_frame(df: DataFrame, contract: Contract) -> None:
    """Fail before any work if the frame's own schema cannot give the contract's."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{c.name}: {kinds[c.name].simpleString() if c.name in kinds else 'missing'}"
        for c in contract.columns
        if c.type != "null" and kinds.get(c.name) != c.spark_type
    ]
    if wrong:
        raise ContractError(f"result does not match the contract of '{contract.name}': {', '.join(wrong)}")


def publish(
    df: DataFrame,
    path: str,
    contract: Contract,
    unit: str | None = None,
    gather: bool = True,
    cast: bool = False,
    units: Sequence[int] | None = None,
    fmt: str = "parquet",
) -> str:
    """Write to a staging area beside the target, check the schema of every file, then replace the partitions.

    The frame's schema is compared first (``cast`` converts it instead), so most mistakes cost nothing. With a
    ``unit``, the landing partition, all that the target has of the written units is replaced, so running one again
    never leaves old rows; without it, each written combination of partition values is. Where renaming is a metadata
    operation the staged folders are moved, and if anything fails the target is as before. Elsewhere the staged files
    are copied in parallel, as they are, and the files they replace go last, by a list made before: a failure in between
    leaves old and new files, which the next run of the same units replaces. The staging area is deleted in any case.

    ``units`` are all values of ``unit`` that the frame stands for. Those it has no rows of are cleared in the target
    and marked there as processed, so that they are not chosen again. Text files (``fmt``) are published the same way;
    what is checked of them is their columns.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if unit and unit not in contract.partitions:
        raise ContractError(f"the contract of '{contract.name}' must be partitioned by {unit}")
    if not cast:
        check_frame(df, contract)
    staging = f"{path}_staging/{uuid.uuid4().hex[:12]}"
    try:
        write_partitioned(df, staging, contract, fmt, gather=gather, fresh=True)
        check_files(spark, staging, contract, fmt)
        found = written_units(spark, staging, unit) if unit and units is not None else set()
        replace_partitions(spark, staging, path, contract, unit)
        if unit and units is not None:
            settle_units(spark, path, contract, unit, {int(u) for u in units}, found)
    finally:
        delete_path(spark, staging)
    return path


def written_units(spark: SparkSession, path: str, unit: str) -> set[int]:
    """The units that have files below a path."""
    value = F.regexp_extract("leaf", rf"(?:^|/){re.escape(unit)}=(\d+)", 1)
    rows = leaf_folders(spark, path).select(value.cast("long").alias("unit")).distinct().collect()
    return {r["unit"] for r in rows if r["unit"] is not None}


def settle_units(
    spark: SparkSession, path: str, contract: Contract, unit: str, units: set[int], found: set[int]
) -> None:
    """Clear and mark the units without rows; a unit that has rows now loses its mark."""
    if units - found:
        of_unit = F.regexp_extract("leaf", rf"(?:^|/){re.escape(unit)}=(\d+)", 1).cast("long")
        there = leaf_folders(spark, path).where(of_unit.isin(sorted(units - found)))
        for row in there.collect():
            delete_path(spark, f"{path}/{row['leaf']}")
    for value in sorted(units - found):
        set_mark(spark, path, PROCESSED, f"{unit}={value}")
    for value in sorted(found):
        delete_path(spark, f"{path}/_{PROCESSED}/{unit}={value}")


def append_batch(df: DataFrame, path: str, partitions: Sequence[str], fmt: str, tag: str) -> None:
    """Add rows as files named by a tag; adding the same tag again replaces its files."""
    spark, staging = df.sparkSession, f"{path.rstrip('/')}_staging/{tag}"
    out = df.hint("rebalance", *partitions) if partitions else df
    writer = out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt in ("csv", "json"):
        writer = writer.option("timestampNTZFormat", TEXT_TIMESTAMP)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partitions:
        writer = writer.partitionBy(*partitions)
    try:
        writer.save(staging)
        adopt_files(spark, staging, path.rstrip("/"), tag)
    finally:
        delete_path(spark, staging)


def check_files(spark: SparkSession, path: str, contract: Contract, fmt: str = "parquet") -> None:
    """Fail unless every file below a path conforms to the contract.

    Of Parquet files all names and types are compared, of CSV files the header, which must be the contract's. JSON
    records leave out what is null, so of them only columns that the contract lacks are faults.
    """
    stored, inventory = contract.without(contract.null_typed()), schema_inventory(spark, path, fmt)
    if fmt == "parquet":
        problems = conforms(inventory, stored)
    else:
        names = [c.name for c in stored.data_columns]
        own = headers(inventory)
        header, wanted = F.col("header"), F.lit(names).cast("array<string>")
        wrong = header != wanted if fmt == "csv" else F.size(F.array_except(header, wanted)) > 0
        problems = own.where(wrong).select("file", F.array_join("header", ",").alias("path"), F.lit("columns differ").alias("problem"))
    # A message names some of them; only if there are any are all counted.
    found = problems.limit(20).collect()
    if found:
        lines = "; ".join(f"{r['path']} {r['problem']} in {r['file']}" for r in found)
        raise ContractError(f"files do not match the contract of '{contract.name}', {problems.count()} faults: {lines}")


def replace_partitions(
    spark: SparkSession, staging: str, path: str, contract: Contract, unit: str | None = None
) -> None:
    """Put staged partitions, or the whole of an unpartitioned table, in the place of the target's."""
    old = f"{staging}_old"
    by_rename = renames_cheaply(spark, path)
    if not by_rename:
        copy_in_place(spark, staging, path, contract, unit)
        return
    try:
        if not contract.partitions:
            parent, _, name = path.rpartition("/")
            rename_path(spark, staging, f"{staging}_new/{name}")
            replace_folders(spark, f"{staging}_new", parent, [name], old)
            delete_path(spark, f"{staging}_new")
            return
        if contract.partitions[0] == unit:
            replace_folders(spark, staging, path, partition_folders(spark, staging, unit), old)
            return
        written = leaf_folders(spark, staging)
        stale = stale_leaves(spark, written, path, unit) if unit else []
        replace_folders(spark, staging, path, [r["leaf"] for r in written.collect()], old)
        for leaf in stale:
            delete_path(spark, f"{path}/{leaf}")
    finally:
        delete_path(spark, old)
        delete_path(spark, f"{staging}_new")


def copy_in_place(spark: SparkSession, staging: str, path: str, contract: Contract, unit: str | None) -> None:
    """Copy staged files below the target, then delete what they replace. Written files have names of their own."""
    old = None
    if path_exists(spark, path):
        there = file_inventory(spark, path).select("path")
        if contract.partitions:
            key = rf"(?:^|/)({re.escape(unit)}=[^/]*)" if unit else "^(.*)$"
            part = F.regexp_extract("leaf", key, 1).alias("part")
            written = leaf_folders(spark, staging).select(part).distinct()
            there = there.withColumn("leaf", _leaf(path)).select("path", part).join(written, "part", "left_semi")
        old = settle(there.select("path"), "replaced")
    relay_files(file_inventory(spark, staging).select("path"), staging, path)
    if old is not None:
        relay_files(old, path, None)


def relay_files(files: DataFrame, root: str, target: str | None) -> int:
    """Copy files to the same places below another folder, or delete them if there is none, in parallel."""

    def relay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["path"]:
                system, source = file_system(file)
                if target is None:
                    if system.get_file_info(source).type != fs.FileType.NotFound:  # a repeated task finds it gone
                        system.delete_file(source)
                    continue
                to = file_system(f"{target}/{path_below(file, root)}")[1]
                system.create_dir(to.rsplit("/", 1)[0], recursive=True)
                system.copy_file(source, to)
            yield batch

    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(tasks).mapInPandas(relay, "path string").count()


def _leaf(path: str) -> Column:
    """The innermost partition folder of a file below a path, relative to it."""
    root = path.rstrip("/").rsplit("/", 1)[1]
    return F.regexp_extract("path", rf"/{re.escape(root)}/([^/=]+=.*)/[^/]+$", 1)


def leaf_folders(spark: SparkSession, path: str) -> DataFrame:
    """The distinct innermost partition folders below a path that hold files, relative to it."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "leaf string")
    return file_inventory(spark, path).select(_leaf(path).alias("leaf")).distinct()


def stale_leaves(spark: SparkSession, written: DataFrame, path: str, unit: str) -> list[str]:
    """Folders that the target has of the written units, but that were not written."""
    of_unit = F.regexp_extract("leaf", rf"(?:^|/)({re.escape(unit)}=[^/]*)", 1).alias("unit")
    units = written.select(of_unit).distinct()
    there = leaf_folders(spark, path).select("leaf", of_unit).join(units, "unit", "left_semi")
    return [r["leaf"] for r in there.join(written, "leaf", "left_anti").select("leaf").collect()]
