"""The lint-and-land job: check every landed file, then move whole files to the pass or the fail area."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.functions.checks import Rule
from stagewise.functions.tokens import plain_path
from stagewise.operators.partitions import promote
from stagewise.operators.profiles import column_profiles
from stagewise.operators.quality import all_must_pass, check_columns, lint_report, missing_required
from stagewise.session import settle
from stagewise.sources.files import path_exists
from stagewise.sources.inventory import (
    UNREADABLE,
    file_inventory,
    file_system,
    headers,
    name_filter,
    path_below,
    schema_inventory,
)
from stagewise.sources.scans import (
    CORRUPT,
    FileGroup,
    file_groups,
    read_csv_group,
    read_parquet_group,
)
from stagewise.spec import Pipeline, TableSpec

REPORT_SCHEMA = "file string, column_name string, rule_name string, rows long, failures long"
VERDICT_SCHEMA = "file string, rows long, bad_rules long, passed boolean"


@dataclass(frozen=True)
class LintResult:
    """What a run found. Nothing reaches the pass area unless ``published``."""

    run_ts: int
    tables: list[str]
    files: int
    failed_files: int
    published: bool
    log_paths: dict[str, str]


def land_frames(
    spark: SparkSession, path: str, spec: TableSpec, contract: Contract, inventory: DataFrame, broken: list[str]
) -> list[DataFrame]:
    """Landed rows with their ``file``, cells as they are stored; one frame per schema that the files have.

    A file is in one frame only, so the reports of the frames do not overlap. CSV files without a header are read
    in the contract's order. Files that are ``broken`` are in no frame.
    """
    fmt, reading = spec.formats["land"], {**spec.read_options, "recursiveFileLookup": "true"}
    if fmt == "csv" and not spec.lint.expect_header:
        group = FileGroup(tuple((c.name, c.type) for c in contract.columns), path)
        stored = contract.without(contract.null_typed())
        frames = [read_csv_group(spark, group, stored, corrupt=True, **{**reading, "header": "false"})]
    elif fmt == "json":
        # Every value as text, which the type rule needs; what is nested stays JSON.
        present = inventory.where(F.col("column").isin(contract.column_names)).select("column").distinct().collect()
        fields = [T.StructField(r["column"], T.StringType()) for r in present]
        reading["pathGlobFilter"] = name_filter("json")
        frames = [spark.read.schema(T.StructType(fields)).options(**reading).json(path)] if fields else []
    elif fmt in ("csv", "parquet"):
        read = partial(read_csv_group, corrupt=True) if fmt == "csv" else read_parquet_group
        groups = file_groups(spark, path, inventory, listed=bool(broken))
        stored, fold = contract.without(contract.null_typed()), spec.lint.headers_ignore_case
        frames = [read(spark, g, stored, ignore_case=fold, **reading) for g in groups]
    else:
        raise ContractError(f"cannot lint '{fmt}' files")
    frames = [f.withColumn("file", plain_path(F.col("_metadata.file_path"))) for f in frames]
    return [f.where(~F.col("file").isin(broken)) for f in frames] if broken else frames


def lint_table(
    spark: SparkSession, pipeline: Pipeline, table: str, stage: str, log: str, profile: str | None = None
) -> DataFrame:
    """Check all landed files of one table; the report goes to ``log`` and the verdicts are read from it.

    A file that cannot be opened, or is of another format than the table's, fails by itself. With a path for them, column
    profiles of each file are written too.
    """
    spec = pipeline.table(table)
    path, fmt, contract = pipeline.path(table, "land"), spec.formats["land"], spec.contract(stage)
    casts = {c.name: ColumnSpec(c.name, c.target) for c in spec.lint.casts}
    stored = contract.without([*contract.partitions, pipeline.partition])
    checked = stored.with_columns(*[replace(c, type=casts[c.name].type) for c in stored.columns if c.name in casts])
    found = settle(schema_inventory(spark, path, fmt, keep_unreadable=True, **spec.read_options), "schemas")
    unreadable = found.where(F.col("type") == UNREADABLE).select("file", F.lit("unreadable").alias("rule_name"))
    inventory = found.where(F.col("type") != UNREADABLE)
    files = settle(file_inventory(spark, path).select(F.col("path").alias("file")), "landed")
    ours = file_inventory(spark, path, ext=fmt).select(F.col("path").alias("file"))
    strays = files.join(ours, "file", "left_anti").select("file", F.lit("format").alias("rule_name"))
    problems = check_columns(headers(inventory), stored, spec.lint).select("file", "column_name", "rule_name")
    problems = problems.unionByName(unreadable.unionAll(strays).withColumn("column_name", F.lit("*")))
    # Damaged files, which are few, are left out of the typed scans.
    broken = [r["file"] for r in unreadable.collect()]
    frames = land_frames(spark, path, spec, stored, inventory, broken)
    # A row with more or fewer cells than the header fails its file, whatever its cells hold.
    cells = [Rule("*", "cells", F.col(CORRUPT).isNotNull())] if fmt == "csv" else []
    if profile and frames:
        found_in = [column_profiles(rows, checked) for rows in frames]
        reduce(DataFrame.unionByName, found_in).write.mode("overwrite").parquet(profile)
    reports = [lint_report(rows, checked, ["file"], more=cells) for rows in frames]
    reports.append(
        problems.select(
            "file",
            "column_name",
            "rule_name",
            F.lit(None).cast("long").alias("rows"),
            F.lit(1).cast("long").alias("failures"),
        )
    )
    reduce(DataFrame.unionByName, reports).write.mode("overwrite").parquet(log)
    per_file = (
        spark.read.schema(REPORT_SCHEMA)
        .parquet(log)
        .groupBy("file")
        .agg(F.max("rows").alias("rows"), F.count_if(F.col("failures") > 0).alias("bad_rules"))
    )
    # A file without data rows is not in the report unless its header is wrong. Every landed file gets a verdict.
    counted = files.join(per_file, "file", "left").select(
        "file", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("bad_rules", F.lit(0)).alias("bad_rules")
    )
    return counted.withColumn("passed", F.col("bad_rules") == 0)


def run_lint(
    spark: SparkSession,
    pipeline: Pipeline,
    run_ts: int,
    tables: Sequence[str] | None = None,
    stage: str = "raw_hist",
    temp_staging: bool = False,
    profiles: bool = False,
) -> LintResult:
    """Lint every table that has landed files, and move its files by their verdicts.

    Passing files keep their bytes and names and get a folder of the landing partition ``run_ts``, unless they lie
    in one already. With ``temp_staging`` they go to a temporary area first, which must then hold one landing
    partition, and are promoted under ``run_ts``. If all must pass and one fails, no file is taken from the landing
    area; failing files are copied to the fail area. With ``profiles``, column profiles of each file are kept in the log,
    where ``merge_profiles`` adds up those of any number of runs.
    """
    specs = [s for s in pipeline.select(list(tables) if tables else None, ["land"]) if s.lint]
    full = [s for s in specs if _has_files(spark, pipeline.path(s.name, "land"))]
    absent = missing_required({s.name: s.lint for s in specs}, [s.name for s in full])
    if absent:
        raise ContractError(f"required tables have no files: {', '.join(absent)}")
    base = pipeline.base_path(stage)
    logs = {s.name: f"{base}/log/{s.name}/report/run={run_ts}" for s in full}
    verdicts = {}
    for spec in full:
        kept = f"{base}/log/{spec.name}/verdicts/run={run_ts}"
        profile = f"{base}/log/{spec.name}/profile/run={run_ts}" if profiles else None
        lint_table(spark, pipeline, spec.name, stage, logs[spec.name], profile).write.mode("overwrite").parquet(kept)
        verdicts[spec.name] = spark.read.schema(VERDICT_SCHEMA).parquet(kept)
    empty = spark.createDataFrame([], VERDICT_SCHEMA)
    total = all_must_pass(reduce(DataFrame.unionByName, verdicts.values(), empty)).first()
    publish = total["publish"] or not pipeline.all_must_pass
    remove = publish and pipeline.remove_on_pass
    for name, verdict in verdicts.items():
        land, part = pipeline.path(name, "land"), f"{pipeline.partition}={run_ts}"
        move_files(verdict.where("not passed"), land, f"{base}/fail/{name}", part, pipeline.partition, remove)
        if not publish:
            continue
        area = f"{base}/temp/pass/{name}" if temp_staging else f"{base}/pass/{name}"
        move_files(verdict.where("passed"), land, area, part, pipeline.partition, remove)
        if temp_staging:
            promote(spark, area, f"{base}/pass/{name}", pipeline.partition, run_ts)
    return LintResult(run_ts, [s.name for s in full], total["files"], total["failed_files"], publish, logs)


def _has_files(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path) and not file_inventory(spark, path).isEmpty()


def move_files(files: DataFrame, root: str, target: str, folder: str, partition: str, remove: bool) -> int:
    """Move (or copy) whole files below ``target``, in parallel over the files; gives their number.

    A task that runs twice finds its source gone and its target in place, which counts as done. A file that is there
    under the same name with other content is kept, and the newcomer's name gets a digest of what it holds.
    """

    def relocate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            moved = [_relocate(file, root, target, folder, partition, remove) for file in batch["file"]]
            yield pd.DataFrame({"moved": moved})

    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.select("file").repartition(tasks).mapInPandas(relocate, "moved string").count()


def _relocate(file: str, root: str, target: str, folder: str, partition: str, remove: bool) -> str:
    relative = path_below(file, root)
    below = relative if f"{partition}=" in relative else f"{folder}/{relative}"
    destination = f"{target}/{below}"
    system, source = file_system(file)
    to = file_system(destination)[1]
    found = {info.path: info.type for info in system.get_file_info([source, to])}
    if found[source] == fs.FileType.NotFound:
        if found[to] == fs.FileType.NotFound:
            raise FileNotFoundError(file)
        return destination
    if found[to] != fs.FileType.NotFound and _digest(system, source) != _digest(system, to):
        folder_of, _, name = to.rpartition("/")
        stem, dot, ending = name.partition(".")
        to = f"{folder_of}/{stem}-{_digest(system, source)[:16]}{dot}{ending}"
        destination = f"{destination.rpartition('/')[0]}/{to.rpartition('/')[2]}"
    system.create_dir(to.rsplit("/", 1)[0], recursive=True)
    if remove:
        system.move(source, to)
    else:
        system.copy_file(source, to)
    return destination


def _digest(system: fs.FileSystem, path: str) -> str:
    found = hashlib.sha256()
    with system.open_input_stream(path, compression=None) as source:
        while block := source.read(1 << 20):
            found.update(block)
    return found.hexdigest()
