"""Derived tables: built from the landing partitions that all inputs have and the output lacks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ContractError
from stagewise.functions.templates import render
from stagewise.operators.ledger import files_fingerprint, stage_files
from stagewise.operators.partitions import (
    common_new,
    same_partitions,
    stage_partitions,
)
from stagewise.operators.quality import assert_not_empty
from stagewise.plans.hooks import Hooks, SqlContext, apply_sql
from stagewise.plans.templates import run_template, template_values
from stagewise.session import settle, workspace
from stagewise.sinks.catalog import register
from stagewise.sinks.write import publish
from stagewise.sources.files import path_exists, set_mark
from stagewise.sources.inventory import Window, window_options
from stagewise.sources.scans import input_scans
from stagewise.spec import Pipeline, TableSpec


@dataclass(frozen=True)
class DerivedOptions:
    """``low`` and ``high`` bound the landing partitions, inclusive.

    With a ``prefix`` the result is registered in the catalog. Shared intermediate tables are kept for later runs at
    ``shared_path``; without one they last as long as the application.
    """

    low: int = 0
    high: int | None = None
    prefix: str | None = None
    location: str | None = None
    tag: str = ""
    params: Mapping[str, Any] = field(default_factory=dict)
    shared_path: str | None = None
    window: Window = (None, None)


def new_partitions(
    spark: SparkSession, pipelines: Mapping[str, Pipeline], pipeline: Pipeline, spec: TableSpec, options: DerivedOptions
) -> list[int]:
    """The work list of a derived table, newest first, from file listings alone."""
    part = pipeline.partition
    given = [
        stage_partitions(spark, pipelines[owner].path(name, stage), part, **window_options(*options.window))
        for (owner, name), stage in spec.inputs.items()
    ]
    done = stage_partitions(spark, pipeline.path(spec.name, "derived"), part)
    return [r[part] for r in common_new(given, done, part, options.low, options.high).collect()]


def shared_temp(
    spark: SparkSession,
    path: str,
    sql: str,
    values: Mapping[str, Any],
    inputs: Mapping[str, DataFrame],
    partition: str,
    partitions: list[int],
    files: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """An intermediate table kept between runs, and whether it was built now.

    It is a written table, so every derived table of the run and the next run can read it. It is kept only if it
    holds exactly the wanted partitions and was built by the same SQL from the same files, of the same sizes and times;
    otherwise it is built again, and must then hold rows. ``files`` lists the files of the inputs; without it they are
    found in the inputs' own metadata.
    """
    rows = run_template(spark, sql, values, inputs, {"snapshot_timestamps": partitions})
    if partition not in rows.columns:
        raise ContractError(f"a shared table must have the column {partition}")
    kept = spark.read.schema(rows.schema)
    origin = _fingerprint(render(sql, values), rows, inputs, files)
    if path_exists(spark, f"{path}/_{BUILT_BY}/{origin}") and same_partitions(
        stage_partitions(spark, path, partition), partitions, partition
    ):
        return kept.parquet(path), False
    gathered = rows.hint("rebalance", partition)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(path)
    set_mark(spark, path, BUILT_BY, origin)
    return assert_not_empty(kept.parquet(path), path), True


# The kind of mark that says what a shared table was built by.
BUILT_BY = "built_by"


def _fingerprint(sql: str, rows: DataFrame, inputs: Mapping[str, DataFrame], files: DataFrame | None) -> str:
    """A digest of the rendered SQL, the result's schema and the files of every input."""
    if files is not None:
        found = [files_fingerprint(files)]
    else:
        found = [f"{name}={files_fingerprint(_files_of(frame))}" for name, frame in sorted(inputs.items())]
    return hashlib.sha256(json.dumps([sql, rows.schema.json(), found]).encode()).hexdigest()


def _files_of(frame: DataFrame) -> DataFrame:
    """The files that a frame is read from; a frame that is not read from files has none."""
    try:
        known = frame.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    except AnalysisException:
        return frame.sparkSession.createDataFrame([], "file_path string, file_size long, file_modification_time timestamp")
    return known.distinct()


def input_files(
    spark: SparkSession, pipelines: Mapping[str, Pipeline], spec: TableSpec, partitions: list[int]
) -> DataFrame:
    """The files of all inputs' chosen partitions, from their listings: nothing is opened."""
    frames = []
    for (owner, name), stage in spec.inputs.items():
        home = pipelines[owner]
        listed = stage_files(spark, home.path(name, stage), home.partition)
        chosen = listed.where(F.col(home.partition).isin([int(p) for p in partitions]))
        frames.append(chosen.select(F.lit(f"{owner}.{name}").alias("input"), "file", "size", "modified"))
    return reduce(DataFrame.unionByName, frames)


def run_derived(
    spark: SparkSession,
    pipelines: Mapping[str, Pipeline],
    pipeline: str,
    tables: list[str] | None = None,
    options: DerivedOptions = DerivedOptions(),
    hooks: Hooks | None = None,
) -> dict[str, list[int]]:
    """Build every chosen derived table from its new partitions; gives the partitions of each.

    Table-scoped intermediates stay lazy, so the table's whole build is one plan that runs when it is published.
    """
    home, built = pipelines[pipeline], {}
    part = home.partition
    (hooks or Hooks()).install(spark)
    for spec in home.select(tables, ["derived"], ["derived"]):
        partitions = new_partitions(spark, pipelines, home, spec, options)
        built[spec.name] = partitions
        if not partitions:
            continue
        frames = named_inputs(input_scans(spark, pipelines, pipeline, spec.name, partitions), pipeline)
        values = template_values(part, home.env, partitions, options.tag, options.params, table_name=spec.name)
        args = {"snapshot_timestamps": partitions}
        shared = (home.shared_sql.get("derived") or {}) if spec.uses_shared_sql else {}
        files = settle(input_files(spark, pipelines, spec, partitions), "input-files") if shared else None
        for name, sql in shared.items():
            path = f"{options.shared_path or workspace(spark)}/shared/{home.name}/{name}"
            frames[name], _ = shared_temp(spark, path, sql, values, frames, part, partitions, files)
            # What is built from this table has its files among its own.
            own = stage_files(spark, path, part).select(F.lit(f"shared.{name}").alias("input"), "file", "size", "modified")
            files = files.unionByName(own)
        for name, sql in spec.temp_sql.items():
            frames[name] = run_template(spark, sql, values, frames, args)
        sql = final_sql(spec, hooks)
        wanted, path = spec.contract("derived"), home.path(spec.name, "derived")
        rows = run_template(spark, sql, values, frames, args)
        rows = apply_sql(rows, "derived", spec.name, hooks or Hooks(), SqlContext(spark, sql, wanted, path))
        publish(rows, path, wanted, unit=part, units=partitions)
        if options.prefix is not None:
            register(spark, home, spec.name, "derived", options.prefix, options.location)
    return built


def named_inputs(scans: Mapping[tuple[str, str], DataFrame], home: str) -> dict[str, DataFrame]:
    """Inputs under the names that templates use: the table's, and ``<pipeline>__<table>``.

    Where two pipelines have a table of one name, the short name is the home pipeline's table.
    """
    frames = {name: frame for (_, name), frame in scans.items()}
    frames.update({name: frame for (owner, name), frame in scans.items() if owner == home})
    frames.update({f"{owner}__{name}": frame for (owner, name), frame in scans.items()})
    return frames


def final_sql(spec: TableSpec, hooks: Hooks | None) -> str:
    """The one final query, named as the table unless the table has its own hook."""
    names = list(spec.final_sql)
    hooked = hooks is not None and spec.name in hooks.sql
    if not names or (not hooked and names != [spec.name]):
        raise ContractError(f"derived table '{spec.name}' needs exactly one final query with its own name")
    return spec.final_sql[names[0]]
