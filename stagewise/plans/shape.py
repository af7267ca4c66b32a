"""The column-shaping job."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from stagewise.operators.partitions import unprocessed_all
from stagewise.operators.shaping import ShapeOptions
from stagewise.plans.hooks import Hooks, ShapeContext, apply_shape
from stagewise.sinks.write import publish
from stagewise.sources.inventory import Window
from stagewise.sources.scans import landed, scan_partitions
from stagewise.spec import TABLE_KINDS, Pipeline


def run_shape(
    spark: SparkSession,
    pipeline: Pipeline,
    table: str,
    stage: str = "curated",
    raw_stage: str = "raw_hist",
    final_stage: str = "curated",
    options: ShapeOptions = ShapeOptions(),
    hooks: Hooks | None = None,
    null_bad_cells: bool = False,
    window: Window = (None, None),
) -> list[int]:
    """Shape every partition that the final stage lacks and write it at ``stage``; gives those partitions.

    With a ``window``, only those with input files that were modified inside it.

    All of them are read as one frame, whose rows know their partition from their folder. The shaping is a
    projection, so each input split goes to its output file without a shuffle. A CSV cell that is not of its column's
    type fails the job before anything is published, unless ``null_bad_cells``.
    """
    spec, part = pipeline.table(table), pipeline.partition
    todo = unprocessed_all(spark, pipeline, [table], raw_stage, final_stage, TABLE_KINDS, window).get(table, [])
    if not todo:
        return []
    given, wanted = landed(spec.contract(raw_stage), part), landed(spec.contract(stage), part)
    source = pipeline.path(table, raw_stage)
    fmt = spec.formats[raw_stage]
    frame = scan_partitions(
        spark,
        source,
        fmt,
        given,
        part,
        todo,
        partial=True,
        drifted=True,
        strict=not null_bad_cells,
        **spec.read_options,
    )
    options = replace(options, partition=part, env=options.env or pipeline.env, db=options.db or pipeline.name)
    shaped = apply_shape(frame, spec.kind, hooks or Hooks(), ShapeContext(table, given, wanted, options))
    path, written = pipeline.path(table, stage), spec.formats[stage]
    gather = len(wanted.partitions) > 1
    publish(shaped, path, wanted, unit=part, gather=gather, cast=True, units=todo, fmt=written)
    return todo
