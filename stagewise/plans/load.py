"""The templated-SQL load of new landing partitions."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators.ledger import fresh_partitions, record_files, take_stock
from stagewise.operators.partitions import drop_partitions, unprocessed_all
from stagewise.operators.shaping import common_columns
from stagewise.plans.hooks import Hooks, SqlContext, apply_sql
from stagewise.plans.templates import run_template, template_values
from stagewise.sinks.write import publish
from stagewise.sources.inventory import Window, window_options
from stagewise.sources.scans import scan_partitions
from stagewise.spec import CHECKED_STAGES, Pipeline, TableSpec


@dataclass(frozen=True)
class LoadOptions:
    """``ledger`` is the path of a file ledger: partitions are then chosen by their new files, not by the output's."""

    input_stage: str = "processed"
    output_stage: str = "curated"
    match_table_name: bool = False
    consume: bool = False
    tag: str = ""
    params: Mapping[str, Any] = field(default_factory=dict)
    window: Window = (None, None)
    ledger: str | None = None


def load_contract(spec: TableSpec, stage: str, partition: str) -> Contract:
    """The stage's contract as the load reads it.

    The landing partition is added as a not-null long, columns that are cast after reading keep their original
    type, and null-typed columns go.
    """
    contract = spec.contract(stage)
    casts = spec.lint.casts if spec.lint and stage in CHECKED_STAGES else ()
    originals = [ColumnSpec(c.name, c.original, nullable=True) for c in casts]
    contract = contract.with_columns(ColumnSpec(partition, "int64", nullable=False), *originals)
    return contract.with_partitions(partition).without(contract.null_typed())


def choose_sql(pipeline: Pipeline, spec: TableSpec, match_table_name: bool = False) -> str:
    """The first shared query for the table's kind, or the first whose name occurs in the table's name."""
    queries = pipeline.shared_sql.get(spec.kind) or {}
    names = [n for n in queries if not match_table_name or n in spec.name]
    if not names:
        raise ContractError(f"no shared SQL for table '{spec.name}'")
    return queries[names[0]]


def sql_load(
    spark: SparkSession,
    pipeline: Pipeline,
    table: str,
    options: LoadOptions = LoadOptions(),
    sql: str | None = None,
    partitions: list[int] | None = None,
    hooks: Hooks | None = None,
) -> list[int]:
    """Load the partitions that the output stage lacks, or that have new files by a ledger, and give them back.

    Only the folders of those partitions are listed and read; the columns the query needs and its own filters
    reach the scan. The result is checked against the output contract before any of it is published.
    """
    spec, part = pipeline.table(table), pipeline.partition
    given, done = options.input_stage, options.output_stage
    source = pipeline.path(table, given)
    stock = None
    if options.ledger:
        stock = take_stock(spark, source, part, options.ledger, spec.formats[given], **window_options(*options.window))
        partitions = fresh_partitions(stock, part) if partitions is None else partitions
    elif partitions is None:
        partitions = unprocessed_all(spark, pipeline, [table], given, done, window=options.window).get(table, [])
    if not partitions:
        _note(stock, options.ledger, part)
        return []
    stored, wanted = load_contract(spec, given, part), spec.contract(done)
    drifted = given in CHECKED_STAGES
    frame = scan_partitions(
        spark, source, spec.formats[given], stored, part, partitions, drifted=drifted, **spec.read_options
    )
    sql = sql or choose_sql(pipeline, spec, options.match_table_name)
    columns = common_columns(stored, wanted)
    if not columns and "sql_columns" in sql:
        raise ContractError(f"'{table}' has no column with one type at both {given} and {done}")
    values = template_values(
        part,
        pipeline.env,
        partitions,
        options.tag,
        options.params,
        table_name=table,
        sql_columns=", ".join(f"`{c}`" for c in columns),
    )
    (hooks or Hooks()).install(spark)
    result = run_template(spark, sql, values, {table: frame}, {"snapshot_timestamps": list(partitions)})
    path = pipeline.path(table, done)
    result = apply_sql(result, spec.kind, table, hooks or Hooks(), SqlContext(spark, sql, wanted, path))
    # Input folders are landing partitions already; rows only have to be gathered by any further partition.
    publish(result, path, wanted, unit=part, gather=len(wanted.partitions) > 1, units=partitions)
    _note(stock, options.ledger, part)
    if options.consume and given != "raw_hist":
        drop_partitions(spark, source, part, partitions)
    return partitions


def _note(stock: DataFrame | None, ledger: str | None, partition: str) -> None:
    """Enter what was looked at into the ledger, under the time of this run."""
    if stock is not None:
        record_files(stock, ledger, partition, time.time_ns() // 1000)
