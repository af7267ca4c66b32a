"""New files as a stream: the same shaping and row checks, without listing the output.

It differs from the batch jobs in two ways. The checkpoint, not the output, says what has been read: deleting output
does not bring the input back. And a late file in a partition that was read before is taken, so rows are always
appended and a partition is never overwritten.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stagewise.contract import ColumnSpec, Contract
from stagewise.functions.checks import NESTED
from stagewise.functions.formats import parse
from stagewise.operators.quality import FAILED, split_valid
from stagewise.operators.shaping import ShapeOptions
from stagewise.plans.hooks import Hooks, ShapeContext, apply_shape
from stagewise.sinks.write import append_batch, under_contract
from stagewise.sources.scans import landed
from stagewise.spec import Pipeline


def stream_source(
    spark: SparkSession, path: str, fmt: str, contract: Contract, max_files: int | None = None, **options: str
) -> DataFrame:
    """A stream of the rows of new files; text formats come as text, so that the type rule sees the cells."""
    fields = [T.StructField(c.name, T.StringType() if _as_text(c, fmt) else c.spark_type) for c in contract.data_columns]
    fields += [T.StructField(p, contract.lookup[p].spark_type) for p in contract.partitions]
    reader = spark.readStream.schema(T.StructType(fields)).format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, enforceSchema=False)
    reader = reader.options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _as_text(spec: ColumnSpec, fmt: str) -> bool:
    return fmt == "csv" or (fmt == "json" and not isinstance(spec.spark_type, NESTED))


def ingest_stream(
    spark: SparkSession,
    pipeline: Pipeline,
    table: str,
    checkpoint: str,
    stage: str = "curated",
    raw_stage: str = "raw_hist",
    options: ShapeOptions = ShapeOptions(),
    hooks: Hooks | None = None,
    quarantine: str | None = None,
    max_files: int | None = None,
) -> list[StreamingQuery]:
    """Take what is new since the last run, then stop: valid rows to the stage, the others to ``quarantine``.

    The source is read once for both. Each batch is written like a batch job's output, its files named by the stream and
    the batch, so that a batch that is run again after a failure replaces its own files. Batch jobs may write the same
    stage.
    """
    spec = pipeline.table(table)
    given, wanted = landed(spec.contract(raw_stage), pipeline.partition), spec.contract(stage)
    given = given.without(given.null_typed())
    path, fmt = pipeline.path(table, raw_stage), spec.formats[raw_stage]
    source = stream_source(spark, path, fmt, given, max_files, **spec.read_options)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:8]
    target, written = pipeline.path(table, stage), spec.formats[stage]
    columns = [c for c in given.data_columns if _as_text(c, fmt)]
    ctx = ShapeContext(table, given, wanted, options)

    def take(rows: DataFrame, batch: int) -> None:
        tag, kept = f"stream-{stream}-{batch}", rows.persist()
        try:
            good, bad = split_valid(kept, given)
            good = good.withColumns({c.name: parse(F.col(f"`{c.name}`"), c) for c in columns})
            shaped = under_contract(apply_shape(good, spec.kind, hooks or Hooks(), ctx), wanted)
            append_batch(shaped, target, wanted.partitions, written, tag)
            if quarantine:
                noted = bad.withColumn(FAILED, F.array_join(FAILED, ","))
                append_batch(noted, quarantine, given.partitions, "parquet", tag)
        finally:
            kept.unpersist()

    query = source.writeStream.foreachBatch(take).option("checkpointLocation", f"{checkpoint}/batches")
    return [query.trigger(availableNow=True).start()]


def ingest_now(*args, **kwargs) -> None:
    """``ingest_stream``, waiting until everything that is there has been taken."""
    for query in ingest_stream(*args, **kwargs):
        query.awaitTermination()
