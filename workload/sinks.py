"""Sinks and catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.session import scratch_path
from stagewise.sinks.catalog import register
from stagewise.sinks.switch import create_switched, drop_replaced, publish_switched
from stagewise.sinks.write import publish, write_partitioned
from stagewise.sources.scans import read_stage
from stagewise.spec import Pipeline, TableSpec
from workload.registry import EVENT_DAY, PART, SHIP_MONTH, events, land, lineitem, query

TYPED_EVENTS = Contract(
    "events",
    (
        ColumnSpec("event_id", "int64"),
        ColumnSpec("value", "float64"),
        ColumnSpec("ts", "timestamp(ns)"),
        ColumnSpec("event_type", "string"),
        ColumnSpec(PART, "int64"),
    ),
    (PART, "event_type"),
)


@query("write_partitioned", f"SELECT event_id, value, ts, event_type, {EVENT_DAY} AS land_ts FROM events")
def q_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    write_partitioned(events(spark, sf_dir), path, TYPED_EVENTS)
    return spark.read.schema(TYPED_EVENTS.struct()).parquet(path)


LINES = Contract(
    "lineitem",
    (
        ColumnSpec("l_orderkey", "int64"),
        ColumnSpec("l_linenumber", "int32"),
        ColumnSpec("l_quantity", "float64"),
        ColumnSpec("l_extendedprice", "float64"),
        ColumnSpec("l_returnflag", "string"),
        ColumnSpec("l_shipdate", "timestamp(ms)"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)


@query(
    "publish_validated",
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate, {SHIP_MONTH} AS land_ts
    FROM lineitem
    """,
)
def q_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    publish(lineitem(spark, sf_dir).select(*LINES.column_names), path, LINES, unit=PART)
    return spark.read.schema(LINES.struct()).parquet(path)


@query(
    "write_formats",
    """
    SELECT f.fmt, event_id, ts, event_type, value, CAST(ts AS DATE) AS day FROM events,
        (VALUES ('csv'), ('json'), ('parquet')) f(fmt)
    """,
)
def q_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = Contract(
        "events",
        (
            ColumnSpec("event_id", "int64"),
            ColumnSpec("ts", "timestamp(ns)"),
            ColumnSpec("event_type", "string"),
            ColumnSpec("value", "float64"),
            ColumnSpec("day", "date32"),
        ),
    )
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    frames = []
    for fmt in ("csv", "json", "parquet"):
        path = scratch_path(spark, fmt)
        write_partitioned(rows, path, wanted, fmt)
        frames.append(read_stage(spark, path, fmt, wanted).withColumn("fmt", F.lit(fmt)))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("register_and_recover", f"SELECT event_id, value, ts, event_type, {EVENT_DAY} AS land_ts FROM events")
def q_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "registered")
    land(events(spark, sf_dir).drop("user_id", "props"), f"{base}/events")
    contract = Contract("events", TYPED_EVENTS.columns, (PART,))
    spec = TableSpec("events", {"curated": contract}, {"curated": "parquet"})
    shop = Pipeline("shop", f"t{uuid.uuid4().hex[:8]}", {"curated": base}, {"events": spec}, PART)
    name = register(spark, shop, "events", "curated", "sw", f"{base}_database")
    return spark.table(name)


@query(
    "publish_switched",
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate, {SHIP_MONTH} AS land_ts
    FROM lineitem WHERE l_returnflag <> 'R' OR {SHIP_MONTH} < 19970101
    """,
)
def q_switched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months are published twice by switching their locations in the catalog; what was replaced is dropped."""
    path, database = scratch_path(spark, "switched"), f"sw_{uuid.uuid4().hex[:8]}"
    rows = lineitem(spark, sf_dir).select(*LINES.column_names)
    name = create_switched(spark, database, LINES, path)
    publish_switched(rows, name, path, LINES, PART)
    late = rows.where((F.col(PART) >= 19970101) & (F.col("l_returnflag") != "R"))
    months = [r[PART] for r in rows.where(F.col(PART) >= 19970101).select(PART).distinct().collect()]
    run = publish_switched(late, name, path, LINES, PART, units=months)
    drop_replaced(spark, name, path, LINES, before=run)
    return spark.table(name).select(*LINES.column_names)

