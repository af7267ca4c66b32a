"""The batch jobs and the stream, end to end, over landed copies of the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.operators.shaping import ShapeOptions, default_shape
from stagewise.plans.derived import DerivedOptions, run_derived, shared_temp
from stagewise.plans.hooks import Hooks, ShapeContext, SqlContext
from stagewise.plans.lint import run_lint
from stagewise.plans.load import LoadOptions, sql_load
from stagewise.plans.shape import run_shape
from stagewise.plans.templates import template_values
from stagewise.session import scratch_path
from stagewise.spec import LintOptions, Pipeline, TableSpec
from stagewise.streaming.ingest import ingest_now
from workload.registry import EVENT_DAY, ORDER_MONTH, PART, SHIP_MONTH, events, land, lineitem, orders, query

RAW_EVENTS = Contract(
    "events",
    (
        ColumnSpec("event_id", "int64", nullable=False),
        ColumnSpec("event_type", "string", enum=("click", "error", "purchase", "signup", "view")),
        ColumnSpec("value", "float64", maximum=450),
        ColumnSpec("props", "null"),
        ColumnSpec("user_id", "int64"),
    ),
)
CURATED_EVENTS = Contract(
    "events",
    (
        ColumnSpec("event_id", "int64"),
        ColumnSpec("value", "float64"),
        ColumnSpec("user_id", "int32"),
        ColumnSpec("event_type", "string"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)


def pipeline(base: str, spec: TableSpec, **more) -> Pipeline:
    paths = {s: f"{base}/{s}" for s in ("land", "raw", "raw_hist", "processed", "curated", "derived")}
    return Pipeline("shop", f"t{uuid.uuid4().hex[:8]}", paths, {spec.name: spec}, PART, **more)


def event_table(kind: str = "default", curated: Contract = CURATED_EVENTS, raw: str = "parquet") -> TableSpec:
    return TableSpec(
        "events",
        {"raw_hist": RAW_EVENTS, "curated": curated},
        {"land": raw, "raw_hist": raw, "curated": "parquet"},
        kind,
        LintOptions(required=True, allow_missing_cols=False),
    )


RAW_COLUMNS = ["event_id", "event_type", "value", "props", "user_id", PART]
# Days with such a value count as loaded before.
DONE = 450


def land_events(
    spark: SparkSession, sf_dir: str, base: str, stage: str = "raw_hist/pass", fmt: str = "parquet"
) -> None:
    land(events(spark, sf_dir).select(*RAW_COLUMNS), f"{base}/{stage}/events", fmt)


def earlier_output(spark: SparkSession, sf_dir: str, base: str) -> None:
    """An earlier run's output: the rows it kept of the days that had a large value."""
    large = events(spark, sf_dir).where(F.col("value") > DONE)
    land(large.select("event_id", "value", F.col("user_id").cast("int"), "event_type", PART), f"{base}/curated/events")


LOAD_SQL = """
    SELECT {{ sql_columns }}, CAST(user_id AS INT) AS user_id, {{ primary_partition }}
    FROM {{ database_name }}.{{ table_name }}
    WHERE {{ primary_partition }} IN ({{ snapshot_timestamps }})
"""
# The days an earlier run loaded keep what it wrote; all others are loaded in full.
LOADED_ROWS = f"""
    SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, event_type, {EVENT_DAY} AS land_ts FROM events
    WHERE {EVENT_DAY} NOT IN (SELECT {EVENT_DAY} FROM events WHERE value > {DONE}) OR value > {DONE}
"""


def read_events(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(CURATED_EVENTS.struct()).parquet(f"{base}/curated/events")


@query("sql_load", LOADED_ROWS)
def q_sql_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "load")
    land_events(spark, sf_dir, base)
    earlier_output(spark, sf_dir, base)
    shop = pipeline(base, event_table(), shared_sql={"default": {"raw_to_curated": LOAD_SQL}})
    sql_load(spark, shop, "events", LoadOptions(input_stage="raw_hist"))
    return read_events(spark, base)


@query("custom_sql_hook", LOADED_ROWS.replace("event_id, value,", "event_id, value * 2 AS value,").replace(
    f"OR value > {DONE}", f"UNION ALL SELECT event_id, value, CAST(user_id AS INTEGER), event_type, {EVENT_DAY} "
    f"FROM events WHERE value > {DONE}"
))
def q_sql_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    def double(rows: DataFrame, ctx: SqlContext) -> DataFrame:
        return rows.withColumn("value", F.col("value") * 2).select(*ctx.wanted.column_names)

    base, hooks = scratch_path(spark, "load"), Hooks()
    land_events(spark, sf_dir, base)
    earlier_output(spark, sf_dir, base)
    hooks.register_sql("events", double)
    shop = pipeline(base, event_table("custom"), shared_sql={"custom": {"raw_to_curated": LOAD_SQL}})
    sql_load(spark, shop, "events", LoadOptions(input_stage="raw_hist"), hooks=hooks)
    return read_events(spark, base)


SHAPED_EVENTS = CURATED_EVENTS.with_columns(
    ColumnSpec("etl_version", "string"), ColumnSpec("note", "string"), ColumnSpec("source", "string")
)


@query(
    "run_shape",
    f"""
    SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, event_type, {EVENT_DAY} AS land_ts,
           'v1' AS etl_version, CAST(NULL AS VARCHAR) AS note, 'web' AS source
    FROM events
    """,
)
def q_run_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "shape")
    land_events(spark, sf_dir, base, fmt="csv")
    shop = pipeline(base, event_table(curated=SHAPED_EVENTS, raw="csv"))
    run_shape(spark, shop, "events", options=ShapeOptions(tag="v1", attributes={"source": "web"}))
    return spark.read.schema(SHAPED_EVENTS.struct()).parquet(f"{base}/curated/events")


@query(
    "custom_hook",
    f"""
    SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, upper(event_type) AS event_type, {EVENT_DAY} AS land_ts
    FROM events WHERE value >= 10
    """,
)
def q_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    def loud(rows: DataFrame, ctx: ShapeContext) -> DataFrame:
        shaped = default_shape(rows, ctx.given, ctx.wanted, ctx.options)
        return shaped.where("value >= 10").withColumn("event_type", F.upper("event_type"))

    base, hooks = scratch_path(spark, "hook"), Hooks()
    land_events(spark, sf_dir, base)
    hooks.register("events", loud)
    run_shape(spark, pipeline(base, event_table("custom")), "events", hooks=hooks)
    return read_events(spark, base)


@query(
    "run_lint",
    f"""
    SELECT CASE WHEN max(value) > 450 THEN 'fail' ELSE 'pass' END AS area, {EVENT_DAY} AS land_ts, count(*) AS n
    FROM events GROUP BY 2
    """,
)
def q_run_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a value above the contract's maximum go to the fail area as a whole."""
    base = scratch_path(spark, "lint")
    land_events(spark, sf_dir, base, stage="land", fmt="csv")
    run_lint(spark, pipeline(base, event_table(raw="csv"), all_must_pass=False), run_ts=1706745600)
    path = f"{base}/raw_hist"
    names = ["event_id", "event_type", "value", "props", "user_id"]
    files = spark.read.schema(", ".join(f"{n} string" for n in names)).option("header", True).option(
        "recursiveFileLookup", True
    ).option("pathGlobFilter", "*.csv").csv(path)
    where = F.col("_metadata.file_path")
    area = F.regexp_extract(where, "/(pass|fail)/", 1).alias("area")
    day = F.regexp_extract(where, f"{PART}=([0-9]+)", 1).cast("long").alias(PART)
    return files.select(area, day).groupBy("area", PART).agg(F.count("*").alias("n"))


@query(
    "ingest_available_now",
    f"""
    SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, event_type, {EVENT_DAY} AS land_ts
    FROM events WHERE value <= 450
    """,
)
def q_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and two runs; the second run only takes the second delivery."""
    base = scratch_path(spark, "ingest")
    rows = events(spark, sf_dir).select(*RAW_COLUMNS)
    shop = pipeline(base, event_table())
    late = F.col("event_type") == "signup"
    for delivery in (rows.where(~late), rows.where(late)):
        delivery.hint("rebalance", PART).write.mode("append").partitionBy(PART).parquet(f"{base}/raw_hist/pass/events")
        options = ShapeOptions(partition=PART)
        ingest_now(spark, shop, "events", f"{base}/checkpoint", quarantine=f"{base}/quarantine", options=options)
    return read_events(spark, base)


# ---- derived tables ---------------------------------------------------------------------------------------------

ORDERS = Contract(
    "orders",
    (
        ColumnSpec("o_orderkey", "int64"),
        ColumnSpec("o_orderstatus", "string"),
        ColumnSpec("o_totalprice", "float64"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)
LINES = Contract(
    "lineitem",
    (
        ColumnSpec("l_orderkey", "int64"),
        ColumnSpec("l_extendedprice", "float64"),
        ColumnSpec("l_returnflag", "string"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)
REVENUE = Contract(
    "revenue",
    (
        ColumnSpec("o_orderstatus", "string"),
        ColumnSpec("l_returnflag", "string"),
        ColumnSpec("n_lines", "int64"),
        ColumnSpec("amount", "float64"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)

FINAL_SQL = """
    SELECT o_orderstatus, l_returnflag, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount, o.{{ primary_partition }}
    FROM {orders} o JOIN {lines} l ON o_orderkey = l_orderkey
    WHERE o.{{ primary_partition }} IN ({{ snapshot_timestamps }})
    GROUP BY o_orderstatus, l_returnflag, o.{{ primary_partition }}
"""
DIRECT = FINAL_SQL.replace("{orders}", "{{ database_name }}.orders").replace("{lines}", "{{ database_name }}.lineitem")
TEMP = FINAL_SQL.replace("{orders}", "__temp__.open_orders").replace("{lines}", "__temp__.shipped")
OPEN_ORDERS = """
    SELECT o_orderkey, o_orderstatus, land_ts FROM {{ database_name }}.orders
    WHERE o_orderstatus <> 'F' AND {{ primary_partition }} IN ({{ snapshot_timestamps }})
"""
SHIPPED = """
    SELECT l_orderkey, l_returnflag, l_extendedprice, land_ts FROM {{ database_name }}.lineitem
    WHERE l_returnflag <> 'R'
"""

# Months that both inputs have, inside the cutoff.
LOW, HIGH = 19950601, 20010601
NEW_MONTHS = f"""
    SELECT {ORDER_MONTH} AS p FROM orders INTERSECT SELECT {SHIP_MONTH} FROM lineitem
"""


def revenue_sql(where: str = "true") -> str:
    return f"""
    WITH months AS (SELECT p FROM ({NEW_MONTHS}) WHERE p BETWEEN {LOW} AND {HIGH}),
    o AS (SELECT *, {ORDER_MONTH} AS p FROM orders), l AS (SELECT *, {SHIP_MONTH} AS q FROM lineitem)
    SELECT o_orderstatus, l_returnflag, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount, p AS land_ts
    FROM o JOIN l ON o_orderkey = l_orderkey
    WHERE p IN (SELECT p FROM months) AND q IN (SELECT p FROM months) AND {where}
    GROUP BY ALL
    """


def derived_pipeline(spark: SparkSession, sf_dir: str, **spec) -> Pipeline:
    base = scratch_path(spark, "derived")
    land(orders(spark, sf_dir).select(*ORDERS.column_names), f"{base}/curated/orders")
    land(lineitem(spark, sf_dir).select(*LINES.column_names), f"{base}/curated/lineitem")
    shared = spec.pop("shared_sql", {})
    tables = {
        "orders": TableSpec("orders", {"curated": ORDERS}, {"curated": "parquet"}),
        "lineitem": TableSpec("lineitem", {"curated": LINES}, {"curated": "parquet"}),
        "revenue": TableSpec(
            "revenue",
            {"derived": REVENUE},
            {"derived": "parquet"},
            "derived",
            inputs={("shop", "orders"): "curated", ("shop", "lineitem"): "curated"},
            **spec,
        ),
    }
    paths = {"curated": f"{base}/curated", "derived": f"{base}/derived"}
    return Pipeline("shop", f"t{uuid.uuid4().hex[:8]}", paths, tables, PART, shared_sql=shared)


def build(spark: SparkSession, shop: Pipeline) -> DataFrame:
    base = shop.base_path("derived")
    options = DerivedOptions(LOW, HIGH, prefix="sw", location=f"{base}_database", shared_path=f"{base}_shared")
    run_derived(spark, {"shop": shop}, "shop", options=options)
    return spark.table(f"sw_shop_derived_{shop.env}.revenue")


@query("derived_final", revenue_sql())
def q_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, derived_pipeline(spark, sf_dir, final_sql={"revenue": DIRECT}))


@query("derived_with_temp", revenue_sql("o_orderstatus <> 'F' AND l_returnflag <> 'R'"))
def q_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = derived_pipeline(
        spark, sf_dir, temp_sql={"open_orders": OPEN_ORDERS, "shipped": SHIPPED}, final_sql={"revenue": TEMP}
    )
    return build(spark, shop)


@query(
    "shared_temp_reuse",
    f"""
    WITH o AS (SELECT *, {ORDER_MONTH} AS p FROM orders WHERE o_orderstatus <> 'F')
    SELECT 'all' AS run, true AS built, p AS land_ts, count(*) AS n FROM o GROUP BY ALL
    UNION ALL SELECT 'again', false, p, count(*) FROM o GROUP BY ALL
    UNION ALL SELECT 'fewer', true, p, count(*) FROM o WHERE p >= 19980101 GROUP BY ALL
    """,
)
def q_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built, reused for the same partitions, and built again for fewer of them."""
    base = scratch_path(spark, "shared")
    land(orders(spark, sf_dir).select(*ORDERS.column_names), f"{base}/orders")
    landed = spark.read.schema(ORDERS.struct()).parquet(f"{base}/orders")
    months = [r[PART] for r in landed.where("o_orderstatus <> 'F'").select(PART).distinct().collect()]
    out = []
    for run, wanted in (("all", months), ("again", months), ("fewer", [m for m in months if m >= 19980101])):
        values = template_values(PART, "test", wanted)
        rows, built = shared_temp(spark, f"{base}/open", OPEN_ORDERS, values, {"orders": landed}, PART, wanted)
        counts = rows.groupBy(F.col(PART).cast("long").alias(PART)).agg(F.count("*").alias("n"))
        kept = scratch_path(spark, "counts")
        counts.select(F.lit(run).alias("run"), F.lit(built).alias("built"), PART, "n").write.parquet(kept)
        out.append(spark.read.schema(f"run string, built boolean, {PART} long, n long").parquet(kept))
    return out[0].union(out[1]).union(out[2])
