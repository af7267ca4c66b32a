"""What goes by history: late files in loaded days, reuse by what something was built from, text output run twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.operators.history import check_key_history, write_key_filters
from stagewise.operators.shaping import ShapeOptions
from stagewise.plans.derived import shared_temp
from stagewise.plans.hooks import Hooks, ShapeContext
from stagewise.plans.load import LoadOptions, sql_load
from stagewise.plans.shape import run_shape
from stagewise.plans.templates import template_values
from stagewise.session import scratch_path
from stagewise.sources.files import rename_path
from stagewise.sources.inventory import file_inventory, path_below
from stagewise.spec import TableSpec
from workload.jobs import (
    CURATED_EVENTS,
    LOAD_SQL,
    OPEN_ORDERS,
    ORDERS,
    RAW_COLUMNS,
    RAW_EVENTS,
    event_table,
    land_events,
    pipeline,
    read_events,
)
from workload.registry import EVENT_DAY, ORDER_MONTH, PART, SHIP_MONTH, events, land, lineitem, orders, query

# Rows with such a value come in late files.
LATE = 480


@query(
    "ledger_late_files",
    f"""
    WITH e AS (SELECT {EVENT_DAY} AS land_ts, value > {LATE} AS late FROM events WHERE value IS NOT NULL),
    days AS (SELECT land_ts, count(*) AS n, count(*) FILTER (NOT late) AS early FROM e GROUP BY land_ts)
    SELECT 'first' AS run, land_ts, early AS n FROM days WHERE early > 0
    UNION ALL SELECT 'late', land_ts, n FROM days WHERE early < n
    """,
)
def q_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads by a file ledger: late files choose their days again, a renamed old file and a third run choose nothing."""
    base = scratch_path(spark, "ledger")
    rows, late = events(spark, sf_dir).where("value IS NOT NULL").select(*RAW_COLUMNS), F.col("value") > LATE
    path = f"{base}/raw_hist/pass/events"
    shop = pipeline(base, event_table(), shared_sql={"default": {"raw_to_curated": LOAD_SQL}})
    options = LoadOptions(input_stage="raw_hist", ledger=f"{base}/ledger/events")
    counts = []
    for run in ("first", "late", "third"):
        if run != "third":
            delivery = rows.where(late if run == "late" else ~late)
            delivery.hint("rebalance", PART).write.mode("append").partitionBy(PART).parquet(path)
        if run == "late":
            # In a day without late files one is renamed: no new data.
            quiet = rows.groupBy(PART).agg(F.max(late).alias("late")).where("NOT late").select(PART)
            for day in quiet.orderBy(PART).limit(1).collect():
                file = path_below(file_inventory(spark, f"{path}/{PART}={day[PART]}").first()["path"], path)
                rename_path(spark, f"{path}/{file}", f"{path}/{file.replace('part-', 'moved-')}")
        days = sql_load(spark, shop, "events", options)
        found = read_events(spark, base).where(F.col(PART).isin(days)) if days else read_events(spark, base).limit(0)
        kept = scratch_path(spark, "counts")
        found.groupBy(PART).agg(F.count("*").alias("n")).write.parquet(kept)
        counts.append(spark.read.schema(f"{PART} long, n long").parquet(kept).select(F.lit(run).alias("run"), PART, "n"))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "shared_temp_rewritten_input",
    f"""
    WITH o AS (SELECT *, {ORDER_MONTH} AS p FROM orders WHERE o_orderstatus <> 'F')
    SELECT 'built' AS run, true AS built, p AS land_ts, count(*) AS n FROM o WHERE o_totalprice >= 50000 GROUP BY ALL
    UNION ALL SELECT 'same', false, p, count(*) FROM o WHERE o_totalprice >= 50000 GROUP BY ALL
    UNION ALL SELECT 'rewritten', true, p, count(*) FROM o GROUP BY ALL
    """,
)
def q_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An intermediate table is used again for the same files, and built again when one was rewritten under its name."""
    base = scratch_path(spark, "rewritten")
    rows = orders(spark, sf_dir).select(*ORDERS.column_names)
    months = [r[PART] for r in rows.where("o_orderstatus <> 'F' AND o_totalprice >= 50000").select(PART).distinct().collect()]
    rows = rows.where(F.col(PART).isin(months))
    out = []
    for run in ("built", "same", "rewritten"):
        if run != "same":
            # One file for each month, always of one name.
            fresh = land(rows if run == "rewritten" else rows.where("o_totalprice >= 50000"), label="delivery")
            for file in file_inventory(spark, fresh).select("path", F.regexp_extract("path", f"{PART}=(\\d+)", 0).alias("day")).collect():
                rename_path(spark, f"{fresh}/{path_below(file['path'], fresh)}", f"{base}/orders.{run}/{file['day']}/part-0.parquet")
            if run == "rewritten":
                rename_path(spark, f"{base}/orders", f"{base}/orders.before")
            rename_path(spark, f"{base}/orders.{run}", f"{base}/orders")
        landed = spark.read.schema(ORDERS.struct()).parquet(f"{base}/orders")
        values = template_values(PART, "test", months)
        table, built = shared_temp(spark, f"{base}/open", OPEN_ORDERS, values, {"orders": landed}, PART, months)
        counts = table.groupBy(F.col(PART).cast("long").alias(PART)).agg(F.count("*").alias("n"))
        kept = scratch_path(spark, "counts")
        counts.select(F.lit(run).alias("run"), F.lit(built).alias("built"), PART, "n").write.parquet(kept)
        out.append(spark.read.schema(f"run string, built boolean, {PART} long, n long").parquet(kept))
    return out[0].union(out[1]).union(out[2])


@query(
    "run_shape_csv",
    f"""
    SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, event_type, {EVENT_DAY} AS land_ts, 0 AS chosen_again
    FROM events WHERE {EVENT_DAY} // 86400 % 2 = 1
    """,
)
def q_shape_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text output is staged, checked and swapped, and days that the shaping leaves nothing of are not chosen again."""
    def odd_days(rows: DataFrame, ctx: ShapeContext) -> DataFrame:
        return rows.where(F.col(PART) / 86400 % 2 == 1).select(*ctx.wanted.column_names)

    base, hooks = scratch_path(spark, "shape-csv"), Hooks()
    land_events(spark, sf_dir, base)
    hooks.register("events", odd_days)
    spec = TableSpec(
        "events", {"raw_hist": RAW_EVENTS, "curated": CURATED_EVENTS}, {"raw_hist": "parquet", "curated": "csv"}, "custom"
    )
    shop = pipeline(base, spec)
    run_shape(spark, shop, "events", options=ShapeOptions(), hooks=hooks)
    again = run_shape(spark, shop, "events", options=ShapeOptions(), hooks=hooks)
    rows = spark.read.schema(CURATED_EVENTS.struct()).option("header", True).csv(f"{base}/curated/events")
    return rows.withColumn("chosen_again", F.lit(len(again)))


LINE_KEYS = Contract(
    "lineitem",
    (ColumnSpec("l_orderkey", "int64"), ColumnSpec("l_linenumber", "int64"), ColumnSpec(PART, "int64")),
    (PART,),
)
# The month that arrives.
NEW_MONTH = f"(SELECT max({SHIP_MONTH}) FROM lineitem WHERE {SHIP_MONTH} <= 19960601)"


@query(
    "primary_key_history",
    f"""
    WITH l AS (SELECT l_orderkey, {SHIP_MONTH} AS land_ts FROM lineitem), m AS (SELECT {NEW_MONTH} AS latest)
    SELECT l_orderkey, land_ts, count(*) AS occurrences FROM l JOIN m ON land_ts < latest
    WHERE l_orderkey IN (SELECT l_orderkey FROM l JOIN m ON land_ts = latest) GROUP BY ALL
    """,
)
def q_key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the newest month that have lines in earlier months; months whose filter has none are not read."""
    path = scratch_path(spark, "keys")
    rows = lineitem(spark, sf_dir).select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), PART)
    latest = rows.where(F.col(PART) <= 19960601).agg(F.max(PART)).first()[0]
    old = rows.where(F.col(PART) != latest)
    land(old, path)
    write_key_filters(old, path, ["l_orderkey"], PART)
    return check_key_history(rows.where(F.col(PART) == latest), path, LINE_KEYS, ["l_orderkey"], PART, before=latest)
