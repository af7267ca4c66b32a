"""Joins by time, profiles that add up, and functions of the user's in templates."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.operators.profiles import column_profiles, merge_profiles, profile_report
from stagewise.operators.temporal import asof_join, interval_join, overlap_join
from stagewise.plans.hooks import Hooks
from stagewise.plans.load import LoadOptions, sql_load
from stagewise.session import scratch_path
from workload.jobs import RAW_EVENTS, event_table, land_events, pipeline, read_events
from workload.registry import EVENT_DAY, PART, events, query, table

# A third of all rows has one key.
ASOF_KEY = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"


@query(
    "asof_join",
    f"""
    WITH e AS (SELECT {ASOF_KEY} AS k, ts, event_id, event_type FROM events),
    seen AS (SELECT k, ts AS seen_at, max(event_id) AS seen_id FROM e WHERE event_type <> 'purchase' GROUP BY ALL)
    SELECT p.k, p.ts, p.event_id, s.seen_id FROM (SELECT * FROM e WHERE event_type = 'purchase') p
    ASOF LEFT JOIN seen s ON p.k = s.k AND p.ts >= s.seen_at
    """,
)
def q_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the latest other event before it, in buckets of time small enough to cut the hot key."""
    rows = table(spark, sf_dir, "events").select(F.expr(ASOF_KEY).alias("k"), "ts", "event_id", "event_type")
    bought = F.col("event_type") == "purchase"
    left = rows.where(bought).select("k", "ts", "event_id")
    seen = rows.where(~bought).select("k", F.col("ts").alias("seen_at"), F.col("event_id").alias("seen_id"))
    return asof_join(left, seen, "ts", "seen_at", ["k"], bucket_rows=1_500).select("k", "ts", "event_id", "seen_id")


# Every hundredth line is under way for years.
SHIPPED_DAYS = "CAST(l_quantity AS INTEGER) + CASE WHEN l_orderkey % 100 = 0 THEN 2000 ELSE 0 END"


@query(
    "interval_join",
    f"""
    WITH l AS (
        SELECT l_suppkey % 100 AS k, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS a,
            CAST(l_shipdate AS DATE) + {SHIPPED_DAYS} AS b FROM lineitem
    ), o AS (SELECT o_custkey % 100 AS k, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT o_orderkey, count(*) AS n, CAST(sum(l_orderkey * 10 + l_linenumber) AS BIGINT) AS which
    FROM o JOIN l ON o.k = l.k AND day >= a AND day < b GROUP BY o_orderkey
    """,
)
def q_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of a region were under way on the day of an order."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 100).alias("k"),
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("a"),
        F.date_add(F.to_date("l_shipdate"), F.expr(SHIPPED_DAYS)).alias("b"),
    )
    days = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 100).alias("k"), "o_orderkey", F.to_date("o_orderdate").alias("day")
    )
    which = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    found = interval_join(days, lines, "day", "a", "b", ["k"], sums={"n": F.lit(1), "which": which})
    return found.groupBy("o_orderkey").agg(F.sum("n").alias("n"), F.sum("which").alias("which"))


@query(
    "overlap_join",
    """
    WITH e AS (SELECT user_id, event_id, ts AS a, ts + INTERVAL 2 HOUR AS b FROM events WHERE event_type <> 'error'),
    f AS (SELECT user_id, event_id AS error_id, ts AS c, ts + to_minutes(CAST(event_id % 240 AS INTEGER)) AS d
        FROM events WHERE event_type = 'error')
    SELECT event_id, error_id FROM e JOIN f ON e.user_id = f.user_id AND a < d AND c < b AND c < d
    """,
)
def q_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two hours, with the errors of their users that were under way meanwhile."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    failed = F.col("event_type") == "error"
    calm = rows.where(~failed).select("user_id", "event_id", F.col("ts").alias("a"), F.expr("ts + INTERVAL 2 HOUR").alias("b"))
    errors = rows.where(failed).select(
        "user_id",
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("c"),
        F.expr("ts + make_dt_interval(0, 0, CAST(event_id % 240 AS INT))").alias("d"),
    )
    return overlap_join(calm, errors, ("a", "b"), ("c", "d"), ["user_id"]).select("event_id", "error_id")


@query(
    "profiles_merged",
    """
    SELECT column_name, rows, nulls, low, high, true AS near FROM (
        SELECT 'event_id' AS column_name, count(*) AS rows, count(*) - count(event_id) AS nulls,
            CAST(min(event_id) AS VARCHAR) AS low, CAST(max(event_id) AS VARCHAR) AS high FROM events
        UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), CAST(min(user_id) AS VARCHAR), CAST(max(user_id) AS VARCHAR)
        FROM events
        UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), min(event_type), max(event_type) FROM events
        UNION ALL SELECT 'value', count(*), count(*) - count(value), CAST(CAST(min(value) AS DECIMAL(18, 6)) AS VARCHAR),
            CAST(CAST(max(value) AS DECIMAL(18, 6)) AS VARCHAR) FROM events
    )
    """,
)
def q_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of each day, kept by two runs and added up; estimates are held against the exact values."""
    base, rows = scratch_path(spark, "profiles"), events(spark, sf_dir)
    for run, part in enumerate((F.col(PART) / 86400 % 2 == 0, F.col(PART) / 86400 % 2 == 1)):
        column_profiles(rows.where(part), RAW_EVENTS, by=[PART]).write.parquet(f"{base}/run={run}")
    merged = profile_report(merge_profiles(spark.read.parquet(base)))
    names = ["event_id", "user_id", "event_type", "value"]
    exact = rows.agg(*[F.count_distinct(n).alias(n) for n in names]).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("exact")) for n in names]))
    )
    # Four deviations of the sketch.
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.col("exact") * 0.07, F.lit(1))
    ends = [
        F.coalesce(f"{e}_text", F.col(f"{e}_whole").cast("string"), F.col(f"{e}_real").cast("decimal(18,6)").cast("string")).alias(e)
        for e in ("low", "high")
    ]
    return merged.join(exact, "column_name").select("column_name", "rows", "nulls", *ends, near.alias("near"))


NUMBERED = ["event_id", "value", "user_id", "event_type", PART]


@query(
    "template_functions",
    f"""
    SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, event_type || '/' || i AS event_type, {EVENT_DAY} AS land_ts
    FROM events, (SELECT unnest([1, 2]) AS i) WHERE value > (
        SELECT (min(v) + max(v)) / 2 FROM (SELECT value AS v FROM events)
    )
    """,
)
def q_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template that uses an Arrow table function and an aggregate over Arrow columns, both registered with the hooks."""
    hooks = Hooks()

    @F.arrow_udtf(returnType=f"event_id long, value double, user_id long, event_type string, {PART} long")
    class Numbered:
        def eval(self, rows: pa.RecordBatch):
            for i in ("/1", "/2"):
                kinds = pc.binary_join_element_wise(rows["event_type"], i, "")
                yield pa.table([rows["event_id"], rows["value"], rows["user_id"], kinds, rows[PART]], names=NUMBERED)

    @F.arrow_udf("double")
    def middle(v: pa.Array) -> float:
        low, high = pc.min(v).as_py(), pc.max(v).as_py()
        return (low + high) / 2

    hooks.register_table_function("numbered", Numbered)
    hooks.register_function("middle", middle)
    base = scratch_path(spark, "functions")
    land_events(spark, sf_dir, base)
    sql = """
        SELECT event_id, value, CAST(user_id AS INT) AS user_id, event_type, {{ primary_partition }}
        FROM numbered(TABLE({{ database_name }}.{{ table_name }}))
        WHERE value > (SELECT middle(value) FROM {{ database_name }}.{{ table_name }})
    """
    shop = pipeline(base, event_table(), shared_sql={"default": {"load": sql}})
    sql_load(spark, shop, "events", LoadOptions(input_stage="raw_hist"), hooks=hooks)
    return read_events(spark, base)
