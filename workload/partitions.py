"""Landing partitions and incremental selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.tokens import extract_partition, extract_timestamp, strip_lint_stamp
from stagewise.operators.partitions import (
    common_new,
    compare_partitions,
    cutoff,
    drop_partitions,
    gate_files,
    list_partitions,
    only_partitions,
    restamp,
    unprocessed,
    unprocessed_many,
)
from workload.registry import EVENT_DAY, ORDER_MONTH, PART, SHIP_MONTH, events, land, lineitem, orders, query

# Partitions count as done when they hold an unusually large value, so the share of done ones varies with the data.
LARGE_EVENT, LARGE_ORDER, LARGE_LINE = 380, 499_000, 104_500


@query(
    "extract_partition",
    f"""
    SELECT regexp_extract(path, 'land_ts=([0-9]{{10}}|[0-9]{{8}})', 0) AS token, count(*) AS n
    FROM (SELECT 'b/land_ts=' || {EVENT_DAY} || '/f-' || event_id || '.csv' AS path FROM events)
    GROUP BY 1
    """,
)
def q_extract_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("b/land_ts="), F.col(PART), F.lit("/f-"), F.col("event_id"), F.lit(".csv"))
    tokens = events(spark, sf_dir).select(extract_partition(path, PART).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@query(
    "extract_timestamp",
    f"""
    SELECT land_ts, count(*) AS n
    FROM (SELECT {EVENT_DAY} AS land_ts FROM events UNION ALL SELECT {ORDER_MONTH} FROM orders)
    GROUP BY land_ts
    """,
)
def q_extract_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = [
        df.select(F.concat(F.lit("land_ts="), F.col(PART)).alias("token"))
        for df in (events(spark, sf_dir), orders(spark, sf_dir))
    ]
    stamps = tokens[0].union(tokens[1]).select(extract_timestamp(F.col("token"), PART).alias(PART))
    return stamps.groupBy(PART).agg(F.count("*").alias("n"))


@query("list_partitions", f"SELECT DISTINCT {EVENT_DAY} AS land_ts FROM events")
def q_list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_partitions(events(spark, sf_dir), PART)


@query(
    "unprocessed_partitions",
    f"""
    SELECT {EVENT_DAY} AS land_ts FROM events
    EXCEPT SELECT {EVENT_DAY} FROM events WHERE value > {LARGE_EVENT}
    """,
)
def q_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = events(spark, sf_dir)
    return unprocessed(given, given.where(F.col("value") > LARGE_EVENT), PART)


@query(
    "unprocessed_many",
    f"""
    (SELECT 'orders' AS table_name, {ORDER_MONTH} AS land_ts FROM orders
     UNION SELECT 'lineitem', {SHIP_MONTH} FROM lineitem)
    EXCEPT
    (SELECT 'orders', {ORDER_MONTH} FROM orders WHERE o_totalprice > {LARGE_ORDER}
     UNION SELECT 'lineitem', {SHIP_MONTH} FROM lineitem WHERE l_extendedprice > {LARGE_LINE})
    """,
)
def q_unprocessed_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = orders(spark, sf_dir), lineitem(spark, sf_dir)

    def rows(o_rows: DataFrame, li_rows: DataFrame) -> DataFrame:
        named = [f.select(F.lit(n).alias("table_name"), PART) for n, f in (("orders", o_rows), ("lineitem", li_rows))]
        return named[0].union(named[1])

    done = rows(o.where(F.col("o_totalprice") > LARGE_ORDER), li.where(F.col("l_extendedprice") > LARGE_LINE))
    return unprocessed_many(rows(o, li), done, PART)


@query(
    "common_new_partitions",
    f"""
    SELECT land_ts FROM (
        SELECT {ORDER_MONTH} AS land_ts FROM orders
        INTERSECT SELECT {SHIP_MONTH} FROM lineitem
        EXCEPT SELECT {ORDER_MONTH} FROM orders WHERE o_totalprice > {LARGE_ORDER}
    ) WHERE land_ts BETWEEN 19950601 AND 20010601
    """,
)
def q_common_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = orders(spark, sf_dir), lineitem(spark, sf_dir)
    done = o.where(F.col("o_totalprice") > LARGE_ORDER)
    return common_new([o, li], done, PART, low=19950601, high=20010601)


@query(
    "cutoff_filter",
    f"""
    SELECT {EVENT_DAY} AS land_ts, count(*) AS n FROM events
    WHERE {EVENT_DAY} BETWEEN 1704412800 AND 1706054400 GROUP BY 1
    """,
)
def q_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.read.parquet(land(events(spark, sf_dir).select("event_id", PART)))
    kept = landed.where(cutoff(PART, 1704412800, 1706054400))
    return kept.groupBy(F.col(PART).cast("long").alias(PART)).agg(F.count("*").alias("n"))


@query(
    "partition_in_list",
    f"""
    SELECT {EVENT_DAY} AS land_ts, event_type, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM events WHERE {EVENT_DAY} IN (1704153600, 1704844800, 1706486400) GROUP BY 1, 2
    """,
)
def q_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.read.parquet(land(events(spark, sf_dir).select("event_type", "value", PART)))
    kept = only_partitions(landed, PART, [1704153600, 1704844800, 1706486400])
    return kept.groupBy(F.col(PART).cast("long").alias(PART), "event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )


def _gate(spark: SparkSession, sf_dir: str, one_a_day: bool) -> DataFrame:
    second = F.unix_date(F.to_date("ts")).cast("long") * 86400 + (
        F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    )
    path = F.concat(F.lit("in/"), F.col("event_type"), F.lit("_"), second, F.lit(".csv"))
    files = events(spark, sf_dir).select("event_id", "event_type", "ts", path.alias("path"))
    existing = files.where("ts < timestamp_ntz'2024-01-20 12:00:00'").select("event_type", "path")
    new = files.where("ts >= timestamp_ntz'2024-01-18 00:00:00'").select("event_id", "event_type", "path")
    return gate_files(new, existing, keys=["event_type"], one_a_day=one_a_day)


GATE_SQL = """
    WITH files AS (SELECT event_id, event_type, ts, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS s FROM events),
    latest AS (SELECT event_type, max(s) AS m FROM files WHERE ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1)
    SELECT event_id, event_type, 'in/' || event_type || '_' || s || '.csv' AS path
    FROM files LEFT JOIN latest USING (event_type)
    WHERE ts >= TIMESTAMP '2024-01-18 00:00:00' AND {test}
    """


@query("gate_any_newer", GATE_SQL.format(test="s > coalesce(m, 0)"))
def q_gate_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir, one_a_day=False)


@query("gate_one_a_day", GATE_SQL.format(test="s // 86400 > coalesce(m, 0) // 86400"))
def q_gate_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir, one_a_day=True)


@query(
    "strip_lint_stamp",
    f"""
    SELECT event_id, regexp_replace(name, '-[0-9]{{1,2}}-[0-9]{{10}}\\.csv$', '.csv') AS name
    FROM (SELECT event_id, 'ev' || event_id || '-' || day(ts) || '-' || {EVENT_DAY} || '.csv' AS name FROM events)
    """,
)
def q_strip_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = F.concat(
        F.lit("ev"), F.col("event_id"), F.lit("-"), F.dayofmonth("ts"), F.lit("-"), F.col(PART), F.lit(".csv")
    )
    return events(spark, sf_dir).select("event_id", strip_lint_stamp(stamped, ".csv").alias("name"))


@query(
    "partition_set_equal",
    f"""
    WITH o AS (SELECT DISTINCT {ORDER_MONTH} AS p FROM orders), l AS (SELECT DISTINCT {SHIP_MONTH} AS p FROM lineitem),
    c AS (SELECT (SELECT count(*) FROM l WHERE p NOT IN (SELECT p FROM o)) AS missing,
                 (SELECT count(*) FROM o WHERE p NOT IN (SELECT p FROM l)) AS extra)
    SELECT missing, extra, missing + extra = 0 AS is_equal FROM c
    """,
)
def q_set_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_partitions(orders(spark, sf_dir), lineitem(spark, sf_dir), PART)


@query("restamp_partition", "SELECT event_id, event_type, CAST(1706745600 AS BIGINT) AS land_ts FROM events")
def q_restamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.year("ts") * 10000 + F.month("ts") * 100 + 1
    staged = events(spark, sf_dir).select("event_id", "event_type", month.cast("long").alias(PART))
    return restamp(staged, PART, 1706745600)


@query(
    "drop_partitions",
    f"""
    SELECT {EVENT_DAY} AS land_ts, count(*) AS n FROM events
    WHERE {EVENT_DAY} NOT IN (SELECT {EVENT_DAY} FROM events WHERE value > {LARGE_EVENT}) GROUP BY 1
    """,
)
def q_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "value", PART)
    path = land(rows.select("event_id", PART))
    done = list_partitions(rows.where(F.col("value") > LARGE_EVENT), PART)
    drop_partitions(spark, path, PART, [r[PART] for r in done.collect()])
    left = spark.read.schema(f"event_id long, {PART} long").parquet(path)
    return left.groupBy(PART).agg(F.count("*").alias("n"))
