"""Scans and sources."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.session import scratch_path
from stagewise.sinks.write import publish
from stagewise.sources.inventory import file_inventory, schema_inventory
from stagewise.sources.scans import input_scans, read_csv, read_json, read_parquet, read_parquet_drifted, scan_stage
from stagewise.spec import Pipeline, TableSpec
from workload.registry import EVENT_DAY, ORDER_MONTH, PART, SHIP_MONTH, events, land, lineitem, orders, query, table

EVENTS = Contract(
    "events",
    (
        ColumnSpec("event_id", "int64", nullable=False),
        ColumnSpec("event_type", "string"),
        ColumnSpec("value", "float64"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)
PARTS = Contract(
    "part",
    (
        ColumnSpec("p_partkey", "int64"),
        ColumnSpec("p_name", "string"),
        ColumnSpec("p_size", "int32"),
        ColumnSpec("p_retailprice", "float64"),
    ),
)


def stage(name: str, contract: Contract, stage_name: str, fmt: str, base: str) -> Pipeline:
    spec = TableSpec(name, {stage_name: contract}, {stage_name: fmt})
    return Pipeline("shop", "test", {stage_name: base}, {name: spec}, PART)


@query("scan_window", "SELECT event_id, value FROM events WHERE event_type IN ('click', 'view')")
def q_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose files were written after the last file of a first delivery."""
    base = scratch_path(spark, "window")
    rows = events(spark, sf_dir).select("event_id", "event_type", "value", PART)
    later = F.col("event_type").isin("click", "view")
    land(rows.where(~later), f"{base}/events")
    first = file_inventory(spark, f"{base}/events").agg(F.unix_micros(F.max("modified"))).first()[0]
    second = rows.where(later).hint("rebalance", PART)
    second.write.mode("append").partitionBy(PART).parquet(f"{base}/events")
    after = datetime.fromtimestamp(first / 1e6, UTC)
    return scan_stage(spark, stage("events", EVENTS, "curated", "parquet", base), "events", "curated", after).select(
        "event_id", "value"
    )


@query("file_inventory", f"SELECT {EVENT_DAY} AS land_ts, true AS has_files, true AS has_bytes FROM events GROUP BY 1")
def q_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = file_inventory(spark, land(events(spark, sf_dir).select("event_id", "value", PART)), PART)
    return files.groupBy(PART).agg(
        (F.count("path") > 0).alias("has_files"), (F.sum("size") > 0).alias("has_bytes")
    )


@query("scan_csv_typed", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def q_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "part").select("p_name", "p_retailprice", "p_partkey", "p_size").write.csv(path, header=True)
    return read_csv(spark, path, PARTS)


@query(
    "scan_parquet_typed",
    f"""
    SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice, {ORDER_MONTH} AS land_ts
    FROM orders
    """,
)
def q_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land(orders(spark, sf_dir).select("o_totalprice", "o_orderstatus", "o_orderkey", PART))
    wanted = Contract(
        "orders",
        (
            ColumnSpec("o_orderkey", "int64"),
            ColumnSpec("o_orderstatus", "string"),
            ColumnSpec("o_totalprice", "decimal128(12,2)"),
            ColumnSpec(PART, "int64"),
        ),
        (PART,),
    )
    return read_parquet(spark, path, wanted)


@query("scan_json", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def q_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    table(spark, sf_dir, "part").write.json(path)
    return read_json(spark, path, PARTS)


@query(
    "schema_inventory",
    """
    SELECT kind, position, "column", "type", n FROM (VALUES
        ('csv', 0, 'conv_id', 'string'), ('csv', 1, 'turn', 'string'), ('csv', 2, 'role', 'string'),
        ('json', 0, 'conv_id', 'int64'), ('json', 1, 'text', 'string'), ('json', 2, 'turn', 'int64'),
        ('parquet', 0, 'conv_id', 'int64'), ('parquet', 1, 'turn', 'int64'), ('parquet', 2, 'words', 'list<string>')
    ) v(kind, position, "column", "type"), (SELECT count(*) AS n FROM conversations)
    """,
)
def q_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, rows = scratch_path(spark, "schemas"), table(spark, sf_dir, "conversations")
    rows.select("conv_id", "turn", "role").write.csv(f"{root}/a", header=True)
    rows.select("conv_id", "text", "turn").write.json(f"{root}/b")
    rows.select("conv_id", "turn", F.split("text", " ").alias("words")).write.parquet(f"{root}/c")
    kind = F.regexp_extract("file", "([a-z]+)$", 1).alias("kind")
    found = schema_inventory(spark, root).select(kind, "position", "column", "type").distinct()
    return found.withColumn("n", F.lit(spark.read.parquet(f"{root}/c").count()).cast("long"))


@query(
    "derived_multi_input",
    f"""
    SELECT 'orders' AS input, {ORDER_MONTH} AS land_ts, count(*) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT 'lineitem', {SHIP_MONTH}, count(*) FROM lineitem GROUP BY ALL
    """,
)
def q_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan per input; the lines belong to another pipeline and another stage."""
    base = scratch_path(spark, "inputs")
    land(orders(spark, sf_dir).select("o_orderkey", PART), f"{base}/shop/orders")
    land(lineitem(spark, sf_dir).select("l_orderkey", PART), f"{base}/depot/pass/lineitem")

    def keyed(name: str, key: str, at: str) -> TableSpec:
        columns = (ColumnSpec(key, "int64"), ColumnSpec(PART, "int64"))
        return TableSpec(name, {at: Contract(name, columns, (PART,))}, {at: "parquet"})

    totals = TableSpec(
        "totals",
        {"derived": Contract("totals", (ColumnSpec(PART, "int64"),), (PART,))},
        {"derived": "parquet"},
        "derived",
        inputs={("shop", "orders"): "curated", ("depot", "lineitem"): "raw_hist"},
    )
    pipelines = {
        "shop": Pipeline(
            "shop", "test", {"curated": f"{base}/{{{{db}}}}"},
            {"orders": keyed("orders", "o_orderkey", "curated"), "totals": totals},
        ),
        "depot": Pipeline(
            "depot", "test", {"raw_hist": f"{base}/{{{{db}}}}"},
            {"lineitem": keyed("lineitem", "l_orderkey", "raw_hist")},
        ),
    }
    scans = input_scans(spark, pipelines, "shop", "totals")
    counts = [
        frame.groupBy(F.lit(name).alias("input"), PART).agg(F.count("*").alias("n"))
        for (_, name), frame in scans.items()
    ]
    return counts[0].union(counts[1])


NESTED_ORDERS = Contract(
    "orders",
    (
        ColumnSpec("o_orderkey", "int64"),
        ColumnSpec("lines", "list<struct<number:int64, qty:float64, price:float64, flag:string>>"),
    ),
)
# The same fields in another order, as a later stage may want them.
TURNED_ORDERS = Contract(
    "orders",
    (
        ColumnSpec("lines", "list<struct<price:float64, flag:string, number:int32, qty:float64>>"),
        ColumnSpec("o_orderkey", "int64"),
    ),
)


@query(
    "nested_reconcile",
    """
    SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS number, l_quantity AS qty, l_extendedprice AS price,
        CASE WHEN o_orderstatus <> 'P' THEN l_returnflag END AS flag
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def q_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as lists of structs, in files of three layouts.

    Fields stand in another order, in upper case or in a narrower type, one is more than the contract has, and one is
    missing, so it is null. The rows are published under a contract that has the fields in yet another order.
    """
    base = scratch_path(spark, "nested")
    line = F.struct(
        *[F.col(c).alias(n) for c, n in (("l_linenumber", "number"), ("l_quantity", "qty"), ("l_extendedprice", "price"))],
        F.col("l_returnflag").alias("flag"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    rows = table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    layouts = {
        "F": "struct(int(x.number) AS number, x.qty AS qty, x.price AS price, x.flag AS flag)",
        "O": "struct(x.price AS price, 'more' AS note, x.flag AS flag, x.qty AS qty, bigint(x.number) AS number)",
        "P": "struct(x.qty AS QTY, x.price AS price, int(x.number) AS NUMBER)",
    }
    for status, layout in layouts.items():
        part = rows.where(F.col("o_orderstatus") == status)
        part.select("o_orderkey", F.expr(f"transform(lines, x -> {layout})").alias("lines")).write.mode("append").parquet(base)
    read = read_parquet_drifted(spark, base, NESTED_ORDERS)
    kept = publish(read, scratch_path(spark, "turned"), TURNED_ORDERS, cast=True)
    back = read_parquet(spark, kept, NESTED_ORDERS)
    return back.select("o_orderkey", F.inline("lines"))
