"""Column shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.operators import shaping as op
from stagewise.session import scratch_path
from stagewise.spec import CastColumn
from workload.registry import EVENT_DAY, ORDER_MONTH, PART, SHIP_MONTH, events, land, lineitem, orders, query, table


def contract(name: str, partitions: tuple[str, ...] = (), **types: str) -> Contract:
    return Contract(name, tuple(ColumnSpec(c, t) for c, t in types.items()), partitions)


def upper(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


@query("keep_contract_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = contract("customer", c_custkey="int64", c_name="string", c_acctbal="float64", c_phone="string")
    return op.keep_contract_columns(table(spark, sf_dir, "customer"), wanted)


@query("lower_columns", "SELECT * FROM customer")
def q_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.lower_columns(upper(table(spark, sf_dir, "customer")))


@query(
    "lift_header_values",
    """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
           '[{"value": 23, "fields": ["s_name"]}, {"value": 24, "fields": ["s_nationkey", "s_acctbal"]}]' AS years
    FROM supplier
    """,
)
def q_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_name": "s_name23", "s_nationkey": "s_nationkey24", "s_acctbal": "s_acctbal24"}
    )
    wanted = contract("supplier", s_suppkey="int64", s_name="string", s_nationkey="int32", s_acctbal="float64")
    return op.lift_header_values(given, "years", "[0-9]{2}", wanted)


@query("add_partition_column", f"SELECT event_id, event_type, {EVENT_DAY} AS land_ts FROM events")
def q_add_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land(events(spark, sf_dir).select("event_id", "event_type", PART))
    files = spark.read.schema("event_id long, event_type string").option("recursiveFileLookup", True).parquet(path)
    return op.add_partition_column(files, PART)


@query("add_version", "SELECT *, 'v1.2.0' AS shop_etl_version FROM part")
def q_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_version(table(spark, sf_dir, "part"), "v1.2.0", "shop")


@query("add_attributes", "SELECT *, 'tpc' AS feed, CAST(3 AS BIGINT) AS feed_level FROM part")
def q_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_attributes(table(spark, sf_dir, "part"), {"feed": "tpc", "feed_level": 3})


@query(
    "add_attributes_file",
    """
    SELECT p_partkey, p_name, a.largest_size, a.brands
    FROM part, (SELECT CAST(max(p_size) AS BIGINT) AS largest_size, count(DISTINCT p_brand) AS brands FROM part) a
    """,
)
def q_attributes_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    path = scratch_path(spark, "attributes")
    totals = parts.agg(F.max("p_size").alias("largest_size"), F.countDistinct("p_brand").alias("brands"))
    totals.coalesce(1).write.json(path)
    return op.add_attributes_file(parts.drop("p_size", "p_brand"), spark, path)


@query("drop_null_typed", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def q_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = contract("supplier", S_SUPPKEY="int64", S_NAME="string", S_NATIONKEY="null", S_ACCTBAL="float64")
    return op.drop_null_typed(table(spark, sf_dir, "supplier"), given)


@query(
    "add_missing_columns",
    "SELECT *, CAST(NULL AS VARCHAR) AS s_phone, CAST(NULL AS INTEGER) AS s_rating FROM supplier",
)
def q_add_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = contract("supplier", (PART,), s_name="string", s_phone="string", s_rating="int32", land_ts="int64")
    return op.add_missing_columns(table(spark, sf_dir, "supplier"), wanted)


@query("reconcile_names", 'SELECT c_custkey, c_name AS "C_NAME", c_acctbal FROM customer')
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "customer").withColumnRenamed("c_name", "C_NAME")
    wanted = contract("customer", C_CUSTKEY="int64", c_name="string", c_acctbal="float64", c_phone="string")
    return op.reconcile_names(given, wanted)


SHAPED = {
    "l_orderkey": "int64",
    "l_linenumber": "int32",
    "l_quantity": "float64",
    "l_extendedprice": "float64",
    "l_returnflag": "string",
    "l_shipdate": "timestamp(ms)",
    "l_comment": "string",
    "price_years": "string",
    "shop_etl_version": "string",
    "feed": "string",
    "land_ts": "int64",
}


@query(
    "default_shape",
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate,
           CAST(NULL AS VARCHAR) AS l_comment, '[{{"value": 24, "fields": ["l_extendedprice"]}}]' AS price_years,
           'v1.2.0' AS shop_etl_version, 'tpc' AS feed, {SHIP_MONTH} AS land_ts
    FROM lineitem
    """,
)
def q_default_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem(spark, sf_dir).withColumn("path", F.concat(F.lit("raw/land_ts="), F.col(PART), F.lit("/f.csv")))
    given = upper(rows.withColumnRenamed("l_extendedprice", "l_extendedprice24").drop(PART))
    stored = contract("lineitem", L_ORDERKEY="int64", L_TAX="null", L_DISCOUNT="null")
    options = op.ShapeOptions(
        tag="v1.2.0",
        prefix="shop",
        partition=PART,
        token=F.col("path"),
        header_field="price_years",
        header_regex="[0-9]{2}",
        attributes={"feed": "tpc"},
    )
    return op.default_shape(given, stored, contract("lineitem", (PART,), **SHAPED), options)


@query("common_columns_select", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def q_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = contract(
        "orders", O_ORDERKEY="int64", o_orderstatus="string", o_totalprice="float64", o_orderpriority="string"
    )
    wanted = contract(
        "orders",
        (PART,),
        o_orderkey="int64",
        o_totalprice="decimal128(12,2)",
        o_orderstatus="string",
        o_orderpriority="string",
        land_ts="int64",
    )
    return op.select_common(orders(spark, sf_dir), given, wanted)


@query("project_stage", f"SELECT o_orderkey, o_orderstatus, {ORDER_MONTH} AS land_ts FROM orders")
def q_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A document in the all-stages layout.
    stages = {"o_orderkey": ("raw", "curated"), "o_clerk": ("raw",), "o_orderstatus": ("curated",), PART: ("curated",)}
    document = {
        "name": "orders",
        "file_formats": [{"name": "raw", "format": "csv"}, {"name": "curated", "format": "parquet"}],
        "partitions": [PART],
        "columns": [
            {"name": c, "stages": [{"name": s, "type": "string" if c == "o_orderstatus" else "int64"} for s in at]}
            for c, at in stages.items()
        ],
    }
    return op.project_stage(orders(spark, sf_dir), Contract.from_document(document, "curated"))


@query(
    "cast_columns",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_custkey, o_orderstatus,
           CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
           o_orderpriority
    FROM orders
    """,
)
def q_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    casts = [
        CastColumn("o_orderkey", "int64", "int32"),
        CastColumn("o_totalprice", "float64", "decimal128(12,2)"),
        CastColumn("o_orderdate", "timestamp(ms)", "date32"),
    ]
    return op.cast_columns(table(spark, sf_dir, "orders"), casts)


@query(
    "parse_formats",
    "SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS at FROM events",
)
def q_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = events(spark, sf_dir).select(
        "event_id",
        F.date_format("ts", "dd/MM/yyyy").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
    )
    declared = Contract(
        "events",
        (
            ColumnSpec("event_id", "int64"),
            ColumnSpec("day", "date32", format="%d/%m/%Y"),
            ColumnSpec("at", "timestamp(s)", format="%Y-%m-%d %H:%M:%S"),
        ),
    )
    return op.parse_formats(text, declared)
