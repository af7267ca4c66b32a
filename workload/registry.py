"""Registration, and the helpers the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.tokens import landing_day, landing_month
from stagewise.session import scratch_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The landing partition of each table, in the oracle's SQL.
EVENT_DAY = "CAST(epoch(date_trunc('day', ts)) AS BIGINT)"
ORDER_MONTH = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS BIGINT)"
SHIP_MONTH = "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 1 AS BIGINT)"
PART = "land_ts"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(PART, landing_day(F.col("ts")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(PART, landing_month(F.col("o_orderdate")))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(PART, landing_month(F.col("l_shipdate")))


def land(df: DataFrame, path: str | None = None, fmt: str = "parquet", label: str = "land", by: str = PART) -> str:
    """Write rows as a stage that has one folder per landing partition."""
    path = path or scratch_path(df.sparkSession, label)
    writer = df.hint("rebalance", by).write.format(fmt).mode("overwrite").partitionBy(by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path
