"""User SQL through the template runner: any Spark SQL is accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagewise.plans.templates import run_template, template_values
from workload.registry import PART, query, table

DB = "{{ database_name }}."


def run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    values = template_values(PART, "test")
    return run_template(spark, sql, values, {n: table(spark, sf_dir, n) for n in names})


JOIN = """
    SELECT n_name, c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS customers,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM {db}orders JOIN {db}customer ON o_custkey = c_custkey JOIN {db}nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus IN ('F', 'O') GROUP BY n_name, c_mktsegment
"""
AGG = """
    SELECT l_returnflag, l_linestatus, count(*) AS n,
           CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(18, 2)))) AS DOUBLE)
               AS revenue
    FROM {db}lineitem WHERE l_shipdate <= DATE '2001-01-01' GROUP BY l_returnflag, l_linestatus
"""
ROLLUP = """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {db}orders
    GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
"""
WINDOW = """
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS BIGINT) AS place FROM (
        SELECT o_custkey, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
        FROM {db}orders) AS ranked
    WHERE place = 1
"""


@query("sql_passthrough_join", JOIN.format(db=""))
def q_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, JOIN.format(db=DB), "orders", "customer", "nation")


@query("sql_passthrough_agg", AGG.format(db=""))
def q_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, AGG.format(db=DB), "lineitem")


@query("sql_passthrough_rollup", ROLLUP.format(db=""))
def q_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, ROLLUP.format(db=DB), "orders")


@query("sql_passthrough_window", WINDOW.format(db=""))
def q_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, WINDOW.format(db=DB), "orders")
