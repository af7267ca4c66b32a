"""Nested columns go by field name, whatever layout each file has."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators.nested import as_type, reader_type, same_shape
from stagewise.operators.shaping import cast_columns
from stagewise.sinks.write import publish, under_contract
from stagewise.sources.scans import file_type, read_parquet, read_parquet_drifted, read_stage
from stagewise.spec import CastColumn

LINES = Contract("t", (ColumnSpec("lines", "list<struct<qty:int32, price:float64>>"),))


def kind(text):
    return T.DataType.fromDDL(text)


def deliver(spark, path, *layouts):
    for layout in layouts:
        spark.sql(f"SELECT array({layout}) AS lines").write.mode("append").parquet(path)


def pairs(df):
    return sorted((r["qty"], r["price"]) for r in df.select(F.inline("lines")).collect())


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_every_reader_goes_by_name(spark, path, order):
    layouts = ["named_struct('price', 9.0D, 'qty', 2)", "named_struct('qty', 5, 'price', 7.0D)"]
    deliver(spark, path, *(layouts[i] for i in order))
    want = [(2, 9.0), (5, 7.0)]
    assert pairs(read_parquet_drifted(spark, path, LINES)) == want
    assert pairs(read_parquet(spark, path, LINES)) == want
    assert pairs(read_stage(spark, path, "parquet", LINES)) == want


def test_fields_that_only_some_files_have(spark, path):
    deliver(spark, path, "named_struct('note', 'x', 'qty', 2)", "named_struct('PRICE', 7.0D, 'qty', 5L)")
    assert sorted(pairs(read_parquet_drifted(spark, path, LINES)), key=str) == [(2, None), (5, 7.0)]


def test_more_fields_than_the_contract_are_not_read(spark, path):
    deliver(spark, path, "named_struct('note', 'x', 'price', 1.0D, 'qty', 2)")
    for read in (read_parquet, read_parquet_drifted):
        plan = read(spark, path, LINES)._jdf.queryExecution().toString()
        assert "note" not in plan.split("ReadSchema:")[-1] and pairs(read(spark, path, LINES)) == [(2, 1.0)]


def test_publishing_and_casting_go_by_name(spark, path):
    rows = spark.sql("SELECT array(named_struct('price', 9.0D, 'qty', 2L), NULL) AS lines UNION ALL SELECT NULL")
    assert {str(r["lines"]) for r in under_contract(rows, LINES).collect()} == {"[Row(qty=2, price=9.0), None]", "None"}
    publish(rows.where("lines IS NOT NULL"), f"{path}/out", LINES, cast=True)
    back = read_parquet(spark, f"{path}/out", LINES).first()["lines"]
    assert (back[0]["qty"], back[0]["price"], back[1]) == (2, 9.0, None)
    cast = cast_columns(rows, [CastColumn("lines", "list<struct<price:float64, qty:int64>>", LINES.columns[0].type)])
    assert same_shape(cast.schema["lines"].dataType, LINES.columns[0].spark_type)
    with pytest.raises(ContractError, match=r"lines\[\].price"):
        under_contract(spark.sql("SELECT array(named_struct('qty', 2)) AS lines"), LINES)


def test_deep_types_are_walked_to_their_innermost_values(spark):
    given = kind("struct<b: array<struct<y: int, x: string, gone: int>>, a: map<string, struct<v: int, u: int>>>")
    wanted = kind("struct<a: map<string, struct<u: bigint, v: string>>, b: array<struct<x: string, y: double>>>")
    row = spark.createDataFrame([({"b": [{"y": 1, "x": "q", "gone": 0}, None], "a": {"k": {"v": 3, "u": 4}}},), (None,)], T.StructType([T.StructField("s", given)]))
    got = row.select(as_type(F.col("s"), given, wanted).alias("s"))
    assert same_shape(got.schema["s"].dataType, wanted)
    filled, empty = (r["s"] for r in got.collect())
    assert empty is None and filled["a"]["k"].asDict() == {"u": 4, "v": "3"}
    assert filled["b"][0].asDict() == {"x": "q", "y": 1.0} and filled["b"][1] is None
    assert reader_type(given, wanted).simpleString() == (
        "struct<a:map<string,struct<u:int,v:int>>,b:array<struct<x:string,y:int>>>"
    )


def test_values_that_cannot_be_cast_and_kinds_that_differ(spark):
    given, wanted = kind("struct<a: string>"), kind("struct<a: int>")
    row = spark.createDataFrame([({"a": "x"},)], T.StructType([T.StructField("s", given)]))
    assert row.select(as_type(F.col("s"), given, wanted, lenient=True).alias("s")).first()["s"]["a"] is None
    with pytest.raises(ContractError, match="s.a is string, not"):
        as_type(F.col("s"), given, kind("struct<a: array<int>>"), "s")
    assert same_shape(file_type("list<struct<a:float, t:timestamp(us, UTC), k:int16>>"), kind("array<struct<a: float, t: timestamp, k: smallint>>"))
