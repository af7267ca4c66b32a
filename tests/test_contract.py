from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from stagewise.contract import ColumnSpec, Contract, ContractError, contract_type, ddl, leaves, plain_type, spark_type
from stagewise.spec import LintOptions, Pipeline, TableSpec, full_database_name

NESTED = "list<struct<route:int64, colour:string, stops:list<struct<place:int64, town:string>>, remark:string>>"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("string", T.StringType()),
        ("int32", T.IntegerType()),
        ("int64", T.LongType()),
        ("float64", T.DoubleType()),
        ("decimal128(12,2)", T.DecimalType(12, 2)),
        ("bool", T.BooleanType()),
        ("date32", T.DateType()),
        ("date64", T.DateType()),
        ("timestamp(ns)", T.TimestampNTZType()),
        ("timestamp(ms)", T.TimestampNTZType()),
        ("timestamp(s)", T.TimestampNTZType()),
        ("datetime", T.TimestampNTZType()),
        ("list<string>", T.ArrayType(T.StringType())),
        ("list<list<string>>", T.ArrayType(T.ArrayType(T.StringType()))),
        ("null", T.NullType()),
        (
            "list<struct<int32:int64, a b:list<date32>>>",
            T.ArrayType(
                T.StructType(
                    [T.StructField("int32", T.LongType()), T.StructField("a b", T.ArrayType(T.DateType()))]
                )
            ),
        ),
    ],
)
def test_types(spark, text, expected):
    assert spark_type(text) == expected


@pytest.mark.parametrize("text", ["int8", "float32", "map<string,string>", "list<uint8>"])
def test_unknown_types(spark, text):
    with pytest.raises(ContractError):
        spark_type(text)


def test_type_text_round_trip(spark):
    assert contract_type(spark_type(NESTED)) == NESTED
    assert "`stops`:array<struct<" in ddl(NESTED)


def test_leaves():
    assert leaves(NESTED, "x") == [
        ("x[].route", "int64"),
        ("x[].colour", "string"),
        ("x[].stops[].place", "int64"),
        ("x[].stops[].town", "string"),
        ("x[].remark", "string"),
    ]
    assert leaves("list<string>", "x") == [("x", "list<string>")]
    assert leaves("struct<a:decimal128(12,2), b:int32>", "x") == [("x.a", "decimal128(12,2)"), ("x.b", "int32")]
    assert plain_type("list<timestamp(ns)>") == "list<timestamp>"


FLAT = {
    "name": "table1",
    "file_format": "csv",
    "partitions": [],
    "columns": [
        {"name": "seats", "type": "int64", "minimum": 9, "maximum": 21, "nullable": False},
        {"name": "carrier", "type": "string", "enum": ["bike", "ferry", "tram", "trolley"], "nullable": False},
        {"name": "owner", "type": "string"},
    ],
}
STAGED = {
    "name": "table1",
    "file_formats": [{"name": "raw_hist", "format": "csv"}, {"name": "curated", "format": "parquet"}],
    "partitions": ["land_ts"],
    "primary_key": ["seats"],
    "columns": [
        {"name": "seats", "stages": [{"name": "raw_hist", "type": "string"}, {"name": "curated", "type": "int32"}]},
        {"name": "note", "nullable": True, "stages": [{"name": "raw_hist", "type": "null"}]},
        {
            "name": "land_ts",
            "stages": [{"name": "curated", "type": "int64"}],
        },
    ],
}


def test_flat_document(spark):
    contract = Contract.from_document(FLAT)
    assert contract.lookup["seats"] == ColumnSpec("seats", "int64", nullable=False, minimum=9, maximum=21)
    assert contract.lookup["owner"].nullable
    field = contract.struct()["carrier"]
    assert field.metadata == {"enum": ["bike", "ferry", "tram", "trolley"]} and not field.nullable


def test_staged_document():
    raw, curated = (Contract.from_document(STAGED, s) for s in ("raw_hist", "curated"))
    assert (raw.column_names, raw.partitions, raw.file_format) == (["seats", "note"], (), "csv")
    assert (curated.column_names, curated.partitions) == (["seats", "land_ts"], ("land_ts",))
    assert raw.null_typed() == ["note"] and not raw.lookup["seats"].nullable


def test_file(tmp_path):
    file = tmp_path / "table1.json"
    file.write_text(json.dumps(STAGED))
    assert Contract.from_file(file, "curated").primary_key == ("seats",)


def broken(**change):
    return {**json.loads(json.dumps(STAGED)), **change}


@pytest.mark.parametrize(
    "document, message",
    [
        (broken(columns=STAGED["columns"] + [STAGED["columns"][0]]), "twice"),
        (broken(partitions=["year"]), "year"),
        (broken(columns=[{"name": "a", "stages": [{"name": "shelf", "type": "string"}]}], partitions=[]), "shelf"),
        (broken(columns=[{"name": "a", "stages": [{"name": "raw", "type": "int8"}]}], partitions=[]), "int8"),
        (broken(file_formats=[]), "no file format"),
    ],
)
def test_broken_documents(document, message):
    with pytest.raises(ContractError, match=message):
        Contract.from_document(document, "raw_hist")


def test_edits_make_new_contracts():
    contract = Contract.from_document(FLAT)
    changed = contract.with_columns(ColumnSpec("seats", "string"), ColumnSpec("land_ts", "int64"))
    assert contract.lookup["seats"].type == "int64"
    assert changed.column_names == ["seats", "carrier", "owner", "land_ts"]
    assert changed.with_partitions("land_ts").partitions_first[0].name == "land_ts"
    assert changed.with_partitions("land_ts").without(["land_ts"]).partitions == ()


CONTRACT = Contract("t", (ColumnSpec("a", "string"),))


@pytest.mark.parametrize(
    "make",
    [
        lambda: TableSpec("t", {}, {"curated": "csv"}, "special"),
        lambda: TableSpec("t", {}, {"shelf": "csv"}),
        lambda: TableSpec("t", {}, {"derived": "parquet"}, "derived"),
        lambda: TableSpec("t", {}, {"derived": "parquet"}, "derived", inputs={("db", "t"): "curated"}),
        lambda: TableSpec("t", {}, {"derived": "parquet"}, "derived", LintOptions(), {("db", "u"): "curated"}),
        lambda: TableSpec("t", {}, {"curated": "csv"}, inputs={("db", "u"): "curated"}),
        lambda: TableSpec("t", {}, {"curated": "csv"}, final_sql={"t": "SELECT 1"}),
    ],
)
def test_broken_specs(make):
    with pytest.raises(ContractError):
        make()


def test_paths_and_selection():
    tables = {
        "a": TableSpec("a", {"raw_hist": CONTRACT}, {"land": "csv", "raw_hist": "csv", "curated": "parquet"}),
        "b": TableSpec("b", {}, {"raw_hist": "csv"}, "custom"),
        "c": TableSpec("c", {}, {"derived": "parquet"}, "derived", inputs={("shop", "a"): "curated"}),
    }
    bases = {"land": "s3://land/{{env}}/{{db}}/", "raw_hist": "s3://hist", "curated": "s3://etl/curated"}
    shop = Pipeline("shop", "dev", bases, tables)
    assert shop.path("a", "land") == "s3://land/dev/shop/a"
    assert shop.path("a", "raw_hist") == "s3://hist/pass/a"
    assert shop.path("a", "curated") == "s3://etl/curated/a"
    with pytest.raises(ContractError, match="land, raw_hist, curated"):
        shop.path("a", "raw")
    assert [s.name for s in shop.select()] == ["a", "b", "c"]
    assert [s.name for s in shop.select(stages=["curated", "raw_hist"])] == ["a", "b"]
    assert [s.name for s in shop.select(stages=["raw_hist"], kinds=["custom"])] == ["b"]
    assert [s.name for s in shop.select(["a"], ["derived"])] == []


def test_database_names():
    assert full_database_name("shop", "dev", "p") == "p_shop_dev"
    assert full_database_name("shop", "dev", "p", derived=True) == "p_shop_derived_dev"
    assert full_database_name("all", "dev", "p") == "p_dev"
