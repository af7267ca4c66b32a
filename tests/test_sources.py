from __future__ import annotations

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.sources.inventory import (
    arrow_type_text,
    day_window,
    file_inventory,
    headers,
    path_below,
    schema_inventory,
)
from stagewise.sources.scans import (
    input_scans,
    landed,
    read_csv,
    read_csv_text,
    read_json,
    read_parquet,
    read_stage,
    scan_partitions,
    scan_stage,
)
from stagewise.spec import Pipeline, TableSpec

PART = "land_ts"
ANIMALS = Contract(
    "table1",
    (
        ColumnSpec("my_int", "int64"),
        ColumnSpec("animal", "string"),
        ColumnSpec("my_datetime", "timestamp(ms)", format="%Y-%m-%d %H:%M:%S"),
        ColumnSpec("my_date", "date32"),
        ColumnSpec("gone", "null"),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_csv_by_name_and_type(spark, path):
    put(f"{path}/{PART}=1664198347/a.csv", "my_date,my_int,animal,gone,my_datetime\n1993-09-27,16,fish,,2013-01-14 15:54:20\n")
    put(f"{path}/{PART}=1664198347/b.csv", "my_date,my_int,animal,gone,my_datetime\nnever,x,\"a,\nb\",,\n")
    rows = read_csv(spark, path, ANIMALS, multiLine="true")
    assert dict(rows.dtypes) == {
        "my_int": "bigint", "animal": "string", "my_datetime": "timestamp_ntz", "my_date": "date", PART: "bigint",
    }
    found = {tuple(r) for r in rows.collect()}
    first = (16, "fish", dt.datetime(2013, 1, 14, 15, 54, 20), dt.date(1993, 9, 27), 1664198347)
    assert found == {first, (None, "a,\nb", None, None, 1664198347)}


def test_csv_files_with_different_headers(spark, path):
    put(f"{path}/{PART}=20200101/a.csv", "my_int,animal\n1,fish\n")
    put(f"{path}/{PART}=20200102/b.csv", "ANIMAL,my_int,other\ncat,2,x\n")
    put(f"{path}/{PART}=20200103/c d+e.csv", "my_date,my_int\n2000-01-01,3\n")
    put(f"{path}/{PART}=20200103/d.csv", "my_int,animal\n4,dog\n")
    rows = read_csv(spark, path, ANIMALS.with_columns(ColumnSpec("ANIMAL", "string")).without(["animal"]))
    assert values(rows, "my_int", "ANIMAL", PART) == [
        (1, "fish", 20200101), (2, "cat", 20200102), (3, None, 20200103), (4, "dog", 20200103),
    ]


def test_csv_corrupt_rows(spark, path):
    put(f"{path}/a.csv", "my_int,animal\n1,fish\n2,cat,extra\n")
    plain = ANIMALS.without([PART])
    rows = read_csv(spark, path, plain, corrupt=True).cache()
    assert values(rows, "my_int", "_corrupt_record") == [(1, None), (2, "2,cat,extra")]
    assert read_csv_text(spark, path, plain).columns == ["my_int", "animal"]


def test_csv_without_files(spark, path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, path, ANIMALS)


def test_parquet_is_cast_and_matched_by_name(spark, path):
    spark.sql("SELECT 1 AS MY_INT, 'fish' AS animal, 1664198347 AS land_ts, 5 AS other").write.partitionBy(PART).parquet(
        f"{path}/t"
    )
    contract = ANIMALS.without(["my_datetime", "my_date", "gone"]).with_columns(ColumnSpec("my_int", "int64"))
    rows = read_parquet(spark, f"{path}/t", contract)
    assert rows.dtypes == [("my_int", "bigint"), ("animal", "string"), (PART, "bigint")]
    with pytest.raises(ContractError, match="my_date"):
        read_parquet(spark, f"{path}/t", contract.with_columns(ColumnSpec("my_date", "date32")))


def test_parquet_files_that_differ(spark, path):
    """No file's columns are lost because another file was looked at first."""
    for i, sql in enumerate(
        ["SELECT 1L AS id", "SELECT 2 AS id, 'x' AS animal", "SELECT '3' AS ID, float(1.5) AS size, 9 AS other"]
    ):
        spark.sql(sql).coalesce(1).write.parquet(f"{path}/t/{PART}=2020010{i + 1}")
    spark.sql("SELECT 4L AS id, timestamp'2020-01-01 10:00:00Z' AS at").write.parquet(f"{path}/t/{PART}=20200104")
    wanted = Contract(
        "t",
        (
            ColumnSpec("id", "int64"),
            ColumnSpec("animal", "string"),
            ColumnSpec("size", "float64"),
            ColumnSpec("at", "timestamp(ms)"),
            ColumnSpec(PART, "int64"),
        ),
        (PART,),
    )
    paths = [f"{path}/t/{PART}=2020010{i}" for i in (1, 2, 3, 4)]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = read_stage(spark, paths, "parquet", wanted, drifted=True, basePath=f"{path}/t")
        found = {tuple(r) for r in rows.select(*wanted.column_names).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {
        (1, None, None, None, 20200101),
        (2, "x", None, None, 20200102),
        (3, None, 1.5, None, 20200103),
        (4, None, None, dt.datetime(2020, 1, 1, 10), 20200104),
    }


def test_nanosecond_files(spark, path):
    stamps = pa.array([1674198347123456789, None], pa.timestamp("ns"))
    pq.write_table(pa.table({"at": stamps}), f"{path}/a.parquet")
    contract = Contract("t", (ColumnSpec("at", "timestamp(ns)"),))
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        rows = [r[0] for r in read_parquet(spark, path, contract).collect()]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    assert rows == [dt.datetime(2023, 1, 20, 7, 5, 47, 123456), None]


def test_json(spark, path):
    put(f"{path}/doc.json", '{\n  "name": "a",\n  "columns": [{"name": "x", "type": "int64"}]\n}\n')
    inferred = read_json(spark, path, multi_line=True)
    assert inferred.first()["columns"][0]["type"] == "int64"
    contract = Contract("t", (ColumnSpec("name", "string"), ColumnSpec("columns", "list<struct<name:string, type:string>>")))
    assert read_json(spark, path, contract, multi_line=True).first()["columns"][0]["name"] == "x"


def pipeline(path):
    wanted = Contract("t", (ColumnSpec("id", "int64"), ColumnSpec(PART, "int64")), (PART,))
    spec = TableSpec("t", {"curated": wanted}, {"curated": "parquet"})
    return Pipeline("db", "dev", {"curated": f"{path}/curated"}, {"t": spec}, PART)


def test_scan_window_is_strict_and_skips_empty_files(spark, path):
    base = f"{path}/curated/t"
    spark.range(3).withColumn(PART, F.lit(20200101)).coalesce(1).write.partitionBy(PART).parquet(base)
    spark.range(3, 6).withColumn(PART, F.lit(20200102)).coalesce(1).write.partitionBy(PART).mode("append").parquet(base)
    put(f"{base}/{PART}=20200102/empty.parquet", "")
    stamps = {}
    for part, stamp in ((20200101, 1_600_000_000), (20200102, 1_600_000_100)):
        for name in os.listdir(f"{base}/{PART}={part}"):
            os.utime(f"{base}/{PART}={part}/{name}", (stamp, stamp))
        stamps[part] = dt.datetime.fromtimestamp(stamp, dt.UTC)
    home = pipeline(path)
    assert values(scan_stage(spark, home, "t", "curated"), "id") == [(i,) for i in range(6)]
    second = dt.timedelta(seconds=1)

    def ids(after, before):
        return values(scan_stage(spark, home, "t", "curated", after, before), "id")

    assert ids(stamps[20200101], None) == [(3,), (4,), (5,)]
    assert ids(stamps[20200101] - second, stamps[20200102]) == [(0,), (1,), (2,)]
    files = file_inventory(spark, base, PART)
    assert files.count() == 2
    assert files.agg(F.min("size")).first()[0] > 0


def test_extra_stage(spark, path):
    spark.range(2).withColumn(PART, F.lit(20200101)).write.partitionBy(PART).json(f"{path}/source/t")
    wanted = Contract("t", (ColumnSpec("id", "int32"),))
    extra = {"source": (f"{path}/source", "json", wanted)}
    rows = scan_stage(spark, pipeline(path), "t", "source", extra_stages=extra)
    assert rows.dtypes == [("id", "int"), (PART, "bigint")] and values(rows) == [(0, 20200101), (1, 20200101)]
    with pytest.raises(ContractError):
        scan_stage(spark, pipeline(path), "t", "nowhere")


def test_day_window():
    after, before = day_window(dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert after == dt.datetime(2024, 1, 2, tzinfo=dt.UTC)
    assert before == dt.datetime(2024, 1, 3, 23, 59, 59, tzinfo=dt.UTC)
    assert day_window() == (None, None)


def test_schema_inventory_of_mixed_files(spark, path):
    put(f"{path}/a.csv", 'x,"y, z"\n1,2\n')
    put(f"{path}/b.json", '{"n": 1, "s": "a", "l": [{"STRING": 1.5}]}\n{"n": 2, "new": true}\n')
    pq.write_table(pa.table({"d": pa.array([], pa.decimal128(12, 2)), "u": pa.array([], pa.uint8())}), f"{path}/c.parquet")
    found = schema_inventory(spark, path)
    name = F.substring_index("file", "/", -1).alias("file")
    assert values(found, name, "position", "column", "type") == [
        ("a.csv", 0, "x", "string"),
        ("a.csv", 1, "y, z", "string"),
        ("b.json", 0, "l", "list<struct<STRING:decimal128(2,1)>>"),
        ("b.json", 1, "n", "int64"),
        ("b.json", 2, "new", "bool"),
        ("b.json", 3, "s", "string"),
        ("c.parquet", 0, "d", "decimal128(12,2)"),
        ("c.parquet", 1, "u", "uint8"),
    ]
    assert values(headers(found.where("type = 'string'")), name, "header")[0] == ("a.csv", ["x", "y, z"])
    with pytest.raises(ContractError):
        schema_inventory(spark, path, "xlsx")


def test_paths_below_a_folder():
    assert path_below("file:/a/b/c/d.csv", "/a/b") == "c/d.csv"
    assert path_below("file:/a/b/d.csv", "file:///a/b/") == "d.csv"
    assert path_below("hdfs://node:8020/a/b/c.csv", "hdfs:///a/b") == "c.csv"
    assert path_below("s3a://bucket/a/b/c.csv", "s3a://bucket/a") == "b/c.csv"
    assert path_below("file:/a/b/x#1?.csv", "/a/b") == "x#1?.csv"
    with pytest.raises(ValueError):
        path_below("file:/a/bc/d.csv", "/a/b")


def test_arrow_types():
    kind = pa.list_(pa.struct([("a", pa.float64()), ("b", pa.list_(pa.date32())), ("c", pa.timestamp("ms"))]))
    assert arrow_type_text(kind) == "list<struct<a:float64, b:list<date32>, c:timestamp(ms)>>"


def test_inputs_are_resolved_in_their_own_pipeline(spark, path):
    for db in ("a", "b"):
        frame = spark.range(2).select((F.col("id") + (10 if db == "b" else 0)).alias("id"), (F.col("id") + 20200101).alias(PART))
        frame.write.partitionBy(PART).parquet(f"{path}/{db}/curated/t")
    out = TableSpec("out", {}, {"derived": "parquet"}, "derived", inputs={("b", "t"): "curated"})
    home = pipeline(f"{path}/a")
    home = Pipeline("a", "dev", home.base_paths, {**home.tables, "out": out}, PART)
    pipelines = {"a": home, "b": pipeline(f"{path}/b")}
    assert values(input_scans(spark, pipelines, "a", "out")[("b", "t")], "id") == [(10,), (11,)]
    assert values(input_scans(spark, pipelines, "a", "out", [20200102])[("b", "t")]) == [(11, 20200102)]
    with pytest.raises(ContractError, match="'b'"):
        input_scans(spark, {"a": home}, "a", "out")


def test_landing_partition_need_not_come_first(spark, path):
    rows = spark.range(4).select("id", (F.col("id") % 2).alias("k"), (F.col("id") + 20200101).alias(PART))
    rows.write.partitionBy("k", PART).parquet(f"{path}/t")
    wanted = Contract("t", tuple(ColumnSpec(c, "int64") for c in ("id", "k", PART)), ("k", PART))
    assert landed(wanted, PART).partitions == ("k", PART)
    found = scan_partitions(spark, f"{path}/t", "parquet", landed(wanted, PART), PART, [20200102, 20200103])
    assert values(found) == [(1, 1, 20200102), (2, 0, 20200103)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "20200102" in plan.split("PartitionFilters: [")[1].split("ReadSchema")[0]


def test_column_pruning_and_filters_reach_the_scan(spark, path):
    rows = spark.range(10).select("id", (F.col("id") * 2).alias("x"), (F.col("id") * 3).alias("y"), F.lit(20200101).alias(PART))
    rows.write.partitionBy(PART).parquet(f"{path}/curated/t")
    wanted = Contract("t", tuple(ColumnSpec(c, "int64") for c in ("id", "x", "y", PART)), (PART,))
    home = Pipeline("db", "dev", {"curated": f"{path}/curated"}, {"t": TableSpec("t", {"curated": wanted}, {"curated": "parquet"})}, PART)
    plan = scan_stage(spark, home, "t", "curated").where("x > 4").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,4)" in plan and "ReadSchema: struct<id:bigint,x:bigint>" in plan
