from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators.partitions import drop_table_partitions
from stagewise.sinks import write as sink
from stagewise.sinks.catalog import ensure_database, recreate_database, register, register_path
from stagewise.spec import Pipeline, TableSpec

PART = "land_ts"
TABLE = Contract(
    "t",
    (
        ColumnSpec("id", "int64"),
        ColumnSpec("animal", "string"),
        ColumnSpec("gone", "null"),
        ColumnSpec("amount", "decimal128(12,2)"),
        ColumnSpec(PART, "int64"),
    ),
    (PART, "animal"),
)
STORED = TABLE.without(["gone"])


def rows(spark, n=6, part=20200101, shift=0):
    return spark.range(n).select(
        (F.col("id") + shift).alias("id"),
        F.when(F.col("id") % 2 == 0, "cat").otherwise("dog").alias("animal"),
        F.lit(None).alias("gone"),
        (F.col("id") / 4).cast("decimal(12,2)").alias("amount"),
        F.lit(part).cast("long").alias(PART),
    )


def read(spark, path):
    return spark.read.schema(STORED.struct()).parquet(path)


def visible(path):
    return sorted(n for n in os.listdir(path) if n[0] not in "._")


def test_partitions_are_replaced_one_by_one(spark, path):
    out = f"{path}/t"
    sink.write_partitioned(rows(spark).union(rows(spark, part=20200102)), out, TABLE)
    sink.write_partitioned(rows(spark, 2, shift=100), out, TABLE)
    assert values(read(spark, out), PART, "id") == [(20200101, 100), (20200101, 101)] + [(20200102, i) for i in range(6)]
    assert visible(out) == [f"{PART}=20200101", f"{PART}=20200102"]
    assert visible(f"{out}/{PART}=20200101") == ["animal=cat", "animal=dog"]
    assert all(f.endswith(".snappy.parquet") for f in visible(f"{out}/{PART}=20200102/animal=dog"))


def test_files_are_split_by_rows(spark, path):
    sink.write_partitioned(rows(spark, 100), f"{path}/t", TABLE, max_records=10)
    assert len(visible(f"{path}/t/{PART}=20200101/animal=cat")) == 5


def test_gathering_splits_a_hot_partition(spark, path):
    """One partition with nearly all rows is written by several tasks, and no partition by all of them."""
    hot = spark.range(0, 400_000, 1, 16).select(
        "id", F.when(F.col("id") < 10, "cat").otherwise("dog").alias("animal"), F.lit(None).alias("gone"),
        F.lit(1).cast("decimal(12,2)").alias("amount"), F.lit(20200101).cast("long").alias(PART),
    )
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",):
        spark.conf.set(key, "256k")
    try:
        sink.write_partitioned(hot, f"{path}/t", TABLE)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert 1 < len(visible(f"{path}/t/{PART}=20200101/animal=dog")) <= 16
    assert len(visible(f"{path}/t/{PART}=20200101/animal=cat")) == 1
    assert read(spark, f"{path}/t").count() == 400_000


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_formats(spark, path, fmt):
    flat = Contract("t", (ColumnSpec("id", "int64"), ColumnSpec("animal", "string")))
    sink.write_partitioned(rows(spark), f"{path}/t", flat, fmt)
    back = spark.read.schema("id long, animal string").option("header", True).format(fmt).load(f"{path}/t")
    assert values(back) == [(i, "dog" if i % 2 else "cat") for i in range(6)]
    with pytest.raises(ContractError):
        sink.write_partitioned(rows(spark), f"{path}/t", flat, "xlsx")


@pytest.mark.parametrize("renames", [True, False])
@pytest.mark.parametrize("order", [(PART, "animal"), ("animal", PART)])
def test_publish_replaces_whole_landing_partitions(spark, path, monkeypatch, order, renames):
    """Whatever the order of the partitions is, no row of a landing partition outlives its replacement."""
    monkeypatch.setattr(sink, "renames_cheaply", lambda *_: renames)
    out, table = f"{path}/t", TABLE.with_partitions(*order)
    sink.publish(rows(spark).union(rows(spark, part=20200102)), out, table, unit=PART)
    sink.publish(rows(spark, 1, shift=100), out, table, unit=PART)
    assert values(read(spark, out).where(f"{PART} = 20200101"), "id", "animal") == [(100, "cat")]
    assert values(read(spark, out).where(f"{PART} = 20200102"), "id") == [(i,) for i in range(6)]
    assert visible(path) == ["t", "t_staging"] and visible(f"{path}/t_staging") == []


def test_publish_without_unit_replaces_written_folders(spark, path):
    out = f"{path}/t"
    sink.publish(rows(spark), out, TABLE)
    sink.publish(rows(spark, 1, shift=100), out, TABLE)
    assert values(read(spark, out), "id", "animal") == [(1, "dog"), (3, "dog"), (5, "dog"), (100, "cat")]
    with pytest.raises(ContractError, match="partitioned by year"):
        sink.publish(rows(spark), out, TABLE, unit="year")


def test_publish_checks_the_frame_before_working(spark, path):
    wrong = rows(spark).withColumn("id", F.col("id").cast("int"))
    with pytest.raises(ContractError, match="id: int"):
        sink.publish(wrong, f"{path}/t", TABLE)
    with pytest.raises(ContractError, match="amount: missing"):
        sink.publish(rows(spark).drop("amount"), f"{path}/t", TABLE)
    assert not os.path.exists(f"{path}/t") and not os.path.exists(f"{path}/t_staging")
    sink.publish(wrong, f"{path}/t", TABLE, cast=True)
    assert read(spark, f"{path}/t").count() == 6


def test_failed_publish_leaves_the_target_alone(spark, path, monkeypatch):
    out = f"{path}/t"
    sink.publish(rows(spark), out, TABLE)

    def late_failure(*_):
        raise ContractError("files do not match")

    monkeypatch.setattr(sink, "check_files", late_failure)
    with pytest.raises(ContractError, match="do not match"):
        sink.publish(rows(spark, 2, shift=100), out, TABLE)
    assert values(read(spark, out), "id") == [(i,) for i in range(6)]
    assert visible(f"{path}/t_staging") == []


def test_failing_rows_leave_the_target_alone(spark, path):
    out = f"{path}/t"
    sink.publish(rows(spark), out, TABLE)
    bad = rows(spark, 4).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="bad row"):
        sink.publish(bad, out, TABLE)
    assert read(spark, out).count() == 6


def test_files_are_checked(spark, path):
    rows(spark).drop("gone").withColumn("amount", F.lit("x")).write.partitionBy(PART, "animal").parquet(f"{path}/t")
    with pytest.raises(ContractError, match="amount type differs"):
        sink.check_files(spark, f"{path}/t", TABLE)


def test_failed_moves_are_taken_back(spark, path, monkeypatch):
    from stagewise.sources import files

    out = f"{path}/t"
    sink.publish(rows(spark).union(rows(spark, part=20200102)), out, TABLE, unit=PART)
    rename, calls = files._rename, []

    def break_fourth(*args):
        calls.append(args)
        if len(calls) == 4:
            raise OSError("no space")
        rename(*args)

    monkeypatch.setattr(files, "_rename", break_fourth)
    with pytest.raises(OSError, match="no space"):
        sink.publish(rows(spark, 2, shift=100).union(rows(spark, 2, part=20200102, shift=100)), out, TABLE, unit=PART)
    assert values(read(spark, out), "id") == sorted([(i,) for i in range(6)] * 2)


def test_publish_without_partitions(spark, path):
    flat = Contract("t", (ColumnSpec("id", "int64"),))
    for n in (3, 2):
        sink.publish(spark.range(n), f"{path}/t", flat)
    assert values(spark.read.parquet(f"{path}/t")) == [(0,), (1,)]


def shop(path, name="t"):
    spec = TableSpec("t", {"curated": Contract(name, TABLE.columns, TABLE.partitions)}, {"curated": "parquet"})
    return Pipeline("shop", f"e{os.path.basename(path)[-8:].replace('-', '_')}", {"curated": path}, {"t": spec}, PART)


def test_register_and_recover(spark, path):
    home = shop(path)
    sink.publish(rows(spark).union(rows(spark, part=20200102)), home.path("t", "curated"), TABLE)
    name = register(spark, home, "t", "curated", "sw", f"{path}/db")
    assert spark.table(name).columns == ["id", "amount", PART, "animal"]
    assert spark.table(name).count() == 12
    plan = spark.table(name).where(f"{PART} = 20200102")._jdf.queryExecution().executedPlan().toString()
    assert f"{PART}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # Registering again finds new partitions and drops no file.
    sink.publish(rows(spark, part=20200103), home.path("t", "curated"), TABLE)
    assert register(spark, home, "t", "curated", "sw") == name and spark.table(name).count() == 18
    drop_table_partitions(spark, name, home.path("t", "curated"), PART, [20200101])
    assert spark.table(name).count() == 12
    assert visible(home.path("t", "curated")) == [f"{PART}=20200102", f"{PART}=20200103"]


def test_contract_name_must_be_the_table_name(spark, path):
    with pytest.raises(ContractError, match="other"):
        register(spark, shop(path, "other"), "t", "curated", "sw")


def test_temporary_databases(spark, path):
    ensure_database(spark, "tmp_db", "it's a test", f"{path}/db")
    ensure_database(spark, "tmp_db")
    spark.range(2).write.parquet(f"{path}/t")
    flat = Contract("t", (ColumnSpec("id", "int64"),))
    assert spark.table(register_path(spark, "tmp_db", flat, f"{path}/t")).count() == 2
    recreate_database(spark, "tmp_db", f"{path}/db2")
    assert spark.sql("SHOW TABLES IN tmp_db").count() == 0 and spark.read.parquet(f"{path}/t").count() == 2
