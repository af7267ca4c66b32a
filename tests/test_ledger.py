"""Work chosen by a ledger of files, and fingerprints of sets of files."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators.ledger import (
    files_fingerprint,
    fresh_partitions,
    read_ledger,
    record_files,
    stage_files,
    start_ledger,
    take_stock,
)
from stagewise.plans.derived import shared_temp
from stagewise.plans.load import LoadOptions, sql_load
from stagewise.plans.shape import run_shape
from stagewise.plans.templates import template_values
from stagewise.sinks.write import publish
from stagewise.spec import Pipeline, TableSpec

PART, DAY = "land_ts", 20240101
ROWS = Contract("t", (ColumnSpec("x", "int64"),))
OUT = Contract("t", (ColumnSpec("x", "int64"), ColumnSpec(PART, "int64")), (PART,))
LOAD = "SELECT x, land_ts FROM {{ database_name }}.t"


def put(path, day, name, *xs):
    folder = f"{path}/raw_hist/pass/t/{PART}={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as out:
        out.write("\n".join(["x", *map(str, xs)]) + "\n")
    return f"{folder}/{name}.csv"


def shop(path, out="parquet"):
    spec = TableSpec("t", {"raw_hist": ROWS, "curated": OUT}, {"raw_hist": "csv", "curated": out})
    paths = {"raw_hist": f"{path}/raw_hist", "curated": f"{path}/curated"}
    return Pipeline("shop", "dev", paths, {"t": spec}, PART, shared_sql={"default": {"load": LOAD}})


def test_late_files_choose_their_day_and_known_bytes_do_not(spark, path):
    home, options = shop(path), LoadOptions(input_stage="raw_hist", ledger=f"{path}/ledger")
    load = lambda: sql_load(spark, home, "t", options)
    kept = lambda: sorted(tuple(r) for r in spark.read.schema(OUT.struct()).parquet(f"{path}/curated/t").collect())
    first = put(path, 20240101, "a", 1, 2)
    put(path, 20240102, "b", 3)
    assert load() == [20240102, 20240101] and load() == []
    put(path, 20240101, "late", 4)
    assert load() == [20240101] and kept() == [(1, 20240101), (2, 20240101), (3, 20240102), (4, 20240101)]
    # Renamed, touched, and moved in from another loaded day: known bytes.
    os.rename(first, first.replace("a.csv", "renamed.csv"))
    shutil.copy(f"{path}/raw_hist/pass/t/{PART}=20240102/b.csv", f"{path}/raw_hist/pass/t/{PART}=20240101/moved.csv")
    os.utime(f"{path}/raw_hist/pass/t/{PART}=20240102/b.csv", (2_000_000_000, 2_000_000_000))
    assert load() == [] and load() == []
    # A new day is chosen although its file equals an earlier day's, and so is a file that was written anew.
    put(path, 20240103, "b", 3)
    put(path, 20240102, "b", 5, 6)
    assert load() == [20240103, 20240102]
    assert read_ledger(spark, f"{path}/ledger", PART).select("run").distinct().count() == 4


def test_a_job_that_fails_before_it_is_entered_chooses_the_same_again(spark, path):
    home, options = shop(path), LoadOptions(input_stage="raw_hist", ledger=f"{path}/ledger")
    put(path, 20240101, "a", 1)
    with pytest.raises(ContractError):
        sql_load(spark, home, "t", options, sql="SELECT 'no number' AS x, land_ts FROM {{ database_name }}.t")
    assert not os.path.exists(f"{path}/ledger") and sql_load(spark, home, "t", options) == [20240101]


def test_a_ledger_that_starts_late(spark, path):
    put(path, 20240101, "a", 1)
    put(path, 20240102, "b", 2)
    source, ledger = f"{path}/raw_hist/pass/t", f"{path}/ledger"
    done = spark.createDataFrame([(20240101,)], f"{PART} long")
    start_ledger(spark, source, PART, ledger, done)
    stock = take_stock(spark, source, PART, ledger)
    assert fresh_partitions(stock, PART) == [20240102]
    record_files(stock, ledger, PART, 7)
    assert take_stock(spark, source, PART, ledger).count() == 0
    assert take_stock(spark, f"{path}/nothing", PART, ledger).count() == 0


def test_fingerprints_do_not_depend_on_order_but_on_each_file(spark):
    rows = [("a", 1), ("b", 2), ("b", 2), ("c", None)]
    make = lambda r: spark.createDataFrame(r, "file string, size long")
    whole = files_fingerprint(make(rows).repartition(3))
    assert whole == files_fingerprint(make(rows[::-1]))
    assert len({whole, files_fingerprint(make(rows[:3])), files_fingerprint(make([*rows[:3], ("c", 3)])), files_fingerprint(make(rows).limit(0))}) == 4


def test_an_input_rewritten_under_its_name_rebuilds_the_shared_table(spark, path):
    sql = f"SELECT x, {PART} FROM {{{{ database_name }}}}.t"

    def build():
        frame = spark.read.schema(OUT.struct()).parquet(f"{path}/in").where("x > 0")
        rows, built = shared_temp(spark, f"{path}/s", sql, template_values(PART, "dev", [DAY]), {"t": frame}, PART, [DAY])
        return sorted(r["x"] for r in rows.collect()), built

    def put_in(*xs):
        spark.createDataFrame([(x, DAY) for x in xs], OUT.struct()).coalesce(1).write.mode("overwrite").parquet(f"{path}/new")
        os.makedirs(f"{path}/in", exist_ok=True)
        (name,) = [n for n in os.listdir(f"{path}/new") if n.endswith(".parquet")]
        os.replace(f"{path}/new/{name}", f"{path}/in/part-0.parquet")
        if os.path.exists(f"{path}/in/.part-0.parquet.crc"):
            os.remove(f"{path}/in/.part-0.parquet.crc")
        spark.catalog.refreshByPath(f"{path}/in")

    put_in(1, 2)
    assert build() == ([1, 2], True) and build() == ([1, 2], False)
    put_in(1, 3)
    assert build() == ([1, 3], True)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_output_is_published_like_parquet(spark, path, fmt):
    home = shop(path, fmt)
    put(path, 20240101, "a", 1, 2)
    put(path, 20240102, "b")
    assert run_shape(spark, home, "t") == [20240102, 20240101]
    read = lambda: sorted(r["x"] for r in spark.read.schema(OUT.struct()).option("header", True).format(fmt).load(f"{path}/curated/t").collect())
    # The second day has no rows: it is marked, and not chosen again.
    assert read() == [1, 2] and run_shape(spark, home, "t") == []
    assert not [n for n in os.listdir(f"{path}/curated") if n == "t_staging" and os.listdir(f"{path}/curated/{n}")]
    # What does not fit the contract is found in the staged files, and the target stays as it was.
    import stagewise.sinks.write as write

    plain, write.under_contract = write.under_contract, lambda df, contract: df.withColumn("more", F.lit(1))
    try:
        with pytest.raises(ContractError, match="columns differ"):
            publish(spark.createDataFrame([(9, 20240101)], OUT.struct()), f"{path}/curated/t", OUT, unit=PART, fmt=fmt)
    finally:
        write.under_contract = plain
    assert read() == [1, 2]


def test_stage_files_have_places_below_the_stage(spark, path):
    put(path, 20240101, "a b", 1)
    found = stage_files(spark, f"{path}/raw_hist/pass/t", PART).first()
    assert (found["file"], found[PART]) == (f"{PART}=20240101/a b.csv", 20240101)
