"""Cases that once lost rows, files or digits."""

from __future__ import annotations

import gzip
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.functions.checks import rules
from stagewise.functions.templates import render
from stagewise.operators import partitions as op
from stagewise.operators.shaping import lift_header_values
from stagewise.plans.lint import run_lint
from stagewise.sinks import write as sink
from stagewise.sources.inventory import csv_layout, literal_path, schema_inventory
from stagewise.sources.scans import read_csv
from stagewise.spec import LintOptions, Pipeline, TableSpec

PART = "land_ts"


def failing(df, contract):
    found = rules(contract, df.schema, typed=True)
    return [tuple(r) for r in df.select(*[rule.failing for rule in found]).collect()]


def test_rules_in_the_columns_own_types(spark):
    df = spark.sql("SELECT 1.0D AS d, 9007199254740993 AS n, DATE'2024-05-01' AS t, CAST('0.30' AS DECIMAL(9,2)) AS m")
    contract = Contract(
        "t",
        (
            ColumnSpec("d", "float64", enum=(1, 2)),
            ColumnSpec("n", "int64", maximum=9007199254740992),
            ColumnSpec("t", "date32", minimum=0, maximum=2_000_000_000),
            ColumnSpec("m", "decimal128(9,2)", minimum=0),
        ),
    )
    assert failing(df, contract) == [(False, True, False, False)]
    late = spark.createDataFrame([(date(2060, 1, 1),)], "t date")
    assert failing(late, Contract("t", (ColumnSpec("t", "date32", maximum=2_000_000_000),))) == [(True,)]
    assert Decimal("0.30") > 0


def test_a_line_break_at_the_end_is_not_in_the_pattern(spark):
    df = spark.createDataFrame([("abc",), ("abc\n",), ("1",)], "a string")
    assert failing(df, Contract("t", (ColumnSpec("a", "string", pattern="[a-z]+"),))) == [(False,), (True,), (True,)]


def test_lifted_headers_must_stay_apart(spark):
    df = spark.createDataFrame([(1, 2)], "sales23 int, sales24 int")
    with pytest.raises(ContractError, match="sales23.*sales24"):
        lift_header_values(df, "years", "[0-9]+", Contract("t", (ColumnSpec("sales", "int64"),)))


@pytest.mark.parametrize("sql", ["{% if a %} x {% endif %}", "{{ a | upper }}", "{# note #}"])
def test_templates_refuse_what_they_do_not_know(sql):
    with pytest.raises(ContractError, match="templates only have names"):
        render(f"SELECT {{{{ a }}}} {sql}", {"a": 1})


def test_rows_without_a_partition_are_not_restamped(spark):
    with pytest.raises(ContractError, match="1 rows have no land_ts"):
        op.restamp(spark.createDataFrame([(20240101,), (None,)], f"{PART} long"), PART, 20240202)


def test_more_inputs_than_a_number_has_bits(spark):
    both, one = (spark.createDataFrame([(v,) for v in vs], f"{PART} long") for vs in ((20240101, 20240102), (20240102,)))
    done = spark.createDataFrame([], f"{PART} long")
    assert values(op.common_new([both] * 64 + [one], done, PART)) == [(20240102,)]


def test_staged_files_join_a_partition_that_is_there(spark, path):
    for name, text in ((f"staged/{PART}=1/a.csv", "new"), (f"area/{PART}=20240101/a.csv", "old")):
        file = Path(path, name)
        file.parent.mkdir(parents=True)
        file.write_text(text)
    op.promote(spark, f"{path}/staged", f"{path}/area", PART, 20240101)
    found = {p.name: p.read_text() for p in Path(path, f"area/{PART}=20240101").iterdir() if p.suffix == ".csv"}
    assert found == {"a.csv": "old", "1-a.csv": "new"}


def test_files_of_a_table_in_any_spelling(spark, path):
    Path(path, "a.csv").write_text("x;y\n1;one\n")
    Path(path, "B.CSV").write_text("y;x\ntwo;2\n")
    Path(path, "s[2024].csv").write_text("x;y\n3;three\n")
    Path(path, "c.csv.gz").write_bytes(gzip.compress(b"x;y\n4;four\n"))
    Path(path, "notes.txt").write_text("77;stray\n")
    contract = Contract("t", (ColumnSpec("x", "int64"), ColumnSpec("y", "string")))
    assert values(read_csv(spark, path, contract, delimiter=";")) == [(1, "one"), (2, "two"), (3, "three"), (4, "four")]
    with pytest.raises(ContractError, match="lineSep".lower()):
        csv_layout({"lineSep": "|"})
    assert literal_path("/a/s[1].csv") == "/a/s\\[1\\].csv"


def test_damaged_files_are_noted_by_file(spark, path):
    Path(path, "cut.parquet").write_bytes(b"PAR1 and no more")
    Path(path, "latin.csv").write_bytes(b"stra\xdfe,b\n1,2\n")
    Path(path, "bad.json").write_text('{"a": 1}\n{"a": \n')
    spark.range(3).coalesce(1).write.mode("append").parquet(path)
    for ext, name in (("parquet", "cut.parquet"), ("csv", "latin.csv"), ("json", "bad.json")):
        found = schema_inventory(spark, path, ext, keep_unreadable=True).where("type = 'unreadable'").collect()
        assert [r["file"].rsplit("/", 1)[1] for r in found] == [name]


def lint_pipeline(path):
    contract = Contract("t", (ColumnSpec("x", "int64", maximum=9),))
    spec = TableSpec("t", {"raw_hist": contract}, {"land": "csv", "raw_hist": "csv"}, lint=LintOptions())
    return Pipeline("shop", "dev", {s: f"{path}/{s}" for s in ("land", "raw_hist")}, {"t": spec}, PART, all_must_pass=False)


def test_a_file_that_lands_again_replaces_nothing(spark, path):
    land = Path(path, "land/t")
    land.mkdir(parents=True)
    for text in ("1", "2", "2"):
        Path(land, "a.csv").write_text(f"x\n{text}\n")
        Path(land, "stray.txt").write_text("no table")
        result = run_lint(spark, lint_pipeline(path), run_ts=20240101)
        assert (result.files, result.failed_files) == (2, 1)
    kept = Path(path, f"raw_hist/pass/t/{PART}=20240101")
    assert sorted(p.read_text() for p in kept.iterdir() if p.suffix == ".csv") == ["x\n1\n", "x\n2\n"]
    assert list(Path(path, f"raw_hist/fail/t/{PART}=20240101").glob("stray.txt")) and not list(land.glob("*.*"))


@pytest.mark.parametrize("partitions", [(), (PART,)])
def test_publishing_by_copies_replaces_all_and_only_its_own(spark, path, monkeypatch, partitions):
    monkeypatch.setattr(sink, "renames_cheaply", lambda *_: False)
    contract = Contract("t", (ColumnSpec("x", "int64"), ColumnSpec(PART, "int64")), partitions)
    frame = lambda *rows: spark.createDataFrame(rows, f"x long, {PART} long")
    unit = PART if partitions else None
    sink.publish(frame((1, 20240101), (2, 20240102)), f"{path}/t", contract, unit=unit)
    relay = sink.relay_files

    def failing_copy(files, root, target):
        if target is None:
            raise OSError("the connection is gone")
        return relay(files, root, target)

    monkeypatch.setattr(sink, "relay_files", failing_copy)
    with pytest.raises(OSError):
        sink.publish(frame((7, 20240101)), f"{path}/t", contract, unit=unit)
    monkeypatch.setattr(sink, "relay_files", relay)
    sink.publish(frame((7, 20240101)), f"{path}/t", contract, unit=unit)
    found = values(spark.read.schema(contract.struct()).parquet(f"{path}/t"), "x")
    assert found == ([(2,), (7,)] if partitions else [(7,)])


def test_units_without_rows_are_cleared_and_remembered(spark, path):
    contract = Contract("t", (ColumnSpec("x", "int64"), ColumnSpec(PART, "int64")), (PART,))
    frame = lambda *rows: spark.createDataFrame(rows, f"x long, {PART} long")
    out, units = f"{path}/t", [20240101, 20240102]
    sink.publish(frame((1, 20240101), (2, 20240102)), out, contract, unit=PART, units=units)
    sink.publish(frame((3, 20240102)), out, contract, unit=PART, units=units)
    assert values(spark.read.schema(contract.struct()).parquet(out), "x") == [(3,)]
    assert values(op.stage_partitions(spark, out, PART)) == [(20240101,), (20240102,)]
    sink.publish(frame((4, 20240101)), out, contract, unit=PART, units=units[:1])
    assert not Path(out, f"_processed/{PART}=20240101").exists()
    assert spark.read.parquet(out).where(F.col(PART) == 20240101).count() == 1
