from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators import quality as op
from stagewise.sources.inventory import schema_inventory
from stagewise.spec import LintOptions

CARRIERS = Contract(
    "table1",
    (
        ColumnSpec("seats", "int64", nullable=False, minimum=9, maximum=21),
        ColumnSpec("carrier", "string", nullable=False, enum=("bike", "ferry", "tram", "trolley")),
        ColumnSpec("owner", "string", pattern=r"\S+@\S+"),
        ColumnSpec("opened", "date32", format="%Y-%m-%d"),
    ),
)
ROWS = [
    ("a", "16", "tram", "desk@tram.example", "1961-07-04"),
    ("a", "8", "bike", None, None),
    ("a", "x", "bird", "nobody", "1993-02-30"),
    ("b", None, None, "c@d", "27/09/1993"),
    ("b", "20", "ferry", "see desk@tram.example", "2000-01-01"),
    ("c", "10", "trolley", "a@b", "2000-01-01"),
]
EXPECTED = {
    0: [],
    1: ["seats:range"],
    2: ["seats:type", "carrier:enum", "owner:pattern", "opened:type"],
    3: ["seats:nullable", "carrier:nullable", "opened:type"],
    4: ["owner:pattern"],
    5: [],
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, *r) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(data, "n int, file string, seats string, carrier string, owner string, opened string")


def test_rules_by_row(rows):
    linted = op.lint_rows(rows, CARRIERS)
    assert {r["n"]: r[op.FAILED] for r in linted.collect()} == EXPECTED


def test_split_valid(rows):
    good, bad = op.split_valid(rows, CARRIERS)
    assert values(good, "n") == [(0,), (5,)] and good.columns == rows.columns
    assert values(bad, "n", F.size(op.FAILED)) == [(1, 1), (2, 4), (3, 3), (4, 1)]


def test_report_counts_every_rule_in_one_pass(rows):
    report = op.lint_report(rows, CARRIERS, ["file"])
    counted = {(r["file"], f"{r['column_name']}:{r['rule_name']}"): r["failures"] for r in report.collect()}
    assert len(counted) == 3 * 7
    for (file, label), failures in counted.items():
        assert failures == sum(label in EXPECTED[i] for i, r in enumerate(ROWS) if r[0] == file)
    assert {r["file"]: r["rows"] for r in report.collect()} == {"a": 3, "b": 2, "c": 1}
    plan = op.lint_report(rows, CARRIERS, ["file"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_report_over_the_whole_table(rows):
    assert op.lint_report(rows, CARRIERS).where("rule_name = 'type'").agg(F.sum("failures")).first()[0] == 3


def test_no_rules(rows):
    free = Contract("t", (ColumnSpec("carrier", "string"),))
    assert op.lint_report(rows, free, ["file"]).count() == 0
    assert op.split_valid(rows, free)[1].count() == 0


def test_file_verdicts(rows):
    verdict = op.verdicts(rows, CARRIERS, ["file"])
    assert values(verdict) == [("a", 3, 2, False), ("b", 2, 2, False), ("c", 1, 0, True)]
    good, bad = op.split_by_verdict(rows, verdict, ["file"])
    assert values(good, "n") == [(5,)] and values(bad, "n") == [(i,) for i in range(5)]
    assert tuple(op.all_must_pass(verdict).first()) == (3, 2, False)
    assert tuple(op.all_must_pass(verdict.where("passed")).first()) == (1, 0, True)
    assert tuple(op.all_must_pass(verdict.where("file = 'z'")).first()) == (0, 0, True)


NESTED_ROWS = [
    ('[{"k": 1, "d": ["2020-01-01"]}]', 0),
    ('[{"k": 1}, {"k": null, "d": [null]}]', 0),
    ('[{"k": 1}, {"k": "x"}]', 1),
    ('[{"d": ["2020-01-01", "soon"]}]', 1),
    ('[{"k": {"a": 1}}]', 1),
    ("3", 1),
    (None, 0),
    ("[]", 0),
]


def test_nested_values_are_checked_inside(spark):
    spec = ColumnSpec("v", "list<struct<k:int64, d:list<date32>>>")
    contract = Contract("t", (ColumnSpec("n", "int32"), spec))
    text = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(NESTED_ROWS)], "n int, v string")
    bad = [(i,) for i, (_, failing) in enumerate(NESTED_ROWS) if failing]
    assert values(op.split_valid(text, contract)[1], "n") == bad
    columns = text.select("n", F.from_json("v", "array<struct<k:string, d:array<string>, more:int>>").alias("v"))
    assert values(op.split_valid(columns, contract)[1], "n") == [b for b in bad if b != (5,)]
    flat = text.select("n", F.split("v", ",").alias("v"))
    assert op.split_valid(flat, contract.with_columns(ColumnSpec("v", "int32")))[1].count() == 7


def test_required_tables():
    options = {"a": LintOptions(required=True), "b": LintOptions(), "c": LintOptions(required=True)}
    assert op.missing_required(options, ["c"]) == ["a"]


@pytest.mark.parametrize(
    "options, expected",
    [
        (LintOptions(), {("missing", "carrier"), ("extra", "CARRIER"), ("extra", "x"), ("duplicate", "x")}),
        (LintOptions(headers_ignore_case=True), {("extra", "x"), ("duplicate", "x")}),
        (LintOptions(allow_missing_cols=True), {("extra", "CARRIER"), ("extra", "x"), ("duplicate", "x")}),
        (LintOptions(expect_header=False), set()),
    ],
)
def test_check_columns(spark, options, expected):
    files = spark.createDataFrame(
        [("f", ["seats", "CARRIER", "opened", "owner", "x", "x"]), ("g", CARRIERS.column_names)],
        "file string, header array<string>",
    )
    assert set(values(op.check_columns(files, CARRIERS, options))) == {("f", *e) for e in expected}


def test_not_empty(rows):
    assert op.assert_not_empty(rows) is rows
    with pytest.raises(ContractError, match="no data in t"):
        op.assert_not_empty(rows.where("n > 99"), "t")


def test_primary_key(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, l string")
    found = {tuple(r) for r in op.check_primary_key(rows, ["k", "l"]).collect()}
    assert found == {(1, "a", 2), (None, "c", 2)}


STRUCT = "list<struct<id:int64, description:string, hobbies:list<struct<id:int64, title:string>>, other:string>>"
TYPED = STRUCT.replace("hobbies:list<struct<id:int64,", "hobbies:list<struct<id:int64, type:string,")


def inventory(spark, columns):
    from stagewise.contract import leaves

    rows = [
        ("f", i, n, t, [{"path": p, "type": k} for p, k in leaves(t, n)]) for i, (n, t) in enumerate(columns)
    ]
    return spark.createDataFrame(
        rows, "file string, position int, column string, type string, leaves array<struct<path:string,type:string>>"
    )


@pytest.mark.parametrize(
    "data, wanted, matches",
    [
        ([("s", STRUCT.replace("other:", "type:string, other:")), ("i", "int32")], [("s", TYPED), ("i", "int32")], False),
        ([("s", STRUCT), ("i", "int32")], [("s", TYPED), ("i", "int32")], False),
        ([("s", TYPED), ("i", "int32")], [("s", STRUCT), ("i", "int32")], True),
        ([("s", TYPED)], [("s", STRUCT), ("i", "int32")], False),
        ([("s", TYPED), ("i", "int32")], [("s", STRUCT)], True),
        ([("i", "int32"), ("s", TYPED)], [("s", TYPED), ("i", "int32")], True),
        ([("i", "int64")], [("i", "int32")], False),
        ([("t", "timestamp(us)")], [("t", "timestamp(ns)")], True),
    ],
)
def test_conforms(spark, data, wanted, matches):
    contract = Contract("t", tuple(ColumnSpec(n, t) for n, t in wanted))
    assert op.conforms(inventory(spark, data), contract).isEmpty() is matches


def test_strict_conformance(spark):
    contract = Contract("t", (ColumnSpec("a", "int32"), ColumnSpec("s", STRUCT)))
    same = [("a", "int32"), ("s", STRUCT)]
    assert op.conforms(inventory(spark, same), contract, strict=True).isEmpty()
    for other in ([*same, ("b", "int32")], same[::-1], [("a", "int32"), ("s", TYPED)]):
        assert values(op.conforms(inventory(spark, other), contract, strict=True)) == [("f", "t", "schema differs")]


def test_partitions_are_left_out_unless_asked(spark):
    contract = Contract("t", (ColumnSpec("a", "int32"), ColumnSpec("land_ts", "int64")), ("land_ts",))
    files = inventory(spark, [("a", "int32")])
    assert op.conforms(files, contract).isEmpty()
    assert values(op.conforms(files, contract, keep_partitions=True)) == [("f", "land_ts", "missing")]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_conformance_of_written_files(spark, path, fmt):
    rows = spark.createDataFrame([(0, "jump"), (1, "hop")], "seats long, hobby string")
    rows.coalesce(1).write.format(fmt).save(f"{path}/a")
    contract = Contract("table2", (ColumnSpec("seats", "int64"), ColumnSpec("hobby", "string")))
    found = schema_inventory(spark, path, fmt)
    assert values(found, "column", "type") == [("hobby", "string"), ("seats", "int64")]
    assert op.conforms(found, contract).isEmpty()
    wrong = contract.with_columns(ColumnSpec("seats", "int32"), ColumnSpec("x", "bool"))
    assert values(op.conforms(found, wrong), "path", "problem") == [("seats", "type differs"), ("x", "missing")]
