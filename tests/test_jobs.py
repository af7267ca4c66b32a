from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators.shaping import ShapeOptions
from stagewise.plans.derived import DerivedOptions, run_derived, shared_temp
from stagewise.plans.hooks import Hooks
from stagewise.plans.lint import run_lint
from stagewise.plans.load import LoadOptions, choose_sql, load_contract, sql_load
from stagewise.plans.shape import run_shape
from stagewise.plans.templates import render, run_template, template_values
from stagewise.spec import CastColumn, LintOptions, Pipeline, TableSpec
from stagewise.streaming.ingest import ingest_now

PART = "land_ts"
HEADER = "seats,carrier,owner,opened_at,opened"
LINES = [
    "16,tram,desk@tram.example,2019-05-03 08:15:40,1961-07-04",
    "12,trolley,yard@trolley.example,2018-11-09 17:30:02,1999-12-30",
    "20,ferry,e@f.net,1999-12-31 23:59:59,1987-01-01",
    "10,trolley,,2000-01-01 00:00:00,1975-03-21",
]
RAW = Contract(
    "table1",
    (
        ColumnSpec("seats", "int64", nullable=False, minimum=9, maximum=21),
        ColumnSpec("carrier", "string", nullable=False, enum=("bike", "ferry", "tram", "trolley")),
        ColumnSpec("owner", "string"),
        ColumnSpec("opened_at", "timestamp(s)"),
        ColumnSpec("opened", "date32"),
    ),
)
CURATED = Contract(
    "table1",
    (
        ColumnSpec("seats", "int64"),
        ColumnSpec("carrier", "string"),
        ColumnSpec("owner", "string"),
        ColumnSpec("opened_at", "timestamp(ns)"),
        ColumnSpec("opened", "date32"),
        ColumnSpec(PART, "int64", nullable=False),
    ),
    (PART, "carrier"),
)
DERIVED = Contract(
    "table2",
    (ColumnSpec("seats", "int64"), ColumnSpec("carrier", "string"), ColumnSpec(PART, "int64", nullable=False)),
    (PART,),
)
LOAD = """
SELECT {{ sql_columns }}, opened_at, opened, land_ts, carrier
FROM {{ database_name }}.{{ table_name }}
WHERE land_ts IN ({{ snapshot_timestamps }}) AND seats < {{ top }}
"""
COPY = """
SELECT seats, carrier, {{ primary_partition }} FROM {{ database_name }}.table1
WHERE {{ primary_partition }} in ({{ snapshot_timestamps }}) and carrier = 'trolley'
"""


def put(path, lines, header=HEADER):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join([header, *lines]) + "\n")


def home(path, kind="default", fmt="csv", derived=None, curated=CURATED, lint=LintOptions(allow_missing_cols=True), **more):
    tables = {
        "table1": TableSpec(
            "table1",
            {"raw_hist": RAW, "raw": RAW, "curated": curated},
            {"land": fmt, "raw_hist": fmt, "raw": fmt, "curated": "parquet"},
            kind,
            lint,
        ),
        "table2": TableSpec(
            "table2",
            {"derived": DERIVED},
            {"derived": "parquet"},
            "derived",
            inputs={("shop", "table1"): "curated"},
            **(derived or {"final_sql": {"table2": COPY}}),
        ),
    }
    paths = {s: f"{path}/{s}" for s in ("land", "raw", "raw_hist", "curated", "derived")}
    return Pipeline("shop", "dev", paths, tables, PART, **more)


def land_two(path, stage="raw_hist/pass"):
    put(f"{path}/{stage}/table1/{PART}=1690000123/a.csv", LINES[:2])
    put(f"{path}/{stage}/table1/{PART}=1700000123/b.csv", LINES[2:])


def visible(path):
    return sorted(n for n in os.listdir(path) if n[0] not in "._") if os.path.exists(path) else []


# ---- templates --------------------------------------------------------------------------------------------------


def test_template(spark):
    frame = spark.createDataFrame([("a1", 20200101), ("b", 20200102)], f"x string, {PART} long")
    sql = r"SELECT x, '{{ environment }}' AS env FROM {{ database_name }}.t JOIN __temp__.u USING (x) WHERE x RLIKE '^[a-z]\\d{1}$' AND array_contains(:snapshot_timestamps, land_ts)"
    values_ = template_values(PART, "dev", [20200101], params={"environment": "mine"})
    found = run_template(spark, sql, values_, {"t": frame, "u": frame.select("x")}, {"snapshot_timestamps": [20200101]})
    assert values(found) == [("a1", "mine")]
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]


def test_template_errors(spark):
    with pytest.raises(ContractError, match="'nothing'"):
        render("SELECT {{ nothing }}", {})
    with pytest.raises(ContractError, match="unknown tables: u"):
        run_template(spark, "SELECT 1 FROM {{ database_name }}.u", template_values(PART, "dev"), {})
    assert run_template(spark, "SELECT 1 AS a", {}, {}).first()[0] == 1


# ---- shape ------------------------------------------------------------------------------------------------------


def test_shape_only_new_partitions(spark, path):
    shop = home(path)
    land_two(path)
    assert run_shape(spark, shop, "table1", options=ShapeOptions(tag="v1")) == [1700000123, 1690000123]
    out = spark.read.parquet(f"{path}/curated/table1")
    assert values(out, "seats", "carrier", PART) == [
        (10, "trolley", 1700000123), (12, "trolley", 1690000123), (16, "tram", 1690000123), (20, "ferry", 1700000123),
    ]
    assert run_shape(spark, shop, "table1") == []
    put(f"{path}/raw_hist/pass/table1/{PART}=1700000200/c.csv", LINES[:1])
    assert run_shape(spark, shop, "table1") == [1700000200]
    assert spark.read.parquet(f"{path}/curated/table1").count() == 5


def test_shape_with_other_headers_and_csv_output(spark, path):
    curated = CURATED.without(["opened_at", "opened"]).with_partitions(PART).with_columns(ColumnSpec("note", "string"))
    shop = home(path, curated=curated)
    put(f"{path}/raw_hist/pass/table1/{PART}=1690000123/a.csv", ["5,bike"], "seats,CARRIER")
    put(f"{path}/raw_hist/pass/table1/{PART}=1690000123/b.csv", ["ferry,6,x"], "carrier,seats,other")
    raw = RAW.with_columns(ColumnSpec("CARRIER", "string"))
    spec = TableSpec("table1", {"raw_hist": RAW, "curated": curated}, {"raw_hist": "csv", "curated": "csv"})
    shop = Pipeline("shop", "dev", shop.base_paths, {"table1": spec}, PART)
    run_shape(spark, shop, "table1")
    out = spark.read.option("header", True).csv(f"{path}/curated/table1")
    assert {(r["seats"], r["carrier"], r["note"]) for r in out.collect()} == {("5", "bike", None), ("6", "ferry", None)}
    assert raw.column_names[-1] == "CARRIER"


def test_shape_lifts_header_values(spark, path):
    names = ["seats23", "owner24", "carrier"]
    raw = Contract("table1", tuple(ColumnSpec(n, "string") for n in names))
    curated = Contract("table1", tuple(ColumnSpec(n, "string") for n in ("seats", "carrier", "owner", "years")))
    spec = TableSpec("table1", {"raw_hist": raw, "curated": curated}, {"raw_hist": "csv", "curated": "parquet"})
    shop = Pipeline("shop", "dev", home(path).base_paths, {"table1": spec}, PART)
    put(f"{path}/raw_hist/pass/table1/{PART}=1690000123/a.csv", ["1,a@b,bike"], "SEATS23,owner24,carrier")
    run_shape(spark, shop, "table1", options=ShapeOptions(header_field="years", header_regex="[0-9]{2}"))
    text = '[{"value": 23, "fields": ["seats"]}, {"value": 24, "fields": ["owner"]}]'
    assert values(spark.read.parquet(f"{path}/curated/table1")) == [("1", "bike", "a@b", text, 1690000123)]


def test_shape_to_a_stage_without_partitions_in_its_contract(spark, path):
    """Only the curated contract lists partitions, yet every stage is kept by landing partition."""
    plain = CURATED.with_partitions().without([PART])
    spec = TableSpec("table1", {"raw_hist": RAW, "processed": plain}, {"raw_hist": "csv", "processed": "parquet"})
    bases = {"raw_hist": f"{path}/raw_hist", "processed": f"{path}/processed"}
    shop = Pipeline("shop", "dev", bases, {"table1": spec}, PART)
    land_two(path)
    run_shape(spark, shop, "table1", "processed", final_stage="processed")
    assert visible(f"{path}/processed/table1") == [f"{PART}=1690000123", f"{PART}=1700000123"]
    put(f"{path}/raw_hist/pass/table1/{PART}=1700000200/c.csv", LINES[:1])
    assert run_shape(spark, shop, "table1", "processed", final_stage="processed") == [1700000200]
    assert spark.read.parquet(f"{path}/processed/table1").count() == 5


# ---- SQL load ---------------------------------------------------------------------------------------------------


def test_load_end_to_end(spark, path):
    shop = home(path, shared_sql={"default": {"raw_to_curated": LOAD}})
    land_two(path)
    options = LoadOptions("raw_hist", params={"top": 100})
    assert sql_load(spark, shop, "table1", options) == [1700000123, 1690000123]
    out = spark.read.parquet(f"{path}/curated/table1")
    assert out.count() == 4 and visible(f"{path}/curated/table1") == [f"{PART}=1690000123", f"{PART}=1700000123"]
    assert visible(f"{path}/raw_hist/pass/table1") == [f"{PART}=1690000123", f"{PART}=1700000123"]
    assert sql_load(spark, shop, "table1", options) == []


def test_load_consumes_its_input(spark, path):
    shop = home(path, shared_sql={"default": {"q": LOAD}})
    land_two(path, "raw/pass")
    land_two(path)
    for stage, left in (("raw", []), ("raw_hist", [f"{PART}=1690000123", f"{PART}=1700000123"])):
        sql_load(spark, shop, "table1", LoadOptions(stage, params={"top": 100}, consume=True), partitions=[1690000123, 1700000123])
        assert visible(f"{path}/{stage}/pass/table1") == left


def test_failed_load_publishes_nothing(spark, path):
    shop = home(path)
    land_two(path)
    with pytest.raises(ContractError, match="opened_at: missing"):
        sql_load(spark, shop, "table1", LoadOptions("raw_hist"), sql=LOAD.replace("opened_at, ", "").replace("{{ top }}", "9"))
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND|unknown tables"):
        sql_load(spark, shop, "table1", LoadOptions("raw_hist"), sql="SELECT * FROM {{ database_name }}.nowhere")
    assert visible(f"{path}/curated/table1") == []


def test_load_contract_and_choice():
    casts = (CastColumn("seats", "string", "int64"),)
    shop = home("/x", lint=LintOptions(casts=casts), shared_sql={"default": {"other": "A", "table": "B"}})
    spec = shop.table("table1")
    contract = load_contract(spec, "raw_hist", PART)
    assert contract.lookup["seats"].type == "string" and contract.partitions == (PART,)
    assert not contract.lookup[PART].nullable
    assert load_contract(spec, "curated", PART).lookup["seats"].type == "int64"
    assert choose_sql(shop, spec) == "A" and choose_sql(shop, spec, match_table_name=True) == "B"
    with pytest.raises(ContractError, match="no shared SQL"):
        choose_sql(home("/x"), spec)


def test_load_without_common_columns(spark, path):
    shop = home(path, curated=Contract("table1", (ColumnSpec("z", "string"), ColumnSpec(PART, "int64")), (PART,)))
    land_two(path)
    with pytest.raises(ContractError, match="no column with one type"):
        sql_load(spark, shop, "table1", LoadOptions("raw_hist", params={"top": 1}), sql=LOAD)


def test_custom_load_needs_a_hook(spark, path):
    shop = home(path, kind="custom", shared_sql={"custom": {"q": LOAD}})
    land_two(path)
    options = LoadOptions("raw_hist", params={"top": 100})
    with pytest.raises(ContractError, match="no SQL transform"):
        sql_load(spark, shop, "table1", options)
    hooks = Hooks()
    hooks.register_sql("table1", lambda df, ctx: df.withColumn("owner", F.upper("owner")))
    sql_load(spark, shop, "table1", options, hooks=hooks)
    assert ("DESK@TRAM.EXAMPLE",) in values(spark.read.parquet(f"{path}/curated/table1").where("seats = 16"), "owner")


# ---- derived ----------------------------------------------------------------------------------------------------


def curate(spark, path, shop):
    land_two(path)
    run_shape(spark, shop, "table1")


def test_derived_end_to_end(spark, path):
    shop = home(path)
    curate(spark, path, shop)
    options = DerivedOptions(low=1695000000, prefix="sw", location=f"{path}/db")
    assert run_derived(spark, {"shop": shop}, "shop", options=options) == {"table2": [1700000123]}
    out = spark.table("sw_shop_derived_dev.table2")
    assert values(out, "seats", "carrier", PART) == [(10, "trolley", 1700000123)]
    assert run_derived(spark, {"shop": shop}, "shop", options=options) == {"table2": []}
    assert run_derived(spark, {"shop": shop}, "shop") == {"table2": [1690000123]}


def test_derived_with_intermediates(spark, path):
    derived = {
        "temp_sql": {"table2_copy": COPY, "twice": "SELECT * FROM __temp__.table2_copy UNION ALL SELECT * FROM __temp__.big"},
        "final_sql": {"table2": "SELECT seats, carrier, land_ts FROM {{ temporary_database }}.twice"},
        "uses_shared_sql": True,
    }
    big = "SELECT seats, carrier, land_ts FROM {{ database_name }}.table1 WHERE seats > 15"
    shop = home(path, derived=derived, shared_sql={"derived": {"big": big}})
    curate(spark, path, shop)
    run_derived(spark, {"shop": shop}, "shop", options=DerivedOptions(shared_path=f"{path}/shared"))
    out = spark.read.parquet(f"{path}/derived/table2")
    assert values(out, "seats", "carrier") == [(10, "trolley"), (12, "trolley"), (16, "tram"), (20, "ferry")]


def test_inputs_of_one_name_from_two_pipelines(spark, path):
    sql = """
        SELECT a.seats, b.carrier, a.land_ts FROM {{ database_name }}.table1 a
        JOIN {{ database_name }}.depot__table1 b ON a.land_ts = b.land_ts AND a.seats = b.seats
    """
    shop, depot = home(f"{path}/a", derived={"final_sql": {"table2": sql}}), home(f"{path}/b")
    spec = shop.table("table2")
    both = {("depot", "table1"): "curated", ("shop", "table1"): "curated"}
    out = TableSpec("table2", spec.contracts, spec.formats, "derived", inputs=both, final_sql={"table2": sql})
    shop = Pipeline("shop", "dev", shop.base_paths, {**shop.tables, "table2": out}, PART)
    for p, lines in ((shop, LINES), (depot, [l.replace("trolley", "bike") for l in LINES])):
        root = p.base_path("raw_hist").rsplit("/", 1)[0]
        put(f"{root}/raw_hist/pass/table1/{PART}=1690000123/a.csv", lines[:2])
        run_shape(spark, p, "table1")
    assert run_derived(spark, {"shop": shop, "depot": depot}, "shop") == {"table2": [1690000123]}
    assert values(spark.read.parquet(f"{path}/a/derived/table2"), "seats", "carrier") == [(12, "bike"), (16, "tram")]


@pytest.mark.parametrize("final", [{}, {"other": COPY}, {"table2": COPY, "more": COPY}])
def test_derived_needs_one_final_query(spark, path, final):
    shop = home(path, derived={"final_sql": final})
    curate(spark, path, shop)
    with pytest.raises(ContractError, match="exactly one final query"):
        run_derived(spark, {"shop": shop}, "shop")


def test_shared_table_is_reused_for_the_same_partitions(spark, path):
    frame = spark.createDataFrame([(1, 20200101), (2, 20200102)], f"x int, {PART} long")
    sql = f"SELECT * FROM {{{{ database_name }}}}.t WHERE {PART} IN ({{{{ snapshot_timestamps }}}})"

    def build(parts):
        rows, built = shared_temp(spark, f"{path}/s", sql, template_values(PART, "dev", parts), {"t": frame}, PART, parts)
        return sorted(r["x"] for r in rows.collect()), built

    assert build([20200101]) == ([1], True)
    assert build([20200101]) == ([1], False)
    assert build([20200101, 20200102]) == ([1, 2], True)
    with pytest.raises(ContractError, match="no data"):
        build([20200103])


# ---- lint -------------------------------------------------------------------------------------------------------

NAMES = [f"dummy_data{i}.csv" for i in range(1, 5)]


def land(path, bad=()):
    for i, name in enumerate(NAMES):
        put(f"{path}/land/table1/{name}", ["99,bird,x,y,z"] if name in bad else [LINES[i]])


def test_lint_moves_passing_files_under_their_names(spark, path):
    land(path)
    result = run_lint(spark, home(path), 1700000000)
    assert (result.files, result.failed_files, result.published) == (4, 0, True)
    assert visible(f"{path}/raw_hist/pass/table1/{PART}=1700000000") == NAMES
    assert visible(f"{path}/land/table1") == []
    assert visible(f"{path}/raw_hist/log/table1") == ["report", "verdicts"]
    report = spark.read.parquet(result.log_paths["table1"])
    assert report.agg(F.sum("failures")).first()[0] == 0 and report.select("file").distinct().count() == 4
    assert run_lint(spark, home(path), 1700000001).tables == []


def test_lint_with_a_failing_file(spark, path):
    land(path, NAMES[:1])
    result = run_lint(spark, home(path), 1700000000)
    assert (result.failed_files, result.published) == (1, False)
    assert visible(f"{path}/raw_hist/pass/table1") == [] and visible(f"{path}/land/table1") == NAMES
    assert visible(f"{path}/raw_hist/fail/table1/{PART}=1700000000") == NAMES[:1]
    failed = spark.read.parquet(result.log_paths["table1"]).where("failures > 0")
    assert values(failed, "column_name", "rule_name") == [
        ("carrier", "enum"), ("opened", "type"), ("opened_at", "type"), ("seats", "range"),
    ]
    result = run_lint(spark, home(path, all_must_pass=False), 1700000001)
    assert result.published and visible(f"{path}/land/table1") == []
    assert visible(f"{path}/raw_hist/pass/table1/{PART}=1700000001") == NAMES[1:]


def test_lint_keeps_landed_files_if_asked(spark, path):
    land(path)
    run_lint(spark, home(path, remove_on_pass=False), 1700000000)
    assert visible(f"{path}/land/table1") == NAMES
    assert visible(f"{path}/raw_hist/pass/table1/{PART}=1700000000") == NAMES


def test_lint_headers_and_header_only_files(spark, path):
    put(f"{path}/land/table1/a.csv", [LINES[0]], HEADER.upper())
    put(f"{path}/land/table1/b.csv", [])
    put(f"{path}/land/table1/c.csv", ["16,tram"], "seats,carrier")
    shop = home(path, all_must_pass=False, lint=LintOptions(allow_missing_cols=False))
    result = run_lint(spark, shop, 1700000000)
    assert (result.files, result.failed_files) == (3, 2)
    assert visible(f"{path}/raw_hist/pass/table1/{PART}=1700000000") == ["b.csv"]
    relaxed = home(path, lint=LintOptions(allow_missing_cols=True, headers_ignore_case=True))
    put(f"{path}/land/table1/a.csv", [LINES[0]], HEADER.upper())
    put(f"{path}/land/table1/c.csv", ["16,tram"], "seats,carrier")
    assert run_lint(spark, relaxed, 1700000001).failed_files == 0


def test_lint_without_headers_and_with_mixed_case(spark, path):
    put(f"{path}/land/table1/a.csv", LINES[1:2], LINES[0])
    shop = home(path, lint=LintOptions(expect_header=False))
    result = run_lint(spark, shop, 1700000000)
    report = spark.read.parquet(result.log_paths["table1"])
    assert result.failed_files == 0 and report.agg(F.max("rows")).first()[0] == 2
    put(f"{path}/land/table1/b.csv", ["99,tram"], "Seats,Carrier")
    mixed = home(path, lint=LintOptions(headers_ignore_case=True, allow_missing_cols=True))
    result = run_lint(spark, mixed, 1700000001)
    failed = spark.read.parquet(result.log_paths["table1"]).where("failures > 0")
    assert values(failed, "column_name", "rule_name") == [("seats", "range")]


def test_lint_rows_with_a_wrong_number_of_cells(spark, path):
    put(f"{path}/land/table1/a.csv", [LINES[0], LINES[1] + ",extra"])
    put(f"{path}/land/table1/b.csv", [LINES[2], "16,tram"])
    put(f"{path}/land/table1/c.csv", [LINES[3]])
    result = run_lint(spark, home(path, all_must_pass=False), 1700000000)
    assert (result.files, result.failed_files) == (3, 2)
    failed = spark.read.parquet(result.log_paths["table1"]).where("failures > 0")
    assert values(failed, "column_name", "rule_name", "rows", "failures") == [("*", "cells", 2, 1)] * 2


def test_lint_odd_headers(spark, path):
    """Nothing a single file holds stops the job: the file fails and the others go on."""
    plain = Contract("table1", (ColumnSpec("a", "string"), ColumnSpec("b", "string")))
    spec = TableSpec("table1", {"raw_hist": plain}, {"land": "csv", "raw_hist": "csv"}, lint=LintOptions())
    shop = Pipeline("shop", "dev", home(path).base_paths, {"table1": spec}, PART, all_must_pass=False)
    for name, text in {"ok": "a,b\n1,2\n", "twice": "a,b,a\n1,2,3\n", "blank": "\n1,2\n", "other": "x,y\n1,2\n"}.items():
        put(f"{path}/land/table1/{name}.csv", [], text.rstrip("\n"))
    result = run_lint(spark, shop, 1700000000)
    assert (result.files, result.failed_files) == (4, 3)
    assert visible(f"{path}/raw_hist/pass/table1/{PART}=1700000000") == ["ok.csv"]
    failed = spark.read.parquet(result.log_paths["table1"]).where("failures > 0")
    name = F.substring_index("file", "/", -1)
    assert set(values(failed.where(name == "twice.csv"), "rule_name", "column_name")) == {("duplicate", "a")}


def test_reader_options(spark, path):
    shop = home(path)
    spec = shop.table("table1")
    odd = TableSpec("table1", spec.contracts, spec.formats, lint=spec.lint, read_options={"sep": ";", "multiLine": "true"})
    shop = Pipeline("shop", "dev", shop.base_paths, {"table1": odd}, PART)
    put(f"{path}/land/table1/a.csv", ['16;tram;"a\n;b";2019-05-03 08:15:40;1961-07-04'], HEADER.replace(",", ";"))
    assert run_lint(spark, shop, 1700000000).failed_files == 0
    run_shape(spark, shop, "table1")
    assert values(spark.read.parquet(f"{path}/curated/table1"), "seats", "owner") == [(16, "a\n;b")]


def test_lint_staged_partitions_are_promoted(spark, path):
    for i, name in enumerate(NAMES):
        put(f"{path}/land/table1/{PART}=1690000000/{name}", [LINES[i]])
    run_lint(spark, home(path), 1700000000, temp_staging=True)
    assert visible(f"{path}/raw_hist/pass/table1/{PART}=1700000000") == NAMES
    assert visible(f"{path}/raw_hist/temp/pass/table1") == []


def test_lint_files_of_different_types(spark, path):
    """One file has numbers, one has text that is not always a number."""
    flat = Contract("table1", (ColumnSpec("seats", "int64", nullable=False, maximum=20),))
    spec = TableSpec("table1", {"raw_hist": flat}, {"land": "parquet", "raw_hist": "parquet"}, lint=LintOptions())
    shop = Pipeline("shop", "dev", home(path).base_paths, {"table1": spec}, PART, all_must_pass=False)
    for name, sql in {"a": "SELECT 5 AS seats", "b": "SELECT '7' AS seats", "c": "SELECT 'x' AS seats", "d": "SELECT 50L AS seats"}.items():
        spark.sql(sql).coalesce(1).write.mode("append").parquet(f"{path}/land/table1/from_{name}")
    result = run_lint(spark, shop, 1700000000)
    assert (result.files, result.failed_files) == (4, 2)
    base = f"{path}/raw_hist/pass/table1/{PART}=1700000000"
    assert visible(base) == ["from_a", "from_b"]


def test_lint_json(spark, path):
    shop = home(path, fmt="json", all_must_pass=False)
    row = '{"seats": %s, "carrier": "%s", "owner": null, "opened_at": "2000-01-01 00:00:00", "opened": "1975-03-21"}'
    put(f"{path}/land/table1/a.json", [row % (12, "bike")], row % (10, "ferry"))
    put(f"{path}/land/table1/b.json", [row % (12, "cow")], row % ('"x"', "ferry"))
    result = run_lint(spark, shop, 1700000000)
    assert (result.files, result.failed_files) == (2, 1)
    failed = spark.read.parquet(result.log_paths["table1"]).where("failures > 0")
    assert values(failed, "column_name", "rule_name") == [("carrier", "enum"), ("seats", "type")]


@pytest.mark.parametrize("tags, failed", [(['[{"k": 1}]', '[{"k": 2}]'], 0), (['[{"k": 1}]', '[{"k": "x"}]'], 1), (["3"], 1)])
def test_lint_nested_json(spark, path, tags, failed):
    nested = Contract("table1", (ColumnSpec("id", "int32"), ColumnSpec("tags", "list<struct<k:int64>>")))
    spec = TableSpec("table1", {"raw_hist": nested}, {"land": "json", "raw_hist": "json"}, lint=LintOptions())
    shop = Pipeline("shop", "dev", home(path).base_paths, {"table1": spec}, PART, all_must_pass=False)
    for i, text in enumerate(tags):
        put(f"{path}/land/table1/f{i}.json", [], f'{{"id": {i}, "tags": {text}}}')
    assert run_lint(spark, shop, 1700000000).failed_files == failed


def test_lint_casts(spark, path):
    casts = (CastColumn("seats", "int64", "string"),)
    shop = home(path, lint=LintOptions(allow_missing_cols=True, casts=casts))
    put(f"{path}/land/table1/a.csv", ["x,tram"], "seats,carrier")
    assert run_lint(spark, shop, 1700000000).failed_files == 0


def test_required_table_without_files(spark, path):
    with pytest.raises(ContractError, match="table1"):
        run_lint(spark, home(path, lint=LintOptions(required=True)), 1700000000)


# ---- stream -----------------------------------------------------------------------------------------------------


def test_stream_takes_new_files_only(spark, path):
    shop = home(path, fmt="csv")
    land_two(path)
    options = ShapeOptions(partition=PART)
    args = (spark, shop, "table1", f"{path}/checkpoint")
    ingest_now(*args, options=options, quarantine=f"{path}/bad")
    out = f"{path}/curated/table1"
    assert spark.read.parquet(out).count() == 4
    # A late file of an old partition is taken, its bad row is set aside, and nothing is taken twice.
    put(f"{path}/raw_hist/pass/table1/{PART}=1690000123/late.csv", [LINES[2], "99,bike,,2000-01-01 00:00:00,2000-01-01"])
    for _ in range(2):
        ingest_now(*args, options=options, quarantine=f"{path}/bad")
    assert values(spark.read.parquet(out).where(f"{PART} = 1690000123"), "seats") == [(12,), (16,), (20,)]
    assert values(spark.read.parquet(f"{path}/bad"), "seats", "failed_rules") == [("99", "seats:range")]


def test_stream_of_json_with_formats(spark, path):
    raw = Contract(
        "table1",
        (
            ColumnSpec("id", "int32", nullable=False),
            ColumnSpec("day", "date32", format="%d/%m/%Y"),
            ColumnSpec("tags", "list<struct<k:int64>>"),
            ColumnSpec("gone", "null"),
        ),
    )
    curated = raw.without(["gone"]).with_columns(ColumnSpec(PART, "int64")).with_partitions(PART)
    spec = TableSpec("table1", {"raw_hist": raw, "curated": curated}, {"raw_hist": "json", "curated": "parquet"})
    shop = Pipeline("shop", "dev", home(path).base_paths, {"table1": spec}, PART)
    text = '{"id": 1, "day": "02/01/2024", "tags": [{"k": 5}]}\n{"id": null}\n{"id": 2, "day": "x"}'
    put(f"{path}/raw_hist/pass/table1/{PART}=1690000123/a.json", [], text)
    ingest_now(spark, shop, "table1", f"{path}/cp", options=ShapeOptions(partition=PART), quarantine=f"{path}/bad")
    rows = spark.read.parquet(f"{path}/curated/table1").collect()
    assert [(r["id"], str(r["day"]), r["tags"][0]["k"], r[PART]) for r in rows] == [(1, "2024-01-02", 5, 1690000123)]
    assert values(spark.read.parquet(f"{path}/bad"), "failed_rules") == [("day:type",), ("id:nullable",)]
