from __future__ import annotations

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.functions.tokens import (
    epoch_day,
    extract_partition,
    extract_timestamp,
    file_name_timestamp,
    partition_value,
    strip_lint_stamp,
)
from stagewise.operators import partitions as op
from stagewise.spec import Pipeline, TableSpec

PART = "land_ts"


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, name, expected",
    [
        ("lake/area/land_ts=1712345678/file.csv", PART, "land_ts=1712345678"),
        ("lake/area/land_ts=1712345678/zone=north/rows.snappy.parquet", PART, "land_ts=1712345678"),
        ("lake/area/notes.json", PART, None),
        ("noise55", PART, None),
        ("lake/area/drop_day=1711111111/f.snappy.parquet", "drop_day", "drop_day=1711111111"),
        ("lake/area/drop_day=20240601/f.snappy.parquet", "drop_day", "drop_day=20240601"),
        ("lake/area/land_ts=20240601/zone=north/rows.snappy.parquet", PART, "land_ts=20240601"),
        ("lake/area/land_ts=20240601", PART, "land_ts=20240601"),
        # Neither nine nor eleven digits are a landing partition.
        ("lake/area/land_ts=123456789/t.csv", PART, None),
        ("lake/area/land_ts=12345678901/t.csv", PART, None),
    ],
)
def test_extract_partition(spark, text, name, expected):
    assert one(spark, text, lambda c: extract_partition(c, name, strict=False)) == expected
    if expected is None:
        with pytest.raises(Exception, match="no land_ts partition"):
            one(spark, text, lambda c: extract_partition(c, name))
    else:
        assert one(spark, text, lambda c: extract_partition(c, name)) == expected


@pytest.mark.parametrize(
    "text, name, expected",
    [
        ("land_ts=", PART, None),
        ("land_ts=1711111111", PART, 1711111111),
        ("no token", PART, None),
        ("drop_day=1710000007", "drop_day", 1710000007),
        ("land_ts=20240229", PART, 20240229),
        ("x/land_ts=20240229", PART, None),
    ],
)
def test_extract_timestamp(spark, text, name, expected):
    assert one(spark, text, lambda c: extract_timestamp(c, name, strict=False)) == expected
    if expected is None:
        with pytest.raises(Exception, match="not a land_ts partition"):
            one(spark, text, lambda c: extract_timestamp(c, name))
    else:
        assert one(spark, text, lambda c: extract_timestamp(c, name)) == expected
        assert one(spark, f"a/{text}/f.csv", lambda c: partition_value(c, name)) == expected


@pytest.mark.parametrize(
    "text, ext, expected",
    [
        (
            "part-00007-e3f0aa12-9b1d-4c55-c000-2-1709876543.snappy.parquet",
            ".snappy.parquet",
            "part-00007-e3f0aa12-9b1d-4c55-c000.snappy.parquet",
        ),
        ("part-00007-e3f0aa12.snappy.parquet", ".snappy.parquet", None),
        ("orders_may-2-1709876543.csv", ".csv", "orders_may.csv"),
        ("orders_may-2-1709876543xcsv", ".csv", None),
        ("orders_may.csv", ".csv", None),
        ("plainname", "", None),
    ],
)
def test_strip_lint_stamp(spark, text, ext, expected):
    if expected is None:
        with pytest.raises(Exception, match="no lint stamp"):
            one(spark, text, lambda c: strip_lint_stamp(c, ext))
    else:
        assert one(spark, text, lambda c: strip_lint_stamp(c, ext)) == expected


@pytest.mark.parametrize(
    "existing, new, one_a_day, taken",
    [
        (["data_1655206833.csv", "data_1655120500.csv"], "data_1655293331.csv", True, True),
        (["data_1655206833.csv", "data_1655120500.csv"], "data_1655206840.csv", True, False),
        (["data_1655206833.csv", "data_1655120500.csv"], "data_1655206840.csv", False, True),
        (["data_1655206833.csv"], "data_1655206833.csv", False, False),
        ([], "data_1655206840.csv", False, True),
        (["leaflet.csv", "data_1655120500.csv"], "data_1655206840.csv", False, None),
        (["data_1655120500.csv"], "data_16552.csv", False, None),
    ],
)
def test_file_gate(spark, existing, new, one_a_day, taken):
    old = spark.createDataFrame([(f"in/{e}",) for e in existing], "path string")
    fresh = spark.createDataFrame([(f"in/{new}",)], "path string")
    if taken is None:
        with pytest.raises(Exception, match="no timestamp"):
            op.gate_files(fresh, old, one_a_day=one_a_day).collect()
    else:
        assert op.gate_files(fresh, old, one_a_day=one_a_day).count() == int(taken)


def test_file_name_timestamp(spark):
    assert one(spark, "s3://b/c/ferries_1655206840-12.snappy.parquet", file_name_timestamp) == 1655206840


def test_epoch_day_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = spark.range(1).select(epoch_day(F.lit(1655164799)), epoch_day(F.lit(1655164800))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days[1] == days[0] + 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    new=st.lists(st.tuples(st.sampled_from("abc"), st.integers(1_600_000_000, 1_600_400_000)), max_size=20),
    existing=st.lists(st.tuples(st.sampled_from("ab"), st.integers(1_600_000_000, 1_600_400_000)), max_size=20),
    one_a_day=st.booleans(),
)
def test_gate_against_brute_force(spark, new, existing, one_a_day):
    frames = [spark.createDataFrame(rows, "k string, ts long") for rows in (new, existing)]
    found = op.newer_than_existing(frames[0], frames[1], ["k"], one_a_day=one_a_day)
    latest = {k: max(t for k2, t in existing if k2 == k) for k, _ in existing}
    unit = 86_400 if one_a_day else 1
    assert values(found) == sorted((k, t) for k, t in new if latest.get(k, 0) // unit < t // unit)


def parts(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], f"{PART} long")


@pytest.mark.parametrize(
    "given_parts, done, expected",
    [
        ([1700000123, 1700000200], [1690000123, 1700000123], [1700000200]),
        ([1690000123, 1700000124, 1700000200], [1690000123], [1700000200, 1700000124]),
        ([1700000123], [1700000123], []),
        ([], [1700000123], []),
        ([1700000123, 1700000123], [], [1700000123]),
    ],
)
def test_unprocessed(spark, given_parts, done, expected):
    found = op.unprocessed(parts(spark, given_parts), parts(spark, done), PART)
    assert [r[0] for r in found.collect()] == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    inputs=st.lists(st.lists(st.integers(20200101, 20200112), max_size=30), min_size=1, max_size=4),
    done=st.lists(st.integers(20200101, 20200112), max_size=5),
    low=st.integers(20200101, 20200105),
    high=st.one_of(st.none(), st.integers(20200106, 20200112)),
)
def test_common_new_against_sets(spark, inputs, done, low, high):
    found = op.common_new([parts(spark, i) for i in inputs], parts(spark, done), PART, low, high)
    wanted = set.intersection(*map(set, inputs)) - set(done)
    wanted = {p for p in wanted if p >= low and (high is None or p <= high)}
    assert [r[0] for r in found.collect()] == sorted(wanted, reverse=True)


def test_common_new_needs_inputs(spark):
    with pytest.raises(ContractError):
        op.common_new([], parts(spark, []), PART)


def test_unprocessed_many(spark):
    rows = [("a", 20200101), ("a", 20200102), ("b", 20200101), ("b", 20200101)]
    done = [("a", 20200101), ("b", 20200102)]
    frames = [spark.createDataFrame(r, f"table_name string, {PART} long") for r in (rows, done)]
    assert values(op.unprocessed_many(*frames, PART)) == [("a", 20200102), ("b", 20200101)]


@pytest.mark.parametrize(
    "found, expected, row",
    [([1, 2], [2, 1], (0, 0, True)), ([1], [1, 2], (1, 0, False)), ([1, 2], [1], (0, 1, False)), ([], [], (0, 0, True))],
)
def test_partition_sets(spark, found, expected, row):
    assert tuple(op.compare_partitions(parts(spark, found), parts(spark, expected), PART).first()) == row
    assert op.same_partitions(parts(spark, found), expected, PART) is row[2]


def test_hot_partition_is_reduced_before_the_shuffle(spark):
    """A partition with most of the rows is one row per task when it is shuffled."""
    rows = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 > 0, 20200101).otherwise(20200102).alias(PART))
    plan = op.unprocessed(rows, parts(spark, [20200102]), PART)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in text and "Join" not in text
    assert [r[0] for r in plan.collect()] == [20200101]


def write_stage(path, partition_files):
    for part, files in partition_files.items():
        for name, text in files.items():
            os.makedirs(f"{path}/{part}", exist_ok=True)
            with open(f"{path}/{part}/{name}", "w") as out:
                out.write(text)


CONTRACT = Contract("table1", (ColumnSpec("a", "string"),))


def pipeline(path):
    spec = TableSpec(
        "table1",
        {"raw_hist": CONTRACT, "curated": CONTRACT},
        {"land": "csv", "raw_hist": "csv", "curated": "csv"},
    )
    bases = {s: f"{path}/{s}" for s in ("land", "raw_hist", "curated")}
    return Pipeline("db", "dev", bases, {"table1": spec, "other": TableSpec("other", {}, {"land": "csv"})}, PART)


def test_stage_listing_and_work_list(spark, path):
    home = pipeline(path)
    write_stage(
        f"{path}/raw_hist/pass/table1",
        {
            "land_ts=1690000123": {"d1.csv": "a\n1\n"},
            "land_ts=1700000123": {"d2.csv": "a\n1\n", "d3.csv": "a\n2\n"},
            "land_ts=1700000200": {"d4.csv": "a\n1\n"},
            "land_ts=1700000300": {"empty.csv": ""},
        },
    )
    write_stage(f"{path}/curated/table1", {"land_ts=1690000123": {"d1.csv": "a\n1\n"}})
    found = op.stage_partitions(spark, home.path("table1", "raw_hist"), PART)
    assert values(found) == [(1690000123,), (1700000123,), (1700000200,)]
    assert op.stage_partitions(spark, f"{path}/nowhere", PART).count() == 0
    work = op.unprocessed_all(spark, home)
    assert work == {"table1": [1700000200, 1700000123]}
    assert op.unprocessed_all(spark, home, kinds=["custom"]) == {}


def test_unexpected_folder_is_an_error(spark, path):
    write_stage(path, {"no token=1690000123": {"d1.csv": "a\n1\n"}})
    with pytest.raises(Exception, match="no land_ts partition"):
        op.stage_partitions(spark, path, PART).collect()


def test_drop_partitions(spark, path):
    write_stage(path, {f"{PART}=2020010{i}": {"a.csv": "a\n"} for i in (1, 2, 3)})
    gone = op.drop_partitions(spark, path, PART, [20200101, 20200103, 20200109])
    assert [g.rsplit("=", 1)[1] for g in gone] == ["20200101", "20200103"]
    assert os.listdir(path) == [f"{PART}=20200102"]


def test_restamp(spark):
    same = spark.createDataFrame([(1, 20200101), (2, 20200101)], f"a int, {PART} long")
    assert values(op.restamp(same, PART, 1700000000)) == [(1, 1700000000), (2, 1700000000)]
    with pytest.raises(ContractError, match="more than one"):
        op.restamp(same.union(spark.createDataFrame([(3, 20200102)], same.schema)), PART, 1700000000)


def test_promote(spark, path):
    staged, target = f"{path}/temp/pass/t", f"{path}/pass/t"
    assert op.promote(spark, staged, target, PART, 1700000000) is None
    write_stage(staged, {f"{PART}=1690000000": {"a.csv": "a\n1\n", "b.csv": "a\n2\n"}})
    assert op.promote(spark, staged, target, PART, 1700000000) == f"{target}/{PART}=1700000000"
    assert sorted(f for f in os.listdir(f"{target}/{PART}=1700000000") if f[0] != ".") == ["a.csv", "b.csv"]
    write_stage(staged, {f"{PART}=1690000001": {"a.csv": "a\n"}, f"{PART}=1690000002": {"a.csv": "a\n"}})
    with pytest.raises(ContractError, match="more than one"):
        op.promote(spark, staged, target, PART, 1700000001)


def test_partition_predicates_prune_folders(spark, path):
    spark.range(6).select("id", (F.col("id") + 20200101).alias(PART)).write.partitionBy(PART).parquet(f"{path}/t")
    rows = spark.read.parquet(f"{path}/t")
    for kept in (rows.where(op.cutoff(PART, 20200102, 20200103)), op.only_partitions(rows, PART, [20200102, 20200103])):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and PART in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert values(kept, "id") == [(1,), (2,)]
    assert rows.where(op.cutoff(PART)).count() == 6
