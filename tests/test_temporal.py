"""As-of and interval joins, column profiles, keys against history, and functions in templates."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from conftest import values
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.operators.history import check_key_history, possible_hits, read_key_filters, write_key_filters
from stagewise.operators.profiles import column_profiles, merge_profiles, profile_report
from stagewise.operators.temporal import asof_join, interval_join, overlap_join
from stagewise.plans.derived import DerivedOptions, run_derived
from stagewise.plans.hooks import Hooks
from workload import QUERIES

PART = "land_ts"


# ---- as of ------------------------------------------------------------------------------------------------------


def latest(rows, right, within=None):
    out = []
    for k, t, x in rows:
        known = [(u, y) for j, u, y in right if None not in (k, t, j, u) and j == k and u <= t]
        best = max(known, default=None)
        ok = best is not None and (within is None or t - best[0] <= within)
        out.append((k, t, x, *(best if ok else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("within", [None, 3])
def test_asof_is_the_latest_earlier_row_also_under_a_hot_key(spark, within):
    rng = random.Random(3)
    key = lambda: rng.choice(["hot"] * 3 + [f"k{rng.randrange(8)}", None])
    left = [(key(), rng.choice([None, *range(0, 120)]), n) for n in range(600)]
    right = [(key(), rng.choice([None, *range(10, 200)]), n) for n in range(300)] + [("hot", 40, 5), ("hot", 40, 7)]
    a = spark.createDataFrame(left, "k string, t int, x int").repartition(3)
    b = spark.createDataFrame(right, "k string, u int, y int").repartition(3)
    got = asof_join(a, b, "t", "u", ["k"], within=within, bucket_rows=40)
    assert got.columns == ["k", "t", "x", "u", "y"]
    assert sorted(map(tuple, got.collect()), key=str) == latest(left, right, within)
    inner = asof_join(a, b, "t", "u", ["k"], "inner", within, bucket_rows=40)
    assert sorted(map(tuple, inner.collect()), key=str) == [r for r in latest(left, right, within) if r[3] is not None]


def test_asof_groups_are_bounded_and_odd_inputs(spark):
    rows = [("hot", datetime(2024, 1, 1) + timedelta(seconds=n), n) for n in range(400)]
    a = spark.createDataFrame(rows, "k string, t timestamp_ntz, x int")
    b = a.select("k", F.col("t").alias("u"), F.col("x").alias("y"))
    got = asof_join(a, b, "t", "u", ["k"], bucket_rows=50)
    assert all(r["x"] == r["y"] for r in got.collect())
    assert asof_join(a, b.limit(0), "t", "u", ["k"]).where("y IS NULL").count() == 400
    assert asof_join(a.limit(0), b, "t", "u", ["k"]).count() == 0
    whole = asof_join(a.drop("k"), b.drop("k"), "t", "u").agg(F.count_if(F.col("x") == F.col("y"))).first()[0]
    assert whole == 400
    with pytest.raises(ContractError, match="both sides"):
        asof_join(a, a.withColumnRenamed("t", "u"), "t", "u", ["k"])
    with pytest.raises(ContractError, match="not a whole number"):
        asof_join(a, b.withColumn("u", F.lit("x")), "t", "u", ["k"])
    with pytest.raises(ContractError, match="outer"):
        asof_join(a, b, "t", "u", ["k"], "outer")


# ---- intervals --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
def test_points_in_intervals(spark, closed):
    rng = random.Random(4)
    points = [(rng.choice([1, 2, None]), rng.choice([None, rng.randrange(-500, 500)]), n) for n in range(300)]
    points += [(1, x, 1000 + x % 7) for x in (-(2**63), 2**63 - 1, 0)]
    spans = []
    for n in range(200):
        a = rng.randrange(-400, 400)
        spans.append((rng.choice([1, 2, None]), rng.choice([None, a]), a + rng.choice([0, 0, 1, 3, 7, 8, 9, 250, -1, 900]), n))
    spans += [(1, -(2**63), 2**63 - 1, 900), (2, -(2**63), 0, 901), (1, 5, None, 902), (1, 0, 2**62 + 5, 903)]
    low = (lambda p, a: p >= a) if closed in ("left", "both") else (lambda p, a: p > a)
    high = (lambda p, b: p <= b) if closed in ("right", "both") else (lambda p, b: p < b)
    want = sorted(
        (i, n)
        for k, p, i in points
        for j, a, b, n in spans
        if None not in (k, p, j, a, b) and a <= b and k == j and low(p, a) and high(p, b)
    )
    left = spark.createDataFrame(points, "k int, p long, i int")
    right = spark.createDataFrame(spans, "k int, a long, b long, n int")
    joined = interval_join(left, right, "p", "a", "b", ["k"], closed)
    assert joined.columns == ["k", "p", "i", "a", "b", "n"] and values(joined, "i", "n") == want
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlaps_of_dates_and_odd_inputs(spark):
    rng = random.Random(5)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    make = lambda: [(day(a := rng.randrange(60)), day(a + rng.choice([-2, 0, 1, 1, 4, 30])), n) for n in range(80)]
    a, b = make(), make()
    want = sorted((i, j) for s, e, i in a for t, f, j in b if s < e and t < f and s < f and t < e)
    left, right = spark.createDataFrame(a, "s date, e date, i int"), spark.createDataFrame(b, "t date, f date, j int")
    assert values(overlap_join(left, right, ("s", "e"), ("t", "f")), "i", "j") == want
    assert interval_join(left, right.limit(0), "s", "t", "f").count() == 0
    assert interval_join(left.limit(0), right, "s", "t", "f").count() == 0
    with pytest.raises(ContractError, match="both sides"):
        interval_join(left, left, "s", "s", "e")
    with pytest.raises(ContractError, match="closed"):
        interval_join(left, right, "s", "t", "f", closed="maybe")


def joined_rows(plan):
    """The most rows that a join of a plan that ran has made."""
    rows = [plan.metrics().get("numOutputRows").get().value()] if "Join" in plan.nodeName() else [0]
    inner = [getattr(plan, x)() for x, kind in (("executedPlan", "AdaptiveSparkPlan"), ("plan", "QueryStage")) if kind in plan.getClass().getSimpleName()]
    children = plan.children()
    return max([*rows, *map(joined_rows, [*inner, *[children.apply(n) for n in range(children.size())]])])


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
@pytest.mark.parametrize("by", [["k"], []])
def test_sums_over_intervals_are_those_of_the_pairs(spark, closed, by):
    rng = random.Random(7)
    key = lambda: rng.choice([1, 1, 1, 2, 3, None])
    ends = (-(2**63), 2**63 - 1)
    points = [(key(), rng.choice([None, *range(-60, 60)]), n) for n in range(300)] + [(1, 7, 0), (1, 7, 0)]
    points += [(k, x, 1000) for k in (1, 2) for x in (*ends, ends[1] - 1)]
    spans = []
    for n in range(200):
        a = rng.randrange(-50, 50)
        b = a + rng.choice([0, 0, 1, 1, 2, 9, 40, -1])
        spans.append((key(), rng.choice([None, a, a, a]), b, rng.choice([None, n, -n, 2**33 + n, -(2**50) - n]), rng.choice([None, n, -n])))
    spans += [(3, -80, 80, None, None), (1, 0, None, 1, 1), (2, ends[0], ends[1], 3, 3), (1, ends[1], ends[1], 5, 5), (1, ends[0], ends[0], 9, 9)]
    low = (lambda p, a: p >= a) if closed in ("left", "both") else (lambda p, a: p > a)
    high = (lambda p, b: p <= b) if closed in ("right", "both") else (lambda p, b: p < b)
    # Where there is no point a sum may be beyond a long.
    spans += [*[(1, 200, 210, 2**62, 0)] * 5, (1, 240, 260, -(2**62), 4), (1, 205, 260, -5, 4)]
    points += [(1, 250, 1001)]
    want = []
    for k, p, i in points:
        hit = [(v, w) for j, a, b, v, w in spans if None not in (p, a, b) and a <= b and low(p, a) and high(p, b) and (not by or None not in (k, j) and j == k)]
        if hit:
            whole = [[x for x in side if x is not None] for side in zip(*hit, strict=True)]
            want.append((k, p, i, len(hit), *[sum(x) if x else None for x in whole], sum(whole[1]) + sum(x is not None for x in whole[1]) if whole[1] else None))
    left = spark.createDataFrame(points, "k int, p long, i int").repartition(3)
    right = spark.createDataFrame(spans, "k long, a long, b long, v long, w int").repartition(3)
    asked = {"n": F.lit(1), "vs": F.col("v"), "ws": F.col("w"), "more": F.col("w") + 1}
    got = interval_join(left, right, "p", "a", "b", by, closed, asked, bucket_rows=20)
    assert got.columns == ["k", "p", "i", "n", "vs", "ws", "more"] and {d for _, d in got.dtypes[3:]} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_sums_of_odd_inputs(spark):
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    left = spark.createDataFrame([(day(3), 1), (day(9), 2)], "s date, i int")
    right = spark.createDataFrame([(day(1), day(4), 2**62), (day(2), day(4), 2**62 - 1), (day(20), day(21), 2**62)], "t date, f date, v long")
    asked = {"n": F.lit(1), "v": F.col("v")}
    assert [tuple(r) for r in interval_join(left, right, "s", "t", "f", sums=asked).collect()] == [(day(3), 1, 2, 2**63 - 1)]
    assert [tuple(r) for r in interval_join(left, right, "s", "t", "f", sums={}).collect()] == [(day(3), 1)]
    assert interval_join(left, right.limit(0), "s", "t", "f", sums=asked).count() == 0
    assert interval_join(left.limit(0), right, "s", "t", "f", sums=asked).count() == 0
    with pytest.raises(ContractError, match="both sides"):
        interval_join(left, right, "s", "t", "f", sums={"i": F.col("v")})
    with pytest.raises(ContractError, match="not a whole number"):
        interval_join(left, right, "s", "t", "f", sums={"x": F.col("v") / 2})
    # One more in the same days is beyond a long.
    with pytest.raises(Exception, match="OVERFLOW|out of range"):
        interval_join(left, right.unionAll(right.limit(1)), "s", "t", "f", sums=asked).collect()


def test_orders_with_their_lines_under_way_make_no_pairs(spark, path):
    at = datetime(2024, 1, 1)
    lines = [(100 * (n % 3), n, 1, at + timedelta(days=n % 40, hours=9), float(50 - n % 7)) for n in range(2000)]
    orders = [(200 + 100 * (n % 3), n // 2, at + timedelta(days=30 + n % 30)) for n in range(2000)]
    schemas = ("l_suppkey long, l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double", "o_custkey long, o_orderkey long, o_orderdate timestamp_ntz")
    for name, rows, schema in (("lineitem", lines, schemas[0]), ("orders", orders, schemas[1])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    under_way = [(a.date(), a.date() + timedelta(days=int(q) + 2000 * (k % 100 == 0)), 10 * k + m) for _, k, m, a, q in lines]
    whole, pairs = {}, 0
    for _, o, t in orders:
        hit = [w for a, b, w in under_way if a <= t.date() < b]
        n, which = whole.get(o, (0, 0))
        whole[o], pairs = (n + len(hit), which + sum(hit)), pairs + len(hit)
    df = QUERIES["interval_join"](spark, path)
    assert sorted(map(tuple, df.collect())) == sorted((o, *x) for o, x in whole.items()) and pairs > 3_000_000
    assert joined_rows(df._jdf.queryExecution().executedPlan()) <= len(orders)


# ---- profiles ---------------------------------------------------------------------------------------------------

TYPED = Contract(
    "t",
    (
        ColumnSpec("n", "int64"),
        ColumnSpec("amount", "float64"),
        ColumnSpec("day", "date32"),
        ColumnSpec("at", "timestamp(us)"),
        ColumnSpec("name", "string"),
        ColumnSpec("tags", "list<string>"),
        ColumnSpec("gone", "string"),
    ),
)


def test_profiles_add_up_to_one_of_all_rows(spark):
    rows = [
        (f"f{n % 3}", n if n % 5 else None, n / 7, date(2024, 1, 1) + timedelta(days=n % 90), datetime(2024, 1, 1, 0, 0, n % 60), f"name{n % 700}", ["a"])
        for n in range(4000)
    ]
    df = spark.createDataFrame(rows, "file string, n long, amount double, day date, at timestamp_ntz, name string, tags array<string>")
    parts = column_profiles(df, TYPED)
    assert parts.count() == 3 * 6
    merged = {r["column_name"]: r for r in profile_report(merge_profiles(parts)).collect()}
    whole = {r["column_name"]: r for r in profile_report(column_profiles(df, TYPED, by=[])).collect()}
    names = ("rows", "nulls", "low_whole", "high_whole", "low_real", "high_real", "low_text", "high_text", "kind")
    assert all([merged[c][x] for x in names] == [whole[c][x] for x in names] for c in whole)
    assert (merged["n"]["rows"], merged["n"]["nulls"], merged["n"]["low_whole"], merged["n"]["high_whole"]) == (4000, 800, 1, 3999)
    assert merged["at"]["low_whole"] == 1704067200000000 and merged["day"]["high_whole"] == 19723 + 89
    assert (merged["name"]["low_text"], merged["name"]["high_text"]) == ("name0", "name99")
    for column, exact in (("n", 3200), ("amount", 4000), ("day", 90), ("at", 60), ("name", 700)):
        assert abs(merged[column]["distinct_values"] - exact) <= 0.07 * exact
    assert all(abs(q - s * 3999 / 7) < 30 for q, s in zip(merged["amount"]["quantiles"], (0.25, 0.5, 0.75), strict=True))
    assert merged["tags"]["kind"] == "other" and merged["tags"]["distinct_values"] is None and merged["name"]["quantiles"] is None


def test_profiles_of_text_cells_nulls_and_nothing(spark):
    text = spark.createDataFrame([("f", "5", "x"), ("f", "bad", None), ("g", None, None)], "file string, n string, amount string")
    found = {(r["file"], r["column_name"]): r for r in profile_report(column_profiles(text, TYPED)).collect()}
    assert (found["f", "n"]["low_whole"], found["f", "n"]["nulls"]) == (5, 1)
    assert (found["g", "n"]["nulls"], found["g", "n"]["distinct_values"], found["g", "n"]["quantiles"]) == (1, 0, None)
    assert column_profiles(text.limit(0), TYPED).count() == 0
    assert column_profiles(text.select("file"), TYPED).count() == 0


# ---- keys against history ---------------------------------------------------------------------------------------

KEYED = Contract("t", (ColumnSpec("a", "int64"), ColumnSpec("b", "string"), ColumnSpec(PART, "int64")), (PART,))


def test_keys_of_earlier_days_are_found_and_other_days_are_not_read(spark, path):
    rng = random.Random(6)
    old = [(d * 1000 + rng.randrange(900), rng.choice(["x", None]), 20240100 + d) for d in range(1, 9) for _ in range(300)]
    new = [(3000 + n, "x") for n in range(200)] + [(7000 + n, None) for n in range(50)] + [(50_000 + n, "x") for n in range(100)]
    rows = spark.createDataFrame(old, KEYED.struct())
    rows.write.mode("append").partitionBy(PART).parquet(path)
    write_key_filters(rows, path, ["a", "b"], PART)
    fresh = spark.createDataFrame([*new, *new], "a int, b string").withColumn("more", F.lit(1))
    got = check_key_history(fresh, path, KEYED, ["a", "b"], PART)
    counts = Counter(old)
    want = sorted(((a, b, p, n) for (a, b, p), n in counts.items() if (a, b) in set(new)), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want and len({p for _, _, p, _ in want}) == 2
    files = {f.split(f"{PART}=")[1].split("/")[0] for f in got.inputFiles() if f"{PART}=" in f}
    assert {"20240103", "20240107"} <= files and len(files) <= 4
    assert all(p < 20240105 for _, _, p, _ in map(tuple, check_key_history(fresh, path, KEYED, ["a", "b"], PART, before=20240105).collect()))
    # Day by day: a partition's new filter replaces its old one, and one without is an error.
    spark.createDataFrame([(99, "x", 20240120)], KEYED.struct()).write.mode("append").partitionBy(PART).parquet(path)
    with pytest.raises(ContractError, match="20240120"):
        check_key_history(fresh, path, KEYED, ["a", "b"], PART)
    write_key_filters(spark.createDataFrame([(99, "x", 20240120)], KEYED.struct()), path, ["a", "b"], PART)
    found = check_key_history(spark.createDataFrame([(99, "x")], "a long, b string"), path, KEYED, ["a", "b"], PART)
    assert (99, "x", 20240120, 1) in map(tuple, found.collect())
    assert read_key_filters(spark, path, PART).select(PART).distinct().count() == 9
    with pytest.raises(ContractError, match="not in the contract"):
        check_key_history(fresh, path, KEYED, ["c"], PART)


def test_filters_of_many_keys_are_cut_into_blocks_and_seldom_wrong(spark, path):
    rows = spark.range(40_000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(20240101).cast("long").alias(PART))
    write_key_filters(rows, path, ["a"], PART)
    filters = read_key_filters(spark, path, PART)
    assert filters.select("blocks").distinct().collect()[0][0] == 16 and filters.count() == 16
    other = spark.range(100_000, 120_000).select(F.col("id").alias("a"))
    assert possible_hits(other, filters, ["a"], PART).count() < 20_000 / 80
    assert possible_hits(rows.select("a"), filters, ["a"], PART).count() == 40_000
    assert check_key_history(other, f"{path}/none", KEYED, ["a"], PART).count() == 0


# ---- functions in templates -------------------------------------------------------------------------------------


def test_functions_are_installed_for_templates_and_hide_nothing(spark):
    hooks = Hooks()

    @F.arrow_udf("long")
    def add_up(v: pa.Array) -> int:
        return pc.sum(v).as_py()

    hooks.register_function("add_up_all", add_up)
    hooks.install(spark)
    hooks.install(spark)
    assert spark.sql("SELECT add_up_all(id) AS s FROM range(5)").first()["s"] == 10
    clash = Hooks()
    clash.register_function("Lower", add_up)
    with pytest.raises(ContractError, match="there is a function 'lower' already"):
        clash.install(spark)
    with pytest.raises(ContractError, match="cannot be the name"):
        hooks.register_table_function("a b", add_up)
    assert run_derived.__defaults__[1] == DerivedOptions() and spark.sql("SELECT lower('A')").first()[0] == "a"
