"""What goes wrong in real landing areas: stray and damaged files, reruns without rows, changed contracts, bad cells."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.operators.partitions import unprocessed_all
from stagewise.operators.shaping import ShapeOptions
from stagewise.plans.lint import run_lint
from stagewise.plans.load import LoadOptions, sql_load
from stagewise.plans.shape import run_shape
from stagewise.session import scratch_path
from stagewise.sources.files import rename_path
from stagewise.sources.inventory import day_window, file_inventory, path_below
from stagewise.sources.scans import read_csv, scan_stage
from stagewise.spec import TableSpec
from stagewise.streaming.ingest import ingest_now
from workload.jobs import CURATED_EVENTS, LOAD_SQL, RAW_COLUMNS, event_table, land_events, pipeline, read_events
from workload.registry import EVENT_DAY, PART, events, land, query

ALL_EVENTS = f"SELECT event_id, value, CAST(user_id AS INTEGER) AS user_id, event_type, {EVENT_DAY} AS land_ts FROM events"
# Days since the epoch, to tell days apart.
DAY_NUMBER = f"{EVENT_DAY} // 86400"


def stray(df: DataFrame, folder: str, name: str) -> None:
    """A file of lines of text in a folder, under a name that promises something else."""
    spark = df.sparkSession
    apart = scratch_path(spark, "stray")
    df.select(F.col("props").alias("value")).repartition(1).write.text(apart)
    made = file_inventory(spark, apart, ext="txt").first()["path"]
    rename_path(spark, f"{apart}/{path_below(made, apart)}", f"{folder}/{name}")


PLAIN = Contract(
    "events",
    (ColumnSpec("event_id", "int64"), ColumnSpec("event_type", "string"), ColumnSpec("value", "float64")),
)


@query("scan_csv_mixed_folder", "SELECT event_id, event_type, value FROM events")
def q_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and packed files, of upper-case endings and other separators' headers too, beside a text file."""
    base = scratch_path(spark, "mixed")
    rows = events(spark, sf_dir).select("event_id", "event_type", "value", "props")
    packed, swapped = F.col("event_type") == "click", F.col("event_type") == "view"
    writer = {"header": True, "sep": ";"}
    rows.where(~packed & ~swapped).write.mode("append").options(**writer).csv(base)
    rows.where(packed).write.mode("append").options(**writer, compression="gzip").csv(base)
    rows.where(swapped).select("value", "props", "event_type", "event_id").write.mode("append").options(**writer).csv(base)
    for file in file_inventory(spark, base, ext="csv").limit(1).collect():
        name = path_below(file["path"], base)
        rename_path(spark, f"{base}/{name}", f"{base}/{name[:-4]}[1].CSV" if name.endswith(".csv") else f"{base}/{name}.GZ")
    stray(rows, base, "notes.txt")
    return read_csv(spark, base, PLAIN, delimiter=";")


@query(
    "lint_unreadable_files",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END AS area, count(*) AS n, 0 AS broken
    FROM events GROUP BY 1
    UNION ALL SELECT 'fail', 0, 2 FROM (SELECT count(*) AS n FROM events) WHERE n > 0
    """,
)
def q_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged file and a stray one fail by themselves; files with a forbidden value fail, all others pass."""
    base = scratch_path(spark, "damaged")
    rows = events(spark, sf_dir).select(*[c for c in RAW_COLUMNS if c not in (PART, "props")], "props")
    for bad in (False, True):
        chosen = rows.where((F.col("event_type") == "error") == bad)
        chosen.drop("props").write.mode("append").parquet(f"{base}/land/events")
    stray(rows, f"{base}/land/events", "cut.parquet")
    stray(rows, f"{base}/land/events", "readme.txt")
    calm = Contract(
        "events",
        (
            ColumnSpec("event_id", "int64", nullable=False),
            ColumnSpec("event_type", "string", enum=("click", "purchase", "signup", "view")),
            ColumnSpec("value", "float64"),
            ColumnSpec("user_id", "int64"),
        ),
    )
    kind = event_table()
    spec = TableSpec("events", {**kind.contracts, "raw_hist": calm}, kind.formats, kind.kind, kind.lint)
    run_lint(spark, pipeline(base, spec, all_must_pass=False), run_ts=1706745600)
    area = F.regexp_extract("path", "/(pass|fail)/", 1).alias("area")
    whole = F.col("path").rlike("/part-[^/]*$")
    files = file_inventory(spark, f"{base}/raw_hist").where("path rlike '/(pass|fail)/'").select("path", area)
    damaged = files.where(~whole).groupBy("area").agg(F.lit(0).cast("long").alias("n"), F.count("*").cast("int").alias("broken"))
    reader = spark.read.schema("event_id long").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.parquet")
    where = F.regexp_extract(F.col("_metadata.file_path"), "/(pass|fail)/", 1).alias("area")
    counted = reader.parquet(f"{base}/raw_hist").select(where).where("area <> ''").groupBy("area").agg(F.count("*").alias("n"))
    return counted.withColumn("broken", F.lit(0)).unionByName(damaged)


@query("sql_load_rerun", f"{ALL_EVENTS} WHERE {DAY_NUMBER} % 2 = 1")
def q_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose rerun gives no rows are cleared, and not chosen again."""
    base = scratch_path(spark, "rerun")
    land_events(spark, sf_dir, base)
    shop = pipeline(base, event_table(), shared_sql={"default": {"raw_to_curated": LOAD_SQL}})
    options = LoadOptions(input_stage="raw_hist")
    days = sql_load(spark, shop, "events", options)
    nothing = LOAD_SQL.rstrip() + " AND event_id < 0"
    sql_load(spark, shop, "events", options, sql=nothing, partitions=[d for d in days if d // 86400 % 2 == 0])
    if sql_load(spark, shop, "events", options):
        raise AssertionError("a processed day was chosen again")
    return read_events(spark, base)


@query("ingest_then_batch", ALL_EVENTS)
def q_ingest_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream and a batch job write one stage; readers see the rows of both."""
    base = scratch_path(spark, "both")
    rows = events(spark, sf_dir).select(*RAW_COLUMNS)
    free = CURATED_EVENTS.lookup
    raw = Contract("events", tuple(ColumnSpec(c, free[c].type) for c in ("event_id", "value", "event_type")) + (
        ColumnSpec("user_id", "int64"),
    ))
    spec = TableSpec("events", {"raw_hist": raw, "curated": CURATED_EVENTS}, {"raw_hist": "parquet", "curated": "parquet"})
    shop, path = pipeline(base, spec), f"{base}/raw_hist/pass/events"
    early = F.col(PART) / 86400 % 2 == 0
    for part, run in ((rows.where(early), "stream"), (rows.where(~early), "batch")):
        part.hint("rebalance", PART).write.mode("append").partitionBy(PART).parquet(path)
        if run == "stream":
            ingest_now(spark, shop, "events", f"{base}/checkpoint", options=ShapeOptions(partition=PART))
        else:
            run_shape(spark, shop, "events")
    return read_events(spark, base)


@query(
    "scan_evolved_contract",
    f"""
    SELECT event_id, CASE WHEN {DAY_NUMBER} % 2 = 0 THEN user_id END AS user_id, {EVENT_DAY} AS land_ts FROM events
    """,
)
def q_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that the contract has gained is null in the files that were written before."""
    base = scratch_path(spark, "evolved")
    rows, newer = events(spark, sf_dir).select("event_id", "user_id", PART), F.col(PART) / 86400 % 2 == 0
    land(rows.where(~newer).drop("user_id"), f"{base}/curated/events")
    rows.where(newer).hint("rebalance", PART).write.mode("append").partitionBy(PART).parquet(f"{base}/curated/events")
    names = (ColumnSpec("event_id", "int64"), ColumnSpec("user_id", "int64"), ColumnSpec(PART, "int64"))
    spec = TableSpec("events", {"curated": Contract("events", names, (PART,))}, {"curated": "parquet"})
    return scan_stage(spark, pipeline(base, spec), "events", "curated")


@query(
    "run_shape_bad_cells",
    f"SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value, {EVENT_DAY} AS land_ts, TRUE AS refused FROM events",
)
def q_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are no numbers stop the job before anything is published, unless they may become null."""
    base = scratch_path(spark, "cells")
    value = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    land(events(spark, sf_dir).select("event_id", value.alias("value"), PART), f"{base}/raw_hist/pass/events", "csv")
    raw = (ColumnSpec("event_id", "int64"), ColumnSpec("value", "float64"))
    curated = Contract("events", (*raw, ColumnSpec(PART, "int64")), (PART,))
    spec = TableSpec(
        "events", {"raw_hist": Contract("events", raw), "curated": curated}, {"raw_hist": "csv", "curated": "parquet"}
    )
    shop, refused = pipeline(base, spec), False
    try:
        run_shape(spark, shop, "events")
    except Exception as error:  # noqa: BLE001
        refused = "is no float64" in str(error)
    run_shape(spark, shop, "events", null_bad_cells=True)
    return spark.read.schema(curated.struct()).parquet(f"{base}/curated/events").withColumn("refused", F.lit(refused))


@query(
    "unprocessed_window",
    f"SELECT 'inside' AS run, {EVENT_DAY} AS land_ts FROM events GROUP BY 2",
)
def q_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose files were modified inside a run's window are chosen, and none in a window that is past."""
    base = scratch_path(spark, "window")
    land_events(spark, sf_dir, base)
    shop = pipeline(base, event_table())
    rows = []
    for run, window in (
        ("inside", day_window(date(2020, 1, 1))),
        ("past", day_window(date(2020, 1, 1), date(2020, 1, 2))),
    ):
        rows += [(run, day) for day in unprocessed_all(spark, shop, window=window)["events"]]
    return spark.createDataFrame(rows, f"run string, {PART} long")
