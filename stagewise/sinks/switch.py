"""Publishing by switching locations in the catalog, for stores where renaming a folder copies it.

Each run writes its partitions into a folder of its own, beside all others: nothing that readers see is touched. When
every file has been checked, the catalog's entry of each partition is pointed to the run's folder. A reader of a partition
therefore has all of its old files or all of its new ones. If a step fails, the entries that were switched before are
pointed back, so the table is as it was, and the run's folder is dropped.

What was replaced is noted in a table beside the data, with the run that replaced it, and its folders are dropped later,
by ``drop_replaced``, when queries that may still read them have ended. Only the work list of a run and its partitions'
entries pass through the driver.
"""

from __future__ import annotations

import time
import urllib.parse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import Contract, ContractError, ddl
from stagewise.sinks.catalog import ensure_database, quoted, text_literal
from stagewise.sinks.write import check_files, check_frame, write_partitioned
from stagewise.sources.files import delete_path, path_exists
from stagewise.sources.inventory import file_inventory

# Values of a partition, in the contract's order of partitions.
Values = tuple[str, ...]
REPLACED = "location string, replaced_by long"


def create_switched(spark: SparkSession, database: str, contract: Contract, path: str) -> str:
    """The external table whose partitions are switched; it is left as it is if it exists."""
    if not contract.partitions:
        raise ContractError(f"the contract of '{contract.name}' has no partitions to switch")
    ensure_database(spark, database)
    table = f"{quoted(database)}.{quoted(contract.name)}"
    columns = [*[contract.lookup[p] for p in contract.partitions], *[c for c in contract.data_columns if c.type != "null"]]
    fields = ", ".join(f"{quoted(c.name)} {ddl(c.type)}" for c in columns)
    by = ", ".join(quoted(p) for p in contract.partitions)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet PARTITIONED BY ({by}) LOCATION '{text_literal(path)}'"
    )
    return table


def publish_switched(
    df: DataFrame,
    table: str,
    path: str,
    contract: Contract,
    unit: str,
    units: Sequence[int] | None = None,
    gather: bool = True,
    cast: bool = False,
    run: int | None = None,
) -> int:
    """Write a run's folder, check its files, and switch the table's partitions to it; gives the run.

    ``unit`` is the landing partition: all that the table has of a written unit is replaced, also further partitions
    below it that are not written again. ``units`` that the frame has no rows of are cleared.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if unit not in contract.partitions:
        raise ContractError(f"the contract of '{contract.name}' must be partitioned by {unit}")
    if not cast:
        check_frame(df, contract)
    run = time.time_ns() // 1000 if run is None else run
    folder = f"{path}/run={run}"
    # A run that is repeated after it was cut off starts with an empty folder.
    delete_path(spark, folder)
    done: list[tuple[Values, str | None]] = []
    try:
        write_partitioned(df, folder, contract, gather=gather, fresh=True)
        check_files(spark, folder, contract)
        written = written_partitions(spark, folder, contract)
        at = contract.partitions.index(unit)
        meant = {values[at] for values in written} | {str(int(u)) for u in units or ()}
        present = table_partitions(spark, table, contract)
        gone = [v for v in present if v[at] in meant and v not in written]
        old = {v: location_of(spark, table, contract, v) for v in present if v[at] in meant}
        note_replaced(spark, path, [x for x in old.values() if x], run)
        for values, place in [*written.items(), *[(v, None) for v in gone]]:
            # Noted first: taking back a step that was not made changes nothing.
            done.append((values, old.get(values)))
            switch_partition(spark, table, contract, values, place)
    except BaseException:
        for values, place in reversed(done):
            switch_partition(spark, table, contract, values, place)
        delete_path(spark, f"{path}/_replaced/run={run}")
        delete_path(spark, folder)
        raise
    return run


def written_partitions(spark: SparkSession, folder: str, contract: Contract) -> dict[Values, str]:
    """The partitions that a run's folder has files of, and where."""
    if not path_exists(spark, folder):
        return {}
    # Spark writes a value that a folder name cannot hold with escapes.
    cols = [
        F.url_decode(F.replace(F.regexp_extract("path", rf"/\Q{p}\E=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))).alias(f"v{n}")
        for n, p in enumerate(contract.partitions)
    ]
    place = F.regexp_replace("path", "/[^/]*$", "").alias("place")
    rows = file_inventory(spark, folder).select(*cols, place).distinct().collect()
    return {tuple(r[f"v{n}"] for n in range(len(contract.partitions))): r["place"] for r in rows}


def table_partitions(spark: SparkSession, table: str, contract: Contract) -> list[Values]:
    """The partitions in the catalog's entry of a table."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = []
    for row in rows:
        parts = dict(p.split("=", 1) for p in row["partition"].split("/"))
        values.append(tuple(urllib.parse.unquote(parts[p]) for p in contract.partitions))
    return values


def _spec(contract: Contract, values: Values) -> str:
    pairs = zip(contract.partitions, values, strict=True)
    return ", ".join(f"{quoted(p)} = '{text_literal(v)}'" for p, v in pairs)


def location_of(spark: SparkSession, table: str, contract: Contract, values: Values) -> str | None:
    """Where the catalog says that a partition lies."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_spec(contract, values)})").collect()
    # The partition's own place comes before the table's.
    return next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)


def switch_partition(spark: SparkSession, table: str, contract: Contract, values: Values, place: str | None) -> None:
    """Point a partition to a folder, or take it out of the catalog; the files stay."""
    spec = _spec(contract, values)
    if place is None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        return
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{text_literal(place)}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{text_literal(place)}'")


def note_replaced(spark: SparkSession, path: str, places: Sequence[str], run: int) -> None:
    if places:
        rows = spark.createDataFrame([(p, run) for p in places], REPLACED)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/_replaced/run={run}")


def drop_replaced(spark: SparkSession, table: str, path: str, contract: Contract, before: int) -> list[str]:
    """Delete the folders that runs up to ``before`` have replaced; gives them. One that is in use again is kept."""
    path = path.rstrip("/")
    if not path_exists(spark, f"{path}/_replaced"):
        return []
    noted = spark.read.schema(REPLACED + ", run long").parquet(f"{path}/_replaced").where(F.col("replaced_by") <= before)
    rows = noted.select("location", "replaced_by").distinct().collect()
    used = {location_of(spark, table, contract, v) for v in table_partitions(spark, table, contract)}
    gone = [r["location"] for r in rows if r["location"] not in used and delete_path(spark, r["location"])]
    for run in {r["replaced_by"] for r in rows}:
        delete_path(spark, f"{path}/_replaced/run={run}")
    return sorted(gone)
