"""Compare registered queries with their SQL in DuckDB. Run as a script: ``python tests/oracle.py <sf> [key ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, Decimal):
        return ("d", str(value))
    return (type(value).__name__, str(value))


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


# Spark type -> DuckDB type of a column that both sides return.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """An empty text if both sides agree, else what differs."""
    rows = [tuple(r) for r in df.collect()]
    found = con.execute(sql)
    names, kinds = [d[0] for d in found.description], [str(d[1]) for d in found.description]
    want_names, want = _sorted(names, found.fetchall())
    got_names, got = _sorted(df.columns, rows)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    by_name = dict(zip(names, kinds, strict=True))
    for name, kind in df.dtypes:
        if kind in TYPES and TYPES[kind] != by_name[name]:
            return f"type of {name}: {kind} != {by_name[name]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
        return f"{len(pairs)} rows differ, first {pairs[0]}"
    return "" if rows else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, queries, oracle = connect(sf_dir), entry.queries(), entry.oracle_sql()
    failed = []
    for key in sys.argv[2:] or queries:
        started = time.time()
        try:
            df = queries[key](spark, sf_dir)
            problem = compare(df, con, oracle[key]) if key in oracle else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = "".join(traceback.format_exception_only(error))[:600]
        print(f"{'ok  ' if not problem else 'FAIL'} {time.time() - started:6.2f}s {key} {problem}", flush=True)
        failed += [key] if problem else []
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
