"""Stages as external tables of the Spark catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stagewise.contract import Contract, ContractError, ddl
from stagewise.spec import Pipeline, full_database_name


def ensure_database(spark: SparkSession, name: str, description: str = "", location: str | None = None) -> None:
    """Create the database unless it exists."""
    place = f" LOCATION '{location}'" if location else ""
    comment = f" COMMENT '{text_literal(description)}'" if description else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{comment}{place}")


def recreate_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """An empty database; for temporary ones, whose tables are external and keep their files."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")
    ensure_database(spark, name, location=location)


def register_path(spark: SparkSession, database: str, contract: Contract, path: str, fmt: str = "parquet") -> str:
    """(Re)create an external table over a path and find its partitions; dropping it leaves the files alone."""
    table = f"{quoted(database)}.{quoted(contract.name)}"
    columns = [c for c in contract.data_columns if c.type != "null"]
    parts = [contract.lookup[p] for p in contract.partitions]
    # Partition columns come first in the contract's order, as the catalog keeps them apart from the data columns.
    fields = ", ".join(f"{quoted(c.name)} {ddl(c.type)}" for c in [*parts, *columns])
    by = f" PARTITIONED BY ({', '.join(quoted(p.name) for p in parts)})" if parts else ""
    options = " OPTIONS (header 'true')" if fmt == "csv" else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({fields}) USING {fmt}{options}{by} LOCATION '{text_literal(path)}'")
    if parts:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return table


def register(
    spark: SparkSession, pipeline: Pipeline, table: str, stage: str, prefix: str, location: str | None = None
) -> str:
    """Register one table of a pipeline at a stage in the pipeline's database, creating that if needed."""
    spec = pipeline.table(table)
    contract = spec.contract(stage)
    if contract.name != table:
        raise ContractError(f"contract is named '{contract.name}' but the table is '{table}'")
    database = full_database_name(pipeline.name, pipeline.env, prefix, derived=stage == "derived")
    ensure_database(spark, database, pipeline.description, location)
    return register_path(spark, database, contract, pipeline.path(table, stage), spec.formats[stage])


def quoted(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
