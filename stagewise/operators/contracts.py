"""Contract documents as tables: one row per document, so that many databases are handled at once."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import (
    COLUMN_TYPES,
    FILE_FORMATS,
    STAGES,
    STRUCT_LIST_PREFIX,
    ColumnSpec,
    Contract,
    ContractError,
)
from stagewise.functions.checks import repeated
from stagewise.functions.templates import render
from stagewise.sources.inventory import file_inventory, schema_inventory

# The layout of an all-stages contract document.
DOCUMENT_SCHEMA = """
    name string,
    description string,
    file_formats array<struct<name:string, format:string>>,
    sensitive boolean,
    primary_key array<string>,
    partitions array<string>,
    columns array<struct<
        name:string, nullable:boolean, enum:array<string>,
        stages:array<struct<name:string, type:string, pattern:string, format:string>>>>
"""


def load_contracts(
    spark: SparkSession, path: str | list[str], database: str = "", multi_line: bool = True
) -> DataFrame:
    """Every contract document of a folder, one row each; a table is named after its file.

    Without ``multi_line`` the files hold one document per line, and a table is named by its document.
    """
    docs = spark.read.schema(DOCUMENT_SCHEMA).options(multiLine=multi_line, pathGlobFilter="*.json").json(path)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    table = stem if multi_line else F.col("name")
    return docs.select(F.lit(database).alias("database"), table.alias("table_name"), "*")


def _blank_as_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def contract_columns(contracts: DataFrame) -> DataFrame:
    """One row per document, column and stage."""
    by_column = contracts.select(
        "database", "table_name", "partitions", "file_formats", F.posexplode("columns").alias("position", "c")
    )
    return by_column.select("*", F.explode("c.stages").alias("at")).select(
        "database",
        "table_name",
        "partitions",
        "file_formats",
        "position",
        F.col("at.name").alias("stage"),
        F.col("c.name").alias("column_name"),
        F.col("at.type").alias("column_type"),
        F.coalesce(F.col("c.nullable"), F.lit(False)).alias("nullable"),
        F.when(F.size("c.enum") > 0, F.col("c.enum")).alias("enum"),
        _blank_as_null(F.col("at.pattern")).alias("pattern"),
        _blank_as_null(F.col("at.format")).alias("format"),
    )


def stage_contract(contracts: DataFrame, stage: str) -> DataFrame:
    """The columns every table has at one stage, with that stage's file format.

    Only the curated stage is partitioned, so ``is_partition`` is false everywhere else.
    """
    fmt = F.filter("file_formats", lambda f: f["name"] == stage)[0]["format"]
    partition = F.array_contains("partitions", F.col("column_name")) if stage == "curated" else F.lit(False)
    return (
        contract_columns(contracts)
        .where(F.col("stage") == stage)
        .withColumns({"is_partition": F.coalesce(partition, F.lit(False)), "file_format": fmt})
        .drop("partitions", "file_formats", "stage")
    )


def contract_at(contracts: DataFrame, table: str, stage: str) -> Contract:
    """One table's contract at a stage as an object; its rows are bounded by the table's width."""
    rows = stage_contract(contracts.where(F.col("table_name") == table), stage).orderBy("position").collect()
    if not rows:
        raise ContractError(f"no columns of '{table}' at stage '{stage}'")
    columns = tuple(
        ColumnSpec(
            r["column_name"],
            r["column_type"],
            r["nullable"],
            tuple(r["enum"] or ()),
            r["pattern"] or "",
            r["format"] or "",
        )
        for r in rows
    )
    parts = tuple(r["column_name"] for r in rows if r["is_partition"])
    return Contract(table, columns, parts, file_format=rows[0]["file_format"] or "parquet", stage=stage)


# Fixed value: the two digits of a year in a column name, before more letters or at the end.
YEAR_PATTERN = r"([0-9]{2}(?=[a-zA-Z]+))|([0-9]{2}$)"


def contract_from_headers(spark: SparkSession, template: str, path: str, ext: str, stage: str = "") -> Contract:
    """Fill a contract template with the years that the newest file has in its column names.

    A column ``sales24`` gives ``24`` to the placeholders ``{{ sales_year }}`` and ``{{ SALES_year }}``. The newest
    file is the last one by path; only its header or footer is read.
    """
    newest = file_inventory(spark, path, ext=ext).agg(F.max("path")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no files below {path}")
    names = [r["column"] for r in schema_inventory(spark, newest, ext).orderBy("position").collect()]
    years = {}
    for name in names:
        found = re.search(YEAR_PATTERN, name)
        if found:
            base = re.sub(YEAR_PATTERN, "", name)
            years[f"{base.lower()}_year"] = years[f"{base.upper()}_year"] = found.group(0)
    return Contract.from_document(json.loads(render(template, years)), stage)


def data_dictionary(contracts: DataFrame) -> DataFrame:
    """One row per curated column of every table, with an empty description to fill in."""
    # The headings of the dictionary file.
    return stage_contract(contracts, "curated").select(
        F.col("database").alias("System"),
        F.col("database").alias("Dataset"),
        F.col("table_name").alias("Data Table"),
        F.col("column_name").alias("Data Field"),
        F.lit("").alias("Description"),
        F.col("column_type").alias("Data Type"),
        F.col("nullable").alias("Nullable"),
    )


def write_data_dictionary(contracts: DataFrame, path: str) -> None:
    """The dictionary as one CSV file."""
    data_dictionary(contracts).repartition(1).write.mode("overwrite").option("header", True).csv(path)


def contract_violations(contracts: DataFrame) -> DataFrame:
    """Broken rules, one row (database, table, rule, item) each. Every rule looks at one document only."""
    names = F.transform("columns", lambda c: c["name"])
    stages = F.flatten(F.transform("columns", lambda c: F.coalesce(c["stages"], F.array())))
    formats = F.coalesce(F.col("file_formats"), F.array())
    known_type = [F.lit(t) for t in COLUMN_TYPES]
    problems = {
        "duplicate column": repeated(names),
        "undeclared partition": F.array_except(F.coalesce("partitions", F.array().cast("array<string>")), names),
        "unknown type": F.transform(
            F.filter(
                stages,
                lambda s: ~F.array_contains(F.array(*known_type), s["type"])
                & ~s["type"].startswith(STRUCT_LIST_PREFIX),
            ),
            lambda s: s["type"],
        ),
        "unknown stage": F.array_except(
            F.concat(F.transform(stages, lambda s: s["name"]), F.transform(formats, lambda f: f["name"])),
            F.array(*[F.lit(s) for s in STAGES]),
        ),
        "unknown format": F.array_except(
            F.transform(formats, lambda f: f["format"]), F.array(*[F.lit(f) for f in FILE_FORMATS])
        ),
    }
    entries = [_labelled(rule, F.array_distinct(items)) for rule, items in problems.items()]
    return contracts.select("database", "table_name", F.inline(F.concat(*entries)))


def _labelled(rule: str, items: Column) -> Column:
    return F.transform(items, lambda item: F.struct(F.lit(rule).alias("rule_name"), item.alias("item")))
