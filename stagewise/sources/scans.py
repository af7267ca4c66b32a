"""Typed scans of a stage."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.contract import ColumnSpec, Contract, ContractError, ddl
from stagewise.functions.formats import parse, utc_wall_clock
from stagewise.operators.nested import as_type, reader_type, same_shape
from stagewise.operators.shaping import reconcile_contract
from stagewise.session import settle
from stagewise.sources.inventory import file_inventory, literal_path, name_filter, schema_inventory, window_options
from stagewise.spec import Pipeline

CORRUPT = "_corrupt_record"
# Contract types that JSON has no type for.
TEXTUAL_IN_JSON = ("date32", "date64", "timestamp(ns)", "timestamp(us)", "timestamp(ms)", "timestamp(s)", "datetime")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    corrupt: bool = False,
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """Comma-separated files with a header, under the contract's types.

    Cells are read as text and converted by the contract's formats, so one bad cell becomes null without losing the
    row; if ``strict``, it is an error. ``corrupt`` keeps the raw line of rows whose number of cells is wrong. Contract
    columns that no file has are left out.
    """
    contract = contract.without(contract.null_typed())
    text = read_csv_text(spark, path, contract, corrupt, **options)
    present = [c for c in contract.data_columns if c.name in text.columns]
    typed = [(_parsed_or_error if strict else parse)(F.col(f"`{c.name}`"), c).alias(c.name) for c in present]
    return text.select(*typed, *contract.partitions, *([CORRUPT] if corrupt else []))


def _parsed_or_error(col: Column, spec: ColumnSpec) -> Column:
    value = parse(col, spec)
    message = F.concat(F.lit(f"a cell of column {spec.name} is no {spec.type}: "), F.substring(col, 1, 100))
    return F.when(col.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)


@dataclass(frozen=True)
class FileGroup:
    """Files whose columns have the same names, types and order."""

    columns: tuple[tuple[str, str], ...]
    paths: str | list[str]


def file_groups(
    spark: SparkSession, path: str | list[str], inventory: DataFrame, listed: bool = False
) -> list[FileGroup]:
    """The files below a path by their own schema, the most common one first.

    Normally there is one group, which is the path itself. Where files differ, or if they are to be ``listed`` as the
    path has others too, each group lists its files: no more than Spark's own file index holds.
    """
    inventory = settle(inventory, "schemas") if not listed else inventory
    fields = F.array_sort(F.collect_list(F.struct("position", "column", "type")))
    shapes = inventory.groupBy("file").agg(F.to_json(fields).alias("shape"))
    counts = shapes.groupBy("shape").agg(F.count("*").alias("files")).orderBy(F.desc("files"), "shape").collect()
    columns = {r["shape"]: tuple((f["column"], f["type"]) for f in json.loads(r["shape"])) for r in counts}
    if len(columns) == 1 and not listed:
        return [FileGroup(next(iter(columns.values())), path)]
    kept = settle(shapes, "shapes")
    return [
        FileGroup(named, [literal_path(r["file"]) for r in kept.where(F.col("shape") == shape).select("file").collect()])
        for shape, named in columns.items()
    ]


def read_csv_text(
    spark: SparkSession, path: str | list[str], contract: Contract, corrupt: bool = False, **options: str
) -> DataFrame:
    """The same files with every cell as text, which is what the type rule has to see.

    Spark takes CSV columns by position, so files are read together only if their header lines agree.
    """
    groups = file_groups(spark, path, schema_inventory(spark, path, "csv", **options))
    if not groups:
        raise FileNotFoundError(f"no CSV files with a header below {path}")
    if len(groups) > 1 and isinstance(path, str):
        options = {"basePath": path, **options}
    frames = [read_csv_group(spark, g, contract, corrupt, **options) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_group(
    spark: SparkSession,
    group: FileGroup,
    contract: Contract,
    corrupt: bool = False,
    ignore_case: bool = False,
    **options: str,
) -> DataFrame:
    """The contract's columns of files with one header, as text."""
    header = [name for name, _ in group.columns]
    stored = reconcile_contract(header, contract.without(contract.partitions), ignore_case)
    positions = [f"c{i}" for i in range(len(header))]
    fields = [T.StructField(p, T.StringType()) for p in positions]
    fields += [T.StructField(p, contract.lookup[p].spark_type) for p in contract.partitions]
    fields += [T.StructField(CORRUPT, T.StringType())] if corrupt else []
    options = {"header": "true", "mode": "PERMISSIVE", "pathGlobFilter": name_filter("csv"), **options}
    reader = spark.read.schema(T.StructType(fields)).options(**options)
    if corrupt:
        # A parser that skips cells nobody asked for would not see that a row has too many or too few.
        reader = reader.options(columnNameOfCorruptRecord=CORRUPT, columnPruning="false")
    # A name that occurs twice in a header stands for its first column.
    wanted = [F.col(positions[header.index(given)]).alias(c.name) for c, given in stored]
    if corrupt:
        # Spark refuses to read the raw line alone, so it is tied to a cell.
        wanted.append(F.when(F.coalesce(F.length(positions[0]), F.lit(0)) >= 0, F.col(CORRUPT)).alias(CORRUPT))
    return reader.csv(group.paths).select(*wanted, *contract.partitions)


# Type words of files that are no contract types -> Spark DDL word.
FILE_WORDS = {"float": "float", "int8": "tinyint", "int16": "smallint", "zoned": "timestamp"}


def file_type(text: str) -> T.DataType:
    """The Spark type in which a file's column is read; some file types are narrower than any contract type."""
    # A time with a zone has two words in its brackets.
    return T.DataType.fromDDL(ddl(re.sub(r"timestamp\(\w+, [^)]*\)", "zoned", text), FILE_WORDS))


def read_parquet_group(
    spark: SparkSession, group: FileGroup, contract: Contract, ignore_case: bool = False, **options: str
) -> DataFrame:
    """The contract's columns of files with one schema, in the files' own types."""
    names = [name for name, _ in group.columns]
    stored = reconcile_contract(names, contract.without(contract.partitions), ignore_case)
    kinds = dict(group.columns)
    fields = [T.StructField(given, reader_type(file_type(kinds[given]), c.spark_type)) for c, given in stored]
    fields += [T.StructField(p, contract.lookup[p].spark_type) for p in contract.partitions]
    options = {"pathGlobFilter": name_filter("parquet"), **options}
    rows = spark.read.schema(T.StructType(fields)).options(**options).format("parquet").load(group.paths)
    return rows.select(*[F.col(f"`{given}`").alias(c.name) for c, given in stored], *contract.partitions)


def read_parquet_drifted(
    spark: SparkSession, path: str | list[str], contract: Contract, **options: str
) -> DataFrame:
    """Parquet files whose columns may differ from file to file, each cast from its own types.

    A plain read takes one file's schema for all, so it would lose the columns that only other files have.
    """
    groups = file_groups(spark, path, schema_inventory(spark, path, "parquet"))
    if not groups:
        raise FileNotFoundError(f"no Parquet files below {path}")
    frames = [cast_to_contract(read_parquet_group(spark, g, contract, **options), contract, True) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parquet(
    spark: SparkSession, path: str | list[str], contract: Contract, partial: bool = False, **options: str
) -> DataFrame:
    """Parquet files under the contract's names and types.

    The files' own types are read and then cast, as a reader schema cannot change a stored type. A partition column
    gets its contract type too, where Spark would infer an int from ten digits. Fields of structs go by name, and one
    that only some files have is null in the others.
    """
    return cast_to_contract(_load_parquet(spark, path, options, contract), contract, partial)


def _load_parquet(
    spark: SparkSession, path: str | list[str], options: Mapping[str, str], contract: Contract, gained: bool = False
) -> DataFrame:
    """Parquet files in their own types, of nested columns only what the contract has.

    With ``gained``, columns that only the contract has, if they may be null, are there in its types: read from the
    files that have them, and null in those that lack them. The same holds for fields of structs in any case.
    """
    rows = _load_first(spark, path, options)
    known = {given: c for c, given in reconcile_contract(rows.columns, contract)}
    fields = [
        T.StructField(f.name, reader_type(f.dataType, known[f.name].spark_type)) if f.name in known else f
        for f in rows.schema.fields
    ]
    if gained:
        found = {c.name for c in known.values()}
        new = [c for c in contract.data_columns if c.nullable and c.name not in found]
        fields += [T.StructField(c.name, c.spark_type) for c in new]
    if same_shape(T.StructType(fields), rows.schema):
        return rows
    options = {"pathGlobFilter": name_filter("parquet"), **options}
    reader = spark.read.options(**options).schema(T.StructType(fields))
    return reader.parquet(*([path] if isinstance(path, str) else path))


def _load_first(spark: SparkSession, path: str | list[str], options: Mapping[str, str]) -> DataFrame:
    """Parquet files in the types of one. An empty file holds no rows, but it must not be asked for the schema."""
    options = {"pathGlobFilter": name_filter("parquet"), **options}
    reader = spark.read.options(**options).format("parquet")
    try:
        return reader.load(path)
    except Exception as error:
        if "CANNOT_READ_FILE_FOOTER" not in str(error):
            raise
        first = file_inventory(spark, path, ext="parquet", **options).select("path").head()
        if first is None:
            raise
        return reader.schema(spark.read.parquet(literal_path(first["path"])).schema).load(path)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """JSON records, typed by a contract or with an inferred schema; ``multi_line`` for one document per file.

    Dates and times are read as text and converted by their declared formats.
    """
    reader = spark.read.options(**{"multiLine": str(multi_line), "pathGlobFilter": name_filter("json"), **options})
    if contract is None:
        return reader.json(path)
    textual = [c for c in contract.data_columns if c.type in TEXTUAL_IN_JSON]
    rows = reader.schema(contract.with_columns(*[replace(c, type="string") for c in textual]).struct()).json(path)
    return rows.withColumns({c.name: parse(F.col(f"`{c.name}`"), c) for c in textual}) if textual else rows


def cast_to_contract(df: DataFrame, contract: Contract, partial: bool = False) -> DataFrame:
    """Select the contract's columns by name (exact, lower or upper case) and cast each to its type, fields by name too.

    A contract column or field that the data lacks is an error; when ``partial``, the column is left out and the field
    is null.
    """
    stored = reconcile_contract(df.columns, contract)
    missing = set(contract.column_names) - {c.name for c, _ in stored}
    if missing and not partial:
        raise ContractError(f"columns {sorted(missing)} of '{contract.name}' are not in the data")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_as_declared(F.col(f"`{given}`"), kinds[given], c, partial).alias(c.name) for c, given in stored])


def _as_declared(col: Column, kind: T.DataType, spec: ColumnSpec, fill: bool) -> Column:
    if spec.type == "timestamp(ns)" and isinstance(kind, T.LongType):
        # Nanosecond files are only readable as longs (spark.sql.legacy.parquet.nanosAsLong).
        return utc_wall_clock(F.floor(col.cast("decimal(19,0)") / F.lit(1000).cast("decimal(4,0)")))
    return as_type(col, kind, spec.spark_type, spec.name, fill)


def read_stage(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    contract: Contract,
    partial: bool = False,
    drifted: bool = False,
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """Rows of one stage in whichever format it is kept. Null-typed columns are not read, as no stage keeps them.

    ``drifted`` is for Parquet files that this library has not written, whose columns may differ. If ``strict``, a CSV
    cell that is not of its column's type is an error; else it is null.
    """
    contract = contract.without(contract.null_typed())
    if fmt == "csv":
        typed = read_csv(spark, path, contract, strict=strict, **options)
    elif fmt == "parquet":
        if drifted:
            typed = read_parquet_drifted(spark, path, contract, **options)
        else:
            typed = _load_parquet(spark, path, options, contract, gained=True)
    elif fmt == "json":
        typed = read_json(spark, path, contract, **options)
    else:
        raise ContractError(f"cannot read '{fmt}' files")
    return cast_to_contract(typed, contract, partial)


def landed(contract: Contract, partition: str) -> Contract:
    """The contract with the landing partition as a not-null long, and as the first partition if it is none yet."""
    contract = contract.with_columns(ColumnSpec(partition, "int64", nullable=False))
    if partition in contract.partitions:
        return contract
    return contract.with_partitions(partition, *contract.partitions)


def scan_stage(
    spark: SparkSession,
    pipeline: Pipeline,
    table: str,
    stage: str,
    after: datetime | None = None,
    before: datetime | None = None,
    extra_stages: Mapping[str, tuple[str, str, Contract]] | None = None,
    ext: str | None = None,
) -> DataFrame:
    """All rows of a table at a stage, from files modified strictly inside a window (UTC).

    Empty files hold no rows and are skipped. ``extra_stages`` maps further stage names to (base path, format,
    contract); the table is a folder of its name below that path.
    """
    spec = pipeline.table(table)
    if extra_stages and stage in extra_stages:
        base, fmt, contract = extra_stages[stage]
        path = f"{base.rstrip('/')}/{table}"
    else:
        path, fmt, contract = pipeline.path(table, stage), spec.formats.get(stage, ""), spec.contract(stage)
    options = {**spec.read_options, **window_options(after, before)}
    if ext:
        options["pathGlobFilter"] = name_filter(ext)
    return read_stage(spark, path, fmt, landed(contract, pipeline.partition), **options)


def partition_paths(path: str, partition: str, values: Sequence[int]) -> list[str]:
    return [f"{path}/{partition}={int(v)}" for v in values]


def scan_partitions(
    spark: SparkSession,
    path: str,
    fmt: str,
    contract: Contract,
    partition: str,
    values: Sequence[int],
    partial: bool = False,
    drifted: bool = False,
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """Rows of the given landing partitions. Only their folders are listed, however long the table's history is.

    If another partition comes first in the layout, all folders are listed, and those of other partitions skipped.
    """
    if contract.partitions[:1] != (partition,):
        rows = read_stage(spark, path, fmt, contract, partial, drifted, strict, **options)
        return rows.where(F.col(partition).isin([int(v) for v in values]))
    paths = partition_paths(path, partition, values)
    return read_stage(spark, paths, fmt, contract, partial, drifted, strict, **{**options, "basePath": path})


def input_scans(
    spark: SparkSession,
    pipelines: Mapping[str, Pipeline],
    pipeline: str,
    table: str,
    partitions: Sequence[int] | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """One DataFrame per input of a derived table, each resolved in the pipeline that owns it."""
    spec = pipelines[pipeline].table(table)
    scans = {}
    for (owner, name), stage in spec.inputs.items():
        if owner not in pipelines:
            raise ContractError(f"input pipeline '{owner}' of '{table}' is not known")
        home = pipelines[owner]
        if partitions is None:
            scans[(owner, name)] = scan_stage(spark, home, name, stage)
            continue
        given = home.table(name)
        contract = landed(given.contract(stage), home.partition)
        path, fmt = home.path(name, stage), given.formats[stage]
        scans[(owner, name)] = scan_partitions(
            spark, path, fmt, contract, home.partition, partitions, **given.read_options
        )
    return scans
