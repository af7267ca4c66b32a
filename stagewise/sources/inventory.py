"""File listings and per-file schemas as DataFrames."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Iterator, Mapping
from datetime import UTC, date, datetime, time

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ContractError, leaves
from stagewise.functions.tokens import partition_value, plain_path

# The type in an inventory of a file that cannot be opened as what its name says.
UNREADABLE = "unreadable"
LEAVES = "array<struct<path:string,type:string>>"
FILE_SCHEMA = f"file string, position int, column string, type string, leaves {LEAVES}"
# A listing row costs almost nothing, so a task takes many files whatever their sizes are.
LISTING_TASKS_PER_CORE = 4


# A run's modification window: strictly after the first moment and before the second, each if given.
Window = tuple[datetime | None, datetime | None]


def window_options(after: datetime | None, before: datetime | None) -> dict[str, str]:
    """Reader options for files modified strictly after / before a moment (UTC)."""
    options = {"timeZone": "UTC"}
    if after is not None:
        options["modifiedAfter"] = after.strftime("%Y-%m-%dT%H:%M:%S.%f")
    if before is not None:
        options["modifiedBefore"] = before.strftime("%Y-%m-%dT%H:%M:%S.%f")
    return options


def day_window(start: date | None = None, end: date | None = None) -> tuple[datetime | None, datetime | None]:
    """The modification window of a run from its first and last day: midnight to one second before it, in UTC."""
    after = datetime.combine(start, time(0, 0, 0), UTC) if start else None
    before = datetime.combine(end, time(23, 59, 59), UTC) if end else None
    return after, before


# Formats whose files may be compressed as a whole.
COMPRESSIBLE = ("csv", "json")


def name_filter(ext: str) -> str:
    """The glob that says which files are of a format: by their ending in any case, for text also behind ``.gz``.

    Every reader, listing, verdict and move goes by it.
    """
    ext = ext.lstrip(".").lower()
    ending = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in ext)
    return f"*.{ending}{{,.[gG][zZ]}}" if ext in COMPRESSIBLE else f"*.{ending}"


def literal_path(path: str) -> str:
    """A path in which Spark's readers find no glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_inventory(
    spark: SparkSession,
    path: str | list[str],
    partition: str | None = None,
    ext: str | None = None,
    **options: str,
) -> DataFrame:
    """One row per non-empty file below a path: ``path``, ``size``, ``modified`` and its landing partition.

    The file contents are not read: only the listing columns of the binary source are selected. The listing itself
    runs in parallel over folders. Further reader options, such as ``window_options``, narrow the listing.
    """
    reader = spark.read.format("binaryFile").options(**{"recursiveFileLookup": "true", **options})
    if ext:
        reader = reader.option("pathGlobFilter", name_filter(ext))
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    files = (
        reader.load(path)
        .where("length > 0")
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
        .coalesce(tasks)
    )
    if partition:
        files = files.withColumn(partition, partition_value(F.col("path"), partition))
    return files


def schema_inventory(
    spark: SparkSession,
    path: str | list[str],
    ext: str | None = None,
    multi_line: bool = False,
    keep_unreadable: bool = False,
    **options: str,
) -> DataFrame:
    """Rows (file, position, column, type, leaves) for every file below a path, types in contract words.

    A file that cannot be read is an error, or with ``keep_unreadable`` one row of the type ``unreadable``.

    ``leaves`` has the path and plain type of each innermost field, one for a column that is not a struct.

    CSV files are opened for their header line only and Parquet files for their footer only, in parallel over the
    files; JSON records are read in full, as any of them may bring a new field. ``multi_line`` is for JSON files
    that hold one document each instead of one record per line.
    """
    if ext is None:
        files = file_inventory(spark, path, **options)
        kinds = [r["kind"] for r in files.select(_suffix(F.col("path")).alias("kind")).distinct().collect()]
        if not kinds:
            raise FileNotFoundError(f"no files below {path}")
        frames = [schema_inventory(spark, path, kind, multi_line, keep_unreadable, **options) for kind in sorted(kinds)]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out
    # Formats whose schema can be read file by file.
    layout = csv_layout(options) if ext == "csv" else {}
    readers = {"parquet": _parquet_rows, "csv": lambda file: _csv_rows(file, layout)}
    if ext == "json":
        whole = multi_line or options.get("multiLine") == "true"
        return _json_schemas(spark, path, whole, keep_unreadable, options)
    if ext not in readers:
        raise ContractError(f"cannot read the schema of '{ext}' files")
    read = readers[ext]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (file, position, name, kind, _leaf_rows(kind, name))
                for file in batch["path"]
                for position, (name, kind) in enumerate(_tried(read, file) if keep_unreadable else read(file))
            ]
            yield pd.DataFrame(found, columns=["file", "position", "column", "type", "leaves"])

    return file_inventory(spark, path, ext=ext, **options).select("path").mapInPandas(rows, FILE_SCHEMA)


def _tried(read: Callable[[str], list[tuple[str, str]]], file: str) -> list[tuple[str, str]]:
    """What a file's schema is, or that it has none. Files that are gone or out of reach are still errors."""
    try:
        return read(file)
    except (FileNotFoundError, PermissionError):
        raise
    except (ValueError, OSError, EOFError, csv.Error):  # Arrow's errors are among these
        return [("", UNREADABLE)]


def headers(inventory: DataFrame) -> DataFrame:
    """One row per file with its column names in order, from ``schema_inventory`` rows."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "column")))
    return inventory.groupBy("file").agg(F.transform(ordered, lambda c: c["column"]).alias("header"))


def _leaf_rows(kind: str, name: str) -> list[dict[str, str]]:
    return [{"path": path, "type": leaf} for path, leaf in leaves(kind, name)]


def _leaf_series(kinds: pd.Series, names: pd.Series) -> pd.Series:
    return pd.Series([_leaf_rows(kind, name) for kind, name in zip(kinds, names, strict=True)])


def _suffix(path: Column) -> Column:
    """The ending of a file's name in lower case, without ``.gz``; a name without one has an empty ending."""
    name = F.regexp_replace(F.lower(F.substring_index(path, "/", -1)), r"\.gz$", "")
    return F.regexp_extract(name, r"\.([^.]+)$", 1)


def local_path(path: str) -> str:
    """A path without the ``file:`` scheme; other schemes stay."""
    return "/" + path[len("file:") :].lstrip("/") if path.startswith("file:") else path


def path_below(path: str, root: str) -> str:
    """A file's path relative to a folder above it, however much of scheme and host either one spells out."""
    inner, above = (re.sub(r"^[A-Za-z][\w+.-]*://[^/]*", "", local_path(p)) for p in (path, root))
    if not inner.startswith(above.rstrip("/") + "/"):
        raise ValueError(f"{path} is not below {root}")
    return inner[len(above.rstrip("/")) + 1 :]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark spells it (``file:/x``, ``s3a://…``, ``hdfs://…``), for use in a task."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), local_path(path)
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _open(path: str) -> pa.NativeFile:
    system, inner = file_system(path)
    return system.open_input_file(inner)


def _parquet_rows(path: str) -> list[tuple[str, str]]:
    with _open(path) as source:
        return [(f.name, arrow_type_text(f.type)) for f in pq.read_schema(source)]


# Options of Spark's CSV reader that do not change what a header line means.
_CSV_PLAIN = (
    "basepath mergeschema modifiedafter modifiedbefore timezone recursivefilelookup pathglobfilter header mode nullvalue "
    "nanvalue positiveinf negativeinf dateformat timestampformat timestampntzformat enforceschema inferschema "
    "emptyvalue maxcolumns maxcharspercolumn columnpruning columnnameofcorruptrecord locale unescapedquotehandling"
).split()


def csv_layout(options: Mapping[str, str]) -> dict[str, str]:
    """How a header line is cut into names under Spark's reader options; an option it cannot follow is an error."""
    given = {k.lower(): v for k, v in options.items()}
    layout = {
        "sep": given.pop("sep", given.pop("delimiter", ",")),
        "quote": given.pop("quote", '"'),
        "escape": given.pop("escape", "\\"),
        "encoding": given.pop("encoding", given.pop("charset", "utf-8")),
        "comment": given.pop("comment", ""),
    }
    given.pop("delimiter", None), given.pop("charset", None), given.pop("multiline", None)
    spaces = [given.pop(f"ignore{side}whitespace", "false") for side in ("leading", "trailing")]
    layout["trim"] = "".join(side[0] for side, on in zip(("left", "right"), spaces, strict=True) if on == "true")
    unknown = sorted(set(given) - set(_CSV_PLAIN))
    if unknown:
        raise ContractError(f"headers cannot be read under the CSV options {unknown}")
    return layout


def _csv_rows(path: str, layout: Mapping[str, str]) -> list[tuple[str, str]]:
    system, inner = file_system(path)
    packed = "gzip" if path.lower().endswith(".gz") else None
    encoding = layout["encoding"]
    with (
        system.open_input_stream(inner, compression=packed) as source,
        io.TextIOWrapper(source, encoding="utf-8-sig" if encoding.lower() == "utf-8" else encoding, newline="") as text,
    ):
        lines = (line for line in text if not (layout["comment"] and line.startswith(layout["comment"])))
        quote, escape = layout["quote"], layout["escape"]
        rows = csv.reader(
            lines,
            delimiter=layout["sep"],
            quotechar=quote or None,
            quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE,
            escapechar=None if escape == quote else escape or None,
            doublequote=True,
        )
        # A blank first line is a header with one nameless column.
        names = next(rows, []) or [""]
    names = [n.lstrip() if "l" in layout["trim"] else n for n in names]
    return [(n.rstrip() if "r" in layout["trim"] else n, "string") for n in names]


def arrow_type_text(kind: pa.DataType) -> str:
    """Contract words for a file's column type; other types keep their own name, so they match no contract."""
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return f"list<{arrow_type_text(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'{f.name}:{arrow_type_text(f.type)}' for f in kind)}>"
    if pa.types.is_timestamp(kind):
        return f"timestamp({kind.unit}, {kind.tz})" if kind.tz else f"timestamp({kind.unit})"
    if pa.types.is_decimal(kind):
        return f"decimal128({kind.precision},{kind.scale})"
    # Arrow name -> contract word, where they differ.
    words = {"double": "float64", "date32[day]": "date32", "large_string": "string"}
    return words.get(str(kind), str(kind))


# JSON (variant) type word, as a pattern that is not a field name -> contract type word.
VARIANT_WORDS = {
    r"\bOBJECT<": "struct<",
    r"\bARRAY<": "list<",
    r"\bBIGINT\b(?!:)": "int64",
    r"\bDOUBLE\b(?!:)": "float64",
    r"\bSTRING\b(?!:)": "string",
    r"\bBOOLEAN\b(?!:)": "bool",
    r"\bDECIMAL\(": "decimal128(",
    r"\bVOID\b(?!:)": "null",
    r": ": ":",
}


def _json_schemas(
    spark: SparkSession, path: str | list[str], multi_line: bool, keep_unreadable: bool, options: Mapping[str, str]
) -> DataFrame:
    """Merged schema of all records of each JSON file. Positions follow the names: records keep no field order."""
    fixed = {"recursiveFileLookup": "true", "wholetext": str(multi_line), "pathGlobFilter": name_filter("json")}
    reader = spark.read.options(**{**fixed, **options})
    text = reader.text(path)
    records = text.where("trim(value) <> ''").select(
        plain_path(F.col("_metadata.file_path")).alias("file"),
        (F.try_parse_json("value") if keep_unreadable else F.parse_json("value")).alias("record"),
    )
    kinds = spark.sql(
        """
        SELECT file, field.key AS column, schema_of_variant_agg(field.value) AS type
        FROM {records}, LATERAL variant_explode(record) AS field
        GROUP BY file, field.key
        """,
        records=records,
    )
    leaf_column = F.pandas_udf(_leaf_series, LEAVES)
    words = F.col("type")
    for word, swap in VARIANT_WORDS.items():
        words = F.regexp_replace(words, word, swap)
    fields = F.array_sort(F.collect_list(F.struct("column", words.alias("type"))))
    found = (
        kinds.groupBy("file")
        .agg(fields.alias("fields"))
        .select("file", F.posexplode("fields").alias("position", "f"))
        .select("file", "position", "f.column", "f.type", leaf_column("f.type", "f.column").alias("leaves"))
    )
    if not keep_unreadable:
        return found
    # One record that is no JSON makes its file unreadable, whatever the others hold.
    broken = records.where(F.col("record").isNull()).select("file").distinct()
    noted = broken.select("file", *[F.expr(c) for c in ("0 AS position", "'' AS column", f"'{UNREADABLE}' AS type")])
    return found.join(broken, "file", "left_anti").unionByName(
        noted.withColumn("leaves", F.expr(f"CAST(array() AS {LEAVES})"))
    )
