"""Column contracts: what a table must look like at one stage.

A contract document is JSON in one of two layouts. The per-stage layout has flat columns with a ``type``; the
all-stages layout has, for each column, a list of stages with a type, pattern and format each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

# The stages, file formats and column types a contract may name.
STAGES = ("land", "raw", "raw_hist", "processed", "curated", "derived", "export")
FILE_FORMATS = ("parquet", "csv", "json", "xlsx")
COLUMN_TYPES = (
    "string",
    "list<string>",
    "list<list<string>>",
    "int32",
    "list<int32>",
    "int64",
    "float64",
    "list<float64>",
    "decimal128(12,2)",
    "bool",
    "list<bool>",
    "date32",
    "list<date32>",
    "timestamp(ns)",
    "timestamp(ms)",
    "timestamp(s)",
    "datetime",
    "null",
)
STRUCT_LIST_PREFIX = "list<struct<"

# Contract type word -> Spark DDL word. Contract timestamps carry no zone.
DDL_WORDS = {
    "list": "array",
    "int32": "int",
    "int64": "bigint",
    "float64": "double",
    "decimal128": "decimal",
    "bool": "boolean",
    "date32": "date",
    "date64": "date",
    "timestamp(ns)": "timestamp_ntz",
    "timestamp(us)": "timestamp_ntz",
    "timestamp(ms)": "timestamp_ntz",
    "timestamp(s)": "timestamp_ntz",
    "datetime": "timestamp_ntz",
    "null": "void",
}
_PLAIN_WORDS = {"string", "struct"}
_FIELD_NAME = re.compile(r"([<,]\s*)([^<>,:()]+?)\s*:\s*")
_TYPE_WORD = re.compile(r"`[^`]*`|timestamp\(\w+\)|[A-Za-z_]\w*")


class ContractError(ValueError):
    """A contract, or data checked against one, breaks a rule."""


def type_allowed(text: str) -> bool:
    return text in COLUMN_TYPES or text.startswith(STRUCT_LIST_PREFIX)


def ddl(text: str, more: dict[str, str] | None = None) -> str:
    """Contract type text as Spark DDL, by swapping the type words; ``more`` has words beyond the contract's."""
    words = {**DDL_WORDS, **(more or {})}

    def swap(match: re.Match[str]) -> str:
        word = match.group(0)
        if word.startswith("`") or word in _PLAIN_WORDS:
            return word
        if word not in words:
            raise ContractError(f"unknown column type '{text}'")
        return words[word]

    return _TYPE_WORD.sub(swap, _FIELD_NAME.sub(r"\1`\2`:", text))


def spark_type(text: str) -> T.DataType:
    return T.DataType.fromDDL(ddl(text))


def contract_type(dtype: T.DataType) -> str:
    """Contract type text of a Spark type; types outside the contract vocabulary raise."""
    if isinstance(dtype, T.ArrayType):
        return f"list<{contract_type(dtype.elementType)}>"
    if isinstance(dtype, T.StructType):
        return f"struct<{', '.join(f'{f.name}:{contract_type(f.dataType)}' for f in dtype.fields)}>"
    if isinstance(dtype, T.DecimalType):
        return f"decimal128({dtype.precision},{dtype.scale})"
    # Spark type -> contract type word.
    words = {
        T.StringType: "string",
        T.IntegerType: "int32",
        T.LongType: "int64",
        T.DoubleType: "float64",
        T.BooleanType: "bool",
        T.DateType: "date32",
        T.TimestampNTZType: "timestamp(us)",
        T.TimestampType: "timestamp(us)",
        T.NullType: "null",
    }
    if type(dtype) not in words:
        raise ContractError(f"{dtype.simpleString()} has no contract type")
    return words[type(dtype)]


def plain_type(text: str) -> str:
    """Type text without the storage details that Spark does not keep apart: time unit and date width."""
    return re.sub(r"timestamp\(\w+\)|datetime", "timestamp", text).replace("date64", "date32")


def split_fields(text: str) -> list[str]:
    """Split the inside of ``struct<...>`` at its own commas, leaving those of nested types alone."""
    out, depth = [""], 0
    for char in text:
        depth += (char in "<(") - (char in ">)")
        if char == "," and depth == 0:
            out.append("")
        else:
            out[-1] += char
    return [part.strip() for part in out if part.strip()]


def leaves(text: str, prefix: str) -> list[tuple[str, str]]:
    """(path, plain type) of every leaf below a column; ``[]`` marks a step into a list of structs."""
    text = text.strip()
    if text.startswith(STRUCT_LIST_PREFIX):
        return leaves(text[len("list<") : -1], f"{prefix}[]")
    if text.startswith("struct<"):
        fields = [part.partition(":") for part in split_fields(text[len("struct<") : -1])]
        return [leaf for name, _, kind in fields for leaf in leaves(kind, f"{prefix}.{name.strip()}")]
    return [(prefix, plain_type(text))]


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    enum: tuple[Any, ...] = ()
    pattern: str = ""
    format: str = ""
    minimum: float | None = None
    maximum: float | None = None

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.type)

    def to_field(self) -> T.StructField:
        rules = {
            key: list(value) if isinstance(value, tuple) else value
            for key in ("enum", "pattern", "format", "minimum", "maximum")
            if (value := getattr(self, key)) not in ((), "", None)
        }
        return T.StructField(self.name, self.spark_type, self.nullable, rules)


@dataclass(frozen=True)
class Contract:
    """The columns of one table at one stage. Never changed in place; every edit gives a new contract."""

    name: str
    columns: tuple[ColumnSpec, ...]
    partitions: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    file_format: str = "parquet"
    stage: str = ""
    description: str = ""
    sensitive: bool = False
    lookup: dict[str, ColumnSpec] = field(init=False, repr=False, compare=False, hash=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "lookup", {c.name: c for c in self.columns})
        if len(self.lookup) != len(self.columns):
            raise ContractError(f"a column is defined twice in the contract of '{self.name}'")
        for part in self.partitions:
            if part not in self.lookup:
                raise ContractError(f"partition column '{part}' is not a column of '{self.name}'")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def data_columns(self) -> list[ColumnSpec]:
        """Columns stored in the files, that is all but the partitions."""
        return [c for c in self.columns if c.name not in self.partitions]

    @property
    def partitions_first(self) -> list[ColumnSpec]:
        return [self.lookup[p] for p in self.partitions] + self.data_columns

    def struct(self, partitions: bool = True) -> T.StructType:
        columns = self.columns if partitions else self.data_columns
        return T.StructType([c.to_field() for c in columns])

    def with_columns(self, *updates: ColumnSpec) -> Contract:
        """Replace columns of the same name, append the others."""
        changed = {c.name: c for c in updates}
        kept = [changed.pop(c.name, c) for c in self.columns]
        return replace(self, columns=(*kept, *changed.values()))

    def without(self, names: Iterable[str]) -> Contract:
        gone = set(names)
        return replace(
            self,
            columns=tuple(c for c in self.columns if c.name not in gone),
            partitions=tuple(p for p in self.partitions if p not in gone),
        )

    def with_partitions(self, *partitions: str) -> Contract:
        return replace(self, partitions=partitions)

    def null_typed(self) -> list[str]:
        return [c.name for c in self.columns if c.type == "null"]

    @classmethod
    def from_document(cls, doc: dict[str, Any], stage: str = "", name: str | None = None) -> Contract:
        """Read either layout; the all-stages layout needs the stage to render."""
        all_stages = any("stages" in c for c in doc["columns"])
        make = _columns_at_stage if all_stages else _flat_columns
        partitions = doc.get("partitions") or []
        formats = {f["name"]: f["format"] for f in doc.get("file_formats") or []}
        if all_stages:
            if stage not in formats:
                raise ContractError(f"no file format for stage '{stage}' of '{doc['name']}'")
            declared = cls("check", tuple(ColumnSpec(c["name"], "string") for c in doc["columns"]))
            missing = [p for p in partitions if p not in declared.lookup]
            if missing:
                raise ContractError(f"partition columns {missing} are not columns of '{doc['name']}'")
            partitions = partitions if stage == "curated" else []
        return cls(
            name=name or doc["name"],
            columns=tuple(make(doc, stage)),
            partitions=tuple(partitions),
            primary_key=tuple(doc.get("primary_key") or []),
            file_format=formats.get(stage) or doc.get("file_format") or "parquet",
            stage=stage,
            description=doc.get("description") or "",
            sensitive=bool(doc.get("sensitive")),
        )

    @classmethod
    def from_file(cls, path: str | Path, stage: str = "") -> Contract:
        return cls.from_document(json.loads(Path(path).read_text(encoding="utf-8")), stage)


def _flat_columns(doc: dict[str, Any], _: str) -> Iterable[ColumnSpec]:
    for c in doc["columns"]:
        yield ColumnSpec(
            name=c["name"],
            type=c["type"],
            nullable=c.get("nullable", True),
            enum=tuple(c.get("enum") or ()),
            pattern=c.get("pattern") or "",
            format=c.get("datetime_format") or c.get("format") or "",
            minimum=c.get("minimum"),
            maximum=c.get("maximum"),
        )


def _columns_at_stage(doc: dict[str, Any], stage: str) -> Iterable[ColumnSpec]:
    if stage not in STAGES:
        raise ContractError(f"unknown stage '{stage}'")
    for c in doc["columns"]:
        for at in c["stages"]:
            if at["name"] not in STAGES:
                raise ContractError(f"unknown stage '{at['name']}' of column '{c['name']}'")
            if not type_allowed(at["type"]):
                raise ContractError(f"unknown type '{at['type']}' of column '{c['name']}'")
        at = next((s for s in c["stages"] if s["name"] == stage), None)
        if at is not None:
            yield ColumnSpec(
                name=c["name"],
                type=at["type"],
                nullable=c.get("nullable", False),
                enum=tuple(c.get("enum") or ()),
                pattern=at.get("pattern") or "",
                format=at.get("format") or "",
            )
