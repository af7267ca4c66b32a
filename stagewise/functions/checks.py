"""Row rules of a contract as boolean columns, true where the value fails.

Null passes every rule but the null rule, so a value fails each rule on its own account.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.contract import ColumnSpec, Contract
from stagewise.functions.formats import parse


NESTED = (T.ArrayType, T.StructType)


def check_type(col: Column, spec: ColumnSpec, kind: T.DataType | None = None) -> Column:
    """A value that does not parse to the contract type; of lists and structs, any value inside them.

    ``kind`` is the type the data has, text if not given. Text stands for a nested value as JSON.
    """
    target = spec.spark_type
    if not isinstance(target, NESTED):
        return col.isNotNull() if isinstance(kind, NESTED) else col.isNotNull() & parse(col, spec).isNull()
    if kind is None or isinstance(kind, T.StringType):
        kind = _with_text(target)
        inner = F.from_json(col, kind.simpleString())
        return col.isNotNull() & (inner.isNull() | _inner_fails(inner, kind, target))
    return _inner_fails(col, kind, target)


def _with_text(kind: T.DataType) -> T.DataType:
    """The same nesting with text as the innermost values."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_text(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_text(f.dataType)) for f in kind.fields])
    return T.StringType()


def _inner_fails(col: Column, kind: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.ArrayType) and isinstance(kind, T.ArrayType):
        inside = F.exists(col, lambda item: _inner_fails(item, kind.elementType, target.elementType))
        return F.coalesce(inside, F.lit(False))
    if isinstance(target, T.StructType) and isinstance(kind, T.StructType):
        shared = [f for f in target.fields if f.name in kind.names]
        parts = [_inner_fails(col.getField(f.name), kind[f.name].dataType, f.dataType) for f in shared]
        return reduce(Column.__or__, parts, F.lit(False))
    if isinstance(target, NESTED) or isinstance(kind, NESTED):
        return col.isNotNull()
    return col.isNotNull() & col.try_cast(target).isNull()


def check_nullable(col: Column, spec: ColumnSpec) -> Column:
    return col.isNull() if not spec.nullable else F.lit(False)


def _is_text(kind: T.DataType | None) -> bool:
    return kind is None or isinstance(kind, T.StringType)


def check_enum(col: Column, spec: ColumnSpec, kind: T.DataType | None = None) -> Column:
    """A value that is none of the listed ones: compared as text, or in the column's own type where it has one."""
    if _is_text(kind) or isinstance(kind, NESTED):
        return col.isNotNull() & ~col.cast("string").isin([str(v) for v in spec.enum])
    listed = [F.lit(str(v)).try_cast(kind) for v in spec.enum]
    return col.isNotNull() & ~reduce(Column.__or__, [col.eqNullSafe(v) for v in listed])


def check_range(col: Column, spec: ColumnSpec, kind: T.DataType | None = None) -> Column:
    """A value beyond the bounds. Exact numbers are compared as decimals, dates and times by their epoch seconds."""
    if isinstance(kind, T.DateType):
        value = F.unix_date(col).cast("double") * 86_400
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(col.cast("timestamp")) / 1e6
    elif isinstance(kind, (T.IntegralType, T.DecimalType)):
        value = col
    elif not _is_text(kind) and not isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit(False)
    else:
        value = col.try_cast("double")

    def bound(limit: float) -> Column:
        exact = isinstance(kind, (T.IntegralType, T.DecimalType)) and float(limit) == int(limit)
        return F.lit(str(int(limit))).cast("decimal(38,0)") if exact else F.lit(float(limit))

    low = value < bound(spec.minimum) if spec.minimum is not None else F.lit(False)
    high = value > bound(spec.maximum) if spec.maximum is not None else F.lit(False)
    return F.coalesce(low | high, F.lit(False))


def check_pattern(col: Column, spec: ColumnSpec) -> Column:
    """A value that the whole pattern does not match; a line break at the end is part of the value."""
    return col.isNotNull() & ~col.cast("string").rlike(rf"\A(?:{spec.pattern})\z")


@dataclass(frozen=True)
class Rule:
    column: str
    name: str
    failing: Column

    @property
    def label(self) -> str:
        return f"{self.column}:{self.name}"


def rules(contract: Contract, schema: T.StructType, typed: bool = False) -> list[Rule]:
    """Every rule the contract puts on the columns of data with the given schema.

    ``typed`` data already has the contract types, so the type rule is left out.
    """
    kinds, out = {f.name: f.dataType for f in schema.fields}, []
    for spec in contract.data_columns:
        if spec.type == "null" or spec.name not in kinds:
            continue
        col = F.col(f"`{spec.name}`")
        if not typed and spec.type != "string":
            out.append(Rule(spec.name, "type", check_type(col, spec, kinds[spec.name])))
        if not spec.nullable:
            out.append(Rule(spec.name, "nullable", check_nullable(col, spec)))
        if spec.enum:
            out.append(Rule(spec.name, "enum", check_enum(col, spec, kinds[spec.name])))
        if spec.minimum is not None or spec.maximum is not None:
            out.append(Rule(spec.name, "range", check_range(col, spec, kinds[spec.name])))
        if spec.pattern:
            out.append(Rule(spec.name, "pattern", check_pattern(col, spec)))
    return out


def repeated(names: Column) -> Column:
    """The names that occur more than once in an array, each once."""
    ordered = F.array_sort(names)
    return F.array_distinct(F.filter(ordered, lambda name, i: (i > 0) & (name == F.get(ordered, i - 1))))
