"""Nested columns matched by field name, whatever their order in the data.

Spark casts one struct to another by position, so fields that stand in another order would swap their values without an
error. Here two types are walked together, and an expression is built field by field: structs become structs of the
wanted fields, lists and maps are transformed element by element, and only innermost values are cast. All of it is
expressions, so it stays in generated code and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.contract import ContractError
from stagewise.functions.formats import utc_wall_clock


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def stored_name(name: str, given: T.StructType) -> str | None:
    """The name that a struct has for a field: exact, else lower-case, else upper-case, as for columns."""
    names = set(given.names)
    return next((n for n in (name, name.lower(), name.upper()) if n in names), None)


def as_type(
    col: Column,
    given: T.DataType,
    wanted: T.DataType,
    path: str = "",
    fill: bool = False,
    lenient: bool = False,
) -> Column:
    """A column of one type under another, fields by name.

    Fields that are not wanted go. A wanted field that the data lacks is an error, or with ``fill`` null; ``lenient``
    makes values that cannot be cast null. Null structs, lists and elements stay null.
    """
    if same_shape(given, wanted):
        return col
    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        parts = []
        for field in wanted.fields:
            name = stored_name(field.name, given)
            below = f"{path}.{field.name}"
            if name is None and not fill:
                raise ContractError(f"field {below.lstrip('.')} is not in the data")
            if name is None:
                part = F.lit(None).cast(field.dataType)
            else:
                part = as_type(col.getField(name), given[name].dataType, field.dataType, below, fill, lenient)
            parts.append(part.alias(field.name))
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        inner = (given.elementType, wanted.elementType, f"{path}[]", fill, lenient)
        return F.transform(col, lambda item: as_type(item, *inner))
    if isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        keys, values = (given.keyType, wanted.keyType), (given.valueType, wanted.valueType)
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                as_type(e.getField("key"), *keys, f"{path}{{key}}", fill, lenient),
                as_type(e.getField("value"), *values, f"{path}{{}}", fill, lenient),
            ),
        )
        return F.map_from_entries(entries)
    if isinstance(given, T.NullType):
        return col.cast(wanted)
    if is_nested(given) != is_nested(wanted) or (is_nested(given) and type(given) is not type(wanted)):
        raise ContractError(f"{path.lstrip('.') or 'a column'} is {given.simpleString()}, not {wanted.simpleString()}")
    if isinstance(given, T.TimestampType) and isinstance(wanted, T.TimestampNTZType):
        return utc_wall_clock(F.unix_micros(col))
    return col.try_cast(wanted) if lenient else col.cast(wanted)


def same_shape(given: T.DataType, wanted: T.DataType) -> bool:
    """Are two types equal in names, order and innermost types? What may be null does not matter."""
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        pairs = zip(given.fields, wanted.fields, strict=False)
        return given.names == wanted.names and all(same_shape(a.dataType, b.dataType) for a, b in pairs)
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return same_shape(given.elementType, wanted.elementType)
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        return same_shape(given.keyType, wanted.keyType) and same_shape(given.valueType, wanted.valueType)
    return given == wanted


def reader_type(given: T.DataType, wanted: T.DataType) -> T.DataType:
    """The type to read a stored column with: the wanted fields only, so that others are not read, in the data's types.

    Wanted fields that this file lacks, but others may have, are added in their wanted type; readers match by name.
    """
    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        fields = []
        for field in wanted.fields:
            name = stored_name(field.name, given)
            kind = field.dataType if name is None else reader_type(given[name].dataType, field.dataType)
            fields.append(T.StructField(name or field.name, kind))
        return T.StructType(fields)
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        return T.ArrayType(reader_type(given.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        return T.MapType(reader_type(given.keyType, wanted.keyType), reader_type(given.valueType, wanted.valueType))
    return given
