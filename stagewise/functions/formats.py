"""Declared date and time formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, ContractError

# Strptime directive -> Spark datetime pattern.
STRPTIME_TO_SPARK = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "E",
    "%A": "EEEE",
    "%j": "DDD",
    "%z": "XX",
    "%%": "%",
}


def spark_pattern(fmt: str) -> str:
    """A Spark datetime pattern; text without strptime directives is taken as one already."""
    if "%" not in fmt:
        return fmt
    parts = re.split(r"(%.)", fmt)
    out = []
    for part in parts:
        if part.startswith("%"):
            if part not in STRPTIME_TO_SPARK:
                raise ContractError(f"no Spark pattern for '{part}' in format '{fmt}'")
            out.append(STRPTIME_TO_SPARK[part])
        else:
            out.append(re.sub(r"[A-Za-z]+", lambda m: f"'{m.group(0)}'", part))
    return "".join(out)


def utc_wall_clock(micros: Column) -> Column:
    """The zone-less timestamp that clocks show in UTC, so many microseconds after the epoch."""
    seconds = micros.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def parse(col: Column, spec: ColumnSpec, lenient: bool = True) -> Column:
    """Text to the column's contract type, by its declared format if it has one.

    ``lenient`` gives null where the text does not parse; otherwise the job fails there.
    """
    target = spec.spark_type
    kind = target.simpleString()
    if spec.format and kind == "date":
        pattern = spark_pattern(spec.format)
        return F.try_to_date(col, pattern) if lenient else F.to_date(col, pattern)
    if spec.format and kind == "timestamp_ntz":
        pattern = spark_pattern(spec.format)
        # Text without a zone is read as UTC, whatever the session zone is.
        zoned = any(letter in re.sub("'[^']*'", "", pattern) for letter in "XxZzOV")
        text, pattern = (col, pattern) if zoned else (F.concat(col, F.lit("Z")), pattern + "X")
        instant = F.try_to_timestamp(text, F.lit(pattern)) if lenient else F.to_timestamp(text, pattern)
        return utc_wall_clock(F.unix_micros(instant))
    return col.try_cast(target) if lenient else col.cast(target)
