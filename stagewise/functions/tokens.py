"""Landing partition tokens and file-name stamps as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A landing partition is 10 digits (epoch seconds) or 8 digits (yyyymmdd).
STAMP_DIGITS = r"(?:\d{10}|\d{8})"
# Fixed value: file names that carry a landing time as their third group.
FILE_NAME_PATTERN = r"^([a-zA-z/?]+)([_-]{1})([0-9]{10})([-0-9]{3})?([0-9]{10})?([.][a-z.]+)$"
SECONDS_PER_DAY = 86_400


def _or_raise(value: Column, source: Column, message: str) -> Column:
    """The value, which is computed once; an error where it is null although its source is not."""
    return F.coalesce(value, F.when(source.isNotNull(), F.raise_error(F.concat(F.lit(message + ": "), source))))


def _java_quote(text: str) -> str:
    return re.sub(r"([^\w])", r"\\\1", text)


def _in_path(name: str) -> str:
    """Pattern of a partition folder; the digits must end the path segment."""
    return rf"{_java_quote(name)}=({STAMP_DIGITS})(?=/|$)"


def extract_partition(path: Column, name: str, strict: bool = True) -> Column:
    """The ``name=digits`` token of a path.

    Without a token: an error when ``strict``, null otherwise. A null path stays null.
    """
    token = F.regexp_substr(path, F.lit(_in_path(name)))
    return _or_raise(token, path, f"no {name} partition in path") if strict else token


def extract_timestamp(token: Column, name: str, strict: bool = True) -> Column:
    """The digits of a token that is exactly ``name=`` and 8 or 10 digits, as a long."""
    value = F.regexp_extract(token, rf"^{_java_quote(name)}=({STAMP_DIGITS})$", 1).try_cast("long")
    return _or_raise(value, token, f"not a {name} partition") if strict else value


def partition_value(path: Column, name: str, strict: bool = True) -> Column:
    """Landing partition of a path as a long."""
    value = F.regexp_extract(path, _in_path(name), 1).try_cast("long")
    return _or_raise(value, path, f"no {name} partition in path") if strict else value


def plain_path(path: Column) -> Column:
    """A row's ``_metadata.file_path`` as a file listing spells it: decoded, with one slash after ``file:``."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_name_timestamp(path: Column, strict: bool = True) -> Column:
    """The landing time in a file name, as a long."""
    value = F.regexp_extract(file_name(path), FILE_NAME_PATTERN, 3).try_cast("long")
    return _or_raise(value, path, "file name has no timestamp") if strict else value


def strip_lint_stamp(name: Column, ext: str = ".snappy.parquet", strict: bool = True) -> Column:
    """Remove the ``-N[N]-<10 digits>`` stamp that sits before the extension."""
    stem = F.regexp_substr(name, F.lit(rf"^.*(?=-[0-9]{{1,2}}-[0-9]{{10}}{_java_quote(ext)}$)"))
    stripped = F.concat(stem, F.lit(ext))
    return _or_raise(stripped, name, "file name has no lint stamp") if strict else stripped


def epoch_day(seconds: Column) -> Column:
    """UTC day number of epoch seconds; independent of the session time zone."""
    return F.floor(seconds / F.lit(SECONDS_PER_DAY))


def landing_day(ts: Column) -> Column:
    """Epoch seconds of the UTC day a zone-less timestamp falls on."""
    return F.unix_date(F.to_date(ts)).cast("long") * F.lit(SECONDS_PER_DAY)


def landing_month(ts: Column) -> Column:
    """``yyyymm01`` of a timestamp as a long."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + 1).cast("long")
