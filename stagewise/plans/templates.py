"""Running a user's templated Spark SQL over named inputs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from stagewise.contract import ContractError
from stagewise.functions.templates import render

# The database words a template may put before an input or an intermediate table.
INPUT_DATABASE = "__input__"
TEMP_DATABASE = "__temp__"
_TABLE = re.compile(rf"\b(?:{INPUT_DATABASE}|{TEMP_DATABASE})\.(\w+)")


def template_values(
    partition: str,
    env: str,
    partitions: Sequence[int] = (),
    tag: str = "",
    params: Mapping[str, Any] | None = None,
    **more: Any,
) -> dict[str, Any]:
    """The values every template can use; the user's own ones win."""
    # The names that templates use.
    return {
        "database_name": INPUT_DATABASE,
        "temporary_database": TEMP_DATABASE,
        "environment": env,
        "primary_partition": partition,
        "snapshot_timestamps": ",".join(str(int(p)) for p in partitions),
        "github_tag": tag,
        **more,
        **(params or {}),
    }


def run_template(
    spark: SparkSession,
    sql: str,
    values: Mapping[str, Any],
    inputs: Mapping[str, DataFrame],
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A template as a DataFrame.

    ``{{ database_name }}.x`` is the input x and ``__temp__.x`` the intermediate x. They are given to Spark as
    DataFrames, so no name in the session changes and several loads can run side by side. ``:name`` markers take
    ``args``, where a list is an array.
    """
    text = render(sql, values)
    used = sorted(set(_TABLE.findall(text)))
    unknown = [t for t in used if t not in inputs]
    if unknown:
        raise ContractError(f"the query reads unknown tables: {', '.join(unknown)}")
    args = {k: v for k, v in (args or {}).items() if v not in ([], (), None)}
    if not used:
        return spark.sql(text, args=args)
    braced = text.replace("{", "{{").replace("}", "}}")
    return spark.sql(_TABLE.sub(r"{\1}", braced), args=args, **{t: inputs[t] for t in used})
