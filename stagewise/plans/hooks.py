"""Per-table transforms that users register."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stagewise.contract import Contract, ContractError
from stagewise.operators.shaping import ShapeOptions, default_shape


@dataclass(frozen=True)
class ShapeContext:
    """What a shape hook gets beside its rows."""

    table: str
    given: Contract
    wanted: Contract
    options: ShapeOptions


@dataclass(frozen=True)
class SqlContext:
    """What an SQL hook gets beside the result of its table's query."""

    spark: SparkSession
    sql: str
    wanted: Contract
    path: str


ShapeHook = Callable[[DataFrame, ShapeContext], DataFrame]
SqlHook = Callable[[DataFrame, SqlContext], DataFrame]


@dataclass
class Hooks:
    """Custom transforms by table name. An error inside one is an error of the job."""

    shape: dict[str, ShapeHook] = field(default_factory=dict)
    sql: dict[str, SqlHook] = field(default_factory=dict)
    functions: dict[str, Callable] = field(default_factory=dict)
    table_functions: dict[str, Callable] = field(default_factory=dict)

    def register(self, table: str, fn: ShapeHook) -> ShapeHook:
        self.shape[table] = fn
        return fn

    def register_sql(self, table: str, fn: SqlHook) -> SqlHook:
        self.sql[table] = fn
        return fn


    def register_function(self, name: str, fn: Callable) -> Callable:
        """A function for template SQL: an Arrow or Pandas UDF, one over columns or over the columns of a group."""
        self.functions[_function_name(name)] = fn
        return fn

    def register_table_function(self, name: str, fn: Callable) -> Callable:
        """A table function for template SQL, such as an Arrow UDTF, for use in FROM or LATERAL."""
        self.table_functions[_function_name(name)] = fn
        return fn

    def install(self, spark: SparkSession) -> None:
        """Make the functions known to a session under their names. Spark's own functions are never hidden."""
        for name, fn in (*self.functions.items(), *self.table_functions.items()):
            if name not in _installed.get(spark.sparkContext.applicationId, {}) and spark.catalog.functionExists(name):
                raise ContractError(f"there is a function '{name}' already")
            known = spark.udtf if name in self.table_functions else spark.udf
            known.register(name, fn)
            _installed.setdefault(spark.sparkContext.applicationId, {})[name] = fn


# By application: the functions that were installed.
_installed: dict[str, dict[str, Callable]] = {}


def _function_name(name: str) -> str:
    if not name.isidentifier():
        raise ContractError(f"'{name}' cannot be the name of a function")
    return name.lower()


def apply_shape(df: DataFrame, kind: str, hooks: Hooks, ctx: ShapeContext) -> DataFrame:
    """The table's own transform if it is not a default table and has one, else the default shaping."""
    hook = hooks.shape.get(ctx.table) if kind != "default" else None
    return hook(df, ctx) if hook else default_shape(df, ctx.given, ctx.wanted, ctx.options)


def apply_sql(df: DataFrame, kind: str, table: str, hooks: Hooks, ctx: SqlContext) -> DataFrame:
    """Default tables take the query's rows as they are; custom tables must have a hook, derived ones may."""
    if kind == "default":
        return df
    if table in hooks.sql:
        return hooks.sql[table](df, ctx)
    if kind == "custom":
        raise ContractError(f"custom table '{table}' has no SQL transform")
    return df
