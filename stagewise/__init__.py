"""stagewise: contract-driven, staged data loads on plain Spark DataFrames."""

from stagewise.contract import ColumnSpec, Contract, spark_type
from stagewise.session import build_session, workspace
from stagewise.spec import Pipeline, TableSpec

__all__ = [
    "ColumnSpec",
    "Contract",
    "Pipeline",
    "TableSpec",
    "build_session",
    "spark_type",
    "workspace",
]
