"""Where tables live and how each one is loaded."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from stagewise.contract import STAGES, Contract, ContractError

# The ways a table can be made.
TABLE_KINDS = ("default", "custom", "derived")
# Stages whose tables sit below a "pass" folder, beside "fail" and "log".
CHECKED_STAGES = ("raw", "raw_hist")


@dataclass(frozen=True)
class CastColumn:
    """A column read as ``original`` and checked as ``target``."""

    name: str
    original: str
    target: str


@dataclass(frozen=True)
class LintOptions:
    required: bool = False
    expect_header: bool = True
    headers_ignore_case: bool = False
    allow_missing_cols: bool = False
    casts: tuple[CastColumn, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    """One table: its contract per stage, the format of each stage, and how it is made.

    ``inputs`` (derived tables only) maps (pipeline name, table name) to the stage that is read. ``read_options`` are
    Spark reader options for files that were not written here, such as ``{"sep": ";", "multiLine": "true"}``.
    """

    name: str
    contracts: Mapping[str, Contract]
    formats: Mapping[str, str]
    kind: str = "default"
    lint: LintOptions | None = None
    inputs: Mapping[tuple[str, str], str] = field(default_factory=dict)
    temp_sql: Mapping[str, str] = field(default_factory=dict)
    final_sql: Mapping[str, str] = field(default_factory=dict)
    uses_shared_sql: bool = False
    frequency: str = "@daily"
    read_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in TABLE_KINDS:
            raise ContractError(f"unknown kind '{self.kind}' of table '{self.name}'")
        unknown = [s for s in self.formats if s not in STAGES]
        if unknown:
            raise ContractError(f"unknown stages {unknown} of table '{self.name}'")
        if self.kind == "derived" and not self.inputs:
            raise ContractError(f"derived table '{self.name}' must name its inputs")
        if self.kind == "derived" and self.lint:
            raise ContractError(f"derived table '{self.name}' cannot have lint options")
        if self.kind != "derived" and self.inputs:
            raise ContractError(f"only derived tables have inputs, '{self.name}' is {self.kind}")
        if self.kind == "default" and (self.temp_sql or self.final_sql):
            raise ContractError(f"default table '{self.name}' cannot have its own SQL")
        if any(table == self.name for _, table in self.inputs):
            raise ContractError(f"derived table '{self.name}' cannot be its own input")

    @property
    def stages(self) -> list[str]:
        return list(self.formats)

    def contract(self, stage: str) -> Contract:
        if stage not in self.contracts:
            raise ContractError(f"table '{self.name}' has no contract for stage '{stage}'")
        return self.contracts[stage]


@dataclass(frozen=True)
class Pipeline:
    """A set of tables with one base path per stage and one landing partition name."""

    name: str
    env: str
    base_paths: Mapping[str, str]
    tables: Mapping[str, TableSpec]
    partition: str = "land_ts"
    description: str = ""
    shared_sql: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    all_must_pass: bool = True
    remove_on_pass: bool = True

    def base_path(self, stage: str) -> str:
        if stage not in self.base_paths:
            raise ContractError(f"pipeline '{self.name}' has no path for stage '{stage}'")
        path = self.base_paths[stage].replace("{{env}}", self.env).replace("{{db}}", self.name)
        return path.rstrip("/")

    def table(self, name: str) -> TableSpec:
        if name not in self.tables:
            raise ContractError(f"pipeline '{self.name}' has no table '{name}'")
        return self.tables[name]

    def path(self, table: str, stage: str) -> str:
        spec = self.table(table)
        if stage not in spec.formats:
            raise ContractError(f"stage must be one of {', '.join(spec.stages)}")
        folder = f"pass/{table}" if stage in CHECKED_STAGES else table
        return f"{self.base_path(stage)}/{folder}"

    def select(
        self, names: list[str] | None = None, stages: list[str] | None = None, kinds: list[str] | None = None
    ) -> list[TableSpec]:
        """Tables that have one of the stages and are of one of the kinds; None means all."""
        specs = self.tables.values() if names is None else [self.table(n) for n in names]
        return [
            s
            for s in specs
            if (stages is None or set(stages) & set(s.stages)) and (kinds is None or s.kind in kinds)
        ]


def full_database_name(name: str, env: str, prefix: str, derived: bool = False) -> str:
    """Catalog database of a pipeline; the name ``all`` stands for the whole environment."""
    own = "" if name == "all" else f"{name}_"
    return f"{prefix}_{own}{'derived_' if derived else ''}{env}"
