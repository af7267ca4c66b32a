"""Row, file and table checks against a contract, each in a single pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.contract import Contract, ContractError, leaves
from stagewise.functions.checks import Rule, repeated, rules
from stagewise.session import settle
from stagewise.spec import LintOptions

FAILED = "failed_rules"


def failed_rules(found: Sequence[Rule]) -> Column:
    """Labels of the rules a row fails, as an array."""
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(r.failing, F.lit(r.label)) for r in found]))


def any_failing(found: Sequence[Rule]) -> Column:
    return reduce(Column.__or__, [r.failing for r in found], F.lit(False))


def lint_rows(df: DataFrame, contract: Contract, typed: bool = False) -> DataFrame:
    """Every row with the labels of the rules it fails."""
    return df.withColumn(FAILED, failed_rules(rules(contract, df.schema, typed)))


def split_valid(df: DataFrame, contract: Contract, typed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their failed rules). Only the latter pay for listing the rules."""
    found = rules(contract, df.schema, typed)
    bad = any_failing(found)
    return df.where(~bad), df.where(bad).withColumn(FAILED, failed_rules(found))


def lint_report(
    df: DataFrame, contract: Contract, by: Sequence[str] = (), typed: bool = False, more: Sequence[Rule] = ()
) -> DataFrame:
    """Failure counts per file (``by``), column and rule, with the number of rows checked.

    All counters are filled in one scan and combined before the shuffle; only then are they turned into rows.
    ``more`` adds rules to those of the contract.
    """
    found = [*rules(contract, df.schema, typed), *more]
    counters = [F.count_if(r.failing).alias(f"n{i}") for i, r in enumerate(found)]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *counters)
    if not found:
        blank = [F.lit(None).cast("string").alias(n) for n in ("column_name", "rule_name")]
        return wide.select(*by, *blank, "rows", F.lit(0).cast("long").alias("failures")).where(F.lit(False))
    entries = [
        F.struct(
            F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule_name"), F.col(f"n{i}").alias("failures")
        )
        for i, r in enumerate(found)
    ]
    return wide.select(*by, "rows", F.inline(F.array(*entries))).select(
        *by, "column_name", "rule_name", "rows", "failures"
    )


def verdicts(
    df: DataFrame, contract: Contract, by: Sequence[str], typed: bool = False
) -> DataFrame:
    """One row per file: rows, bad rows, and whether it passes, which it does only if every row does."""
    bad = any_failing(rules(contract, df.schema, typed))
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad_rows"))
    return counts.withColumn("passed", F.col("bad_rows") == 0)


def split_by_verdict(
    df: DataFrame, verdict: DataFrame, by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows of passing files, rows of failing files).

    The failing files are settled, so the join broadcasts them only when their list is known to be small.
    """
    failing = settle(verdict.where(~F.col("passed")).select(*by), "failing")
    return df.join(failing, list(by), "left_anti"), df.join(failing, list(by), "left_semi")


def all_must_pass(verdict: DataFrame) -> DataFrame:
    """One row over all files of all tables: how many there are, how many fail, and whether to publish."""
    return verdict.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(~F.col("passed")).alias("failed_files"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("publish"),
    )


def missing_required(options: Mapping[str, LintOptions], tables_with_files: Sequence[str]) -> list[str]:
    """Required tables that have landed no file."""
    return sorted(n for n, o in options.items() if o.required and n not in set(tables_with_files))


def check_columns(
    files: DataFrame, contract: Contract, options: LintOptions, by: Sequence[str] = ("file",)
) -> DataFrame:
    """Header problems, one row (file, rule, column) each, from rows with a ``header`` array of names.

    Rules are ``missing`` (unless missing columns are allowed), ``extra`` and ``duplicate``. Without an expected
    header, names are not compared.
    """

    def fold(names: Column) -> Column:
        return F.transform(names, F.lower) if options.headers_ignore_case else names

    header = fold(F.col("header"))
    wanted = fold(F.array(*[F.lit(c.name) for c in contract.data_columns]).cast("array<string>"))
    none = F.array().cast("array<string>")
    problems = {
        "missing": none if options.allow_missing_cols else F.array_except(wanted, header),
        "extra": F.array_except(header, wanted),
        "duplicate": repeated(header),
    }
    if not options.expect_header:
        problems = {}
    entries = [_labelled(rule, names, "column_name") for rule, names in problems.items()]
    empty = F.array().cast("array<struct<rule_name:string,column_name:string>>")
    return files.select(*by, F.inline(F.concat(empty, *entries)))


def _labelled(rule: str, items: Column, name: str) -> Column:
    return F.transform(items, lambda item: F.struct(F.lit(rule).alias("rule_name"), item.alias(name)))


def assert_not_empty(df: DataFrame, name: str = "table") -> DataFrame:
    """The frame itself; an error if it has no row. Stops at the first row found."""
    if df.isEmpty():
        raise ContractError(f"no data in {name}")
    return df


def check_primary_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count; counted before the shuffle, so a hot key is cheap."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def conforms(
    inventory: DataFrame, contract: Contract, keep_partitions: bool = False, strict: bool = False
) -> DataFrame:
    """Violations of the contract's schema, one row (file, path, problem) each, from ``schema_inventory`` rows.

    Every contract column must be in every file with the same type; lists of structs are compared field by field.
    Column order and additional columns or fields are fine, unless ``strict``: then names, types and order must be
    equal. A file is one row of at most as many fields as it has, so no join over files is needed.
    """
    columns = contract.columns if keep_partitions else contract.data_columns
    wanted = [leaf for c in columns for leaf in leaves(c.type, c.name)]
    if strict:
        own = F.flatten(F.transform(_in_order(), lambda f: f["leaves"]))
        text = F.concat_ws("|", F.transform(own, lambda leaf: F.concat_ws(" ", leaf["path"], leaf["type"])))
        expected = F.lit("|".join(f"{path} {kind}" for path, kind in wanted))
        return (
            inventory.groupBy("file")
            .agg(text.alias("found"))
            .where(F.col("found") != expected)
            .select("file", F.lit(contract.name).alias("path"), F.lit("schema differs").alias("problem"))
        )
    entries = F.flatten(F.collect_list("leaves"))
    has = F.map_from_entries(F.array_distinct(entries))
    files = inventory.groupBy("file").agg(has.alias("has"))
    checks = [
        F.struct(
            F.lit(path).alias("path"),
            F.when(F.col("has")[path].isNull(), F.lit("missing"))
            .when(F.col("has")[path] != kind, F.lit("type differs"))
            .alias("problem"),
        )
        for path, kind in wanted
    ]
    return files.select("file", F.inline(F.array(*checks))).where("problem IS NOT NULL")


def _in_order() -> Column:
    return F.array_sort(F.collect_list(F.struct("position", "leaves")))
