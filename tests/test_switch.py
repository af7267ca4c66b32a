"""Publishing by switching partition locations: all or nothing, without renaming anything."""

from __future__ import annotations

import os
import uuid

import pytest

import stagewise.sinks.switch as switch
import stagewise.sources.files as files
from stagewise.contract import ColumnSpec, Contract, ContractError
from stagewise.sinks.switch import create_switched, drop_replaced, publish_switched

PART = "land_ts"
ONE = Contract("t", (ColumnSpec("x", "int64"), ColumnSpec(PART, "int64")), (PART,))
TWO = Contract("t", (ColumnSpec("x", "int64"), ColumnSpec(PART, "int64"), ColumnSpec("kind", "string")), (PART, "kind"))


@pytest.fixture
def make(spark, path, monkeypatch):
    def refused(*_):
        raise OSError("this store does not rename")

    monkeypatch.setattr(files, "_rename", refused)
    database = f"switch_{uuid.uuid4().hex[:8]}"

    def table(contract):
        return create_switched(spark, database, contract, f"{path}/t")

    yield table
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def rows(spark, contract, *values):
    return spark.createDataFrame(list(values), contract.struct())


def seen(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("x", PART).collect())


def test_units_are_replaced_cleared_and_dropped_later(spark, path, make):
    name = make(ONE)
    publish_switched(rows(spark, ONE, (1, 20240101), (2, 20240102), (3, 20240103)), name, f"{path}/t", ONE, PART)
    first = seen(spark, name)
    run = publish_switched(rows(spark, ONE, (9, 20240102)), name, f"{path}/t", ONE, PART, units=[20240102, 20240103])
    assert first == [(1, 20240101), (2, 20240102), (3, 20240103)]
    assert seen(spark, name) == [(1, 20240101), (9, 20240102)]
    assert drop_replaced(spark, name, f"{path}/t", ONE, before=run - 1) == []
    gone = drop_replaced(spark, name, f"{path}/t", ONE, before=run)
    assert [g.rsplit("/", 1)[1] for g in gone] == [f"{PART}=20240102", f"{PART}=20240103"]
    assert not any(os.path.exists(g.removeprefix("file:")) for g in gone) and len(seen(spark, name)) == 2
    assert drop_replaced(spark, name, f"{path}/t", ONE, before=run) == []


@pytest.mark.parametrize("contract", [ONE, TWO], ids=["one level", "two levels"])
@pytest.mark.parametrize("step", ["write_partitioned", "check_files", "note_replaced", 0, 1, 2, 3])
def test_a_failure_at_any_step_leaves_the_table_as_it_was(spark, path, make, monkeypatch, contract, step):
    name = make(contract)
    more = lambda kind: (kind,) if contract is TWO else ()
    old = [(1, 20240101, *more("a")), (2, 20240102, *more("b c")), (3, 20240103, *more("d"))]
    new = [(7, 20240101, *more("e")), (8, 20240102, *more("b c")), (9, 20240104, *more("a=/%+"))]
    publish_switched(rows(spark, contract, *old), name, f"{path}/t", contract, PART)
    before, calls = seen(spark, name), []
    if isinstance(step, str):
        def broken(*args, **kwargs):
            raise OSError("lost")
    else:
        plain = switch.switch_partition

        def broken(*args):
            calls.append(args)
            if len(calls) == step + 1:
                raise OSError("lost")
            plain(*args)

    monkeypatch.setattr(switch, step if isinstance(step, str) else "switch_partition", broken)
    publish = lambda run: publish_switched(rows(spark, contract, *new), name, f"{path}/t", contract, PART, [20240103], run=run)
    with pytest.raises(OSError, match="lost"):
        publish(5)
    assert seen(spark, name) == before and not os.path.exists(f"{path}/t/run=5")
    monkeypatch.undo()
    publish(6)
    assert seen(spark, name) == sorted(r[:2] for r in new)
    if contract is TWO:
        assert {r["kind"] for r in spark.table(name).collect()} == {"e", "b c", "a=/%+"}


def test_wrong_rows_and_contracts_are_refused(spark, path, make):
    name = make(ONE)
    with pytest.raises(ContractError, match="does not match"):
        publish_switched(spark.createDataFrame([("a", 20240101)], f"x string, {PART} long"), name, f"{path}/t", ONE, PART)
    with pytest.raises(ContractError, match="must be partitioned"):
        publish_switched(rows(spark, ONE, (1, 20240101)), name, f"{path}/t", ONE, "day")
    with pytest.raises(ContractError, match="no partitions to switch"):
        create_switched(spark, "x", Contract("t", (ColumnSpec("x", "int64"),)), path)
