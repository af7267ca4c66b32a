"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from workload import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")

# Rare values decide these results; on the smallest tables there may be none.
MAY_BE_EMPTY = {"unprocessed_partitions", "unprocessed_many", "common_new_partitions", "lint_quarantine"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    problem = compare(QUERIES[key](spark, SF_DIR), con, ORACLE[key])
    assert problem == "" or (problem == "no rows" and key in MAY_BE_EMPTY)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
