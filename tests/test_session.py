from __future__ import annotations

from types import SimpleNamespace

import pytest

from stagewise.session import build_session, clear_workspace, scratch_path, settle, workspace
from stagewise.sources.files import path_exists


def fake(master, shared=None):
    conf = SimpleNamespace(get=lambda key, default: shared or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId=f"app-{master}", master=master))


def test_workspace_is_the_folder_the_cluster_names():
    assert workspace(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared/stagewise/app-yarn"


def test_workspace_on_a_cluster_must_be_named():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(fake("yarn"))


def test_workspace_of_a_local_session_may_be_temporary():
    session = fake("local[2]")
    assert workspace(session) == workspace(session)


def test_settled_frames(spark):
    settled = settle(spark.range(5).groupBy().count(), "n")
    assert settled.first()[0] == 5
    assert "Aggregate" not in settled._jdf.queryExecution().optimizedPlan().toString()
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert path_exists(spark, workspace(spark))


def test_a_large_settled_side_is_not_broadcast(spark):
    """The planner goes by the size of the written files."""
    side, rows = settle(spark.range(1000), "side"), spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = side.join(settle(rows, "rows"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in side.join(rows, "id")._jdf.queryExecution().executedPlan().toString()


def test_session_defaults(spark):
    session = build_session("again", spark__sql__shuffle__partitions="8")
    assert session.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    session.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_clearing(spark):
    scratch = scratch_path(spark, "gone")
    spark.range(1).write.parquet(scratch)
    assert path_exists(spark, scratch)
    clear_workspace(spark)
    assert not path_exists(spark, scratch)
