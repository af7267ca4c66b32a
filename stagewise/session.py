"""Session defaults and the shared working area."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "stagewise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; keyword dots are written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_shipped: set[str] = set()
_local_folders: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the few functions that run in Python there.

    The archive is built on the driver, and Spark itself hands it out; no executor sees the driver's folder.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="stagewise-pkg-")) / "stagewise"
    archive = shutil.make_archive(str(target), "zip", root_dir=package.parent, base_dir=package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def workspace(spark: SparkSession) -> str:
    """The folder all executors share, for staged writes and lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder; on a cluster a machine-local folder would be wrong, so that is an error.
    """
    app, shared = spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # Executors of a local-cluster are processes of their own, as on any cluster.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="stagewise-")
        shared = _local_folders[app]
    return f"{shared.rstrip('/')}/stagewise/{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared working area."""
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def clear_workspace(spark: SparkSession) -> None:
    """Delete what this application has put into the shared working area."""
    path = spark._jvm.org.apache.hadoop.fs.Path(workspace(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a reduced result once and read it back.

    The read-back has a short lineage that survives lost executors, and its size is known from its files, so a
    later join broadcasts it only when it is under ``spark.sql.autoBroadcastJoinThreshold`` and is a sort-merge
    join (with the adaptive skew split) otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
