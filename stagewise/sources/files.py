"""Folder operations through Hadoop's file system, so they work wherever Spark can read."""

from __future__ import annotations

from pyspark.sql import SparkSession

# File systems where renaming a folder is a metadata operation.
RENAMING_SCHEMES = ("file", "hdfs", "viewfs", "abfs", "abfss")


def path_exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_hadoop_path(spark, path))


def delete_path(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).delete(_hadoop_path(spark, path), True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder inside one file system, making the parent folders of the target."""
    system, to = _filesystem(spark, source), _hadoop_path(spark, target)
    system.mkdirs(to.getParent())
    _rename(spark, system, source, target)


def merge_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move all files below a folder to the same places below another that exists already.

    A file that is in the target under its name gets a number in front, so nothing is overwritten.
    """
    system = _filesystem(spark, target)
    for status in system.listStatus(_hadoop_path(spark, source)):
        name = status.getPath().getName()
        destination = f"{target}/{name}"
        there = system.exists(_hadoop_path(spark, destination))
        if status.isDirectory() and there:
            merge_folder(spark, f"{source}/{name}", destination)
            continue
        number = 1
        while there:
            destination, number = f"{target}/{number}-{name}", number + 1
            there = system.exists(_hadoop_path(spark, destination))
        _rename(spark, system, f"{source}/{name}", destination)
    system.delete(_hadoop_path(spark, source), True)


def adopt_files(spark: SparkSession, source: str, target: str, tag: str) -> None:
    """Move the data files below a folder to the same places below another, with a tag in front of their names.

    What the target has under the tag in those places goes first, so doing the same again replaces it.
    """
    system = _filesystem(spark, target)
    system.mkdirs(_hadoop_path(spark, target))
    for status in system.listStatus(_hadoop_path(spark, target)):
        if not status.isDirectory() and status.getPath().getName().startswith(f"{tag}-"):
            system.delete(status.getPath(), False)
    for status in system.listStatus(_hadoop_path(spark, source)):
        name = status.getPath().getName()
        if status.isDirectory():
            adopt_files(spark, f"{source}/{name}", f"{target}/{name}", tag)
        elif not name.startswith(("_", ".")):
            _rename(spark, system, f"{source}/{name}", f"{target}/{tag}-{name}")


def set_mark(spark: SparkSession, path: str, kind: str, name: str) -> None:
    """Leave a mark of a kind below a path, where readers do not look."""
    _filesystem(spark, path).mkdirs(_hadoop_path(spark, f"{path}/_{kind}/{name}"))


def marks(spark: SparkSession, path: str, kind: str) -> list[str]:
    """The marks of a kind below a path."""
    folder = f"{path}/_{kind}"
    if not path_exists(spark, folder):
        return []
    return sorted(s.getPath().getName() for s in _filesystem(spark, folder).listStatus(_hadoop_path(spark, folder)))


def replace_folders(spark: SparkSession, source: str, target: str, names: list[str], old: str) -> None:
    """Move the named folders from one parent to another, in the place of those that have the same names there.

    Names may be nested. Replaced folders are kept below ``old``. If a move fails, all moves before it are taken back.
    """
    system, done, parents = _filesystem(spark, target), [], set()
    system.mkdirs(_hadoop_path(spark, target))
    first_level = {s.getPath().getName() for s in system.listStatus(_hadoop_path(spark, target))}

    def is_there(name: str) -> bool:
        first, _, nested = name.partition("/")
        return first in first_level and (not nested or system.exists(_hadoop_path(spark, f"{target}/{name}")))

    def move(before: str, after: str) -> None:
        parent = after.rpartition("/")[0]
        if parent not in parents:
            system.mkdirs(_hadoop_path(spark, parent))
            parents.add(parent)
        _rename(spark, system, before, after)
        done.append((before, after))

    try:
        for name in names:
            if is_there(name):
                move(f"{target}/{name}", f"{old}/{name}")
            move(f"{source}/{name}", f"{target}/{name}")
    except Exception:
        for before, after in reversed(done):
            _rename(spark, system, after, before)
        raise


def _rename(spark: SparkSession, system, source: str, target: str) -> None:
    if not system.rename(_hadoop_path(spark, source), _hadoop_path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def partition_folders(spark: SparkSession, path: str, partition: str) -> list[str]:
    """Names of the ``partition=value`` folders directly below a path: one listing call, no file is opened."""
    if not path_exists(spark, path):
        return []
    statuses = _filesystem(spark, path).listStatus(_hadoop_path(spark, path))
    names = [s.getPath().getName() for s in statuses if s.isDirectory()]
    return sorted(n for n in names if n.startswith(f"{partition}="))


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def renames_cheaply(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).getScheme() in RENAMING_SCHEMES
