"""File-system metadata through Hadoop, so that any path Spark reads works here too.

Only names, sizes and small text files pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    is_dir: bool
    size: int


@lru_cache(maxsize=4)
def _hadoop(gateway):
    """Classes looked up once: every step of a dotted name asks the JVM."""
    return gateway.jvm.org.apache.hadoop.fs


@lru_cache(maxsize=4)
def _path_class(gateway):
    return _hadoop(gateway).Path


def _open(spark: SparkSession, path: str):
    handle = _path_class(spark.sparkContext._gateway)(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def _joined(spark: SparkSession, statuses) -> list[str]:
    """The paths of an array of statuses, in one call however many there are."""
    gateway = spark.sparkContext._gateway
    paths = _hadoop(gateway).FileUtil.stat2Paths(statuses)
    text = gateway.jvm.scala.runtime.ScalaRunTime.genericWrapArray(paths).mkString("\n")
    return text.split("\n") if text else []


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return bool(fs.exists(handle) and fs.getFileStatus(handle).isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return bool(fs.exists(handle))


def listing(spark: SparkSession, path: str) -> list[Entry]:
    """Entries of a folder; a folder that does not exist has none."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return [
        Entry(status.getPath().getName(), bool(status.isDirectory()), int(status.getLen()))
        for status in fs.listStatus(handle)
    ]


def total_size(spark: SparkSession, path: str) -> int:
    fs, handle = _open(spark, path)
    return int(fs.getContentSummary(handle).getLength())


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that shows up complete or not at all; False when the name is
    already taken.  Written under another name first and renamed without overwriting."""
    hadoop = _hadoop(spark.sparkContext._gateway)
    fs, handle = _open(spark, path)
    beside = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    # The qualified path names its file system even where ``path`` leaves it out.
    context = hadoop.FileContext.getFileContext(
        fs.makeQualified(handle).toUri(), spark._jsc.hadoopConfiguration()
    )
    rule = getattr(hadoop, "Options$Rename")
    rules = spark.sparkContext._gateway.new_array(rule, 1)
    rules[0] = rule.NONE
    try:
        context.rename(beside, handle, rules)
    except Exception:
        if not fs.exists(handle):
            raise
        fs.delete(beside, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, handle = _open(spark, path)
    stream = fs.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.delete(handle, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, handle = _open(spark, source)
    if not fs.rename(handle, _path_class(spark.sparkContext._gateway)(target)):
        raise OSError(f"cannot rename {source} to {target}")


def _each(spark: SparkSession, paths: list[tuple], work: Callable) -> None:
    """Many calls on one file system, some at a time, as they mostly wait."""
    if not paths:
        return
    fs, _ = _open(spark, paths[0][0])
    path = _path_class(spark.sparkContext._gateway)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda names: work(fs, *map(path, names)), paths))


def make_dirs(spark: SparkSession, paths: Sequence[str]) -> None:
    _each(spark, [(p,) for p in paths], lambda fs, handle: fs.mkdirs(handle))


def rename_all(spark: SparkSession, moves: Sequence[tuple[str, str]]) -> None:
    def move(fs, source, target) -> None:
        if not fs.rename(source, target):
            raise OSError(f"cannot rename {source.toString()} to {target.toString()}")

    _each(spark, list(moves), move)


def writers(spark: SparkSession) -> int:
    """Tasks for making many small files.  Adaptive execution would merge them by their bytes,
    though it is the files that cost."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, spark.sparkContext.defaultParallelism)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*`` or ``{a,b}``, one level per ``/``."""
    fs, handle = _open(spark, pattern)
    found = fs.globStatus(handle)
    return _joined(spark, found) if found else []


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; a folder that does not exist has none."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return [found.rpartition("/")[2] for found in _joined(spark, fs.listStatus(handle))]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the shared folder named by ``spark.checkpoint.dir``, or in the
    session's warehouse, which is shared as well, where that is not set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/tidemark/{app}/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has put under ``scratch_path`` so far.  Results that were
    not computed yet may still read it: call it when a session's work is done."""
    delete_tree(spark, scratch_path(spark, "any").rpartition("/")[0])
