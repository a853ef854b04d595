"""Files and folders on the cluster's shared file system."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; onto a present one it would land inside it, so that is refused."""
    fs, source_path = _resolve(spark, source)
    _, target_path = _resolve(spark, target)
    if fs.exists(target_path):
        raise FileExistsError(f"{target} is there already; {source} was left where it is")
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files in a folder, sorted."""
    fs, path = _resolve(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(path) if status.isFile())


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """The names of the folders in a folder, sorted."""
    fs, path = _resolve(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory())


def mark(spark: SparkSession, folder: str) -> str:
    """Text that changes with the files of a folder: how many, bytes, time of the last change."""
    fs, path = _resolve(spark, folder)
    held = fs.getContentSummary(path)
    return f"{held.getFileCount()}-{held.getLength()}-{fs.getFileStatus(path).getModificationTime()}"


def as_pattern(path: str) -> str:
    """A path as readers take it, who read patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a file, a folder or a pattern stands for, sorted; hidden ones are left out."""
    fs, path = _resolve(spark, pattern)
    found = []
    for status in fs.globStatus(path) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [s.getPath().toString() for s in inside if s.isFile() and s.getPath().getName()[0] not in "._"]
    return sorted(found)


def first_lines(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> list[str | None]:
    """The first line of each file, None for an empty one; as much work for the driver as listing the files."""
    jvm = spark.sparkContext._jvm

    def first(path: str) -> str | None:
        fs, target = _resolve(spark, path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(target), "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(first, paths))


def escaped_value(spark: SparkSession, value: str) -> str:
    """A partition value as its folder's name has it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    A session without that setting gets a folder below its warehouse, which all executors
    reach as well; never one of a single machine's temporary folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
