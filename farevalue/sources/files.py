"""What Hadoop's file system says of a path; it works wherever Spark reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Contents:
    """Size of all files below a path, their number, and the last change seen at its top."""

    size: int
    files: int
    changed: int

    def mark(self) -> str:
        return f"{self.size}-{self.files}-{self.changed}"


def _opened(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def contents(spark: SparkSession, path: str) -> Contents:
    """Measure a file, a folder or a pattern of them; nothing there counts as empty."""
    pattern, system = _opened(spark, path)
    size = files = changed = 0
    for top in system.globStatus(pattern) or []:
        summary = system.getContentSummary(top.getPath())
        size += summary.getLength()
        files += summary.getFileCount()
        inside = system.listStatus(top.getPath()) if top.isDirectory() else []
        changed = max([changed, top.getModificationTime(), *(s.getModificationTime() for s in inside)])
    return Contents(size, files, changed)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, from one listing."""
    top, system = _opened(spark, path)
    return [s.getPath().getName() for s in system.listStatus(top) if s.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    target, system = _opened(spark, path)
    system.delete(target, True)
