"""Numbered versions of a folder, each seen only once it is published.

A version is a folder ``version=N``. It is written first and published after that by an empty
marker file, created in one step on every file system Spark writes to. A writer that dies
half-way leaves a folder without a marker: readers go on with the version before, and the
next writer takes the same number and replaces it. One writer at a time is assumed.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import SparkSession

MARKER = "_PUBLISHED"


def _at(spark: SparkSession, path: str):
    """File system and path object of ``path``."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, path = _at(spark, folder)
    return [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []


def remove(spark: SparkSession, path: str) -> None:
    files, path = _at(spark, path)
    files.delete(path, True)


def version_path(base: str, version: int) -> str:
    return posixpath.join(base, f"version={version}")


def numbers(spark: SparkSession, base: str) -> list[int]:
    """All versions below ``base``, published or not, in ascending order."""
    found = [name.removeprefix("version=") for name in names(spark, base) if name.startswith("version=")]
    return sorted(int(number) for number in found if number.isdigit())


def published(spark: SparkSession, base: str) -> int | None:
    """The newest published version below ``base``, or None."""
    for version in reversed(numbers(spark, base)):
        files, marker = _at(spark, posixpath.join(version_path(base, version), MARKER))
        if files.exists(marker):
            return version
    return None


def publish(spark: SparkSession, base: str, version: int) -> None:
    """Make a written version the one that readers take."""
    files, marker = _at(spark, posixpath.join(version_path(base, version), MARKER))
    files.create(marker, True).close()


def prune(spark: SparkSession, base: str, keep: int = 1) -> None:
    """Remove all versions before the newest published one but the last ``keep - 1`` of them."""
    if keep < 1:
        raise ValueError("the newest version stays")
    newest = published(spark, base)
    before = [version for version in numbers(spark, base) if newest is not None and version < newest]
    for version in before[: len(before) - (keep - 1)]:
        remove(spark, version_path(base, version))
