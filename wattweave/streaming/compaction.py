"""Merging of the small files that micro-batches leave in a daily table.

The rows of a stream arrive below ``arrived`` as ``year/month/day/batch``. ``compact`` merges
the batches of a day into one set of files below ``merged/version=N`` and then publishes a
manifest with, for every merged day, its version and the last batch in it. A reader takes a
day's merged version and the batches after that, so it sees a day either before or after a
compaction and each row once. What was replaced stays until ``remove_replaced``.

The manifest has a row per merged day; it is the only thing that comes to the driver, where
it becomes a filter on partition columns: replaced files are not listed for a scan.
"""

from __future__ import annotations

import datetime
import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattweave.sources import versions
from wattweave.sources.sinks import DAY_PARTS

MANIFEST = "date date, version int, through bigint"


def arrived_path(base: str) -> str:
    """Where a stream writes (``stream_clients_by_day`` and the like)."""
    return posixpath.join(base, "arrived")


def _merged(base: str) -> str:
    return posixpath.join(base, "merged")


def _manifests(base: str) -> str:
    return posixpath.join(base, "manifest")


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that a stream finished; -1 before the first."""
    done = [int(name) for name in versions.names(spark, posixpath.join(checkpoint, "commits")) if name.isdigit()]
    return max(done, default=-1)


def manifest(spark: SparkSession, base: str) -> dict[datetime.date, tuple[int, int]]:
    """Merged day -> (version, last batch in it)."""
    newest = versions.published(spark, _manifests(base))
    if newest is None:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(versions.version_path(_manifests(base), newest)).collect()
    return {r.date: (r.version, r.through) for r in rows}


def _by_day(values: dict[datetime.date, int]) -> Column:
    """The value of a row's day, from its partition columns; -1 for other days."""
    day = F.make_date(*DAY_PARTS)
    cells = [F.lit(cell) for item in values.items() for cell in item]
    return F.coalesce(F.try_element_at(F.create_map(*cells), day), F.lit(-1)) if cells else F.lit(-1)


def _kept(
    spark: SparkSession, base: str, schema: T.StructType | None, days: dict[datetime.date, tuple[int, int]]
) -> DataFrame:
    """The merged rows of ``days``, with the given schema or that of the files."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("version", T.IntegerType())]))
    version = _by_day({day: version for day, (version, _) in days.items()})
    return reader.parquet(_merged(base)).filter(F.col("version") == version).drop("version")


def _live(spark: SparkSession, base: str, days: dict[datetime.date, tuple[int, int]]) -> DataFrame:
    """Rows as the manifest ``days`` gives them."""
    arrived = _table(spark, arrived_path(base))
    if arrived is None and not days:
        raise FileNotFoundError(f"no batch has been written to {arrived_path(base)}")
    if arrived is None:  # all batches are merged and removed
        return _kept(spark, base, None, days)
    rows = arrived.filter(F.col("batch") > _by_day({day: through for day, (_, through) in days.items()}))
    rows = rows.drop("batch")
    if not days:
        return rows
    return rows.unionByName(_kept(spark, base, rows.schema, days))


def read_compacted(spark: SparkSession, base: str) -> DataFrame:
    """All rows of the table, merged or not, with its day columns."""
    return _live(spark, base, manifest(spark, base))


def compact(spark: SparkSession, base: str, checkpoint: str, least: int = 2) -> list[datetime.date]:
    """Merge every day with at least ``least`` unmerged batches; returns the days.

    Only batches that the stream of ``checkpoint`` finished are taken, so a stream may run
    meanwhile; one compaction runs at a time. A compaction that breaks off changes nothing
    that readers see, and the next one replaces what it left. Rows without a day are not merged.
    """
    arrived = _table(spark, arrived_path(base))
    if arrived is None:
        return []
    days, last = manifest(spark, base), committed_batch(spark, checkpoint)
    fresh = F.col("batch") > _by_day({day: through for day, (_, through) in days.items()})
    # partition columns only: no column chunk is read; one row per day comes to the driver
    waiting = (
        arrived.filter(fresh & (F.col("batch") <= last))
        .select(F.make_date(*DAY_PARTS).alias("date"), "batch")
        .distinct()
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("batches"), F.max("batch").alias("through"))
        .filter(F.col("date").isNotNull() & (F.col("batches") >= least))
    )
    found = {r.date: r.through for r in waiting.collect()}
    if not found:
        return []
    version = 1 + max([versions.published(spark, _manifests(base)) or 0, *[v for v, _ in days.values()]])

    through = _by_day(found)
    mine = F.make_date(*DAY_PARTS).isin(list(found))
    rows = arrived.filter(mine & fresh & (F.col("batch") <= through)).drop("batch")
    again = {day: days[day] for day in found if day in days}
    if again:
        rows = rows.unionByName(_kept(spark, base, rows.schema, again))
    written = rows.hint("rebalance", *DAY_PARTS).write.mode("overwrite").option("partitionOverwriteMode", "static")
    written.partitionBy(*DAY_PARTS).parquet(versions.version_path(_merged(base), version))

    after = days | {day: (version, upto) for day, upto in found.items()}
    listed = spark.createDataFrame([(day, *entry) for day, entry in after.items()], MANIFEST)
    listed.coalesce(1).write.mode("overwrite").parquet(versions.version_path(_manifests(base), version))
    versions.publish(spark, _manifests(base), version)
    return sorted(found)


def remove_replaced(spark: SparkSession, base: str) -> None:
    """Delete the batches and versions that the newest manifest replaced.

    For a time when no reader of an older manifest is left.
    """
    newest = versions.published(spark, _manifests(base))
    if newest is None:
        return
    days = manifest(spark, base)
    for day, (version, through) in days.items():
        parts = [f"year={day.year}", f"month={day.month}", f"day={day.day}"]
        folder = posixpath.join(arrived_path(base), *parts)
        for name in versions.names(spark, folder):
            if name.startswith("batch=") and int(name.removeprefix("batch=")) <= through:
                versions.remove(spark, posixpath.join(folder, name))
    used = {version for version, _ in days.values()}
    for version in versions.numbers(spark, _merged(base)):
        if version < newest and version not in used:
            versions.remove(spark, versions.version_path(_merged(base), version))
    versions.prune(spark, _manifests(base))
