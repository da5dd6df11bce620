"""Parquet tables between steps, daily partitions and idempotent backfill."""

from __future__ import annotations

import datetime
import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattweave.functions.columns import quoted

DAY_PARTS = ["year", "month", "day"]


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def union_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, matched by column name; missing columns become null."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def day_path(base: str, day: datetime.date, name: str | None = None) -> str:
    """``base/year=Y/month=M/day=D`` without zero padding, as ``partitionBy`` writes it."""
    parts = [f"year={day.year}", f"month={day.month}", f"day={day.day}"] + ([name] if name else [])
    return posixpath.join(base, *parts)


def with_day_parts(df: DataFrame, date: str = "date") -> DataFrame:
    at = quoted(date)
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})


def write_daily(df: DataFrame, path: str, date: str = "date", within: list[str] | None = None) -> None:
    """Write each day of ``df`` to its partition, replacing that partition and no other.

    ``within`` names columns that part a day further.

    The rebalance hint gathers a day's rows into few files and still splits a day that
    is too large for one task.
    """
    names = DAY_PARTS + (within or [])
    parts = with_day_parts(df, date).hint("rebalance", *names)
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)


def run_path(base: str, run_date: datetime.date) -> str:
    """Folder of the run of a day; its name cannot clash with a table's own year, month or day."""
    return posixpath.join(base, f"run_date={run_date.isoformat()}")


def write_run(df: DataFrame, path: str, run_date: datetime.date) -> None:
    """Write a whole table under the partition of the day it was made."""
    df.write.mode("overwrite").parquet(run_path(path, run_date))


def calendar(spark: SparkSession, start: datetime.date, end: datetime.date) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.make_dt_interval(F.lit(1)))
    return spark.range(1).select(F.explode(days).alias("date"))


def written_days(spark: SparkSession, path: str, start: datetime.date | None = None, end: datetime.date | None = None) -> DataFrame:
    """Days that already have a partition, in the interval if one is given; none without a table.

    The interval is a filter on partition columns, so only its folders are looked into.
    """
    none = spark.createDataFrame([], "date date")
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return none
        raise
    day = F.make_date(*DAY_PARTS)
    if start is not None:
        table = table.filter(F.col("year") >= start.year).filter(day >= F.lit(start))
    if end is not None:
        table = table.filter(F.col("year") <= end.year).filter(day <= F.lit(end))
    # partition columns only: no column chunk is read
    return table.select(*DAY_PARTS).distinct().select(F.make_date(*DAY_PARTS).alias("date"))


def pending_days(wanted: DataFrame, done: DataFrame, date: str = "date") -> DataFrame:
    """Days of ``wanted`` not in ``done``."""
    return wanted.select(date).distinct().join(done.select(date), on=date, how="left_anti")


def backfill_daily(
    df: DataFrame, path: str, start: datetime.date, end: datetime.date, date: str = "date"
) -> DataFrame:
    """Write the missing days of ``[start, end]`` in one job; return (date, rows) per day handled.

    Days already present are left alone, so a second run writes nothing. Days without
    rows are reported with 0 and get no partition.
    """
    spark = df.sparkSession
    todo = pending_days(calendar(spark, start, end), written_days(spark, path, start, end)).withColumnRenamed("date", date)
    # the list of days is fixed before the write changes what is there (bounded by the calendar)
    days = [row[0] for row in todo.collect()]
    todo = spark.createDataFrame([(d,) for d in days], f"{date} date")
    rows = df.filter(quoted(date).between(F.lit(start), F.lit(end))).join(todo, on=date, how="left_semi")
    if days:
        write_daily(rows, path, date)
        mine = F.make_date(*DAY_PARTS).isin(days)  # partition columns only: other days are not read
        written = read_table(spark, path).filter(mine).groupBy(quoted(date)).agg(F.count(F.lit(1)).alias("rows"))
        todo = todo.join(written, on=date, how="left")
    else:
        todo = todo.withColumn("rows", F.lit(0).cast("bigint"))
    return todo.select(quoted(date), F.coalesce("rows", F.lit(0)).alias("rows"))
