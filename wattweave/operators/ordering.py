"""Totals and positions over one global order, and row repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattweave.functions.columns import columns_except, quoted, select_names
from wattweave.session import durable



def running_total(
    df: DataFrame,
    order: list[str],
    value: str,
    out: str,
    *,
    descending: tuple[str, ...] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Cumulative sum of ``value`` over the total order of ``order`` (unique keys).

    Rows are split into key ranges (as many as the session has shuffle partitions,
    unless given): the sum within a range is a window per range, and each range is
    shifted by the total of the ranges before it (one row per range). ``ranges=1`` is
    for tables that are small by nature: one window in one task, and nothing is written.
    """
    ordering = [quoted(c).desc_nulls_last() if c in descending else quoted(c).asc_nulls_first() for c in order]
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if ranges == 1:
        frame = Window.orderBy(*ordering).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(quoted(value)).over(frame))

    # The range number of a row is stored, so that a re-run task cannot change it.
    ranged = durable(df.repartitionByRange(ranges, *ordering).withColumn("__range", F.spark_partition_id()))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__range")
        .agg(F.sum(quoted(value)).alias("__total"))
        .select("__range", F.sum("__total").over(earlier).alias("__before"))
    )
    within = Window.partitionBy("__range").orderBy(*ordering)
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(F.broadcast(offsets), on="__range")  # at most `ranges` rows
        .withColumn(out, F.coalesce("__before", F.lit(0)) + F.sum(quoted(value)).over(within))
        .drop("__range", "__before")
    )


def number_rows(df: DataFrame, order: list[str], out: str, **options) -> DataFrame:
    """0-based position of each row in the total order of ``order`` (unique keys)."""
    counted = running_total(df.withColumn("__one", F.lit(1)), order, "__one", out, **options)
    return counted.withColumn(out, quoted(out) - 1).drop("__one")


def repeat_rows(df: DataFrame, times: Column, number: str | None = None) -> DataFrame:
    """Each row ``times`` times; ``__copies`` is dropped, ``number`` names a column for the copy's number."""
    names = columns_except(df, ["__copies"]) + ([number] if number else [])
    repeated = df.withColumn("__copies", F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("bigint"), times.cast("bigint")))))
    return select_names(repeated.withColumn(number, F.col("__copies")) if number else repeated, names)


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows of an explicit order; Spark keeps only ``n`` rows per task."""
    return df.orderBy(*order).limit(n)
