"""Training intervals, time splits and month folds."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.functions.calendar import minus_months
from wattweave.functions.columns import quoted


def training_interval(
    df: DataFrame, ts: str = "datetime", train_months: int = 6, test_months: int = 3
) -> tuple[Column, Column]:
    """(start, end): end is the latest time, start lies train + test calendar months before.

    Both are scalar subqueries: they run once, before the scans that use them, and
    reach these scans as filter values.
    """
    last = df.agg(F.max(quoted(ts)).alias("last"))
    start = last.select(minus_months(F.col("last"), train_months + test_months)).scalar()
    return start, last.scalar()


def interval_values(
    df: DataFrame, ts: str = "datetime", train_months: int = 6, test_months: int = 3
) -> tuple[datetime.datetime, datetime.datetime]:
    """:func:`training_interval`, evaluated."""
    last = F.max(quoted(ts))
    return tuple(df.agg(minus_months(last, train_months + test_months), last).first())


def date_column(df: DataFrame) -> str:
    """First column whose name contains "date"."""
    for name in df.columns:
        if "date" in name:
            return name
    raise ValueError(f"no column name contains 'date': {df.columns}")


def between_times(df: DataFrame, start, end, column: str | None = None) -> DataFrame:
    """Rows with ``start < time <= end``; a date counts as its midnight."""
    at = quoted(column or date_column(df))
    low, high = (_naive(x) for x in (start, end))
    return df.filter((at > low) & (at <= high))


def _naive(value) -> Column:
    """Literal of a Python date or time, without a zone."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz" if isinstance(value, datetime.datetime) else "date")


def time_split(df: DataFrame, date: str = "date", test_months: int = 3, out: str = "split") -> DataFrame:
    """Mark rows before (latest date - test months) as train, the others as test."""
    border = df.agg(minus_months(F.max(quoted(date)), test_months)).scalar()
    return df.withColumn(out, F.when(quoted(date) < border, "train").when(quoted(date) >= border, "test"))


def month_number(ts: Column) -> Column:
    """Months since the year 0, so that neighbours differ by one."""
    return F.year(ts) * 12 + F.month(ts) - 1


def year_and_month(number: int) -> tuple[int, int]:
    """The year and month of a :func:`month_number`."""
    return number // 12, number % 12 + 1


def month_roles(df: DataFrame, date: str = "date", train_months: int = 3, test_months: int = 1) -> DataFrame:
    """Which months serve which fold: one row per (fold_id, role, month number).

    Every month of the data is the last training month of one fold. A fold trains on its
    last ``train_months`` months and on the same month of earlier years, and tests on the
    next ``test_months`` months. Folds whose train or test months hold no rows are left
    out. Only distinct months are joined, never rows.
    """
    number = month_number(quoted(date)).alias("month_number")
    present = df.select(number).filter(F.col("month_number").isNotNull()).distinct()
    return roles_of_months(present, train_months, test_months)


def roles_of_months(present: DataFrame, train_months: int = 3, test_months: int = 1) -> DataFrame:
    """:func:`month_roles` of the distinct month numbers ``present``."""
    month = F.col("month_number")
    folds = present.select(month.alias("fold"))
    fold = F.col("fold")

    def role(name: str, first: Column, last: Column) -> DataFrame:
        return folds.select(fold, F.lit(name).alias("role"), F.explode(F.sequence(first, last)).alias("month_number"))

    recent = role("train", fold - (train_months - 1), fold) if train_months > 0 else None
    test = role("test", fold + 1, fold + test_months)
    same_month = (
        folds.withColumn("__m", F.pmod(fold, F.lit(12)))
        .join(present.withColumn("__m", F.pmod(month, F.lit(12))), on="__m")
        .filter(month < fold)
        .select("fold", F.lit("train").alias("role"), "month_number")
    )
    train = same_month if recent is None else same_month.union(recent).distinct()
    roles = train.union(test).join(present, on="month_number", how="left_semi")
    complete = roles.groupBy("fold").agg(F.count_distinct("role").alias("sides")).filter("sides = 2").select("fold")
    start = F.make_date(F.floor((fold + 1) / 12).cast("int"), F.pmod(fold + 1, F.lit(12)) + 1, F.lit(1))
    return roles.join(complete, on="fold").select(
        (F.floor(fold / 12) * 100 + F.pmod(fold, F.lit(12)) + 1).cast("int").alias("fold_id"),
        start.alias("test_start"),
        "role",
        "month_number",
    )


def month_folds(
    df: DataFrame, date: str = "date", train_months: int = 3, test_months: int = 1, max_folds: int | None = None
) -> DataFrame:
    """Rows of every fold: ``fold_id`` (yyyymm of the last training month), ``role``, row.

    Rows repeat once per fold that uses them. To train one fold, filter by ``fold_id``:
    the filter reaches the months before they meet the rows.
    """
    roles = first_folds(month_roles(df, date, train_months, test_months), max_folds)
    keyed = df.withColumn("month_number", month_number(quoted(date)))
    # at most one row per pair of calendar months
    return keyed.join(F.broadcast(roles), on="month_number").select(
        "fold_id", "test_start", "role", *[quoted(c) for c in df.columns]
    )


def first_folds(roles: DataFrame, max_folds: int | None) -> DataFrame:
    """Roles of the earliest ``max_folds`` folds."""
    if max_folds is None:
        return roles
    kept = roles.select("fold_id").distinct().orderBy("fold_id").limit(max_folds)
    return roles.join(kept, on="fold_id", how="left_semi")


def fold_sizes(df: DataFrame, date: str = "date", train_months: int = 3, test_months: int = 1) -> DataFrame:
    """Rows per fold and role, from one count per month."""
    monthly = df.groupBy(month_number(quoted(date)).alias("month_number")).agg(F.count(F.lit(1)).alias("rows"))
    roles = month_roles(df, date, train_months, test_months)
    return roles.join(monthly, on="month_number").groupBy("fold_id", "test_start", "role").agg(
        F.sum("rows").alias("rows")
    )
