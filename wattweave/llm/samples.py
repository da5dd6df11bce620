"""Bounded training samples, drawn by a hash of the id, and the split into folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(id_col: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null without an id."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string")) % divisor


def held_out(id_col: str | Column, divisor: int, rest: int) -> Column:
    return F.coalesce(remainder(id_col, divisor) == rest, F.lit(False))


def class_counts(rows: DataFrame) -> dict:
    """Rows of (id, label) by label."""
    return {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}


def draw(rows: DataFrame, counts: dict, per_label: int) -> DataFrame:
    """At most ``per_label`` rows (id, label) of each label: those with the smallest hashes of the id.

    A first cut by hash leaves little more than that many rows of a label, so the exact
    order is taken over few rows however large a class is.
    """
    if not counts:
        return rows.limit(0)
    space = 1 << 40
    limits: list[Column] = []
    for label, n in counts.items():
        share = min(1.0, (1.2 * per_label + 50) / n)
        limits += [F.lit(label), F.lit(int(space * share))]
    mixed = F.pmod(F.xxhash64("id"), F.lit(space))
    near = rows.withColumn("mixed", mixed).where(F.col("mixed") < F.create_map(*limits)[F.col("label")])
    order = Window.partitionBy("label").orderBy("mixed", "id")
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label).drop("place", "mixed")
