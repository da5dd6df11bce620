"""Named relations and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, **relations: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` in the text refers to a relation given by keyword."""
    return spark.sql(text, **relations)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
