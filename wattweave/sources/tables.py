"""Typed readers of the seven source tables and their lookups.

``shape_*`` functions take raw columns (strings or wider types, any file format) to the
loaded form; ``read_*`` functions put a CSV scan in front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattweave.functions.calendar import add_calendar_parts, publication_shift, shift_days
from wattweave.functions.columns import (
    add_if_missing,
    cast_columns,
    fill_null,
    midpoint,
    parse_date,
    parse_datetime,
    quoted,
    sql_name,
    whole_number,
)
from wattweave.operators.aggregates import group_mean
from wattweave.operators.joins import join_group_ranges, locate_stations
from wattweave.schemas import (
    CLIENTS,
    ELECTRICITY,
    FORECAST,
    FORECAST_MEASURES,
    GAS,
    MEASURED,
    MEASURED_MEASURES,
    METERING,
    PUBLICATION_HOUR,
    STATION_COLUMNS,
    STATIONS,
    WEATHER_KEYS,
)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header: a file, a folder or a glob.

    Without a schema all columns are strings; nothing is read to infer types. Only the
    columns used later are parsed. All files must have the same header: Spark matches
    columns by position, so a file in another order is an error here. Read such files
    apart and put them together by name with ``sinks.union_tables``.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        schema = reader.csv(path).schema  # of the first file's header
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with inferred types, for exploration: reads the data twice."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_json_lookup(spark: SparkSession, path: str, key: str = "county", value: str = "name") -> DataFrame:
    """A JSON object ``{"0": "name", ...}`` as a (key, value) table with integer keys."""
    pairs = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", T.MapType(T.StringType(), T.StringType()))).alias("k", "v")
    )
    return pairs.select(F.col("k").cast("int").alias(key), F.col("v").alias(value))


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``. Text such as "1.0" is a valid integer, "2.7" is an error."""
    whole = {f.name: f.dataType.simpleString() for f in schema.fields if isinstance(f.dataType, T.IntegralType)}
    df = _whole_numbers(df, whole)
    return df.selectExpr(
        *[f"CAST({sql_name(f.name)} AS {f.dataType.simpleString()}) AS {sql_name(f.name)}" for f in schema.fields]
    )


def _whole_numbers(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Text columns of these names as integers of the given kinds."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns({name: whole_number(quoted(name), kind) for name, kind in kinds.items() if name in text})


def shape_clients(raw: DataFrame) -> DataFrame:
    return add_if_missing(raw).transform(parse_date, "date").transform(_typed, CLIENTS)


def shape_electricity(raw: DataFrame) -> DataFrame:
    """Prices are known one day after the hour they were set for."""
    prices = add_if_missing(raw.drop("origin_date")).transform(parse_datetime, "forecast_date")
    return (
        prices.withColumn("forecast_date", shift_days(F.col("forecast_date"), 1))
        .withColumnsRenamed({"forecast_date": "datetime", "euros_per_mwh": "electricity_euros_per_mwh"})
        .transform(_typed, ELECTRICITY)
    )


def shape_gas(raw: DataFrame) -> DataFrame:
    """The mean price is taken from the prices before they are narrowed."""
    low, high = F.col("lowest_price_per_mwh").cast("double"), F.col("highest_price_per_mwh").cast("double")
    return (
        add_if_missing(raw.drop("origin_date"))
        .withColumn("gas_mean_price_per_mhw", midpoint(low, high))
        .transform(parse_date, "forecast_date")
        .withColumnsRenamed(
            {
                "forecast_date": "date",
                "lowest_price_per_mwh": "gas_lowest_price_per_mwh",
                "highest_price_per_mwh": "gas_highest_price_per_mwh",
            }
        )
        .transform(_typed, GAS)
    )


def shape_stations(raw: DataFrame) -> DataFrame:
    """Stations with their county (-1 and "Unknown" if none) and the county's bounding box."""
    rounded = {c: F.round(F.col(c).cast("float"), 2) for c in ("longitude", "latitude")}
    known = _whole_numbers(raw.withColumns(rounded), {"county": "tinyint"})
    known = fill_null(known, {"county": -1, "county_name": "Unknown"})
    return join_group_ranges(known, "county", ["longitude", "latitude"]).transform(_typed, STATIONS)


def shape_forecast(raw: DataFrame, stations: DataFrame) -> DataFrame:
    """Station forecasts averaged to county, hour and block."""
    readings = raw.drop("origin_datetime").withColumnRenamed("forecast_datetime", "datetime")
    return _county_weather(readings, stations, FORECAST_MEASURES).transform(_typed, FORECAST)


def shape_measured(raw: DataFrame, stations: DataFrame, offset_hours: int = PUBLICATION_HOUR) -> DataFrame:
    """Station measurements averaged to county, hour and block, then moved to when they are known."""
    hourly = _county_weather(raw, stations, MEASURED_MEASURES)
    shifted = hourly.withColumn("datetime", publication_shift(F.col("datetime"), offset_hours))
    return shifted.transform(_typed, MEASURED)


def _county_weather(readings: DataFrame, stations: DataFrame, measures: list[str]) -> DataFrame:
    typed = add_if_missing(readings).transform(parse_datetime, "datetime")
    typed = _whole_numbers(typed, {"data_block_id": "smallint"})
    typed = cast_columns(
        typed,
        {"latitude": "float", "longitude": "float", "data_block_id": "smallint"} | {m: "double" for m in measures},
    )
    return group_mean(locate_stations(typed, stations), WEATHER_KEYS, measures, STATION_COLUMNS)


def shape_metering(raw: DataFrame) -> DataFrame:
    typed = add_if_missing(raw).drop("prediction_unit_id", "row_id").transform(parse_datetime, "datetime")
    return add_calendar_parts(typed).transform(_typed, METERING)


def read_clients(spark: SparkSession, path: str) -> DataFrame:
    return shape_clients(read_csv(spark, path))


def read_electricity(spark: SparkSession, path: str) -> DataFrame:
    return shape_electricity(read_csv(spark, path))


def read_gas(spark: SparkSession, path: str) -> DataFrame:
    return shape_gas(read_csv(spark, path))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return shape_stations(read_csv(spark, path))


def read_forecast(spark: SparkSession, path: str, stations: DataFrame) -> DataFrame:
    return shape_forecast(read_csv(spark, path), stations)


def read_measured(
    spark: SparkSession, path: str, stations: DataFrame, offset_hours: int = PUBLICATION_HOUR
) -> DataFrame:
    return shape_measured(read_csv(spark, path), stations, offset_hours)


def read_metering(spark: SparkSession, path: str) -> DataFrame:
    return shape_metering(read_csv(spark, path))
