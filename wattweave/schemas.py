"""Input schemas, the training-table schema, and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------
PRODUCT_TYPES = {0: "Combined", 1: "Fixed", 2: "General service", 3: "Spot"}
PRODUCT_DEFAULT = "Unknown"
INGEST_PRODUCT_DEFAULT = "General service"
MODEL_TYPES = {"producer": 0, "consumer": 1}
PUBLICATION_HOUR = 11
LAG_DAYS = 7
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

SEGMENT_KEYS = ["county", "is_business", "product_type", "is_consumption"]
CONTRACT_KEYS = ["county", "is_business", "product_type", "data_block_id"]
WEATHER_KEYS = ["county", "datetime", "data_block_id"]
STATION_COLUMNS = ["latitude_min", "latitude_max", "longitude_min", "longitude_max", "county_name"]

FORECAST_MEASURES = [
    "hours_ahead",
    "temperature",
    "dewpoint",
    "cloudcover_high",
    "cloudcover_low",
    "cloudcover_mid",
    "cloudcover_total",
    "10_metre_u_wind_component",
    "10_metre_v_wind_component",
    "direct_solar_radiation",
    "surface_solar_radiation_downwards",
    "snowfall",
    "total_precipitation",
]
MEASURED_MEASURES = [
    "temperature",
    "dewpoint",
    "rain",
    "snowfall",
    "surface_pressure",
    "cloudcover_total",
    "cloudcover_low",
    "cloudcover_mid",
    "cloudcover_high",
    "windspeed_10m",
    "winddirection_10m",
    "shortwave_radiation",
    "direct_solar_radiation",
    "diffuse_radiation",
]
FORECAST_ROLLING = [c for c in FORECAST_MEASURES if c != "hours_ahead"]
MEASURED_ROLLING = [c for c in MEASURED_MEASURES if c != "surface_pressure"]

# Identifier columns that never become model features.
NON_FEATURE_COLUMNS = [
    "client_id",
    "datetime",
    "data_block_id",
    "county",
    "county_name_forecast",
    "date_client",
    "date_gas",
    "latitude_max_forecast",
    "latitude_min_forecast",
    "longitude_max_forecast",
    "longitude_min_forecast",
]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BYTE, SHORT, INT, LONG = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE, STRING = T.FloatType(), T.DoubleType(), T.StringType()
DATE, NAIVE, BOOLEAN = T.DateType(), T.TimestampNTZType(), T.BooleanType()

# --- loaded tables ----------------------------------------------------------------
METERING = _struct(
    county=BYTE, is_business=BYTE, product_type=BYTE, target=FLOAT, is_consumption=BYTE,
    datetime=NAIVE, data_block_id=SHORT, date=DATE, year=INT, month=BYTE, day=BYTE,
    weekday=BYTE, day_of_year=SHORT, hour=BYTE,
)
CLIENTS = _struct(
    product_type=BYTE, county=BYTE, eic_count=SHORT, installed_capacity=FLOAT,
    is_business=BYTE, date=DATE, data_block_id=SHORT,
)
ELECTRICITY = _struct(datetime=NAIVE, electricity_euros_per_mwh=FLOAT, data_block_id=SHORT)
GAS = _struct(
    date=DATE, gas_lowest_price_per_mwh=FLOAT, gas_highest_price_per_mwh=FLOAT,
    gas_mean_price_per_mhw=DOUBLE, data_block_id=SHORT,
)
STATIONS = _struct(
    longitude=FLOAT, latitude=FLOAT, county=BYTE, county_name=STRING,
    longitude_min=FLOAT, longitude_max=FLOAT, latitude_min=FLOAT, latitude_max=FLOAT,
)
_BOX = {name: (STRING if name == "county_name" else FLOAT) for name in STATION_COLUMNS}
FORECAST = _struct(
    county=BYTE, datetime=NAIVE, data_block_id=SHORT, **{c: FLOAT for c in FORECAST_MEASURES}, **_BOX
)
MEASURED = _struct(
    county=BYTE, datetime=NAIVE, data_block_id=SHORT, **{c: FLOAT for c in MEASURED_MEASURES}, **_BOX
)

# Client records as they arrive on a stream, before any cast.
CLIENT_MESSAGE = _struct(
    product_type=LONG, county=LONG, eic_count=LONG, installed_capacity=DOUBLE,
    is_business=LONG, date=STRING, data_block_id=LONG,
)

_FORECAST_CLASHES = [c for c in FORECAST_MEASURES if c in MEASURED_MEASURES] + STATION_COLUMNS


def forecast_name(column: str) -> str:
    """Name of a forecast column once it stands beside the measured weather."""
    return f"{column}_forecast" if column in _FORECAST_CLASHES else column


CYCLES = ["hour", "weekday", "month", "day_of_year"]

TRAINING_TABLE = _struct(
    client_id=INT, county=BYTE, is_business=BYTE, product_type=STRING, is_consumption=BYTE,
    datetime=NAIVE, date=DATE, year=INT, month=BYTE, day=BYTE, target=FLOAT, data_block_id=SHORT,
    eic_count=SHORT, installed_capacity=FLOAT, date_client=DATE,
    date_gas=DATE, gas_lowest_price_per_mwh=FLOAT, gas_highest_price_per_mwh=FLOAT,
    gas_mean_price_per_mhw=FLOAT, electricity_euros_per_mwh=FLOAT,
    **{c: FLOAT for c in MEASURED_MEASURES},
    **_BOX,
    **{forecast_name(c): FLOAT for c in FORECAST_MEASURES},
    **{forecast_name(c): kind for c, kind in _BOX.items()},
    **{f"{c}_forecast_last_day": FLOAT for c in FORECAST_ROLLING},
    **{f"{c}_last_7_days": FLOAT for c in MEASURED_ROLLING},
    **{f"{c}_last_24_hours": FLOAT for c in MEASURED_ROLLING},
    **{f"target_{d}_days_ago": FLOAT for d in range(2, LAG_DAYS + 1)},
    **{f"{fn}({c})": FLOAT for c in CYCLES for fn in ("sin", "cos")},
    is_holiday=BOOLEAN,
)
