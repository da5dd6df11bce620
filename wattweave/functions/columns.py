"""Casts, null rules, value maps, ratios, segment filters and keyed noise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.schemas import DATE_FORMAT, DATETIME_FORMAT, MODEL_TYPES, PRODUCT_DEFAULT, PRODUCT_TYPES


def sql_name(name: str) -> str:
    """Exact column name for SQL text, for names such as ``sin(hour)`` or ``10_metre_u``."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by exact name."""
    return F.col(sql_name(name))


def select_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Select by exact names; one call however wide the table is."""
    return df.selectExpr(*[sql_name(c) for c in names])


# --- casts ------------------------------------------------------------------------
def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; values that do not fit raise."""
    return df.withColumns({name: quoted(name).cast(kind) for name, kind in types.items()})


def _narrow(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *[
            f"CAST({sql_name(name)} AS {targets[kind]}) AS {sql_name(name)}" if kind in targets else sql_name(name)
            for name, kind in df.dtypes
        ]
    )


def narrow_to_32_bits(df: DataFrame) -> DataFrame:
    """bigint to int and double to float; other columns are untouched."""
    return _narrow(df, {"bigint": "int", "double": "float"})


def narrow_to_16_bits(df: DataFrame) -> DataFrame:
    """bigint and int to smallint; floats are untouched."""
    return _narrow(df, {"bigint": "smallint", "int": "smallint"})


def _names(columns: str | list[str]) -> list[str]:
    if isinstance(columns, str):
        return [columns]
    if not isinstance(columns, list):
        raise TypeError(f"expected a column name or a list of names, got {type(columns).__name__}")
    return columns


def parse_date(df: DataFrame, columns: str | list[str], fmt: str = DATE_FORMAT) -> DataFrame:
    """String columns to dates."""
    return df.withColumns({c: F.to_date(quoted(c), fmt) for c in _names(columns)})


def parse_datetime(df: DataFrame, columns: str | list[str], fmt: str = DATETIME_FORMAT) -> DataFrame:
    """String columns to naive timestamps."""
    return df.withColumns({c: F.to_timestamp_ntz(quoted(c), F.lit(fmt)) for c in _names(columns)})


def parse_zoned_datetime(df: DataFrame, columns: str | list[str], fmt: str, zone: str) -> DataFrame:
    """String columns holding local times of ``zone`` to instants."""

    def instant(local: Column) -> Column:
        second = F.extract(F.lit("SECOND"), local)
        return F.make_timestamp(
            F.year(local), F.month(local), F.day(local), F.hour(local), F.minute(local), second, F.lit(zone)
        )

    return df.withColumns({c: instant(F.to_timestamp_ntz(quoted(c), F.lit(fmt))) for c in _names(columns)})


def sql_round_to_int(value: Column) -> Column:
    """Numeric to int the SQL way: halves go to the even neighbour, nothing is truncated."""
    return F.bround(value).cast("int")


def to_boolean(value: Column) -> Column:
    return value.cast("boolean")


# --- constants, nulls -------------------------------------------------------------
def add_if_missing(df: DataFrame, column: str = "data_block_id", value=0) -> DataFrame:
    """Add a constant column unless it is already there."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def fill_null(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls by a literal, keeping the column type."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(v).cast(types[c])) for c, v in values.items()})


def fill_null_from(df: DataFrame, sources: dict[str, str]) -> DataFrame:
    """Replace nulls of each column by the value of another column of the row."""
    return df.withColumns({c: F.coalesce(quoted(c), quoted(s)) for c, s in sources.items()})


def drop_any_null(df: DataFrame) -> DataFrame:
    """Keep rows without nulls. NaN is a value and stays (``na.drop`` would remove it)."""
    return df.filter(" AND ".join(f"{sql_name(c)} IS NOT NULL" for c in df.columns))


def columns_except(df: DataFrame, excluded) -> list[str]:
    """Column names of ``df`` minus a set, in table order."""
    excluded = set(excluded)
    return [c for c in df.columns if c not in excluded]


# --- values -----------------------------------------------------------------------
def whole_number(value: Column, kind: str) -> Column:
    """Text such as "10" or "10.0" as an integer; a fraction is an error, not cut off."""
    number = value.cast("double")
    message = F.concat(F.lit("not a whole number: "), value.cast("string"))
    return F.when(number.isNull() | (number == F.floor(number)), number.cast(kind)).otherwise(
        F.raise_error(message).cast(kind)
    )


def midpoint(low: Column, high: Column) -> Column:
    return (low + high) / 2


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with IEEE results for a zero denominator (inf, -inf, NaN) instead of an error."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    by_zero = F.when(F.isnan(top), F.lit(math.nan)).when(top > 0, F.lit(math.inf)).when(top < 0, F.lit(-math.inf))
    by_zero = by_zero.otherwise(F.lit(math.nan))
    return F.when(top.isNull(), None).when(bottom == 0, by_zero).otherwise(top / bottom)


def add_capacity_ratios(df: DataFrame) -> DataFrame:
    """Installed capacity per metering point, and the inverse."""
    capacity, points = F.col("installed_capacity"), F.col("eic_count")
    return df.withColumns(
        {
            "installed_capacity_eic_count_ratio": ratio(capacity, points),
            "eic_count_installed_capacity_ratio": ratio(points, capacity),
        }
    )


def map_values(value: Column, mapping: dict, default) -> Column:
    """Look ``value`` up in a fixed mapping; anything else, null included, gets the default."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    key_type = "int" if all(isinstance(k, int) for k in mapping) else "string"
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value.cast(key_type)), F.lit(default))


def product_name(value: Column, default: str = PRODUCT_DEFAULT) -> Column:
    return map_values(value, PRODUCT_TYPES, default)


def map_from_table(
    df: DataFrame, column: str, table: DataFrame, key: str, value: str, default: str = "Unknown"
) -> DataFrame:
    """Replace a code by its name from a lookup table with unique keys; unmatched codes get the default."""
    lookup = table.select(quoted(key).alias("__key"), quoted(value).alias("__value"))
    joined = df.join(lookup, quoted(column) == F.col("__key"), "left")
    return joined.withColumn(column, F.coalesce("__value", F.lit(default))).drop("__key", "__value")


# --- filters ----------------------------------------------------------------------
def segment(df: DataFrame, model_type: str, is_business: bool | None = None) -> DataFrame:
    """Rows of one model segment; the columns that became constant are dropped."""
    kind = model_type.lower()
    if kind not in MODEL_TYPES:
        raise ValueError(f"model type must be one of {sorted(MODEL_TYPES)}, got {model_type!r}")
    rows = df.filter(F.col("is_consumption") == MODEL_TYPES[kind]).drop("is_consumption")
    if is_business is None:
        return rows
    return rows.filter(F.col("is_business") == int(is_business)).drop("is_business")


def at_day(df: DataFrame, day, column: str = "date") -> DataFrame:
    return df.filter(F.col(column).cast("date") == F.lit(day))


# --- noise ------------------------------------------------------------------------
def keyed_noise(keys: list[Column], seed: int = 42) -> Column:
    """Standard normal value that depends on the row's key and the seed only.

    Two hashes give two uniforms and Box-Muller turns them into a normal, so the
    result is the same under any partitioning and after a task is run again.
    """
    def uniform(stream: int) -> Column:
        # 53 bits of the hash, centred so that 0 never occurs
        bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed), F.lit(stream)), 11)
        return (bits.cast("double") + 0.5) * F.lit(2.0**-53)

    return F.sqrt(F.lit(-2.0) * F.ln(uniform(1))) * F.cos(F.lit(2 * math.pi) * uniform(2))


def add_noise(df: DataFrame, keys: list[str], seed: int = 42, out: str = "noise") -> DataFrame:
    return df.withColumn(out, keyed_noise([quoted(k) for k in keys], seed))
