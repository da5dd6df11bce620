"""The training table: metering joined with contracts, prices and weather, plus features."""

from __future__ import annotations

import datetime
import posixpath
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattweave.functions.calendar import add_time_features
from wattweave.functions.columns import (
    add_noise,
    drop_any_null,
    narrow_to_32_bits,
    product_name,
    quoted,
    segment,
    select_names,
)
from wattweave.operators.joins import (
    add_entity_id,
    add_target_lags,
    add_target_lags_by_counts,
    add_target_lags_by_join,
    suffix_join,
)
from wattweave.operators.ordering import repeat_rows
from wattweave.operators.splits import between_times, interval_values
from wattweave.operators.windows import DAY, WEEK, add_monthly_history, rolling_mean, rolling_mean_by_frame
from wattweave.schemas import (
    CONTRACT_KEYS,
    FORECAST_ROLLING,
    LAG_DAYS,
    MEASURED_MEASURES,
    MEASURED_ROLLING,
    SEGMENT_KEYS,
    TRAINING_TABLE,
    WEATHER_KEYS,
)
from wattweave.sources import tables
from wattweave.sources.sinks import read_table, run_path, write_run


@dataclass(frozen=True)
class Sources:
    """The six loaded tables."""

    metering: DataFrame
    clients: DataFrame
    gas: DataFrame
    electricity: DataFrame
    forecast: DataFrame
    measured: DataFrame

    def between(self, start, end) -> Sources:
        """Every table limited to ``start < time <= end``."""
        return replace(self, **{name: between_times(df, start, end) for name, df in vars(self).items()})


def read_sources(spark: SparkSession, paths: dict[str, str]) -> Sources:
    """Read the CSV files named by ``paths`` (train, clients, gas, electricity,
    weather_station_map, weather_forecast, historical_weather)."""
    stations = tables.read_stations(spark, paths["weather_station_map"])
    return Sources(
        metering=tables.read_metering(spark, paths["train"]),
        clients=tables.read_clients(spark, paths["clients"]),
        gas=tables.read_gas(spark, paths["gas"]),
        electricity=tables.read_electricity(spark, paths["electricity"]),
        forecast=tables.read_forecast(spark, paths["weather_forecast"], stations),
        measured=tables.read_measured(spark, paths["historical_weather"], stations),
    )


def forecast_last_day(forecast: DataFrame) -> DataFrame:
    """Append one-day rolling means to the forecasts, per county and block.

    A series is one forecast run of one county, a few dozen hours, so plain frames do.
    """
    return rolling_mean_by_frame(
        forecast, ["county", "data_block_id"], "datetime", FORECAST_ROLLING, {"forecast_last_day": DAY}
    )


def measured_rolling(measured: DataFrame) -> DataFrame:
    """7-day and 24-hour rolling means per county and time, from one pass.

    Measurements are hourly means of a limited interval, so a county has one point per
    hour of the interval however many readings there were.
    """
    return rolling_mean(
        measured,
        ["county"],
        "datetime",
        MEASURED_ROLLING,
        {"last_7_days": WEEK, "last_24_hours": DAY},
        short_series=True,
    )


# Key by which the rows of each table meet a metering row.
JOIN_KEYS = {
    "clients": CONTRACT_KEYS,
    "gas": ["data_block_id"],
    "electricity": ["datetime", "data_block_id"],
    "forecast": WEATHER_KEYS,
    "measured": ["county", "datetime"],
}
BROADCAST_BYTES = 256 * 2**20
ROW_BYTES = 40 * 16  # of a joined row, at 16 bytes for each of at most 40 columns
COPY = "__copy"  # number of a row among those that a join has made of one


@dataclass(frozen=True)
class JoinFacts:
    """Row counts of the tables that metering is joined with, and how often a key occurs at most."""

    rows: dict[str, int]
    most: dict[str, int]

    @property
    def repeats(self) -> bool:
        return any(most > 1 for most in self.most.values())

    def broadcast(self, limit: int) -> set[str]:
        """Tables to send to every executor: the smallest ones whose counted bytes stay below the limit together."""
        chosen, total = set(), 0
        for name, rows in sorted(self.rows.items(), key=lambda item: item[1]):
            total += rows * ROW_BYTES
            if total > limit:
                break
            chosen.add(name)
        return chosen


def join_facts(sources: Sources) -> JoinFacts:
    """Count rows and repeated keys of the five smaller tables; reads their key columns only."""
    counts = [
        getattr(sources, name)
        .groupBy(*on)
        .count()
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.coalesce(F.max("count"), F.lit(0)).alias("most"))
        .select(F.lit(name).alias("name"), "rows", "most")
        for name, on in JOIN_KEYS.items()
    ]
    found = reduce(DataFrame.union, counts).collect()  # one row per table
    facts = JoinFacts({r["name"]: r["rows"] for r in found}, {r["name"]: r["most"] for r in found})
    for name in ("gas", "clients"):
        if facts.most[name] > 1:
            raise ValueError(
                f"{name} has {facts.most[name]} rows for one {JOIN_KEYS[name]}: each would repeat the metering rows it "
                "meets. Without a data_block_id of its own a table gets one constant block; give it one."
            )
    return facts


def join_sources(
    sources: Sources, facts: JoinFacts, lag_days: int | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """All tables joined to the metering rows; ``data_block_id`` keeps later data out.

    Tables whose counted size is small, in sum below ``broadcast_bytes``, are broadcast, so that
    the wide rows of metering are not shuffled; the others are left to Spark. With ``lag_days`` the target lags are
    added before anything is joined, while rows are narrow. That is the same as adding
    them afterwards if no join repeats rows.
    """
    data = add_entity_id(sources.metering, SEGMENT_KEYS, "client_id")
    if lag_days is not None:
        data = add_target_lags(data, lag_days=lag_days)

    small = facts.broadcast(broadcast_bytes)

    def join(name: str, table: DataFrame, on: list[str], suffix: str = "_right") -> DataFrame:
        return suffix_join(data, F.broadcast(table) if name in small else table, on, suffix=suffix)

    data = join("clients", sources.clients, CONTRACT_KEYS, "_client")
    data = join("gas", sources.gas, ["data_block_id"], "_gas")
    data = join("electricity", sources.electricity, ["datetime", "data_block_id"], "_electricity")
    data = join("measured", sources.measured, WEATHER_KEYS, "_measured")
    data = join("forecast", forecast_last_day(sources.forecast), WEATHER_KEYS, "_forecast")
    # The block is no key here: with k blocks at one county and time, each of the two
    # rolling tables repeats the row k times.
    data = join("measured", measured_rolling(sources.measured), ["county", "datetime"])
    return repeat_rows(data, F.coalesce(F.col("__copies") * F.col("__copies"), F.lit(1)), number=COPY)


def add_features(data: DataFrame, holidays=None) -> DataFrame:
    """Calendar features and product names; everything narrowed to 32 bits."""
    data = add_time_features(data, holidays)
    return narrow_to_32_bits(data.withColumn("product_type", product_name(F.col("product_type"))))


def training_table(
    sources: Sources,
    *,
    train_months: int = 6,
    test_months: int = 3,
    start=None,
    end=None,
    model_type: str | None = None,
    is_business: bool | None = None,
    columns: list[str] | None = None,
    noise: bool = True,
    seed: int = 42,
    lag_days: int = LAG_DAYS,
    lags: str = "counts",
    holidays=None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The feature table of the given interval (default: the last train + test months).

    ``lags`` says how target lags are found. "counts" is right in all cases and takes one
    window and one join for all lags; "join" gives the same with one self-join per lag. With one
    target per client and time, "after" (the joins) needs the window only; if no joined table
    repeats a key either, so does "before", while rows are narrow. These two raise where their
    condition does not hold.

    With ``model_type`` only that segment is kept, after client ids are assigned and
    before features are built. Rows with any null are dropped.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is None:
        # Two timestamps come to the driver; as literals they prune partitions and row groups.
        start, end = interval_values(sources.metering, "datetime", train_months, test_months)
    sources = sources.between(start, end)
    facts = join_facts(sources)
    if lags not in ("counts", "join", "after", "before"):
        raise ValueError(f"lags must be 'counts', 'join', 'after' or 'before', got {lags!r}")
    if lags == "before" and facts.repeats:
        raise ValueError(f"lags='before' needs tables without repeated keys; rows per key: {facts.most}")
    data = join_sources(sources, facts, lag_days if lags == "before" else None, broadcast_bytes)
    if model_type is not None:
        data = segment(data, model_type, is_business)
    if lags != "before":
        add = {"after": add_target_lags, "counts": add_target_lags_by_counts, "join": add_target_lags_by_join}[lags]
        data = add(data, lag_days=lag_days)
    data = drop_any_null(add_features(data, holidays))
    order = [c for c in TRAINING_TABLE.names if c in data.columns]
    if noise:
        data = add_noise(data, ["client_id", "datetime", COPY], seed)
    data = data.drop(COPY)
    data = select_names(data, order + [c for c in data.columns if c not in order])
    if columns:
        data = select_names(data, columns + ["noise"] * noise)
    return data


def add_weather_history(data: DataFrame, measured: DataFrame) -> DataFrame:
    """Mean of every measurement over the same month of earlier years, else the row's own value."""
    return add_monthly_history(data, measured, "datetime", MEASURED_MEASURES)


def store_sources(sources: Sources, base: str, run_date: datetime.date) -> Sources:
    """Write the loaded tables under the day of the run and go on from the written tables."""
    for name, df in vars(sources).items():
        write_run(df, posixpath.join(base, name), run_date)
    spark = sources.metering.sparkSession
    return Sources(**{name: read_table(spark, run_path(posixpath.join(base, name), run_date)) for name in vars(sources)})


def store_training_table(table: DataFrame, base: str, run_date: datetime.date) -> DataFrame:
    """Write the table under the day of the run, by month, and go on from the written table.

    Models read it many times, and folds filter on its partition columns. A table with a
    column of nulls only is refused.
    """
    path, written = run_path(base, run_date), Observation("written")
    counts = [F.count(quoted(name)).alias(f"n{i}") for i, name in enumerate(table.columns)]
    # counted on the way to the files; a task that runs twice makes no count zero and no zero more
    watched = table.observe(written, F.count(F.lit(1)).alias("rows"), *counts)
    # the hint gathers a month's rows into few files and splits a month too large for one task
    watched.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)
    seen = written.get
    empty = [name for i, name in enumerate(table.columns) if seen["rows"] and not seen[f"n{i}"]]
    if empty:
        raise ValueError(f"a column of the training table holds nothing but nulls: {', '.join(empty)}")
    return table.sparkSession.read.schema(table.schema).parquet(path).select(*map(quoted, table.columns))


def scoring_table(sources: Sources, start, end, **options) -> DataFrame:
    """As :func:`training_table` for a given interval, without the noise column."""
    return training_table(sources, start=start, end=end, noise=False, **options)
