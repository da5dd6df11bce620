"""Equi-joins of the data model.

No broadcast is forced on tables of unknown size: Spark broadcasts a side when its
statistics (or, at run time, its measured size) are below the session thresholds and
otherwise shuffles, splitting the partitions of hot keys.
"""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattweave.functions.calendar import day_of_epoch, micros_of_day, shift_days
from wattweave.functions.columns import quoted, select_names, sql_name
from wattweave.operators.ordering import number_rows, repeat_rows
from wattweave.schemas import LAG_DAYS, SEGMENT_KEYS, STATION_COLUMNS


def suffix_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", suffix: str = "_right"
) -> DataFrame:
    """Equi-join where right columns whose names clash get ``suffix``; left names are kept."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    renamed = {c: f"{c}{suffix}" for c in right.columns if c not in on and c in left.columns}
    result = left.columns + [renamed.get(c, c) for c in right.columns if c not in on]
    repeated = sorted({c for c in result if result.count(c) > 1})
    if repeated:
        raise ValueError(f"join would repeat columns {repeated}; choose another suffix")
    joined = left.join(right.withColumnsRenamed(renamed), on=on, how=how)
    return select_names(joined, result)


def centi_degrees(coordinate: Column) -> Column:
    """Coordinate in hundredths of a degree, as an exact join key."""
    return F.round(coordinate.cast("double") * 100).cast("int")


def locate_stations(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Attach county and bounding box to station readings; the coordinates are dropped.

    Readings of unknown stations keep null counties, and a station listed twice
    doubles its readings.
    """
    keys = {"__lat": centi_degrees(F.col("latitude")), "__lon": centi_degrees(F.col("longitude"))}
    known = stations.withColumns(keys).select("__lat", "__lon", "county", *STATION_COLUMNS)
    return (
        readings.withColumns(keys)
        .drop("latitude", "longitude")
        .join(known, on=["__lat", "__lon"], how="left")
        .drop("__lat", "__lon")
    )


def join_group_ranges(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Join each row with ``<column>_min`` and ``<column>_max`` of its group.

    The ranges are pre-aggregated, so a hot group costs no more than any other.
    """
    ranges = df.groupBy(key).agg(
        *[f(quoted(c)).alias(f"{c}_{name}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    )
    return df.join(ranges, on=key, how="inner")


def entity_ids(df: DataFrame, keys: list[str], out: str = "client_id", **options) -> DataFrame:
    """Distinct key combinations with dense 0-based ids in key order."""
    return number_rows(df.select(*keys).distinct(), keys, out, **options)


def add_entity_id(
    df: DataFrame, keys: list[str] | None = None, out: str = "client_id", source: DataFrame | None = None, **options
) -> DataFrame:
    """Attach :func:`entity_ids`; rows with a null key are dropped by the inner join.

    ``source`` may name a cheaper table with the same key combinations, so that
    numbering the keys does not run the plan of ``df``.
    """
    keys = SEGMENT_KEYS if keys is None else keys
    ids = entity_ids(df if source is None else source, keys, out, **options)
    return df.join(ids, on=keys, how="inner").transform(select_names, [out, *df.columns])


def lag_names(target: str, lag_days: int) -> dict[int, str]:
    return {d: f"{target}_{d}_days_ago" for d in range(2, lag_days + 1)}


def add_target_lags(
    df: DataFrame,
    entity: str = "client_id",
    ts: str = "datetime",
    target: str = "target",
    lag_days: int = LAG_DAYS,
) -> DataFrame:
    """Value of the same entity at the same time 2 ... ``lag_days`` days earlier.

    Missing days give null, so this is not a row lag. Rows that see each other share
    the time of day; they are partitioned by (entity, time of day) and each lag is a
    frame of exactly one day number. A group holds one row per calendar day, however
    large the entity is. Rows that earlier joins have repeated stand for one value and
    repeat the rows they are a lag of, as a join would. Different values for one entity
    and time raise; :func:`add_target_lags_by_join` handles that.
    """
    key, value = sql_name(entity), sql_name(target)
    matched = f"({key} IS NOT NULL AND {sql_name(ts)} IS NOT NULL)"
    # rows without a key have no lags; they are spread over all tasks
    spread = f"IF({matched}, NULL, pmod(xxhash64({', '.join(map(sql_name, df.columns))}), 4096))"
    at = quoted(ts)
    keyed = df.withColumns({"__day": day_of_epoch(at), "__time": micros_of_day(at), "__spread": F.expr(spread)})

    def over(first: str, days: str) -> str:
        return f"{first} OVER (PARTITION BY {key}, __time, __spread ORDER BY __day RANGE BETWEEN {days} AND {days})"

    def same_time(first: str) -> str:
        return over(first, "CURRENT ROW")

    rows, values = same_time("count(1)"), same_time(f"count({value})")
    one_value = f"{same_time(f'min({value})')} <=> {same_time(f'max({value})')} AND {values} IN (0, {rows})"
    clash = f"CAST(raise_error('different values of {target} for one ({entity}, {ts})') AS BIGINT)"
    names = lag_names(target, lag_days)
    lags = [
        f"IF({matched}, {over(f'max({value})', f'{d} PRECEDING')}, NULL) AS {sql_name(name)}" for d, name in names.items()
    ]
    repeats = [f"greatest({over('count(1)', f'{d} PRECEDING')}, 1)" for d in names]
    copies = f"CASE WHEN NOT {matched} THEN 1L WHEN {one_value} THEN {' * '.join(['1L', *repeats])} ELSE {clash} END"
    lagged = keyed.selectExpr(*map(sql_name, df.columns), *lags, f"{copies} AS __copies")
    return repeat_rows(lagged, F.col("__copies"))


def add_target_lags_by_join(
    df: DataFrame,
    entity: str = "client_id",
    ts: str = "datetime",
    target: str = "target",
    lag_days: int = LAG_DAYS,
) -> DataFrame:
    """As :func:`add_target_lags`, with one self-join per lag; repeated rows multiply."""
    past = df.select(quoted(entity), quoted(ts), quoted(target))
    for d, name in lag_names(target, lag_days).items():
        shifted = past.select(quoted(entity), shift_days(quoted(ts), d).alias(ts), quoted(target).alias(name))
        df = df.join(shifted, on=[entity, ts], how="left")
    return df




def add_target_lags_by_counts(
    df: DataFrame,
    entity: str = "client_id",
    ts: str = "datetime",
    target: str = "target",
    lag_days: int = LAG_DAYS,
) -> DataFrame:
    """As :func:`add_target_lags_by_join`, repeats and different values included, with one join for all lags.

    Rows are first reduced to a multiset: for each (entity, time) the different values with
    their counts. One window over (entity, time of day) then puts the multisets of all lags beside a time,
    each from a frame of exactly one day number, and one join brings them to the rows. A
    row is repeated for every combination of values, as often as the product of their
    counts; a lag without rows gives null. A multiset has one value as a rule, so that the
    joined table has one short row per time and entity.
    """
    names = lag_names(target, lag_days)
    key, at = quoted(entity), quoted(ts)
    known = df.filter(key.isNotNull() & at.isNotNull())
    counted = known.groupBy(key.alias("__entity"), at.alias("__at"), quoted(target).alias("__value")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    values = counted.groupBy("__entity", "__at").agg(F.collect_list(F.struct("__value", "__n")).alias("__values"))
    days = values.withColumns({"__day": day_of_epoch(F.col("__at")), "__time": micros_of_day(F.col("__at"))})

    def at_lag(d: int) -> Column:
        # the rows of a frame are one at most
        window = Window.partitionBy("__entity", "__time").orderBy("__day").rangeBetween(-d, -d)
        return F.first("__values").over(window)

    lags = days.select("__entity", "__at", *[at_lag(d).alias(f"__lag_{d}") for d in names])
    joined = df.join(lags, (key == F.col("__entity")) & (at == F.col("__at")), "left")
    for d in names:
        joined = joined.withColumn(f"__one_{d}", F.explode_outer(f"__lag_{d}"))
    copies = reduce(mul, [F.coalesce(f"__one_{d}.__n", F.lit(1)) for d in names], F.lit(1).cast("long"))
    found = [F.col(f"__one_{d}.__value").alias(name) for d, name in names.items()]
    return repeat_rows(joined.select(*[quoted(c) for c in df.columns], *found, copies.alias("__copies")), F.col("__copies"))
