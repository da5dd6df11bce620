"""The training table and the models, with events standing in for the energy tables.

Each event type is one prosumer segment; six-hour slots stand for hours. All six source
tables are derived from one table of sums per event type and slot.
"""

from __future__ import annotations

import datetime
import posixpath
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.functions.calendar import add_calendar_parts, publication_shift
from wattweave.functions.columns import quoted
from wattweave.plans import models
from wattweave.plans.training_table import Sources, store_training_table, training_table
from wattweave.registry import query
from wattweave.registry.folds import _COMPLETE, _FOLDS
from wattweave.schemas import (
    CLIENTS,
    CYCLES,
    ELECTRICITY,
    FORECAST,
    FORECAST_MEASURES,
    FORECAST_ROLLING,
    GAS,
    MEASURED,
    MEASURED_MEASURES,
    MEASURED_ROLLING,
    METERING,
    TRAINING_TABLE,
    forecast_name,
)
from wattweave.session import durable, shared_dir
from wattweave.sources.tables import _typed
from wattweave.sources.views import table

# event type -> county, is_business, product_type, is_consumption
SEGMENTS = {
    "click": (0, 0, 0, 0),
    "view": (0, 1, 1, 1),
    "error": (1, 0, 2, 1),
    "purchase": (1, 1, 3, 0),
    "signup": (2, 0, 7, 1),
}
FIRST_DAY = datetime.date(2024, 1, 1)
SLOT_HOURS = 6


def _weights(i: int) -> tuple[float, float]:
    """The i-th measure of a slot is (a * sum of values + b * sum of k) / events."""
    return 1 + i * 0.5, 0.25 * (i + 1)


def slot_sums(spark, folder) -> DataFrame:
    """Sums per event type and slot: the only pass over the events."""
    events = table(spark, folder, "events").withColumn("k", F.from_json("props", "k int").k)
    day = F.col("ts").cast("date").cast("timestamp_ntz")
    slot = day + F.make_dt_interval(F.lit(0), F.floor(F.hour("ts") / SLOT_HOURS).cast("int") * SLOT_HOURS)
    sums = events.groupBy("event_type", slot.alias("datetime")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("v"),
        F.sum("k").alias("k"),
        F.max("k").alias("kmax"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
    )
    codes = [F.create_map(*[x for t, s in SEGMENTS.items() for x in (F.lit(t), F.lit(s[i]))]) for i in range(4)]
    names = ["county", "is_business", "product_type", "is_consumption"]
    return sums.withColumns({n: code[F.col("event_type")] for n, code in zip(names, codes)})


def _block(ts, later: int = 0):
    return F.datediff(ts.cast("date"), F.lit(FIRST_DAY)) + later


def _weather(slots: DataFrame, measures: list[str]) -> DataFrame:
    n = F.sum("n")
    return slots.groupBy("county", "datetime").agg(
        *[
            ((F.sum("v") * a + F.sum("k") * b) / n).cast("float").alias(m)
            for m, (a, b) in ((m, _weights(i)) for i, m in enumerate(measures))
        ]
    ).withColumns(
        {
            "latitude_min": F.col("county") + 57,
            "latitude_max": F.col("county") + 58,
            "longitude_min": F.col("county") + 21,
            "longitude_max": F.col("county") + 23,
            "county_name": F.concat(F.lit("County "), F.col("county")),
        }
    )


def sources(spark, folder) -> Sources:
    slots = durable(slot_sums(spark, folder))
    at = F.col("datetime")
    by_day = slots.withColumn("date", at.cast("date"))

    metering = slots.select(
        "county", "is_business", "product_type", "is_consumption", "datetime",
        F.col("v").alias("target"), _block(at).alias("data_block_id"),
    )
    clients = by_day.groupBy("county", "is_business", "product_type", "date").agg(
        F.max("kmax").alias("eic_count"), F.sum("v").alias("installed_capacity")
    ).withColumn("data_block_id", _block(F.col("date"), 1))
    gas = by_day.groupBy("date").agg(
        F.min("lo").alias("gas_lowest_price_per_mwh"), F.max("hi").alias("gas_highest_price_per_mwh")
    ).withColumns(
        {
            "gas_mean_price_per_mhw": (F.col("gas_lowest_price_per_mwh") + F.col("gas_highest_price_per_mwh")) / 2,
            "data_block_id": _block(F.col("date"), 1),
        }
    )
    next_day = at + F.expr("INTERVAL 1 DAY")
    electricity = slots.groupBy(next_day.alias("datetime")).agg(
        (F.sum("v") / F.sum("n")).alias("electricity_euros_per_mwh")
    ).withColumn("data_block_id", _block(at))
    measured = _weather(slots, MEASURED_MEASURES).withColumn("datetime", publication_shift(at)).withColumn(
        "data_block_id", _block(at)
    )
    forecast = _weather(slots, FORECAST_MEASURES).withColumn("datetime", next_day).withColumn(
        "data_block_id", _block(at)
    )
    return Sources(
        metering=_typed(add_calendar_parts(metering), METERING),
        clients=_typed(clients, CLIENTS),
        gas=_typed(gas, GAS),
        electricity=_typed(electricity, ELECTRICITY),
        forecast=_typed(forecast, FORECAST),
        measured=_typed(measured, MEASURED),
    )


def shown(df: DataFrame) -> DataFrame:
    """Floats as rounded doubles, for comparison with SQL."""
    return df.select(
        [
            F.round(quoted(c).cast("double"), 4).alias(c) if kind in ("float", "double") else quoted(c)
            for c, kind in df.dtypes
        ]
    )


# --- the same in SQL --------------------------------------------------------------
def _sql_case(i: int) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{t}' THEN {s[i]}" for t, s in SEGMENTS.items()) + " END::TINYINT"


def _sql_weather(measures: list[str]) -> str:
    parts = []
    for i, m in enumerate(measures):
        a, b = _weights(i)
        parts.append(f'((sum(value) * {a}::DOUBLE + sum(k) * {b}::DOUBLE) / count(*))::FLOAT AS "{m}"')
    return ", ".join(parts)


def _sql_box(suffix: str = "") -> str:
    return (
        f"(county + 57)::FLOAT AS latitude_min{suffix}, (county + 58)::FLOAT AS latitude_max{suffix}, "
        f"(county + 21)::FLOAT AS longitude_min{suffix}, (county + 23)::FLOAT AS longitude_max{suffix}, "
        f"'County ' || county AS county_name{suffix}"
    )


def _sql_rolling(measures: list[str], by: str, seconds: int, suffix: str) -> str:
    over = (
        f"(PARTITION BY {by} ORDER BY datetime RANGE BETWEEN INTERVAL '{seconds - 1}.999999 seconds' "
        "PRECEDING AND CURRENT ROW)"
    )
    return ", ".join(f'avg("{m}") OVER {over} AS "{m}_{suffix}"' for m in measures)


def _sql_block(ts: str, later: int = 0) -> str:
    return f"(datediff('day', DATE '2024-01-01', ({ts})::DATE) + {later})::SMALLINT"


def _training_sql() -> str:
    lags = "".join(f", l{d}.target AS target_{d}_days_ago" for d in range(2, 8))
    lag_joins = "".join(
        f" LEFT JOIN joined l{d} ON l{d}.client_id = j.client_id AND l{d}.datetime + INTERVAL {d} DAY = j.datetime"
        for d in range(2, 8)
    )
    renamed = ", ".join(f'"{m}" AS "{forecast_name(m)}"' for m in FORECAST_MEASURES)
    circle = {"hour": "2 * pi() * hour(datetime) / 24", "weekday": "2 * pi() * isodow(datetime) / 7",
              "month": "2 * pi() * month(datetime) / 12", "day_of_year": "pi() * dayofyear(datetime) / 366"}
    cycles = ", ".join(f'{fn}({circle[c]})::FLOAT AS "{fn}({c})"' for c in CYCLES for fn in ("sin", "cos"))
    output = ", ".join(
        f'round("{f.name}"::FLOAT::DOUBLE, 4) AS "{f.name}"'
        if f.dataType.simpleString() == "float"
        else f'"{f.name}"'
        for f in TRAINING_TABLE.fields
    )
    complete = " AND ".join(f'"{c}" IS NOT NULL' for c in TRAINING_TABLE.names)
    return f"""
    WITH slotted AS (
        SELECT *, date_trunc('day', ts) + to_hours((hour(ts) // {SLOT_HOURS}) * {SLOT_HOURS}) AS datetime,
               (props::JSON ->> 'k')::INTEGER AS k,
               {_sql_case(0)} AS county, {_sql_case(1)} AS is_business, {_sql_case(2)} AS product_type,
               {_sql_case(3)} AS is_consumption
        FROM events
    ), metering AS (
        SELECT county, is_business, product_type, is_consumption, datetime, sum(value)::FLOAT AS target,
               {_sql_block('datetime')} AS data_block_id
        FROM slotted GROUP BY ALL
    ), clients AS (
        SELECT county, is_business, product_type, datetime::DATE AS date_client, max(k)::SMALLINT AS eic_count,
               sum(value)::FLOAT AS installed_capacity, {_sql_block('datetime', 1)} AS data_block_id
        FROM slotted GROUP BY ALL
    ), gas AS (
        SELECT datetime::DATE AS date_gas, min(value)::FLOAT AS gas_lowest_price_per_mwh,
               max(value)::FLOAT AS gas_highest_price_per_mwh, (min(value) + max(value)) / 2 AS gas_mean_price_per_mhw,
               {_sql_block('datetime', 1)} AS data_block_id
        FROM slotted GROUP BY ALL
    ), electricity AS (
        SELECT datetime + INTERVAL 1 DAY AS datetime, avg(value)::FLOAT AS electricity_euros_per_mwh,
               {_sql_block('datetime + INTERVAL 1 DAY')} AS data_block_id
        FROM slotted GROUP BY ALL
    ), measured_slots AS (
        SELECT county, datetime AS seen_at, {_sql_weather(MEASURED_MEASURES)}, {_sql_box()} FROM slotted GROUP BY 1, 2
    ), measured AS (
        SELECT *, CASE WHEN hour(seen_at) < 11 THEN seen_at + INTERVAL 1 DAY ELSE seen_at + INTERVAL 2 DAY END AS datetime,
               {_sql_block("datetime")} AS data_block_id
        FROM measured_slots
    ), forecast AS (
        SELECT county, datetime + INTERVAL 1 DAY AS datetime, {_sql_weather(FORECAST_MEASURES)}
        FROM slotted GROUP BY 1, 2
    ), forecast_rolled AS (
        SELECT county, datetime, {_sql_block('datetime')} AS data_block_id, {renamed}, {_sql_box('_forecast')},
               {_sql_rolling(FORECAST_ROLLING, f"county, {_sql_block('datetime')}", 86_400, 'forecast_last_day')}
        FROM forecast
    ), measured_rolled AS (
        SELECT county, datetime, {_sql_rolling(MEASURED_ROLLING, 'county', 7 * 86_400, 'last_7_days')},
               {_sql_rolling(MEASURED_ROLLING, 'county', 86_400, 'last_24_hours')}
        FROM measured
    ), joined AS (
        SELECT (dense_rank() OVER (ORDER BY county, is_business, product_type, is_consumption) - 1)::INTEGER AS client_id, *
        FROM metering
        LEFT JOIN clients USING (county, is_business, product_type, data_block_id)
        LEFT JOIN gas USING (data_block_id)
        LEFT JOIN electricity USING (datetime, data_block_id)
        LEFT JOIN (SELECT * EXCLUDE (seen_at) FROM measured) USING (county, datetime, data_block_id)
        LEFT JOIN forecast_rolled USING (county, datetime, data_block_id)
        LEFT JOIN measured_rolled USING (county, datetime)
    ), featured AS (
        SELECT j.* REPLACE (CASE j.product_type WHEN 0 THEN 'Combined' WHEN 1 THEN 'Fixed' WHEN 2 THEN 'General service'
                                            WHEN 3 THEN 'Spot' ELSE 'Unknown' END AS product_type)
               {lags}, j.datetime::DATE AS date, year(j.datetime)::INTEGER AS year, month(j.datetime)::TINYINT AS month,
               day(j.datetime)::TINYINT AS day, {cycles.replace('(datetime)', '(j.datetime)')},
               j.datetime::DATE = DATE '2024-01-01' AS is_holiday
        FROM joined j {lag_joins}
    )
    SELECT {output} FROM featured WHERE {complete}
    """


@query("training_table", _training_sql())
def training_table_from_events(spark, folder):
    return shown(training_table(sources(spark, folder), noise=False, lags="before"))


# --- models -----------------------------------------------------------------------
# Boosting is not the subject of these queries: few rounds of small trees, over all rows and columns.
_FEW = models.Parameters(rounds=5, options={"maxDepth": 3})
_SPLIT_DAYS = 7
_TABLE = f"WITH built AS ({_training_sql()}), marked AS (SELECT *, date > max(date) OVER (PARTITION BY is_consumption, is_business) - {_SPLIT_DAYS} AS is_test FROM built)"
_NO_FEATURES = {*models.NON_FEATURE_COLUMNS, models.LABEL, "date"} & {*TRAINING_TABLE.names}
# segments with more training rows than product types
_FITTED = "count(*) FILTER (NOT is_test) > count(DISTINCT product_type) FILTER (NOT is_test)"
_KINDS = ", ".join(f"({side}, '{name}')" for name, side in models.MODEL_TYPES.items())


def _table(spark, folder, **options) -> DataFrame:
    return durable(training_table(sources(spark, folder), lags="before", **options))


def _recent(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Model frame whose last week is the test set: the events span one month only."""
    last = table.agg(F.max("date")).scalar()
    frame = table.drop(*models.NON_FEATURE_COLUMNS)
    frame = frame.withColumn(models.IS_TEST, F.col("date") > F.date_sub(last, _SPLIT_DAYS)).drop("date")
    return frame.select([quoted(c) for c in columns] + [models.IS_TEST]) if columns else frame


@query(
    "segment_models",
    f"""{_TABLE}
    SELECT name AS model_type, is_business = 1 AS is_business, count(*) FILTER (is_test) AS test_rows,
           count(*) FILTER (is_test) > 0 AS scored
    FROM marked JOIN (VALUES {_KINDS}) kinds(code, name) ON is_consumption = code
    GROUP BY name, is_business HAVING {_FITTED}
    """,
)
def segment_models(spark, folder):
    """Fit one model per segment and score it on the last week."""
    data = _table(spark, folder, noise=False)
    fitted = models.train_segments(data, {"consumer": _FEW, "producer": _FEW}, frame=_recent)
    scores = models.segment_scores(data, fitted, frame=_recent)
    return scores.select("model_type", "is_business", "test_rows", F.col("mae").isNotNull().alias("scored"))


@query(
    "fold_scores",
    _FOLDS.format(train=6, test=3)
    + f"""
    SELECT DISTINCT fold_id, true AS scored FROM used WHERE {_COMPLETE}
    """,
)
def fold_scores(spark, folder):
    """Fit and score every month fold over daily order totals per nation, stored by month."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    daily = (
        table(spark, folder, "orders")
        .join(customers, on="o_custkey")
        .groupBy("c_nationkey", F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sum("o_totalprice").alias("target"), F.count(F.lit(1)).alias("orders"))
        .withColumns({"weekday": F.weekday("date") + 1, "year": F.year("date"), "month": F.month("date")})
    )
    base = posixpath.join(shared_dir(spark), f"daily-{uuid.uuid4().hex}")
    stored = store_training_table(daily, base, datetime.date(2024, 1, 31))
    scores = models.fold_scores(stored, _FEW, train_months=6, test_months=3)
    return scores.select("fold_id", (F.col("mae") > 0).alias("scored"))


@query(
    "batch_score",
    f"""{_TABLE}
    SELECT client_id, datetime, kinds.name AS model_type, is_business = 1 AS is_business, true AS predicted
    FROM marked JOIN (VALUES {_KINDS}) kinds(code, name) ON is_consumption = code
    WHERE (is_consumption, is_business) IN
          (SELECT (is_consumption, is_business) FROM marked GROUP BY is_consumption, is_business HAVING {_FITTED})
    """,
)
def batch_score(spark, folder):
    """Save a fitted model for each segment, load them again and predict the whole interval."""
    data = sources(spark, folder)
    train = durable(training_table(data, noise=False, lags="before"))
    base, day = posixpath.join(shared_dir(spark), f"models-{uuid.uuid4().hex}"), datetime.date(2024, 1, 31)
    fitted = models.train_segments(train, {"consumer": _FEW, "producer": _FEW}, frame=_recent)
    models.save_segments(fitted, base, day)
    scored = models.score_segments(train, base, day)
    return scored.select(
        "client_id", "datetime", "model_type", "is_business", F.col("prediction").isNotNull().alias("predicted")
    )


@query("learning_curve", "SELECT i::INTEGER AS iteration, true AS measured FROM range(1, 6) rounds(i)")
def learning_curve(spark, folder):
    curve = models.learning_curve(_recent(_table(spark, folder)), _FEW)
    return curve.select("iteration", ((F.col("train") > 0) & (F.col("valid") > 0)).alias("measured"))


@query(
    "feature_importance",
    f"""
    SELECT {len(TRAINING_TABLE.names) - len(_NO_FEATURES) + 1}::BIGINT AS features, true AS sums_to_100,
           true AS cumulative_ends_at_100, true AS noise_ranked, true AS some_beat_noise
    FROM (SELECT count(*) FROM events)
    """,
)
def feature_importance(spark, folder):
    """Importances of a fitted model over all features and the noise column, in summary."""
    frame = _recent(_table(spark, folder))
    importances = models.feature_importances(spark, models.fit(frame, _FEW), frame)
    weak = models.weaker_than_noise(importances).agg(F.count("*")).scalar()
    return importances.agg(
        F.count("*").alias("features"),
        (F.abs(F.sum("importance_perc") - 100) < 1e-6).alias("sums_to_100"),
        (F.abs(F.max("importance_perc_cumulative") - 100) < 1e-6).alias("cumulative_ends_at_100"),
        F.coalesce(F.max(F.when(F.col("feature") == "noise", F.lit(True))), F.lit(False)).alias("noise_ranked"),
        (weak < F.count("*")).alias("some_beat_noise"),
    )


@query(
    "candidate_scores",
    """
    SELECT candidate, objective, true AS scored
    FROM (VALUES ('shallow', 'l2'), ('deep', 'l2'), ('poisson', 'poisson')) candidates(candidate, objective)
    """,
)
def candidate_scores(spark, folder):
    """Two tree depths and a Poisson model on all features, scored on the last week."""
    frame = _recent(_table(spark, folder, noise=False))
    candidates = {
        "shallow": models.Parameters(rounds=5, options={"maxDepth": 2}),
        "deep": models.Parameters(rounds=5, options={"maxDepth": 4}),
        "poisson": models.Parameters("poisson"),
    }
    scores = models.candidate_scores(frame, candidates)
    return scores.select("candidate", "objective", (F.col("mae") >= 0).alias("scored"))
