"""Rolling means and prior-year means."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from wattweave.operators import windows
from wattweave.operators.ordering import repeat_rows
from wattweave.registry import query
from wattweave.sources.views import table


def _sql(by: list[str], seconds: int, suffix: str) -> str:
    # The frame (t - period, t]: timestamps are whole microseconds. Sums of cents are exact
    # in any order, so the means must agree to the last bit.
    keys = ", ".join(by)
    return f"""
    SELECT {keys}, ts, sum(cents) OVER w::DOUBLE / count(cents) OVER w AS cents_{suffix},
           sum(k) OVER w::DOUBLE / count(k) OVER w AS k_{suffix}
    FROM (SELECT *, round(value * 100)::BIGINT AS cents, (props::JSON ->> 'k')::INTEGER AS k FROM events)
    WINDOW w AS (PARTITION BY {keys} ORDER BY ts
                 RANGE BETWEEN INTERVAL '{seconds - 1}.999999 seconds' PRECEDING AND CURRENT ROW)
    """


def _rolling(spark, folder, by, period, suffix):
    events = table(spark, folder, "events").withColumns(
        {"cents": F.round(F.col("value") * 100).cast("bigint"), "k": F.from_json("props", "k int").k}
    )
    means = windows.rolling_mean(events, by, "ts", ["cents", "k"], {suffix: period})
    return repeat_rows(means, F.col("__copies"))


@query("rolling_1d_two_keys", _sql(["event_type", "user_id"], 86_400, "last_day"))
def rolling_1d_two_keys(spark, folder):
    return _rolling(spark, folder, ["event_type", "user_id"], windows.DAY, "last_day")


@query("rolling_7d", _sql(["event_type"], 7 * 86_400, "last_7_days"))
def rolling_7d(spark, folder):
    return _rolling(spark, folder, ["event_type"], windows.WEEK, "last_7_days")


@query("rolling_24h", _sql(["event_type"], 86_400, "last_24_hours"))
def rolling_24h(spark, folder):
    return _rolling(spark, folder, ["event_type"], datetime.timedelta(hours=24), "last_24_hours")


@query(
    "hourly_rolling_24h",
    """
    WITH hourly AS (
        SELECT event_type, date_trunc('hour', ts) AS datetime, avg(value)::FLOAT AS value, min(event_type) AS label
        FROM events GROUP BY 1, 2
    )
    SELECT event_type, datetime, round(value::DOUBLE, 4) AS value, label,
           round(avg(value) OVER (PARTITION BY event_type ORDER BY datetime
               RANGE BETWEEN INTERVAL '86399.999999 seconds' PRECEDING AND CURRENT ROW), 4) AS value_last_24_hours
    FROM hourly
    """,
)
def hourly_rolling_24h(spark, folder):
    """Hourly means per event type, then their rolling day; a series has one row per hour."""
    from wattweave.operators.aggregates import group_mean

    events = table(spark, folder, "events").withColumns(
        {"datetime": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "label": F.col("event_type")}
    )
    hourly = group_mean(events, ["event_type", "datetime"], ["value"], ["label"])
    rolled = windows.rolling_mean_by_frame(
        hourly, ["event_type"], "datetime", ["value"], {"last_24_hours": windows.DAY}
    )
    return rolled.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("value", "value_last_24_hours")})


@query(
    "prior_year_month_mean",
    """
    WITH monthly AS (
        SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, sum(o_totalprice) AS s, count(o_totalprice) AS n
        FROM orders GROUP BY 1, 2
    ), earlier AS (
        SELECT a.y, a.m, sum(b.s) / sum(b.n) AS mean FROM monthly a JOIN monthly b ON a.m = b.m AND b.y < a.y
        GROUP BY 1, 2
    )
    SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
           round(coalesce(mean, o_totalprice), 4) AS o_totalprice_monthly_historical
    FROM orders LEFT JOIN earlier ON y = year(o_orderdate) AND m = month(o_orderdate)
    """,
)
def prior_year_month_mean(spark, folder):
    orders = table(spark, folder, "orders")
    rows = orders.select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_totalprice"
    )
    filled = windows.add_monthly_history(rows, orders, "o_orderdate", ["o_totalprice"])
    name = "o_totalprice_monthly_historical"
    return filled.withColumn(name, F.round(name, 4)).drop("o_totalprice")
