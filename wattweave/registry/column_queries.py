"""Casts, null rules, value maps, filters, calendar features."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from wattweave.functions import calendar as cal
from wattweave.functions import columns as col
from wattweave.operators import splits
from wattweave.registry import query
from wattweave.sources.views import table


@query(
    "typed_cast",
    """
    SELECT l_orderkey, l_linenumber::TINYINT AS l_linenumber, l_quantity::SMALLINT AS l_quantity,
           l_extendedprice::FLOAT AS l_extendedprice, l_shipdate::DATE AS l_shipdate
    FROM lineitem
    """,
)
def typed_cast(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    types = {"l_linenumber": "tinyint", "l_quantity": "smallint", "l_extendedprice": "float", "l_shipdate": "date"}
    return col.cast_columns(rows, types)


@query(
    "narrow_32",
    """
    SELECT p_name, p_size, length(p_name)::INTEGER AS name_length, p_retailprice::FLOAT AS p_retailprice FROM part
    """,
)
def narrow_32(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_name", "p_size", F.length("p_name").cast("bigint").alias("name_length"), "p_retailprice"
    )
    return col.narrow_to_32_bits(rows)


@query(
    "narrow_16",
    """
    SELECT p_name, p_size::SMALLINT AS p_size, length(p_name)::SMALLINT AS name_length, p_retailprice FROM part
    """,
)
def narrow_16(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_name", "p_size", F.length("p_name").cast("bigint").alias("name_length"), "p_retailprice"
    )
    return col.narrow_to_16_bits(rows)


@query("default_block", "SELECT o_orderkey, o_custkey, 0::SMALLINT AS data_block_id FROM orders")
def default_block(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    blocked = col.add_if_missing(orders)
    return col.cast_columns(col.add_if_missing(blocked), {"data_block_id": "smallint"})


def _customers_with_late_orders(spark, folder):
    """Every customer with all orders; what is known of an order is null before 2001 and without an order."""
    late = F.col("o_orderdate") >= F.lit(datetime.date(2001, 1, 1))
    names = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    late = table(spark, folder, "orders").select("o_custkey", *[F.when(late, F.col(n)).alias(n) for n in names])
    customers = table(spark, folder, "customer")
    return customers.join(late, customers.c_custkey == late.o_custkey, "left")


_LATE = """
    customer LEFT JOIN (
        SELECT o_custkey, CASE WHEN late THEN o_orderkey END AS o_orderkey, CASE WHEN late THEN o_totalprice END AS o_totalprice,
               CASE WHEN late THEN o_orderpriority END AS o_orderpriority
        FROM (SELECT *, o_orderdate >= DATE '2001-01-01' AS late FROM orders)
    ) ON c_custkey = o_custkey
"""


@query(
    "drop_any_null",
    f"""
    SELECT c_custkey, o_orderkey, o_totalprice FROM {_LATE}
    WHERE c_custkey IS NOT NULL AND o_orderkey IS NOT NULL AND o_totalprice IS NOT NULL
    """,
)
def drop_any_null(spark, folder):
    rows = _customers_with_late_orders(spark, folder).select("c_custkey", "o_orderkey", "o_totalprice")
    return col.drop_any_null(rows)


@query(
    "fill_null_default",
    f"""
    SELECT c_custkey, coalesce(o_orderkey, -1) AS o_orderkey, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority
    FROM {_LATE}
    """,
)
def fill_null_default(spark, folder):
    rows = _customers_with_late_orders(spark, folder).select("c_custkey", "o_orderkey", "o_orderpriority")
    return col.fill_null(rows, {"o_orderkey": -1, "o_orderpriority": "Unknown"})


@query(
    "fill_from_column",
    f"SELECT c_custkey, o_orderkey, coalesce(o_totalprice, c_acctbal) AS o_totalprice, c_acctbal FROM {_LATE}",
)
def fill_from_column(spark, folder):
    rows = _customers_with_late_orders(spark, folder).select("c_custkey", "o_orderkey", "o_totalprice", "c_acctbal")
    return col.fill_null_from(rows, {"o_totalprice": "c_acctbal"})


@query(
    "publication_shift",
    """
    SELECT event_id, CASE WHEN hour(ts) < 11 THEN ts + INTERVAL 1 DAY ELSE ts + INTERVAL 2 DAY END AS known_at
    FROM events
    """,
)
def publication_shift(spark, folder):
    return table(spark, folder, "events").select("event_id", cal.publication_shift(F.col("ts")).alias("known_at"))


@query(
    "day_shift",
    """
    SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY AS next_day, o_orderdate - INTERVAL 9 MONTH AS nine_months_before
    FROM orders
    """,
)
def day_shift(spark, folder):
    at = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", cal.shift_days(at, 1).alias("next_day"), cal.minus_months(at, 9).alias("nine_months_before")
    )


@query(
    "midpoint_ratio",
    """
    SELECT l_orderkey, l_linenumber, (l_discount + l_tax) / 2 AS middle,
           round(l_extendedprice / l_quantity, 8) AS price_per_unit,
           round(l_quantity / l_extendedprice, 9) AS units_per_price
    FROM lineitem
    """,
)
def midpoint_ratio(spark, folder):
    price, units = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        col.midpoint(F.col("l_discount"), F.col("l_tax")).alias("middle"),
        F.round(col.ratio(price, units), 8).alias("price_per_unit"),
        F.round(col.ratio(units, price), 9).alias("units_per_price"),
    )


@query(
    "map_default",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 'Interaction' WHEN 'view' THEN 'Interaction' WHEN 'purchase' THEN 'Sale'
                           ELSE 'Unknown' END AS kind,
           CASE user_id % 6 WHEN 0 THEN 'Combined' WHEN 1 THEN 'Fixed' WHEN 2 THEN 'General service' WHEN 3 THEN 'Spot'
                            ELSE 'Unknown' END AS product
    FROM events
    """,
)
def map_default(spark, folder):
    kinds = {"click": "Interaction", "view": "Interaction", "purchase": "Sale"}
    return table(spark, folder, "events").select(
        "event_id",
        col.map_values(F.col("event_type"), kinds, "Unknown").alias("kind"),
        col.product_name(F.col("user_id") % 6).alias("product"),
    )


@query(
    "lookup_default",
    """
    SELECT c_custkey, coalesce(r_name, 'Unknown') AS county FROM customer LEFT JOIN region ON c_nationkey = r_regionkey
    """,
)
def lookup_default(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("county"))
    return col.map_from_table(customers, "county", table(spark, folder, "region"), "r_regionkey", "r_name")


@query(
    "interval_filter",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 9 MONTH FROM orders)
      AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)
    """,
)
def interval_filter(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    start, end = splits.training_interval(orders, "o_orderdate", train_months=6, test_months=3)
    return splits.between_times(orders, start, end)


@query(
    "segment_filter",
    """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal >= 0
    """,
)
def segment_filter(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        "c_acctbal",
        (F.col("c_mktsegment") == "MACHINERY").cast("tinyint").alias("is_consumption"),
        (F.col("c_acctbal") >= 0).cast("tinyint").alias("is_business"),
    )
    return col.segment(customers, "consumer", is_business=True)


@query(
    "one_day",
    "SELECT event_id, ts, value FROM events WHERE ts::DATE = DATE '2024-01-17'",
)
def one_day(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return col.at_day(events, datetime.date(2024, 1, 17), "ts")


@query(
    "project_rename",
    """
    SELECT c_custkey AS client, c_name AS name, c_nationkey AS county, c_acctbal AS balance FROM customer
    """,
)
def project_rename(spark, folder):
    customers = table(spark, folder, "customer")
    kept = customers.select(col.columns_except(customers, {"c_comment"})).drop("c_mktsegment")
    return kept.withColumnsRenamed(
        {"c_custkey": "client", "c_name": "name", "c_nationkey": "county", "c_acctbal": "balance"}
    )


@query(
    "calendar_parts",
    """
    SELECT event_id, ts::DATE AS date, year(ts)::INTEGER AS year, month(ts)::TINYINT AS month, day(ts)::TINYINT AS day,
           isodow(ts)::TINYINT AS weekday, dayofyear(ts)::SMALLINT AS day_of_year, hour(ts)::TINYINT AS hour
    FROM events
    """,
)
def calendar_parts(spark, folder):
    return cal.add_calendar_parts(table(spark, folder, "events").select("event_id", "ts"), "ts").drop("ts")


@query("weekday_name", "SELECT o_orderkey, dayname(o_orderdate) AS weekday FROM orders")
def weekday_name(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", cal.weekday_name(F.col("o_orderdate")).alias("weekday")
    )


@query(
    "cyclic_features",
    """
    SELECT event_id,
           round(sin(2 * pi() * hour(ts) / 24), 5) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 5) AS hour_cos,
           round(sin(2 * pi() * isodow(ts) / 7), 5) AS weekday_sin,
           round(cos(2 * pi() * isodow(ts) / 7), 5) AS weekday_cos
    FROM events
    """,
)
def cyclic_features(spark, folder):
    at = F.col("ts")
    pairs = {"hour": cal.cyclic(F.hour(at), 24), "weekday": cal.cyclic(cal.iso_weekday(at), 7)}
    return table(spark, folder, "events").select("event_id", *_rounded_pairs(pairs))


@query(
    "half_cycle_doy",
    """
    SELECT o_orderkey, round(sin(pi() * d / n), 5) AS doy_sin, round(cos(pi() * d / n), 5) AS doy_cos
    FROM (SELECT o_orderkey, dayofyear(o_orderdate) AS d, dayofyear(make_date(year(o_orderdate), 12, 31)) AS n
          FROM orders)
    """,
)
def half_cycle_doy(spark, folder):
    at = F.col("o_orderdate")
    pairs = {"doy": cal.half_cycle_day_of_year(F.dayofyear(at), at)}
    return table(spark, folder, "orders").select("o_orderkey", *_rounded_pairs(pairs))


def _rounded_pairs(pairs):
    return [
        F.round(value.cast("double"), 5).alias(f"{name}_{part}")
        for name, pair in pairs.items()
        for part, value in zip(("sin", "cos"), pair)
    ]


# Easter Sundays as published, so that the check does not repeat the rule it checks.
_EASTER = "1995-04-16 1996-04-07 1997-03-30 1998-04-12 1999-04-04 2000-04-23 2001-04-15".split()
_HOLIDAYS = f"""
    SELECT make_date(y::INTEGER, m, d) AS holiday FROM range(1995, 2002) years(y),
    (VALUES (1, 1), (2, 24), (5, 1), (6, 23), (6, 24), (8, 20), (12, 24), (12, 25), (12, 26)) days(m, d)
    UNION ALL
    SELECT (e::DATE + o)::DATE FROM (VALUES {", ".join(f"('{e}')" for e in _EASTER)}) easter(e),
    (VALUES (-2), (0), (49)) offsets(o)
"""


@query(
    "holiday_flag",
    f"""
    SELECT o_orderkey, o_orderdate::DATE AS date, o_orderdate::DATE IN (SELECT holiday FROM ({_HOLIDAYS})) AS is_holiday
    FROM orders
    """,
)
def holiday_flag(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return orders.withColumn("is_holiday", cal.is_holiday(F.col("date"), cal.holidays(range(1995, 2002))))


@query(
    "time_features",
    """
    SELECT event_id, month(ts)::TINYINT AS month, year(ts)::INTEGER AS year,
           round(sin(2 * pi() * hour(ts) / 24), 5) AS "sin(hour)", round(cos(2 * pi() * hour(ts) / 24), 5) AS "cos(hour)",
           round(sin(2 * pi() * isodow(ts) / 7), 5) AS "sin(weekday)",
           round(cos(2 * pi() * isodow(ts) / 7), 5) AS "cos(weekday)",
           round(sin(2 * pi() * month(ts) / 12), 5) AS "sin(month)", round(cos(2 * pi() * month(ts) / 12), 5) AS "cos(month)",
           round(sin(pi() * dayofyear(ts) / 366), 5) AS "sin(day_of_year)",
           round(cos(pi() * dayofyear(ts) / 366), 5) AS "cos(day_of_year)",
           ts::DATE IN (DATE '2024-01-01') AS is_holiday
    FROM events
    """,
)
def time_features(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("ts").alias("datetime"))
    featured = cal.add_time_features(cal.add_calendar_parts(events)).drop("datetime", "date", "day")
    return featured.select(
        [
            F.round(col.quoted(c).cast("double"), 5).alias(c) if kind == "float" else col.quoted(c)
            for c, kind in featured.dtypes
        ]
    )


@query("json_props", "SELECT event_id, (props::JSON ->> 'k')::INTEGER AS k FROM events")
def json_props(spark, folder):
    parsed = F.from_json("props", "k int")
    return table(spark, folder, "events").select("event_id", parsed.k.alias("k"))


@query(
    "sql_rounding_cast",
    """
    SELECT l_orderkey, l_linenumber, round_even(l_extendedprice, 0)::INTEGER AS price,
           round_even(l_quantity / 2, 0)::INTEGER AS half_quantity
    FROM lineitem
    """,
)
def sql_rounding_cast(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        col.sql_round_to_int(F.col("l_extendedprice")).alias("price"),
        col.sql_round_to_int(F.col("l_quantity") / 2).alias("half_quantity"),
    )


@query(
    "noise_column",
    """
    SELECT count(*) AS rows, count(DISTINCT event_id) AS "values", true AS centred, true AS of_unit_spread,
           true AS equal_when_repeated
    FROM events
    """,
)
def noise_column(spark, folder):
    """Noise per event, in summary: a value for each key, mean near 0, deviation near 1, the same every time."""
    events = table(spark, folder, "events").select("event_id")
    twice = [col.add_noise(df, ["event_id"], seed=42) for df in (events, events.repartition(7))]
    both = twice[0].join(twice[1].withColumnRenamed("noise", "again"), "event_id")
    bound = 5 / F.sqrt(F.count("*"))
    return both.agg(
        F.count("*").alias("rows"),
        F.count_distinct("noise").alias("values"),
        (F.abs(F.avg("noise")) < bound).alias("centred"),
        (F.abs(F.stddev("noise") - 1) < bound).alias("of_unit_spread"),
        F.bool_and(F.col("noise") == F.col("again")).alias("equal_when_repeated"),
    )
