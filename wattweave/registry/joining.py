"""Joins, entity ids, lags, SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattweave.operators import aggregates, joins
from wattweave.registry import query
from wattweave.sources import views
from wattweave.sources.views import table


@query(
    "left_join_suffix",
    """
    SELECT o_custkey AS custkey, o_orderkey, o_totalprice AS amount, c_acctbal AS amount_client, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def left_join_suffix(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", F.col("o_totalprice").alias("amount")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"), "c_mktsegment"
    )
    return joins.suffix_join(orders, customers, ["custkey"], suffix="_client")


# Nations stand for weather stations, regions for counties, customers for readings. The
# last region has no stations, so its readings stay without a county.
@query(
    "round_join_key",
    """
    SELECT c_custkey, c_acctbal AS value, county, lo AS latitude_min, hi AS latitude_max, county_name
    FROM customer LEFT JOIN (
        SELECT n_nationkey, n_regionkey AS county, 'County ' || n_regionkey AS county_name,
               round(57 + min(n_nationkey) OVER (PARTITION BY n_regionkey) / 100, 2) AS lo,
               round(57 + max(n_nationkey) OVER (PARTITION BY n_regionkey) / 100, 2) AS hi
        FROM nation
    ) ON c_nationkey = n_nationkey AND county < 4
    """,
)
def round_join_key(spark, folder):
    """Readings at 32-bit coordinates matched to stations on hundredths of a degree."""

    def at(key):
        return {"latitude": (57 + F.col(key) / 100).cast("float"), "longitude": F.lit(21.7).cast("float")}

    stations = (
        table(spark, folder, "nation")
        .withColumns(at("n_nationkey"))
        # stations of the last region are elsewhere, so readings there match none
        .withColumn("latitude", F.expr("CAST(latitude + IF(n_regionkey = 4, 10, 0) AS FLOAT)"))
        .select("latitude", "longitude", F.col("n_regionkey").alias("county"))
        .withColumn("county_name", F.concat(F.lit("County "), F.col("county")))
    )
    boxed = joins.join_group_ranges(stations, "county", ["latitude", "longitude"])
    readings = table(spark, folder, "customer").withColumns(at("c_nationkey"))
    located = joins.locate_stations(
        readings.select("c_custkey", F.col("c_acctbal").alias("value"), "latitude", "longitude"), boxed
    )
    edges = {c: F.round(F.col(c).cast("double"), 2) for c in ("latitude_min", "latitude_max")}
    return located.withColumns(edges).drop("longitude_min", "longitude_max")


@query(
    "bbox_join_back",
    """
    SELECT s_suppkey, s_nationkey, s_acctbal, lo AS s_acctbal_min, hi AS s_acctbal_max
    FROM supplier JOIN (SELECT s_nationkey, min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier GROUP BY 1)
    USING (s_nationkey)
    """,
)
def bbox_join_back(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return joins.join_group_ranges(suppliers, "s_nationkey", ["s_acctbal"])


@query(
    "group_mean_first",
    """
    SELECT n_regionkey, round(avg(s_acctbal)::FLOAT::DOUBLE, 2) AS s_acctbal, min(r_name) AS r_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    GROUP BY n_regionkey
    """,
)
def group_mean_first(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    placed = joins.suffix_join(table(spark, folder, "supplier"), nations, ["s_nationkey"])
    named = joins.suffix_join(placed, regions, ["n_regionkey"])
    means = aggregates.group_mean(named, ["n_regionkey"], ["s_acctbal"], ["r_name"])
    return means.withColumn("s_acctbal", F.round(F.col("s_acctbal").cast("double"), 2))


@query(
    "two_key_enrichment",
    """
    SELECT a.event_id, a.event_type, a.slot, b.events, b.cents AS cents_measured
    FROM (SELECT event_id, event_type, date_trunc('hour', ts) AS slot FROM events) a
    LEFT JOIN (SELECT event_type, date_trunc('hour', ts) + INTERVAL 1 DAY AS slot, count(*) AS events,
                      sum(round(value * 100)::BIGINT)::DOUBLE / count(value) AS cents
               FROM events GROUP BY ALL) b
    ON a.event_type = b.event_type AND a.slot = b.slot
    """,
)
def two_key_enrichment(spark, folder):
    """Rows enriched with an hourly aggregate that became known a day later."""
    events = table(spark, folder, "events").withColumn("slot", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    hourly = events.groupBy("event_type", (F.col("slot") + F.expr("INTERVAL 1 DAY")).alias("slot")).agg(
        F.count(F.lit(1)).alias("events"), F.avg(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    )
    rows = events.select("event_id", "event_type", "slot", F.lit(None).cast("double").alias("cents"))
    joined = joins.suffix_join(rows, hourly, ["event_type", "slot"], suffix="_measured")
    return joined.drop("cents")


@query(
    "dense_entity_id",
    """
    SELECT (dense_rank() OVER (ORDER BY l_returnflag, l_linestatus, l_suppkey) - 1)::BIGINT AS client_id,
           l_returnflag, l_linestatus, l_suppkey, l_orderkey, l_linenumber
    FROM lineitem
    """,
)
def dense_entity_id(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_suppkey", "l_orderkey", "l_linenumber"
    )
    return joins.add_entity_id(rows, ["l_returnflag", "l_linestatus", "l_suppkey"])


_DAILY = """
    SELECT c_nationkey AS client_id, o_orderdate AS datetime, round(sum(o_totalprice), 2) AS target
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
"""


@query(
    "target_lags",
    f"WITH daily AS ({_DAILY}) SELECT d.*"
    + "".join(f", l{n}.target AS target_{n}_days_ago" for n in range(2, 8))
    + " FROM daily d"
    + "".join(
        f" LEFT JOIN daily l{n} ON l{n}.client_id = d.client_id AND l{n}.datetime + INTERVAL {n} DAY = d.datetime"
        for n in range(2, 8)
    ),
)
def target_lags(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    daily = (
        table(spark, folder, "orders")
        .join(customers, on="o_custkey")
        .groupBy(F.col("c_nationkey").alias("client_id"), F.col("o_orderdate").alias("datetime"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("target"))
    )
    return joins.add_target_lags(daily)


@query(
    "target_lags_repeats",
    """
    WITH read AS (
        SELECT (o_custkey // 40)::BIGINT AS client_id, o_orderdate AS datetime, round(o_totalprice / 100000) AS target FROM orders
    ) SELECT d.*"""
    + "".join(f", l{n}.target AS target_{n}_days_ago" for n in range(2, 8))
    + " FROM read d"
    + "".join(
        f" LEFT JOIN read l{n} ON l{n}.client_id = d.client_id AND l{n}.datetime + INTERVAL {n} DAY = d.datetime"
        for n in range(2, 8)
    ),
)
def target_lags_repeats(spark, folder):
    """Lags of groups of forty customers, with days missing and several orders, equal or not, on one day."""
    read = table(spark, folder, "orders").select(
        F.floor(F.col("o_custkey") / 40).alias("client_id"),
        F.col("o_orderdate").alias("datetime"),
        F.round(F.col("o_totalprice") / 100000).alias("target"),
    )
    return joins.add_target_lags_by_counts(read)


@query(
    "sql_left_join",
    """
    SELECT o_orderkey, year(o_orderdate)::SMALLINT AS year, dayname(o_orderdate) AS weekday, o_totalprice::FLOAT AS target,
           c_mktsegment, c_nationkey::TINYINT AS county
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def sql_left_join(spark, folder):
    return views.sql(
        spark,
        """
        SELECT o_orderkey, CAST(date_part('year', o_orderdate) AS SMALLINT) AS year,
               date_format(o_orderdate, 'EEEE') AS weekday, CAST(o_totalprice AS FLOAT) AS target,
               c_mktsegment, CAST(c_nationkey AS TINYINT) AS county
        FROM {train} LEFT JOIN {clients} ON o_custkey = c_custkey
        """,
        train=table(spark, folder, "orders"),
        clients=table(spark, folder, "customer"),
    )
