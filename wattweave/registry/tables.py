"""Profiles, statistics, shares, orders of rows, unions, pending days, client ingest."""

from __future__ import annotations

import datetime
import posixpath
import uuid

from pyspark.sql import functions as F

from wattweave.functions.columns import whole_number
from wattweave.operators import aggregates
from wattweave.operators.ordering import top_rows as first_rows
from wattweave.registry import query
from wattweave.registry.column_queries import _LATE, _customers_with_late_orders
from wattweave.session import shared_dir
from wattweave.sources import sinks
from wattweave.sources.tables import read_csv
from wattweave.sources.views import table
from wattweave.streaming import compaction, ingest

_PROFILED = [("c_custkey", "bigint"), ("c_mktsegment", "string"), ("o_orderkey", "bigint"), ("o_totalprice", "double")]


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) AS rows, count({c}) AS non_null,
        count(*) - count({c}) AS nulls, count({c}) = 0 AS all_null FROM {_LATE}"""
        for c, kind in _PROFILED
    ),
)
def null_profile(spark, folder):
    return aggregates.table_profile(_customers_with_late_orders(spark, folder).select([c for c, _ in _PROFILED]))


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
        round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM lineitem"""
        for c in _DESCRIBED
    ),
)
def describe(spark, folder):
    summary = aggregates.describe(table(spark, folder, "lineitem"), _DESCRIBED)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    "correlation",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "left", '{b}' AS "right", round(corr({a}, {b}), 6) AS correlation FROM lineitem"""
        for a, b in [
            ("l_quantity", "l_extendedprice"),
            ("l_quantity", "l_discount"),
            ("l_extendedprice", "l_discount"),
        ]
    ),
)
def correlation(spark, folder):
    pairs = aggregates.correlations(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return pairs.withColumn("correlation", F.round("correlation", 6))


_BRANDS = "SELECT p_brand AS feature, sum(p_size)::BIGINT AS importance FROM part GROUP BY 1"


def _brands(spark, folder):
    return (
        table(spark, folder, "part")
        .groupBy(F.col("p_brand").alias("feature"))
        .agg(F.sum("p_size").alias("importance"))
    )


@query(
    "cumulative_share",
    f"""
    SELECT feature, importance,
           round(importance * 100.0::DOUBLE / sum(importance) OVER (), 6) AS importance_perc,
           round(sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) * 100.0::DOUBLE
                 / sum(importance) OVER (), 6) AS importance_perc_cumulative
    FROM ({_BRANDS})
    """,
)
def cumulative_share(spark, folder):
    shares = aggregates.cumulative_share(_brands(spark, folder), "feature", "importance")
    return shares.withColumns({c: F.round(c, 6) for c in ("importance_perc", "importance_perc_cumulative")})


@query(
    "noise_threshold",
    f"""
    SELECT feature, importance FROM ({_BRANDS})
    WHERE importance < (SELECT importance FROM ({_BRANDS}) WHERE feature = 'Brand#7')
    """,
)
def noise_threshold(spark, folder):
    return aggregates.below_reference(_brands(spark, folder), "feature", "importance", "Brand#7")


@query(
    "best_candidate",
    f"""
    SELECT arg_min(feature, importance * 1000 + length(feature)) AS feature,
           min(importance * 1000 + length(feature)) AS importance
    FROM ({_BRANDS})
    """,
)
def best_candidate(spark, folder):
    scored = _brands(spark, folder).withColumn("importance", F.col("importance") * 1000 + F.length("feature"))
    return aggregates.best_candidate(scored, "feature", "importance")


@query(
    "top_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return first_rows(orders, 100, F.desc("o_totalprice"), "o_orderkey")


@query(
    "union_runs",
    """
    SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier
    """,
)
def union_runs(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key")
    )
    return sinks.union_tables(customers, suppliers)


@query(
    "pending_days",
    """
    SELECT DISTINCT o_orderdate::DATE AS date FROM orders
    EXCEPT SELECT l_shipdate::DATE FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def pending_days(spark, folder):
    """Order days on which nothing returned was shipped."""
    wanted = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    shipped = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    return sinks.pending_days(wanted, shipped.select(F.col("l_shipdate").cast("date").alias("date")))


@query(
    "distinct_periods",
    """
    SELECT DISTINCT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day
    FROM orders
    """,
)
def distinct_periods(spark, folder):
    periods = aggregates.distinct_periods(table(spark, folder, "orders"), "o_orderdate")
    first = F.date_format(F.make_date("year", "month", F.lit(1)), "yyyy-MM-dd")
    return periods.withColumn("first_day", first)


def _messages(customers, *others):
    """Customers as client records in JSON, as they would arrive on a topic, and other columns beside them."""
    day = F.date_add(F.lit(datetime.date(2021, 9, 1)), F.pmod("c_custkey", F.lit(30)).cast("int"))
    return customers.select(
        F.to_json(
            F.struct(
                (F.col("c_custkey") % 6).alias("product_type"),
                F.col("c_nationkey").alias("county"),
                (F.col("c_custkey") % 500).alias("eic_count"),
                F.col("c_acctbal").alias("installed_capacity"),
                (F.col("c_mktsegment") == "MACHINERY").cast("int").alias("is_business"),
                day.cast("string").alias("date"),
                (F.col("c_custkey") % 30).alias("data_block_id"),
            )
        ).alias("value"),
        *others,
    )


_CLIENTS_SQL = """
    SELECT CASE c_custkey % 6 WHEN 0 THEN 'Combined' WHEN 1 THEN 'Fixed' WHEN 3 THEN 'Spot' ELSE 'General service' END
               AS product_type,
           coalesce(r_name, 'Unknown') AS county, (c_custkey % 500)::INTEGER AS eic_count,
           round(c_acctbal::FLOAT::DOUBLE, 2) AS installed_capacity, c_mktsegment = 'MACHINERY' AS is_business,
           (DATE '2021-09-01' + (c_custkey % 30)::INTEGER)::DATE AS date, (c_custkey % 30)::INTEGER AS data_block_id
    FROM customer LEFT JOIN region ON c_nationkey = r_regionkey
"""


def _counties(spark, folder):
    return table(spark, folder, "region").select(F.col("r_regionkey").alias("county"), F.col("r_name").alias("name"))


def _shown(clients):
    """Written client rows without the partition columns."""
    rounded = F.round(F.col("installed_capacity").cast("double"), 2)
    return clients.withColumn("installed_capacity", rounded).drop("year", "month", "day")


@query("client_normalise", _CLIENTS_SQL)
def client_normalise(spark, folder):
    """Batch form of the ingest: the same records, decoded and normalised."""
    return _shown(ingest.prepare_clients(_messages(table(spark, folder, "customer")), _counties(spark, folder)))


@query("client_ingest_stream", _CLIENTS_SQL)
def client_ingest_stream(spark, folder):
    """Stream the records to daily partitions, run twice, and read the table back."""
    base = posixpath.join(shared_dir(spark), f"clients-{uuid.uuid4().hex}")
    path, progress = posixpath.join(base, "table"), posixpath.join(base, "progress")
    schema = table(spark, folder, "customer").schema
    for _ in range(2):  # the second run finds nothing new
        arriving = _messages(spark.readStream.schema(schema).parquet(f"{folder}/customer.parque[t]"))
        ingest.stream_clients(arriving, _counties(spark, folder), path, progress).awaitTermination()
    return _shown(sinks.read_table(spark, path))


@query("client_ingest_by_day", _CLIENTS_SQL)
def client_ingest_by_day(spark, folder):
    """Stream the records in many batches, whose days overlap, run twice, and read the table back."""
    base = posixpath.join(shared_dir(spark), f"clients-{uuid.uuid4().hex}")
    inbox, path, progress = (posixpath.join(base, name) for name in ("inbox", "table", "progress"))
    messages = _messages(table(spark, folder, "customer"))
    messages.repartition(3).write.text(inbox)
    for _ in range(2):
        arriving = spark.readStream.option("maxFilesPerTrigger", 1).text(inbox)
        ingest.stream_clients_by_day(arriving, _counties(spark, folder), path, progress).awaitTermination()
    return _shown(sinks.read_table(spark, path)).drop("batch")


def _damaged(customers):
    """Client records of which a part are no client rows: cut off, without a day, with a bad one, too large, or null."""
    kind = F.pmod("c_custkey", F.lit(20))
    text = F.col("value")
    damaged = (
        F.when(kind == 3, F.substring(text, 1, 30))
        .when(kind == 7, F.regexp_replace(text, '"date":"[^"]*"', '"date":null'))
        .when(kind == 11, F.regexp_replace(text, '"date":"[^"]*"', '"date":"2021-13-45"'))
        .when(kind == 13, F.regexp_replace(text, '"eic_count":', '"eic_count":9000000000'))
        .when(kind == 17, F.lit(None))
        .otherwise(text)
    )
    return _messages(customers, "c_custkey").select(damaged.alias("value"))


@query(
    "client_ingest_rejected",
    f"""
    SELECT c_custkey % 20 IN (3, 7, 11, 13, 17) AS rejected,
           CASE c_custkey % 20 WHEN 3 THEN 'malformed' WHEN 7 THEN 'no date' WHEN 11 THEN 'bad date'
                WHEN 13 THEN 'out of range: eic_count' WHEN 17 THEN 'empty' END AS reason,
           CASE WHEN c_custkey % 20 IN (3, 7, 11, 13, 17) THEN NULL ELSE (c_custkey % 500)::INTEGER END AS eic_count,
           CASE WHEN c_custkey % 20 IN (3, 7, 11, 13, 17) THEN NULL
                ELSE (DATE '2021-09-01' + (c_custkey % 30)::INTEGER)::DATE END AS date
    FROM customer
    """,
)
def client_ingest_rejected(spark, folder):
    """Stream records of which a quarter are bad, in many batches, run twice; rows of both tables that come out."""
    base = posixpath.join(shared_dir(spark), f"clients-{uuid.uuid4().hex}")
    inbox, path, rejects, progress = (posixpath.join(base, name) for name in ("inbox", "table", "rejects", "progress"))
    _damaged(table(spark, folder, "customer")).repartition(3).write.parquet(inbox)
    for _ in range(2):
        arriving = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(inbox)
        ingest.stream_clients_with_rejects(arriving, _counties(spark, folder), path, rejects, progress).awaitTermination()
    good = sinks.read_table(spark, path).select(F.lit(False).alias("rejected"), "eic_count", "date")
    bad = sinks.read_table(spark, rejects).select(F.lit(True).alias("rejected"), "reason")
    return good.unionByName(bad, allowMissingColumns=True)


@query("client_ingest_compacted", _CLIENTS_SQL)
def client_ingest_compacted(spark, folder):
    """Stream the records in batches, merge the small files between two of them and at the end, and read the table."""
    base = posixpath.join(shared_dir(spark), f"clients-{uuid.uuid4().hex}")
    inbox, progress = posixpath.join(base, "inbox"), posixpath.join(base, "progress")
    customers = table(spark, folder, "customer")
    for half in (0, 1):
        messages = _messages(customers.filter(F.pmod(F.xxhash64("c_custkey"), F.lit(2)) == half))
        messages.repartition(3).write.mode("append").text(inbox)
        arriving = spark.readStream.option("maxFilesPerTrigger", 1).text(inbox)
        run = ingest.stream_clients_by_day(arriving, _counties(spark, folder), compaction.arrived_path(base), progress)
        run.awaitTermination()
        compaction.compact(spark, base, progress)
    compaction.remove_replaced(spark, base)
    return _shown(compaction.read_compacted(spark, base))


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def csv_roundtrip(spark, folder):
    """Customers written as CSV in two column orders and read back by name."""
    base = posixpath.join(shared_dir(spark), f"csv-{uuid.uuid4().hex}")
    names = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    customers = table(spark, folder, "customer").select(names)
    parts = [customers.filter("c_custkey % 2 = 0"), customers.filter("c_custkey % 2 = 1").select(names[::-1])]
    read = []
    for i, part in enumerate(parts):
        part.write.option("header", True).csv(posixpath.join(base, str(i)))
        read.append(read_csv(spark, posixpath.join(base, str(i))))
    kinds = dict(customers.dtypes)
    return sinks.union_tables(*read).select(
        [whole_number(F.col(n), kinds[n]).alias(n) if kinds[n] in ("int", "bigint") else F.col(n) for n in names]
    )


@query(
    "run_partitions",
    """
    SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
           day(o_orderdate)::INTEGER AS day, run_date
    FROM orders, (VALUES (DATE '2024-01-31'), (DATE '2024-02-01')) runs(run_date)
    """,
)
def run_partitions(spark, folder):
    """A table with date columns of its own, written by two runs and read as one data set."""
    base = posixpath.join(shared_dir(spark), f"runs-{uuid.uuid4().hex}")
    orders = sinks.with_day_parts(table(spark, folder, "orders"), "o_orderdate").select("o_orderkey", *sinks.DAY_PARTS)
    for day in (datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)):
        sinks.write_run(orders, base, day)
    return sinks.read_table(spark, base)


@query(
    "daily_backfill",
    """
    SELECT d::DATE AS date, count(o_orderkey) AS rows
    FROM range(TIMESTAMP '1998-02-01', TIMESTAMP '1998-03-13', INTERVAL 1 DAY) days(d)
    LEFT JOIN orders ON o_orderdate = d
    GROUP BY d HAVING d < TIMESTAMP '1998-02-20' OR d > TIMESTAMP '1998-02-25' OR count(o_orderkey) = 0
    """,
)
def daily_backfill(spark, folder):
    """Days of an interval that have no partition yet, with the rows each of them got."""
    path = posixpath.join(shared_dir(spark), f"orders-{uuid.uuid4().hex}")
    orders = table(spark, folder, "orders").withColumn("date", F.col("o_orderdate").cast("date")).drop("o_orderdate")
    sinks.write_daily(orders.filter("date BETWEEN '1998-02-20' AND '1998-02-25'"), path)
    return sinks.backfill_daily(orders, path, datetime.date(1998, 2, 1), datetime.date(1998, 3, 12))
