"""Time splits and month folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattweave.operators import splits
from wattweave.registry import query
from wattweave.sources.views import table


def _dated_orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))


@query(
    "time_split",
    """
    SELECT o_orderkey, o_orderdate::DATE AS date,
           CASE WHEN o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 3 MONTH THEN 'train' ELSE 'test' END
               AS split
    FROM orders
    """,
)
def time_split(spark, folder):
    return splits.time_split(_dated_orders(spark, folder), "date", test_months=3)


_FOLDS = """
    WITH periods AS (
        SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders
    ), folds AS (
        SELECT y, m, (y * 100 + m)::INTEGER AS fold_id, (make_date(y, m, 1) + INTERVAL 1 MONTH)::DATE AS cur FROM periods
    ), days AS (
        SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1
    ), used AS (
        SELECT fold_id, cur, 'train' AS role, d, n FROM folds JOIN days
        ON (d >= cur - INTERVAL {train} MONTH AND d < cur) OR (year(d) < y AND month(d) = m)
        UNION ALL
        SELECT fold_id, cur, 'test', d, n FROM folds JOIN days ON d >= cur AND d < cur + INTERVAL {test} MONTH
    )
"""
_COMPLETE = "fold_id IN (SELECT fold_id FROM used GROUP BY 1 HAVING count(DISTINCT role) = 2)"


@query(
    "month_folds",
    _FOLDS.format(train=3, test=1)
    + f"""
    SELECT fold_id, cur AS test_start, role, sum(n)::BIGINT AS rows FROM used WHERE {_COMPLETE} GROUP BY ALL
    """,
)
def month_folds(spark, folder):
    """Rows per fold and role, three months of training and one of test."""
    return splits.fold_sizes(_dated_orders(spark, folder), "date", train_months=3, test_months=1)


@query(
    "first_fold_rows",
    _FOLDS.format(train=15, test=6)
    + f""", first AS (SELECT min(fold_id) AS f FROM used WHERE {_COMPLETE})
    SELECT fold_id, cur AS test_start, role, o_orderkey, d AS date
    FROM used JOIN first ON fold_id = f JOIN orders ON o_orderdate::DATE = d
    """,
)
def first_fold_rows(spark, folder):
    """Rows of the first fold, fifteen months of training and six of test."""
    return splits.month_folds(_dated_orders(spark, folder), "date", train_months=15, test_months=6, max_folds=1)
