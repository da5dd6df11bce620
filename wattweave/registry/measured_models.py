"""Model frames and errors compared by value, on the daily sales of each nation, which follow the quantity sold."""

from __future__ import annotations

import datetime
import posixpath
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.functions.columns import add_noise
from wattweave.operators.aggregates import mean_absolute_error
from wattweave.plans import models
from wattweave.registry import query
from wattweave.session import durable, shared_dir
from wattweave.sources.views import table

# means of cents may lie half-way between two rounded values, where the order of a sum would decide
_OFF_TIES = 3e-7

_DAILY = """
    WITH daily AS (
        SELECT c_nationkey AS nation, o_orderdate::DATE AS date, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents,
               sum(l_quantity)::BIGINT AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    ), marked AS (
        SELECT *, cents / 100.0::DOUBLE AS target, date >= (SELECT max(date) FROM daily) - INTERVAL 3 MONTH AS is_test FROM daily
    )
"""
_MEANS = """, means AS (SELECT nation, avg(target) AS prediction FROM marked WHERE NOT is_test GROUP BY 1)"""


def _daily(spark, folder) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").join(orders, on="l_orderkey").join(customers, on="o_custkey")
    daily = lines.groupBy("nation", F.col("o_orderdate").cast("date").alias("date"))
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    return daily.agg((cents / 100).alias("target"), F.sum("l_quantity").cast("bigint").alias("quantity"))


def _mean_errors(frame: DataFrame) -> DataFrame:
    """Test rows of each nation and the error of its mean over the training rows."""
    means = frame.filter(~F.col(models.IS_TEST)).groupBy("nation").agg(F.avg("target").alias("prediction"))
    tested = frame.filter(models.IS_TEST).join(means, on="nation")
    return tested.groupBy("nation").agg(
        F.count(F.lit(1)).alias("test_rows"), mean_absolute_error("target", "prediction").alias("mae")
    )


@query("model_frame_rows", _DAILY + "SELECT nation, quantity, round(target, 2) AS target, is_test FROM marked")
def model_frame_rows(spark, folder):
    """Features, label and test mark of every row, the last three months being the test."""
    return models.model_frame(_daily(spark, folder)).withColumn("target", F.round("target", 2))


@query(
    "mean_errors",
    _DAILY
    + _MEANS
    + """
    SELECT nation, count(*) AS test_rows, round(avg(abs(target - prediction)) + 3e-7::DOUBLE, 4) AS mae
    FROM marked JOIN means USING (nation) WHERE is_test GROUP BY 1
    """,
)
def mean_errors(spark, folder):
    """Mean absolute error of the plainest prediction, by nation."""
    return _mean_errors(models.model_frame(_daily(spark, folder))).withColumn("mae", F.round(F.col("mae") + _OFF_TIES, 4))


@query(
    "model_against_mean",
    _DAILY
    + _MEANS
    + """
    SELECT count(*) AS test_rows, round(avg(abs(target - prediction)) + 3e-7::DOUBLE, 2) AS mean_mae, true AS model_below_mean,
           true AS best_not_above_start, true AS curve_ends_with_model
    FROM marked JOIN means USING (nation) WHERE is_test
    """,
)
def model_against_mean(spark, folder):
    """Boosted trees of the library's default number of rounds against that prediction.

    The model's error must be below the mean's; it must be that of the curve's best round, which is not above the first.
    """
    frame = durable(models.model_frame(_daily(spark, folder)))
    model, curve = models.fit_with_curve(frame)
    error, best = models.test_error(model, frame), min(valid for _, _, valid in curve)
    start = curve[0][2]
    summary = _mean_errors(frame).agg(
        F.sum("test_rows").alias("test_rows"), (F.sum(F.col("mae") * F.col("test_rows")) / F.sum("test_rows")).alias("mean_mae")
    )
    return summary.select(
        "test_rows",
        F.round(F.col("mean_mae") + _OFF_TIES, 2).alias("mean_mae"),
        (F.lit(error) < F.col("mean_mae")).alias("model_below_mean"),
        F.lit(best <= start).alias("best_not_above_start"),
        F.lit(abs(error - best) <= 1e-6 * best).alias("curve_ends_with_model"),
    )


# --- segments, curves, importances and candidates of the library's default number of rounds ---
_SEGMENTED = f"""{_DAILY}, sided AS (
        SELECT *, CASE WHEN nation % 2 = 1 THEN 'consumer' ELSE 'producer' END AS model_type, nation // 2 % 2 = 1 AS is_business
        FROM marked
    ), segmented AS (
        SELECT * EXCLUDE (is_test), date >= max(date) OVER (PARTITION BY model_type, is_business) - INTERVAL 3 MONTH AS is_test
        FROM sided
    ), segment_means AS (
        SELECT model_type, is_business, avg(target) AS prediction FROM segmented WHERE NOT is_test GROUP BY ALL
    )
"""
_ALL_MEANS = """, whole AS (SELECT avg(target) AS prediction FROM marked WHERE NOT is_test)"""


def _mean_error(frame: DataFrame, rows: Column) -> Column:
    """Error on ``rows`` of the mean over the training rows, as a scalar subquery."""
    mean = frame.filter(~F.col(models.IS_TEST)).agg(F.avg("target")).scalar()
    return frame.filter(rows).agg(F.avg(F.abs(F.col("target") - mean))).scalar()


@query(
    "segment_errors",
    _SEGMENTED
    + """
    SELECT model_type, is_business, count(*) AS test_rows, round(avg(abs(target - prediction)) + 3e-7::DOUBLE, 2) AS mean_mae,
           true AS model_below_mean, true AS batch_agrees
    FROM segmented JOIN segment_means USING (model_type, is_business) WHERE is_test GROUP BY ALL
    """,
)
def segment_errors(spark, folder):
    """A model for each segment of nations against the segment's mean, and again after saving, loading and batch scoring.

    The error of a model must be below the mean's, and that of the predictions of the loaded model the same.
    """
    sides = {
        "client_id": F.col("nation"),
        "datetime": F.col("date").cast("timestamp_ntz"),
        "is_consumption": F.col("nation") % 2,
        "is_business": F.floor(F.col("nation") / 2) % 2,
    }
    daily = durable(_daily(spark, folder).withColumns(sides))
    fitted = models.train_segments(daily)
    base, day = posixpath.join(shared_dir(spark), f"models-{uuid.uuid4().hex}"), datetime.date(2024, 1, 31)
    models.save_segments(fitted, base, day)

    keys = ["model_type", "is_business"]
    kind = F.when(F.col("is_consumption") == 1, "consumer").otherwise("producer")
    rows = daily.select("client_id", "datetime", "date", "target", kind.alias("model_type"), (F.col("is_business") == 1).alias("is_business"))
    rows = rows.join(rows.groupBy(keys).agg(F.add_months(F.max("date"), -3).alias("test_start")), on=keys)
    means = rows.filter("date < test_start").groupBy(keys).agg(F.avg("target").alias("mean"))
    scored = models.score_segments(daily, base, day)
    tested = rows.filter("date >= test_start").join(means, on=keys).join(scored, on=[*keys, "client_id", "datetime"])
    plain = tested.groupBy(keys).agg(
        mean_absolute_error("target", "mean").alias("mean_mae"), mean_absolute_error("target", models.PREDICTION).alias("batch_mae")
    )
    both = models.segment_scores(daily, fitted).join(plain, on=keys)
    return both.select(
        *keys,
        "test_rows",
        F.round(F.col("mean_mae") + _OFF_TIES, 2).alias("mean_mae"),
        (F.col("mae") < F.col("mean_mae")).alias("model_below_mean"),
        (F.abs(F.col("mae") - F.col("batch_mae")) <= 1e-6 * F.col("mae")).alias("batch_agrees"),
    )


@query(
    "curve_against_mean",
    _DAILY
    + _ALL_MEANS
    + """
    SELECT iteration::INTEGER AS iteration, train_mae, valid_mae, true AS train_below_mean, true AS valid_below_mean
    FROM range(1, 101) rounds(iteration), (
        SELECT round(avg(abs(target - prediction)) FILTER (NOT is_test) + 3e-7::DOUBLE, 2) AS train_mae,
               round(avg(abs(target - prediction)) FILTER (is_test) + 3e-7::DOUBLE, 2) AS valid_mae
        FROM marked, whole
    )
    """,
)
def curve_against_mean(spark, folder):
    """Every round of the learning curve beside the errors of the mean, which all must stay below."""
    frame = durable(models.model_frame(_daily(spark, folder)))
    train, valid = _mean_error(frame, ~F.col(models.IS_TEST)), _mean_error(frame, F.col(models.IS_TEST))
    return models.learning_curve(frame).select(
        "iteration",
        F.round(train + _OFF_TIES, 2).alias("train_mae"),
        F.round(valid + _OFF_TIES, 2).alias("valid_mae"),
        (F.col("train") < train).alias("train_below_mean"),
        (F.col("valid") < valid).alias("valid_below_mean"),
    )


@query(
    "importance_against_correlation",
    _DAILY
    + """
    SELECT CASE WHEN abs(corr(quantity, target)) > abs(corr(nation, target)) THEN 'quantity' ELSE 'nation' END AS best_feature,
           true AS best_beats_noise, true AS sums_to_100
    FROM marked WHERE NOT is_test
    """,
)
def importance_against_correlation(spark, folder):
    """The most important feature is the one most correlated with the label, and matters more than noise."""
    frame = durable(models.model_frame(add_noise(_daily(spark, folder), ["nation", "date"])))
    ranked = models.feature_importances(spark, models.fit(frame), frame)
    noise = ranked.filter("feature = 'noise'").agg(F.max("importance")).scalar()
    return ranked.agg(
        F.max_by("feature", "importance").alias("best_feature"),
        (F.max("importance") > noise).alias("best_beats_noise"),
        (F.abs(F.sum("importance_perc") - 100) < 1e-6).alias("sums_to_100"),
    )


@query(
    "candidate_errors",
    _DAILY
    + _ALL_MEANS
    + """
    SELECT candidate, objective, mean_mae, true AS below_mean
    FROM (VALUES ('shallow', 'l2'), ('deep', 'l2'), ('poisson', 'poisson')) candidates(candidate, objective),
         (SELECT round(avg(abs(target - prediction)) + 3e-7::DOUBLE, 2) AS mean_mae FROM marked, whole WHERE is_test)
    """,
)
def candidate_errors(spark, folder):
    """Two tree depths and a Poisson model against the mean of the training rows."""
    frame = durable(models.model_frame(_daily(spark, folder)))
    candidates = {
        "shallow": models.Parameters(options={"maxDepth": 2}),
        "deep": models.Parameters(options={"maxDepth": 4}),
        "poisson": models.Parameters("poisson"),
    }
    error = _mean_error(frame, F.col(models.IS_TEST))
    scores = models.candidate_scores(frame, candidates)
    return scores.select(
        "candidate", "objective", F.round(error + _OFF_TIES, 2).alias("mean_mae"), (F.col("mae") < error).alias("below_mean")
    )
