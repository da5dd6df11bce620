import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattweave.operators import aggregates


def test_group_mean_skips_nulls_and_keeps_null_groups(spark, rows):
    df = spark.createDataFrame(
        [(1, 1.0, "A"), (1, None, "A"), (None, 4.0, None), (2, None, "B")], "county int, v double, name string"
    )
    got = aggregates.group_mean(df, ["county"], ["v"], ["name"])
    assert rows(got, "county") == [(None, 4.0, None), (1, 1.0, "A"), (2, None, "B")]
    assert dict(got.dtypes)["v"] == "float"


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None)], "`sin(a)` int, b string")
    assert rows(aggregates.table_profile(df), "column") == [
        ("b", "string", 2, 0, 2, True), ("sin(a)", "int", 2, 1, 1, False),
    ]
    assert spark.range(1).select(aggregates.has_null_column(df)).first()[0] is True
    assert spark.range(1).select(aggregates.has_null_column(df.select("`sin(a)`"))).first()[0] is False


@pytest.mark.parametrize("ranges", [1, 8])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_describe_is_exact(spark, accuracy, ranges):
    rng = random.Random(5)
    data = [
        (rng.gauss(0, 1), rng.choice([1, 1, 1, 2, 9]), None if rng.random() < 0.3 else rng.randrange(10**6), None)
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "x double, `a b` int, n bigint, empty double")
    got = {r["column"]: r for r in aggregates.describe(df, accuracy=accuracy, ranges=ranges).collect()}
    want = pd.DataFrame(data, columns=["x", "a b", "n", "empty"]).astype(float).describe()
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}
    for column in ("x", "a b", "n"):
        for mine, theirs in names.items():
            assert got[column][mine] == pytest.approx(want[column][theirs], rel=1e-12), (column, mine)
    assert got["empty"]["count"] == 0 and got["empty"]["p50"] is None


@pytest.mark.parametrize("wrong", [(-90.0, -80.0), (95.0, 99.0), (1e6, 1e6), (-1e6, -1e6), (20.0, 20.5), (50.0, 50.2)])
def test_quantiles_from_a_wrong_interval(spark, monkeypatch, wrong):
    """The first interval lies anywhere but around the quantile, or holds one of the two ranks."""
    data = [float(v) for v in range(-100, 101)] + [50.0] * 7
    df = spark.createDataFrame([(v,) for v in data], "x double").repartition(5)
    sketch, asked = aggregates._sketch, []

    def first_wrong(df, slices, accuracy):
        asked.append(len(slices))
        return [wrong] * len(slices) if len(asked) == 1 else sketch(df, slices, accuracy)

    monkeypatch.setattr(aggregates, "_sketch", first_wrong)
    got = aggregates.describe(df, quantiles=(0.0, 0.1, 0.5, 0.77, 1.0)).first()
    want = pd.Series(data).quantile([0.0, 0.1, 0.5, 0.77, 1.0]).tolist()
    assert [got[n] for n in ("p0", "p10", "p50", "p77", "p100")] == pytest.approx(want, rel=1e-12)
    assert len(asked) > 1


def test_correlation_ignores_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    assert aggregates.correlations(df, ["a", "b"]).first().correlation == pytest.approx(1)


@pytest.mark.parametrize("ranges", [None, 1])
def test_cumulative_share_and_noise(spark, rows, ranges):
    df = spark.createDataFrame([("a", 1.0), ("noise", 2.0), ("c", 5.0), ("b", 2.0)], "feature string, importance double")
    shares = aggregates.cumulative_share(df, "feature", "importance", ranges=ranges)
    got = [(r.feature, r.importance_perc, r.importance_perc_cumulative) for r in shares.orderBy("importance_perc_cumulative").collect()]
    assert got == [("c", 50.0, 50.0), ("b", 20.0, 70.0), ("noise", 20.0, 90.0), ("a", 10.0, 100.0)]
    assert [r.feature for r in aggregates.below_reference(df, "feature", "importance").collect()] == ["a"]
    assert aggregates.best_candidate(df, "feature", "importance").first().feature == "a"


def test_mean_absolute_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 0.0)], "target float, prediction double")
    assert df.agg(aggregates.mean_absolute_error("target", "prediction")).first()[0] == 2.0


def test_latest_is_a_subquery(spark):
    df = spark.range(5)
    assert df.filter(F.col("id") == aggregates.latest(df, "id")).first().id == 4
