import datetime
import random

import pytest
from pyspark.sql import functions as F

from wattweave.operators import windows
from wattweave.operators.ordering import repeat_rows

GOLDEN = [
    ("A", "2024-01-01 00:00:00", 1.0, 1.0),
    ("A", "2024-01-01 12:00:00", 2.0, 1.5),
    ("A", "2024-01-02 00:00:00", 3.0, 3.3333),
    ("A", "2024-01-02 00:00:00", 5.0, 3.3333),
    ("A", "2024-01-02 11:59:59", 7.0, 4.25),
]


def series(spark, data):
    return spark.createDataFrame(data, "k string, s string, v double").select(
        "k", F.to_timestamp_ntz("s", F.lit("yyyy-MM-dd HH:mm:ss")).alias("t"), "v"
    )


@pytest.mark.parametrize("short", [False, True])
def test_half_open_frame_with_ties(spark, short):
    df = series(spark, [g[:3] for g in GOLDEN])
    means = windows.rolling_mean(df, ["k"], "t", ["v"], {"day": windows.DAY}, short_series=short)
    rows = repeat_rows(means, F.col("__copies")).orderBy("t").collect()
    assert [round(r.v_day, 4) for r in rows] == [g[3] for g in GOLDEN]


def test_plain_frames(spark):
    df = series(spark, [g[:3] for g in GOLDEN])
    rows = windows.rolling_mean_by_frame(df, ["k"], "t", ["v"], {"day": windows.DAY}).orderBy("t", "v").collect()
    assert [round(r.v_day, 4) for r in rows] == [g[3] for g in GOLDEN]


def random_series(spark, n, seed):
    rng = random.Random(seed)
    start = datetime.datetime(1969, 12, 20)  # buckets before 1970 have negative numbers
    data = []
    for _ in range(n):
        key = None if rng.random() < 0.1 else ("hot" if rng.random() < 0.5 else rng.choice("abc"))
        seconds = rng.choice([rng.randrange(0, 30 * 86_400), 3600 * rng.randrange(0, 720), 450 * rng.randrange(0, 5760)])
        v = None if rng.random() < 0.2 else float(rng.randrange(1000))
        data.append((key, start + datetime.timedelta(seconds=seconds), v, rng.randrange(10)))
    return spark.createDataFrame(data, "k string, t timestamp_ntz, v double, w int")


def brute_force(data, period):
    out = []
    for key, t, *_ in data:
        seen = [r for r in data if r[0] == key and t - period < r[1] <= t]
        out.append((str(key), t, _mean([r[2] for r in seen]), _mean([r[3] for r in seen])))
    return sorted(out, key=str)


def _mean(values):
    values = [x for x in values if x is not None]
    return round(sum(values) / len(values), 9) if values else None


@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_equals_brute_force(spark, short, seed):
    df = random_series(spark, 400, seed)
    data = [tuple(r) for r in df.collect()]
    periods = {"day": windows.DAY, "week": windows.WEEK}
    means = windows.rolling_mean(df, ["k"], "t", ["v", "w"], periods, short_series=short)
    rows = repeat_rows(means, F.col("__copies")).collect()
    for label, period in periods.items():
        got = [
            (str(r.k), r.t, None if r[f"v_{label}"] is None else round(r[f"v_{label}"], 9), round(r[f"w_{label}"], 9))
            for r in rows
        ]
        assert sorted(got, key=str) == brute_force(data, period)


def test_bucket_count_does_not_matter(spark):
    df = random_series(spark, 1500, 3)
    got = []
    for buckets in (2, 6, 96):
        means = windows.rolling_mean(df, ["k"], "t", ["w"], {"day": windows.DAY}, buckets_per_period=buckets)
        got.append(sorted(map(str, (tuple(r) for r in means.collect()))))
    assert got[0] == got[1] == got[2]
    with pytest.raises(ValueError):
        windows.rolling_mean(df, ["k"], "t", ["w"], {"x": datetime.timedelta(microseconds=7)}, buckets_per_period=2)


def test_infinite_values_stay_in_their_frame(spark):
    df = series(
        spark,
        [("A", "2024-01-01 00:00:00", float("inf")), ("A", "2024-01-01 01:00:00", 1.0), ("A", "2024-01-02 00:30:00", 3.0)],
    )
    means = windows.rolling_mean(df, ["k"], "t", ["v"], {"day": windows.DAY}).orderBy("t").collect()
    assert [r.v_day for r in means] == [float("inf"), float("inf"), 2.0]


def dense_series(n, seed):
    """Nine tenths of the points of a key within a second, half of these within two milliseconds."""
    rng = random.Random(seed)
    start = datetime.datetime(1969, 12, 30)
    data = []
    for i in range(n):
        if i % 10 == 0:
            micros = rng.randrange(0, 6 * 86_400_000_000)
        else:
            micros = 2 * 86_400_000_000 + 777_777 + rng.randrange(0, 2_000 if i % 2 else 1_000_000)
            micros += rng.choice([0, 0, 86_400_000_000])
        value = None if rng.random() < 0.1 else float(rng.randrange(1000))
        data.append((rng.choice(["hot", "hot", "hot", "cold", None]), start + datetime.timedelta(microseconds=micros), value, 1))
    return data


@pytest.mark.parametrize("limit", [5, 400])
def test_dense_buckets_equal_brute_force(spark, limit):
    data = dense_series(500, limit)
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v double, w int")
    periods = {"day": windows.DAY, "half": datetime.timedelta(hours=12)}
    means = windows.rolling_mean(df, ["k"], "t", ["v", "w"], periods, dense_rows=limit)
    rows = repeat_rows(means, F.col("__copies")).collect()
    for label, period in periods.items():
        got = [
            (str(r.k), r.t, None if r[f"v_{label}"] is None else round(r[f"v_{label}"], 9), round(r[f"w_{label}"], 9))
            for r in rows
        ]
        assert sorted(got, key=str) == brute_force(data, period)


def test_ties_do_not_make_a_bucket_dense(spark):
    """Rows are many, but points few: counted once more as points, no bucket is cut."""
    df = series(spark, [g[:3] for g in GOLDEN] * 30)
    rows = windows.rolling_mean(df, ["k"], "t", ["v"], {"day": windows.DAY}, dense_rows=10).orderBy("t").collect()
    assert [(r["__copies"], round(r.v_day, 4)) for r in rows] == [(30, 1.0), (30, 1.5), (60, 3.3333), (30, 4.25)]


def test_parts_of_dense_buckets_are_bounded(spark):
    widths = windows._widths(1_800_000_000)
    assert widths[0] == 1_800_000_000 and widths[-1] == 1 and len(widths) <= 12
    assert all(a % b == 0 and 1 < a // b <= windows.FANOUT for a, b in zip(widths, widths[1:]))
    assert windows._widths(34) == [34, 17, 1] and windows._widths(19) == [19, 1] and windows._widths(23 * 29) == [667, 29, 1]
    n, limit = 20_000, 500
    marks = spark.range(n).selectExpr(
        "'hot' AS __k0", "IF(id % 10 = 0, id * 1000000007L, 5000000000L + id) AS __at"
    )
    levels = windows._dense_nodes(marks, ["__k0"], widths, limit)
    leaves = windows._below(marks, ["__k0"], widths, levels).groupBy("__k0", "__depth", "__leaf").count()
    assert marks.groupBy(F.expr("__at DIV 1800000000")).count().agg(F.max("count")).first()[0] >= 0.9 * n
    assert leaves.agg(F.max("count")).first()[0] <= limit
    assert leaves.agg(F.sum("count")).first()[0] == n


def test_no_task_sees_a_whole_series(spark):
    """A hot key is spread over its time buckets: both full-size exchanges carry the bucket."""
    df = random_series(spark, 100, 4)
    plan = windows.rolling_mean(df, ["k"], "t", ["v"], {"day": windows.DAY})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_prior_year_month_mean(spark, rows):
    data = [(2021, 1, 10.0), (2022, 1, 20.0), (2022, 1, 40.0), (2023, 1, 5.0), (2022, 2, 7.0)]
    df = spark.createDataFrame(data, "year int, month int, v double").withColumn(
        "t", F.make_timestamp_ntz("year", "month", F.lit(3), F.lit(0), F.lit(0), F.lit(0))
    )
    means = windows.prior_year_month_mean(df, "t", ["v"])
    assert [(y, m, round(v, 4)) for y, m, v in rows(means, "year")] == [(2022, 1, 10.0), (2023, 1, 23.3333)]
    filled = windows.add_monthly_history(df.drop("t"), df, "t", ["v"]).orderBy("year", "month", "v")
    assert [round(r.v_monthly_historical, 4) for r in filled.collect()] == [10.0, 10.0, 10.0, 7.0, 23.3333]
