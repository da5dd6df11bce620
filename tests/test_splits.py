import datetime

import pytest
from pyspark.sql import functions as F

from wattweave.operators import splits

D = datetime.date


def dated(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "date date")


def test_training_interval_edges(spark, rows):
    times = [
        datetime.datetime(2022, 8, 31, 23), datetime.datetime(2022, 8, 31, 23, 0, 1), datetime.datetime(2023, 5, 31, 23),
    ]
    df = spark.createDataFrame([(t,) for t in times], "datetime timestamp_ntz")
    values = splits.interval_values(df)
    assert values == (datetime.datetime(2022, 8, 31, 23), datetime.datetime(2023, 5, 31, 23))
    for start, end in (values, splits.training_interval(df)):
        assert [r[0] for r in rows(splits.between_times(df, start, end), "datetime")] == times[1:]
        days = dated(spark, D(2022, 8, 31), D(2022, 9, 1), D(2023, 5, 31))
        assert [r[0] for r in rows(splits.between_times(days, start, end), "date")] == [D(2022, 9, 1), D(2023, 5, 31)]


def test_interval_reaches_the_scan(spark, tmp_path):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ'2024-01-01 00:00:00' + id * INTERVAL '1' DAY AS datetime FROM range(100)")
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    cut = splits.between_times(table, datetime.datetime(2024, 2, 1), datetime.datetime(2024, 2, 10))
    assert cut.count() == 9
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(datetime," in plan and "LessThanOrEqual(datetime," in plan


def test_no_date_column(spark):
    with pytest.raises(ValueError):
        splits.between_times(spark.range(1), D(2024, 1, 1), D(2024, 1, 2))


def test_time_split(spark, rows):
    df = dated(spark, D(2023, 2, 27), D(2023, 2, 28), D(2023, 5, 31))
    assert [r.split for r in splits.time_split(df).orderBy("date").collect()] == ["train", "test", "test"]


def brute_folds(days, train, test):
    def plus(y, m, n):
        k = y * 12 + m - 1 + n
        return D(k // 12, k % 12 + 1, 1)

    out = {}
    for y, m in sorted({(d.year, d.month) for d in days}):
        cur = plus(y, m, 1)
        tr = [d for d in days if plus(y, m, 1 - train) <= d < cur or (d.year < y and d.month == m)]
        te = [d for d in days if cur <= d < plus(y, m, 1 + test)]
        if tr and te:
            out[y * 100 + m] = (cur, sorted(tr), sorted(te))
    return out


@pytest.mark.parametrize("train,test", [(3, 1), (1, 2), (15, 6), (6, 3)])
def test_folds_equal_brute_force(spark, train, test):
    start = D(2019, 11, 3)
    days = [start + datetime.timedelta(days=17 * i) for i in range(80) if i % 11 not in (3, 4)]
    df = dated(spark, *days)
    rows = splits.month_folds(df, "date", train, test).collect()
    got = {}
    for r in rows:
        cur, tr, te = got.setdefault(r.fold_id, (r.test_start, [], []))
        (tr if r.role == "train" else te).append(r.date)
    assert {k: (c, sorted(a), sorted(b)) for k, (c, a, b) in got.items()} == brute_folds(days, train, test)
    sizes = {(r.fold_id, r.role): r.rows for r in splits.fold_sizes(df, "date", train, test).collect()}
    assert sizes == {(k, role): len(v) for k, (_, a, b) in got.items() for role, v in (("train", a), ("test", b))}


def test_fold_edges(spark):
    df = dated(spark, *[D(2021, m, 15) for m in (1, 2, 3, 4)])
    folds = {r.fold_id for r in splits.month_roles(df).collect()}
    assert folds == {202101, 202102, 202103}  # the last month has nothing to test on
    first = splits.month_folds(df, max_folds=1)
    assert {(r.fold_id, r.role, r.date) for r in first.collect()} == {
        (202101, "train", D(2021, 1, 15)), (202101, "test", D(2021, 2, 15)),
    }
    assert splits.month_roles(df).filter(F.col("test_start") <= F.lit(D(2021, 1, 31))).count() == 0
