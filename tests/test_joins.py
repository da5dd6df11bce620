import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from wattweave.operators import joins, ordering


def test_suffix_join(spark):
    left = spark.sql("SELECT 1 AS k, 5.0D AS temperature")
    right = spark.sql("SELECT 1 AS k, 6.0D AS temperature, 24 AS hours_ahead")
    joined = joins.suffix_join(left, right, ["k"], suffix="_forecast")
    assert joined.columns == ["k", "temperature", "temperature_forecast", "hours_ahead"]
    assert tuple(joined.first()) == (1, 5.0, 6.0, 24)
    with pytest.raises(ValueError):
        joins.suffix_join(left.withColumn("temperature_forecast", F.lit(1)), right, ["k"], suffix="_forecast")
    with pytest.raises(ValueError):
        joins.suffix_join(left, right, ["k"], how="outer")


def test_null_keys_never_match(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    right = spark.createDataFrame([(None, 10), (2, 20)], "k int, b int")
    assert {(r.a, r.b) for r in joins.suffix_join(left, right, ["k"]).collect()} == {(1, None), (2, 20)}


def test_dense_ids(spark, rows):
    keys = ["county", "is_business", "product_type", "is_consumption"]
    df = spark.createDataFrame(
        [(0, 0, 1, 0), (0, 0, 1, 0), (0, 1, 1, 0), (2, 0, 3, 1), (2, None, 3, 1)], ", ".join(f"{k} int" for k in keys)
    )
    got = joins.add_entity_id(df, keys)
    assert got.columns[0] == "client_id" and dict(got.dtypes)["client_id"] == "bigint"
    ids = [r.client_id for r in got.orderBy(*keys).collect()]
    assert ids == [0, 0, 1, 3] or ids == [0, 0, 1, 2]  # the null key takes the place its order gives it


@pytest.mark.parametrize("ranges", [1, 16, None])
def test_row_numbers_and_totals_over_ranges(spark, ranges):
    df = spark.range(5000).select(
        F.pmod(F.xxhash64("id"), F.lit(7)).alias("a"), (5000 - F.col("id")).alias("b"), (F.col("id") % 3).alias("v")
    )
    expected = sorted((r.a, r.b, r.v) for r in df.collect())
    numbered = ordering.number_rows(df, ["a", "b"], "n", ranges=ranges).orderBy("n").collect()
    assert [(r.a, r.b, r.v) for r in numbered] == expected and [r.n for r in numbered] == list(range(5000))
    totals = ordering.running_total(
        df, ["a", "b"], "v", "total", descending=("a",), ranges=ranges
    ).collect()
    total, running = 0, {}
    for a, b, v in sorted(expected, key=lambda r: (-r[0], r[1])):
        total += v
        running[a, b] = total
    assert {(r.a, r.b): r.total for r in totals} == running


def test_stations(spark, rows):
    stations = spark.createDataFrame(
        [(57.6, 21.7, 1, "A"), (57.6, 21.8, -1, "Unknown")], "latitude float, longitude float, county int, county_name string"
    )
    boxed = joins.join_group_ranges(stations, "county", ["latitude", "longitude"])
    readings = spark.createDataFrame([(57.6, 21.7, 1), (57.6, 21.8, 2), (57.6, 21.9, 3)], "latitude float, longitude float, v int")
    got = joins.locate_stations(readings, boxed).orderBy("v").collect()
    assert [r.county for r in got] == [1, -1, None] and "latitude" not in got[0].asDict()
    twice = joins.locate_stations(readings, boxed.union(boxed))
    assert twice.count() == 5  # a station listed twice doubles its readings


def daily(spark, data):
    return spark.createDataFrame(
        [(c, None if d is None else datetime.datetime(2024, 1, d), v) for c, d, v in data],
        "client_id int, datetime timestamp_ntz, target float",
    )


BASE = [(1, 1, 10.0), (1, 2, 20.0), (1, 3, 30.0), (2, 3, 99.0), (None, 3, 1.0), (None, 1, 2.0), (3, None, 5.0), (1, 9, None)]


def test_target_lags(spark):
    got = joins.add_target_lags(daily(spark, BASE))
    third = got.filter("client_id = 1 AND day(datetime) = 3").first()
    assert third.target_2_days_ago == 10.0 and third.target_3_days_ago is None
    others = got.filter("NOT (client_id = 1 AND day(datetime) IN (3, 9)) OR client_id IS NULL OR datetime IS NULL")
    assert all(r.target_2_days_ago is None for r in others.collect())
    assert got.filter("day(datetime) = 9").first().target_7_days_ago == 20.0
    assert got.columns == daily(spark, BASE).columns + [f"target_{d}_days_ago" for d in range(2, 8)]


def test_target_lags_equal_joins(spark):
    hours = spark.range(3000).select(
        (F.col("id") % 5).cast("int").alias("client_id"),
        (F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")) + F.make_dt_interval(F.lit(0), (F.col("id") / 5).cast("int"))).alias("datetime"),
        F.col("id").cast("double").alias("target"),
    ).filter("pmod(xxhash64(target), 4) != 0")
    one, many = joins.add_target_lags(hours), joins.add_target_lags_by_join(hours)
    assert one.columns == many.select(one.columns).columns
    assert one.exceptAll(many.select(one.columns)).count() == 0 and one.count() == many.count() == hours.count()


def test_repeated_rows_multiply_as_joins_do(spark):
    fanned = daily(spark, [(1, 1, 10.0)] * 3 + [(1, 3, 30.0)] * 2 + [(1, 4, None)] * 2 + [(1, 6, 1.0)])
    one, many = joins.add_target_lags(fanned), joins.add_target_lags_by_join(fanned)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.select(one.columns).collect()))


def test_different_values_for_one_time_raise(spark):
    clash = daily(spark, [(1, 1, 10.0), (1, 1, 11.0)])
    with pytest.raises(SparkRuntimeException, match="different values"):
        joins.add_target_lags(clash).collect()
    assert joins.add_target_lags_by_join(clash).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_lags_by_counts_equal_joins_on_gappy_and_repeated_targets(spark, seed):
    rows = spark.range(700).select(
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(4))).cast("int").alias("client_id"),
        F.when(
            F.col("id") % 60 != 1,
            F.to_timestamp_ntz(F.lit("2024-03-01 06:00:00"))
            + F.make_dt_interval(F.pmod(F.xxhash64("id", F.lit(seed + 10)), F.lit(150)).cast("int"), (F.col("id") % 2 * 6).cast("int")),
        ).alias("datetime"),
        F.when(F.col("id") % 9 != 0, F.pmod(F.xxhash64("id", F.lit(seed + 20)), F.lit(3))).cast("float").alias("target"),
        F.col("id").alias("sin(hour)"),
    )
    one, many = joins.add_target_lags_by_counts(rows), joins.add_target_lags_by_join(rows)
    many = many.select(one.columns)
    assert one.columns == [*rows.columns, *[f"target_{d}_days_ago" for d in range(2, 8)]]
    assert one.count() == many.count() > 700
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_lags_by_counts_take_one_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = daily(spark, [*BASE, (1, 3, 30.0), (1, 1, 11.0)])
        plan = joins.add_target_lags_by_counts(rows)._jdf.queryExecution().executedPlan().toString()
        many = joins.add_target_lags_by_join(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and many.count("SortMergeJoin") == 6


def test_hot_join_key_is_split(spark):
    """A third of the rows on one key: AQE splits that key's partition and the result is whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(60_000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text")
        )
        right = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = joins.suffix_join(left, right, ["k"])
        assert joined.filter("v = 2 * k").count() == 60_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert len(rows) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
