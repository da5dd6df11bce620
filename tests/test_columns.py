import datetime
import math

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from wattweave.functions import columns as col


def test_narrowing_keeps_other_types(spark):
    df = spark.sql("SELECT 1L AS a, 2 AS b, 1.5D AS c, CAST(1 AS FLOAT) AS d, 'x' AS e")
    assert [t for _, t in col.narrow_to_32_bits(df).dtypes] == ["int", "int", "float", "float", "string"]
    assert [t for _, t in col.narrow_to_16_bits(df).dtypes] == ["smallint", "smallint", "double", "float", "string"]


def test_strict_casts_raise(spark):
    with pytest.raises(ArithmeticException):
        col.cast_columns(spark.sql("SELECT id + 300 AS a FROM range(1)"), {"a": "tinyint"}).collect()


def test_parse_date_and_datetime(spark):
    df = spark.createDataFrame([("2022-01-01", "2022-01-01 10:30:00")], "d string, t string")
    assert col.parse_date(df, "d").first().d == datetime.date(2022, 1, 1)
    parsed = col.parse_datetime(df, ["t"])
    assert dict(parsed.dtypes)["t"] == "timestamp_ntz"
    assert parsed.first().t == datetime.datetime(2022, 1, 1, 10, 30)
    with pytest.raises(TypeError):
        col.parse_date(df, ("d",))


def test_parse_zoned_datetime(spark):
    df = spark.createDataFrame([("2022-07-01 12:00:00",), ("2022-01-01 12:00:00",)], "t string")
    zoned = col.parse_zoned_datetime(df, "t", "yyyy-MM-dd HH:mm:ss", "Europe/Tallinn")
    assert dict(zoned.dtypes)["t"] == "timestamp"
    micros = [r[0] for r in zoned.select(F.unix_micros("t")).collect()]
    assert [m // 10**6 for m in micros] == [1656666000, 1641031200]  # 09:00 and 10:00 UTC


def test_add_if_missing(spark):
    df = spark.sql("SELECT 1 AS x")
    assert col.add_if_missing(df).first().data_block_id == 0
    present = df.withColumn("data_block_id", F.lit(7))
    assert col.add_if_missing(present) is present


def test_null_rules(spark, rows):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double")
    kept = [r[0] for r in rows(col.drop_any_null(df))]
    assert len(kept) == 2 and 1.0 in kept and any(math.isnan(x) for x in kept)
    pairs = spark.createDataFrame([(None, 2), (1, 3)], "a int, b int")
    assert rows(col.fill_null_from(pairs, {"a": "b"}), "b") == [(2, 2), (1, 3)]
    assert rows(col.fill_null(pairs, {"a": -1}), "b") == [(-1, 2), (1, 3)]
    assert col.fill_null(pairs, {"a": -1}).dtypes == pairs.dtypes


def test_ratio_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (3.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(col.ratio(F.col("a"), F.col("b"))).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] is None and got[4] == 1.5


def test_capacity_ratios(spark):
    df = spark.sql("SELECT CAST(10 AS SMALLINT) AS eic_count, CAST(25 AS FLOAT) AS installed_capacity")
    row = col.add_capacity_ratios(df).first()
    assert row.installed_capacity_eic_count_ratio == 2.5 and row.eic_count_installed_capacity_ratio == 0.4


def test_product_names(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (9,), (None,)], "p int")
    names = [r[0] for r in df.select(col.product_name(F.col("p"))).collect()]
    assert names == ["Combined", "Fixed", "General service", "Spot", "Unknown", "Unknown"]
    ingest = [r[0] for r in df.select(col.product_name(F.col("p"), "General service")).collect()]
    assert ingest[4:] == ["General service", "General service"]


def test_lookup_table_default(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, None)], "id int, county int")
    names = spark.createDataFrame([(0, "Harju")], "county int, name string")
    assert rows(col.map_from_table(df, "county", names, "county", "name"), "id") == [
        (1, "Harju"), (2, "Unknown"), (3, "Unknown"),
    ]


def test_segment(spark, rows):
    df = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, 4)], "is_consumption int, is_business int, v int")
    assert rows(col.segment(df, "Producer", True)) == [(2,)]
    assert col.segment(df, "consumer").columns == ["is_business", "v"]
    with pytest.raises(ValueError):
        col.segment(df, "trader")


def test_sql_rounding(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (2.4,)], "x double")
    assert [r[0] for r in df.select(col.sql_round_to_int(F.col("x"))).collect()] == [2, 4, -2, 2]


def test_noise_is_normal_and_independent_of_partitions(spark):
    keys = spark.range(20_000).select(F.col("id"), F.concat(F.lit("k"), "id").alias("name"))
    noisy = col.add_noise(keys, ["id", "name"], seed=7)
    stats = noisy.agg(F.avg("noise"), F.stddev("noise"), F.kurtosis("noise"), F.count_distinct("noise")).first()
    assert abs(stats[0]) < 0.03 and abs(stats[1] - 1) < 0.03 and abs(stats[2]) < 0.15 and stats[3] == 20_000
    one = noisy.repartition(1).orderBy("id").limit(50).collect()
    many = col.add_noise(keys.repartition(13), ["id", "name"], seed=7).orderBy("id").limit(50).collect()
    assert one == many
    assert col.add_noise(keys, ["id", "name"], seed=8).orderBy("id").limit(50).collect() != one
