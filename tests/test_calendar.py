import datetime
import math

import pytest
from pyspark.sql import functions as F

from wattweave.functions import calendar as cal


def at(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "s string").select(
        F.to_timestamp_ntz("s", F.lit("yyyy-MM-dd HH:mm:ss")).alias("datetime")
    )


def test_publication_shift(spark):
    got = at(spark, "2024-02-28 10:59:00", "2024-02-28 11:00:00").select(cal.publication_shift(F.col("datetime")))
    assert [r[0] for r in got.collect()] == [
        datetime.datetime(2024, 2, 29, 10, 59), datetime.datetime(2024, 3, 1, 11, 0),
    ]
    assert got.dtypes[0][1] == "timestamp_ntz"


def test_month_arithmetic_clips(spark):
    got = at(spark, "2023-05-31 23:00:00").select(cal.minus_months(F.col("datetime"), 3)).first()[0]
    assert got == datetime.datetime(2023, 2, 28, 23)


def test_calendar_parts(spark):
    parts = cal.add_calendar_parts(at(spark, "2024-01-07 13:00:00", "2024-12-31 00:00:00"))
    sunday, last = parts.collect()
    assert (sunday.weekday, sunday.hour, sunday.month, sunday.day) == (7, 13, 1, 7)
    assert last.day_of_year == 366 and last.date == datetime.date(2024, 12, 31)
    assert dict(parts.dtypes)["weekday"] == "tinyint" and dict(parts.dtypes)["day_of_year"] == "smallint"


def test_epoch_micros_ignores_the_session_zone(spark):
    df = at(spark, "2024-03-31 03:30:00").select(
        (F.col("datetime") + F.expr("INTERVAL '0.000007' SECOND")).alias("datetime")
    )
    want = 1711855800 * 10**6 + 7
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Tallinn"):  # that local hour does not exist in Tallinn
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(cal.epoch_micros(F.col("datetime"))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_features(spark):
    df = cal.add_calendar_parts(at(spark, "2024-01-01 12:00:00", "2024-12-31 00:00:00"))
    noon, last = cal.add_time_features(df).collect()
    assert noon["sin(hour)"] == pytest.approx(0, abs=1e-6) and noon["cos(hour)"] == pytest.approx(-1)
    assert noon["sin(month)"] == pytest.approx(0.5) and noon["cos(month)"] == pytest.approx(math.sqrt(3) / 2)
    assert noon.is_holiday and not last.is_holiday
    assert last["sin(day_of_year)"] == pytest.approx(0, abs=1e-6) and last["cos(day_of_year)"] == pytest.approx(-1)
    assert not {"hour", "weekday", "day_of_year"} & set(cal.add_time_features(df).columns)


def test_leap_years(spark):
    df = at(spark, "2024-03-01 00:00:00", "2023-03-01 00:00:00", "2000-01-01 00:00:00", "1900-01-01 00:00:00")
    assert [r[0] for r in df.select(cal.is_leap_year(F.col("datetime"))).collect()] == [True, False, True, False]


def test_holidays():
    assert cal.easter_sunday(2024) == datetime.date(2024, 3, 31)
    published = "2000-04-23 2008-03-23 2011-04-24 2021-04-04 2022-04-17 2023-04-09 2025-04-20 2038-04-25 2049-04-18 2076-04-19"
    assert [str(cal.easter_sunday(int(d[:4]))) for d in published.split()] == published.split()
    dates = cal.holidays(range(2021, 2026))
    assert datetime.date(2023, 4, 7) in dates and datetime.date(2023, 5, 28) in dates
    assert len([d for d in dates if d.year == 2023]) == 12


def test_holiday_table_list_and_rule_are_equal_in_any_year(spark, rows):
    days = spark.sql("SELECT explode(sequence(DATE'1970-01-01', DATE'2059-12-31')) AS date")
    known = cal.holidays(range(1970, 2060))
    table = spark.createDataFrame([(d,) for d in known], "date date")
    by_list = days.withColumn("is_holiday", cal.is_holiday(F.col("date"), known))
    listed = days.withColumn("is_holiday", cal.is_holiday(F.col("date")))
    assert rows(cal.mark_holidays(days, "date", table), "date") == rows(listed, "date") == rows(by_list, "date")
    assert (datetime.date(2026, 1, 1), True) in rows(listed, "date")
