"""Calendar parts, cyclic encodings, holidays and time arithmetic.

Timestamps are naive (``timestamp_ntz``) and stay naive.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.schemas import PUBLICATION_HOUR

MICROS_PER_DAY = 86_400_000_000

# Estonian public holidays, as (month, day) and as days from Easter Sunday.
FIXED_HOLIDAYS = [
    (1, 1),  # New Year's Day
    (2, 24),  # Independence Day
    (5, 1),  # Spring Day
    (6, 23),  # Victory Day
    (6, 24),  # Midsummer Day
    (8, 20),  # Restoration of Independence
    (12, 24),  # Christmas Eve
    (12, 25),  # Christmas Day
    (12, 26),  # Second Day of Christmas
]
EASTER_OFFSETS = [-2, 0, 49]  # Good Friday, Easter Sunday, Pentecost


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def months(n: int) -> Column:
    return F.make_ym_interval(F.lit(0), F.lit(n))


def shift_days(ts: Column, n: int) -> Column:
    """Timestamp ``n`` days later, same time of day."""
    return ts + days(n)


def minus_months(ts: Column, n: int) -> Column:
    """Timestamp ``n`` calendar months earlier; clips to the month end, keeps the time of day."""
    return ts - months(n)


def publication_shift(ts: Column, hour: int = PUBLICATION_HOUR) -> Column:
    """When a measurement becomes known: next day before ``hour``, else the day after."""
    return F.when(F.hour(ts) < hour, ts + days(1)).otherwise(ts + days(2))


def iso_weekday(ts: Column) -> Column:
    """Monday 1 ... Sunday 7."""
    return F.weekday(ts) + 1


def weekday_name(ts: Column) -> Column:
    """Full English name, e.g. ``Monday``."""
    return F.date_format(ts, "EEEE")


def day_of_epoch(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("long")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a naive timestamp, whatever the session zone."""
    return day_of_epoch(ts) * MICROS_PER_DAY + micros_of_day(ts)


def micros_of_day(ts: Column) -> Column:
    seconds = F.hour(ts).cast("long") * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def days_in_year(ts: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(ts), F.lit(12), F.lit(31)))


def is_leap_year(ts: Column) -> Column:
    return days_in_year(ts) == 366


def add_calendar_parts(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """date, year, month, day, weekday, day_of_year and hour of ``ts``."""
    at = F.col(ts)
    return df.withColumns(
        {
            "date": at.cast("date"),
            "year": F.year(at),
            "month": F.month(at).cast("tinyint"),
            "day": F.day(at).cast("tinyint"),
            "weekday": iso_weekday(at).cast("tinyint"),
            "day_of_year": F.dayofyear(at).cast("smallint"),
            "hour": F.hour(at).cast("tinyint"),
        }
    )


def cyclic(value: Column, period: float | Column, turn: float = 2 * math.pi) -> tuple[Column, Column]:
    """(sin, cos) of ``value`` on a circle of ``period``, as 32-bit floats."""
    angle = F.lit(turn) * value / period
    return F.sin(angle).cast("float"), F.cos(angle).cast("float")


def half_cycle_day_of_year(day_of_year: Column, ts: Column) -> tuple[Column, Column]:
    """(sin, cos) of the day of the year over half a turn; the period is the length of the year."""
    return cyclic(day_of_year, days_in_year(ts), turn=math.pi)


def _easter_moon(year, whole):
    """Month * 31 + day - 1 of Easter Sunday, of a number or a column; ``whole(a, n)`` is a // n."""
    golden, century = year % 19, whole(year, 100)
    shift = century - whole(century, 4) - whole(century - whole(century + 8, 25) + 1, 3)
    moon = (golden * 19 + shift + 15) % 30
    weekday = ((century % 4) * 2 + whole(year % 100, 4) * 2 + 32 - moon - year % 4) % 7
    return moon + weekday - whole(golden + moon * 11 + weekday * 22, 451) * 7 + 114


def easter_sunday(year: int) -> datetime.date:
    """Gregorian Easter of any year."""
    moon = _easter_moon(year, lambda a, n: a // n)
    return datetime.date(year, moon // 31, moon % 31 + 1)


def easter_of(date: Column) -> Column:
    """Gregorian Easter of the year of a date."""
    moon = _easter_moon(F.year(date), lambda a, n: F.floor(a / n))
    return F.make_date(F.year(date), F.floor(moon / 31).cast("int"), (moon % 31 + 1).cast("int"))


def holidays(years) -> list[datetime.date]:
    """Public holidays of the given years; a dozen per year."""
    dates = set()
    for year in years:
        dates.update(datetime.date(year, m, d) for m, d in FIXED_HOLIDAYS)
        easter = easter_sunday(year)
        dates.update(easter + datetime.timedelta(days=n) for n in EASTER_OFFSETS)
    return sorted(dates)


def is_holiday(date: Column, dates: list[datetime.date] | None = None) -> Column:
    """Whether a date is in the list of holidays, or follows the rule for any year if there is none."""
    if dates is not None:
        return date.isin(list(dates))
    fixed = (F.month(date) * 100 + F.day(date)).isin([month * 100 + day for month, day in FIXED_HOLIDAYS])
    return fixed | F.datediff(date, easter_of(date)).isin(EASTER_OFFSETS)


def mark_holidays(df: DataFrame, date: str, table: DataFrame, out: str = "is_holiday") -> DataFrame:
    """As :func:`is_holiday`, with the holidays given as a table holding a ``date`` column."""
    known = table.select(F.col("date").alias(date)).distinct().withColumn(out, F.lit(True))
    return df.join(known, on=date, how="left").withColumn(out, F.coalesce(out, F.lit(False)))


def add_time_features(df: DataFrame, dates: list[datetime.date] | None = None) -> DataFrame:
    """Cyclic encodings and the holiday flag; the parts they come from are dropped."""
    pairs = {
        "hour": cyclic(F.col("hour"), 24),
        "weekday": cyclic(F.col("weekday"), 7),
        "month": cyclic(F.col("month"), 12),
        "day_of_year": half_cycle_day_of_year(F.col("day_of_year"), F.col("datetime")),
    }
    features = {}
    for name, (sine, cosine) in pairs.items():
        features[f"sin({name})"] = sine
        features[f"cos({name})"] = cosine
    features["is_holiday"] = is_holiday(F.col("date"), dates)
    return df.withColumns(features).drop("hour", "day_of_year", "weekday")
