"""Dates: spines, trading days, missing dates, gaps and feed readiness.

Frames in this module hold dates only, so their size is bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every date from ``start`` to ``end``; empty if ``start`` is later."""
    return _spine(spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last")))


def _spine(bounds: DataFrame) -> DataFrame:
    # sequence() counts down when its start is the larger one, hence the filter.
    return bounds.filter(F.col("first") <= F.col("last")).select(
        F.explode(F.sequence("first", "last")).alias("date")
    )


def _open_days(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    weekdays = dates.filter(~F.dayofweek("date").isin(1, 7))
    return weekdays.join(holidays.select("date"), "date", "left_anti")


def trading_days(
    spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame
) -> DataFrame:
    """Weekdays that are not in ``holidays``."""
    return _open_days(date_spine(spark, start, end), holidays)


# Days on which the exchange stayed closed outside its holiday rules (since 1971).
SPECIAL_CLOSURES = (
    "1972-11-07", "1972-12-28", "1973-01-25", "1976-11-02", "1977-07-14", "1980-11-04", "1985-09-27",
    "1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11",
    "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09",
)
# Before, holidays fell on other days and sessions on Saturdays.
FIRST_RULED_YEAR = 1971


def _easter(year: Column) -> Column:
    """Easter Sunday by the Gregorian computus."""

    def div(a: Column, b: int) -> Column:
        return F.call_function("div", a, F.lit(b))

    century = div(year, 100)
    golden = year % 19
    epact = (century - div(century, 4) - div(century * 8 + 13, 25) + golden * 19 + 15) % 30
    moon = epact - div(epact, 28) * (
        F.lit(1) - F.call_function("div", F.lit(29), epact + 1) * div(F.lit(21) - golden, 11)
    )
    weekday = (year + div(year, 4) + moon + 2 - century + div(century, 4)) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), (moon - weekday).cast("int"))


def nyse_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Full-day closures of the New York Stock Exchange by its holiday rules, since 1971.

    Earlier years raise ``ValueError``: pass holidays of your own there.
    """
    if first_year < FIRST_RULED_YEAR:
        raise ValueError(f"no holiday rules before {FIRST_RULED_YEAR}: pass the holidays of {first_year}")
    y = F.col("year")

    def on(month: int, day: int) -> Column:
        return F.make_date(y, F.lit(month), F.lit(day))

    def observed(date: Column, saturday: int) -> Column:
        """Moved off the weekend; ``saturday`` is the shift of a Saturday."""
        day = F.dayofweek(date)
        shift = F.when(day == 1, 1).when(day == 7, saturday).otherwise(0)
        return F.date_add(date, shift)

    def nth_weekday(month: int, weekday: str, n: int) -> Column:
        return F.date_add(F.next_day(F.date_sub(on(month, 1), 1), weekday), 7 * (n - 1))

    days = F.array(
        observed(on(1, 1), 0),  # on a Saturday it is not moved
        F.when(y >= 1998, nth_weekday(1, "Mon", 3)),
        nth_weekday(2, "Mon", 3),
        F.date_sub(_easter(y), 2),
        F.date_sub(F.next_day(on(5, 31), "Mon"), 7),
        F.when(y >= 2022, observed(on(6, 19), -1)),
        observed(on(7, 4), -1),
        nth_weekday(9, "Mon", 1),
        nth_weekday(11, "Thu", 4),
        observed(on(12, 25), -1),
    )
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    special = spark.createDataFrame([(d,) for d in SPECIAL_CLOSURES], "d string").select(
        F.to_date("d").alias("date")
    )
    by_rule = years.select(F.explode(days).alias("date")).filter(F.col("date").isNotNull())
    return by_rule.union(special.filter(F.year("date").between(first_year, last_year))).distinct()


def missing_dates(available: DataFrame, loaded: DataFrame) -> DataFrame:
    """Available dates that are not loaded, in order."""
    return (
        available.select("date").distinct().join(loaded.select("date"), "date", "left_anti")
        .orderBy("date")
    )


def trading_day_gaps(loaded: DataFrame, holidays: DataFrame) -> DataFrame:
    """Trading days between the first and the last loaded date that are not loaded."""
    dates = loaded.select("date").distinct()
    bounds = dates.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return _open_days(_spine(bounds), holidays).join(dates, "date", "left_anti").orderBy("date")


def ready_dates(
    stock_dates: DataFrame,
    option_dates: DataFrame,
    stock_max: dt.date | None = None,
    option_max: dt.date | None = None,
    since_year: int | None = None,
) -> DataFrame:
    """Dates that both feeds offer and that lie after what is loaded of each, in order."""

    def new(dates: DataFrame, loaded_max: dt.date | None) -> DataFrame:
        if loaded_max is not None:
            dates = dates.filter(F.col("date") > F.lit(loaded_max))
        if since_year is not None:
            dates = dates.filter(F.year("date") >= since_year)
        return dates.select("date")

    return new(stock_dates, stock_max).intersect(new(option_dates, option_max)).orderBy("date")


def split_check_dates(splits: DataFrame) -> DataFrame:
    """Per ticker the days to check around each split: 30 days and 1 day before, on, 1 after."""
    offsets = F.array(*[F.lit(d) for d in (-30, -1, 0, 1)])
    dates = F.transform(offsets, lambda d: F.date_add(F.col("execution_date"), d))
    return splits.select("ticker", F.explode(dates).alias("date")).distinct()
