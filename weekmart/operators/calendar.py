"""The calendar dimension: one row per week, with its last-year and baseline counterparts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.functions import dates as d

WEEK = "calendar_week_year"
SUNDAY_WEEK = ("week_starting_sun", "week_ending_sat")
MONDAY_WEEK = ("week_starting_mon", "week_ending_sun")


def build_calendar(
    spark: SparkSession,
    first_year: int,
    last_year: int,
    baseline_year: int,
    covid_start: datetime.date | None = None,
    fiscal_start_month: int = 7,
) -> DataFrame:
    """Calendar for sources that bring none: ISO weeks of the given years.

    The Sunday-based week starts the day before the Monday-based one. ``yoy_week`` is the week 364
    days earlier; ``baseline_week`` the same week number of the baseline year (53 counts as 52);
    ``covid_week`` a running number from ``covid_start``, null before it.
    """
    monday = datetime.date.fromisocalendar(first_year, 1, 1)
    weeks = (datetime.date.fromisocalendar(last_year + 1, 1, 1) - monday).days // 7
    mon = F.col("week_starting_mon")
    fiscal = d.fiscal_year(mon, fiscal_start_month) * 100 + F.ceil(
        (F.datediff(mon, F.make_date(
            d.fiscal_year(mon, fiscal_start_month) - 1, F.lit(fiscal_start_month), F.lit(1))) + 1) / 7)
    covid = F.lit(None)
    if covid_start is not None:
        covid = F.when(mon >= F.lit(covid_start), F.floor(F.datediff(mon, F.lit(covid_start)) / 7) + 1)
    return (
        spark.range(0, weeks, 1, 1)
        .select(F.date_add(F.lit(monday), (F.col("id") * 7).cast("int")).alias("week_starting_mon"))
        .select(
            d.iso_week_key(mon).alias(WEEK),
            F.date_sub(mon, 1).alias("week_starting_sun"),
            F.date_add(mon, 5).alias("week_ending_sat"),
            mon,
            F.date_add(mon, 6).alias("week_ending_sun"),
            d.iso_week_key(F.date_sub(mon, 364)).alias("yoy_week"),
            (F.lit(baseline_year * 100) + F.least(d.iso_week(mon), F.lit(52))).cast("int").alias("baseline_week"),
            covid.cast("int").alias("covid_week"),
            fiscal.cast("int").alias("fiscal_week_one"),
            fiscal.cast("int").alias("fiscal_week_two"),
        )
    )


def add_calendar(df: DataFrame, calendar: DataFrame, columns, week: str = WEEK) -> DataFrame:
    """Attach calendar columns by week key; weeks the calendar lacks get nulls, of repeated ones the smallest row counts."""
    wanted = [c for c in columns if c not in df.columns]
    if not wanted:
        return df
    side = calendar.groupBy(F.col(WEEK).alias(week)).agg(F.min(F.struct(*wanted)).alias("_side"))
    return df.join(side.select(week, "_side.*"), week, "left")


def attach_week(df: DataFrame, calendar: DataFrame, day: str, calendar_day: str, how: str = "left") -> DataFrame:
    """Date to week key through one of the calendar's start or end dates; the earliest week if several have it."""
    side = calendar.groupBy(F.col(calendar_day).alias("_day")).agg(F.min(WEEK).alias(WEEK))
    return df.join(side, F.col(day) == F.col("_day"), how).drop("_day")


def attach_fiscal_week(df: DataFrame, calendar: DataFrame, fiscal_week: str, calendar_fiscal: str) -> DataFrame:
    """Distributor fiscal week to calendar week key; the earliest week if several share it."""
    side = calendar.groupBy(F.col(calendar_fiscal).alias(fiscal_week)).agg(F.min(WEEK).alias(WEEK))
    return df.join(side, fiscal_week, "left")


def valid_week(df: DataFrame, calendar: DataFrame, week: str) -> DataFrame:
    """Week key looked up in the calendar itself: unknown weeks become null."""
    side = calendar.select(F.col(WEEK).alias("_known")).distinct()
    return df.join(side, F.col(week) == F.col("_known"), "left").drop(week).withColumnRenamed("_known", WEEK)


def known_weeks_only(df: DataFrame, week: str = WEEK) -> DataFrame:
    """Drop rows without a week key."""
    return df.dropna(subset=[week])


def current_week(calendar: DataFrame, as_of: datetime.date) -> DataFrame:
    """The one-row frame with the week whose Monday-Sunday span holds ``as_of``; an error if the calendar has none."""
    day = F.lit(as_of)
    return calendar.filter((F.col("week_starting_mon") <= day) & (F.col("week_ending_sun") >= day)).select(
        F.coalesce(F.max(WEEK), F.raise_error(F.lit(f"the calendar has no week of {as_of}")).cast("int")).alias(WEEK))


def before_current_week(df: DataFrame, calendar: DataFrame, as_of: datetime.date, week: str = WEEK) -> DataFrame:
    """Rows of weeks strictly before the current one."""
    return df.filter(F.col(week) < current_week(calendar, as_of).scalar())


def complete_weeks(df: DataFrame, day: str, as_of: datetime.date) -> DataFrame:
    """Rows dated up to the last Sunday strictly before ``as_of``."""
    return df.filter(F.col(day) <= d.sunday_before(F.lit(as_of)))
