"""Date and week expressions. All take and return Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(text: Column, fmt: str | None = None) -> Column:
    """Text to date; unreadable text becomes null (ANSI mode would raise on a cast)."""
    parsed = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return parsed.cast("date")


def saturday_of_sunday_week(start: Column) -> Column:
    """Saturday that ends the week starting on Sunday ``start``."""
    return F.date_add(start, 6)


def sunday_on_or_after(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "SUN")


def sunday_before(day: Column) -> Column:
    """Last Sunday strictly before ``day``."""
    return F.date_sub(F.next_day(F.date_sub(day, 1), "SUN"), 7)


def sunday_on_or_before(day: Column) -> Column:
    return F.date_sub(F.next_day(day, "SUN"), 7)


def monday_on_or_before(day: Column) -> Column:
    return F.date_sub(F.next_day(day, "MON"), 7)


def monday_after(day: Column) -> Column:
    """First Monday strictly after ``day``."""
    return F.next_day(day, "MON")


def day_after_saturday(day: Column) -> Column:
    """Saturday on or after ``day``, plus one day."""
    return F.date_add(F.next_day(F.date_sub(day, 1), "SAT"), 1)


def day_before(day: Column) -> Column:
    return F.date_sub(day, 1)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def year_week(year: Column, week: Column) -> Column:
    """``YYYYWW`` integer from a year and a week number."""
    return (year.cast("int") * 100 + week.cast("int")).cast("int")


def iso_week_key(day: Column) -> Column:
    return year_week(iso_year(day), iso_week(day))


def year_week_text(year: Column, week: Column) -> Column:
    """``YYYYWW`` through zero-padded text, for parts that arrive as numbers or text."""
    return F.concat(year.cast("string"), F.lpad(week.cast("string"), 2, "0")).cast("int")


def fiscal_period(day: Column, start_month: int = 7) -> Column:
    return F.pmod(F.month(day) - F.lit(start_month), F.lit(12)) + 1


def fiscal_year(day: Column, start_month: int = 7) -> Column:
    return F.year(day) + F.when(F.month(day) >= start_month, 1).otherwise(0)


def fiscal_quarter(day: Column, start_month: int = 7) -> Column:
    return F.ceil(fiscal_period(day, start_month) / 3).cast("int")


def with_fiscal(df: DataFrame, day: str, start_month: int = 7) -> DataFrame:
    """Add ``fiscal_year``, ``fiscal_period`` and ``fiscal_quarter`` of a date column."""
    return df.withColumns({
        "fiscal_year": fiscal_year(F.col(day), start_month),
        "fiscal_period": fiscal_period(F.col(day), start_month),
        "fiscal_quarter": fiscal_quarter(F.col(day), start_month),
    })


def weekly_sum(df: DataFrame, day: str, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sum by week ending Sunday (and keys)."""
    ending = sunday_on_or_after(F.col(day)).alias("week_ending_sun")
    return df.groupBy(ending, *keys).agg(F.sum(value).alias(value))
