"""Aggregates, profiles, rankings and change metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekmart.operators.history import side_by_side
from weekmart.operators.ranking import quantiles
from weekmart.session import staged


def sum_by(df: DataFrame, keys: Sequence[str], value: str, keep_null: bool = True, name: str | None = None) -> DataFrame:
    """Sum by keys; rows with a null key are dropped on request. A group of nulls sums to zero."""
    if not keep_null:
        df = df.dropna("any", subset=list(keys))
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name or value))


def span(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest value, overall or per group (data freshness)."""
    return df.groupBy(*keys).agg(F.min(value).alias("min"), F.max(value).alias("max"))


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """Row counts per value, largest first."""
    if not keep_null:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Value counts of every column in one pass: ``column, value, rows``."""
    columns = list(columns or df.columns)
    texts = df.select([F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], columns, "column", "value").filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("rows"))
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, min, quartiles, max per column, one row per column.

    Quartiles are exact and interpolated; they are selected by rank from ranges of the values, so a column of as many
    different values as rows needs no larger buffer than another.
    """
    cells = [F.struct(
        F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
    ) for c in columns]
    told = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75)).withColumnRenamed("column", "_of")
    at = [F.get("quantiles", k).alias(f"q{q}") for k, q in enumerate((25, 50, 75))]
    return told.join(quartiles, F.col("column") == F.col("_of"), "left").select("column", "count", "mean", "std", "min", *at, "max")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, number of values, most frequent value (the first in order of several) and its frequency, one row per column."""
    order = F.struct((-F.col("rows")).alias("less"), "value")
    return profile(df, columns).groupBy("column").agg(
        F.sum("rows").alias("count"), F.count("*").alias("unique"), F.min_by("value", order).alias("top"), F.max("rows").alias("freq"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations that occur (rows with a null in one of them are left out)."""
    return df.select(*columns).dropna("any").distinct()


def top_sums(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The ``n`` largest groups by sum."""
    total = df.groupBy(*keys).agg(F.sum(value).alias(value))
    return total.orderBy(F.desc(value), *keys).limit(n)


def last_groups(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Sums of the ``n`` latest keys."""
    return df.groupBy(key).agg(F.sum(value).alias(value)).orderBy(F.desc(key)).limit(n)


def percent_change(
    df: DataFrame, period: str, value: str, periods: int = 1, last: int | None = None, name: str = "change",
) -> DataFrame:
    """Relative change of the period totals against ``periods`` earlier; null where that was zero.

    The fact is summed per period first; only the totals, one row per period, are ordered.
    """
    totals = df.filter(F.col(period).isNotNull()).groupBy(period).agg(F.sum(value).alias(value))
    if last is not None:
        totals = totals.orderBy(F.desc(period)).limit(last + periods)
    earlier = F.lag(value, periods).over(Window.orderBy(period))
    out = totals.withColumn("_before", earlier).withColumn(name, F.try_divide(F.col(value) - F.col("_before"), "_before"))
    out = out.drop("_before")
    return out.orderBy(F.desc(period)).limit(last) if last is not None else out


def season_change(
    df: DataFrame, period: str, value: str, this: tuple[Column, Column], other: tuple[Column, Column], last: int = 5,
) -> DataFrame:
    """Last changes of two seasons side by side; each season is (after, up to and including)."""
    def season(bounds, period_name, change_name):
        rows = df.filter((F.col(period) > bounds[0]) & (F.col(period) <= bounds[1]))
        return percent_change(rows, period, value, 1, last, change_name).select(
            F.col(period).alias(period_name), change_name)
    a = season(this, "period", "change")
    b = season(other, "other_period", "other_change")
    return side_by_side(a, b, "period", "other_period", last)


def keep_large(df: DataFrame, key: str, value: str, threshold: float) -> DataFrame:
    """Rows of the keys whose total exceeds the threshold."""
    large = df.groupBy(key).agg(F.sum(value).alias("_total")).filter(F.col("_total") > threshold)
    return df.join(staged(large.select(key)), key, "left_semi")


def week_year_matrix(df: DataFrame, week: str, year: str, value: str) -> DataFrame:
    """One row per week number, one column per year that the data holds; rows without a year make no column."""
    label = F.concat(F.lit("y"), F.col(year).cast("string"))
    return df.withColumn("_year", F.coalesce(label, F.lit("_none"))).groupBy(week).pivot("_year").agg(F.sum(value)).drop("_none")


def totals_and_members(df: DataFrame, period: str, member: str, value: str, members: Sequence[str]) -> DataFrame:
    """Period totals over all members plus the series of selected members, in one pass.

    The total carries the member label ``Total``.
    """
    sets = df.groupingSets([[period], [period, member]], period, member)
    out = sets.agg(F.sum(value).alias(value), F.grouping(member).alias("_all"))
    label = F.when(F.col("_all") == 1, "Total").otherwise(F.col(member))
    wanted = (F.col("_all") == 1) | F.col(member).isin(*members)
    return out.filter(wanted).select(period, label.alias(member), value)


def sum_where(df: DataFrame, condition: Column, value: str) -> DataFrame:
    return df.filter(condition).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def sum_of_sums(
    df: DataFrame, masks: Sequence[Column], inner: Sequence[str], outer: str, value: str,
) -> DataFrame:
    """Filter by all masks, sum by the inner keys, then by the outer key, largest first."""
    kept = df.filter(reduce(lambda a, b: a & b, masks))
    first = sum_by(kept, inner, value)
    return sum_by(first, [outer], value, keep_null=False).orderBy(F.desc(value), outer)
