"""Sell-in: extracts from the warehouse star, preparation, comparison with sell-out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.functions import clean as c
from weekmart.operators import calendar as cal
from weekmart.operators.calendar import SUNDAY_WEEK, WEEK
from weekmart.plans.analysis import analyze

# fixed values: sell-out measures of the comparison, and the sell-in measures set beside them
COMPARED = (
    "lbs", "sma_4", "sma_8", "sma_12", "lbs_precovid",
    "lbs_baseline", "sma_4_baseline", "sma_8_baseline", "sma_12_baseline",
    "lbs_lag_1", "lbs_lag_2", "lbs_lag_3", "lbs_lag_4", "lbs_baseline_lag_1", "sma_4_lag_1", "sma_4_baseline_lag_1",
)
CATEGORY = "consolidated_category"


@dataclass(frozen=True)
class Link:
    """One joined table of a star: equal columns ``{fact side: table side}``."""

    table: DataFrame
    on: Mapping[str, str]
    how: str = "inner"


def star_extract(
    fact: DataFrame, links: Sequence[Link], where: Sequence[Column],
    keys: Mapping[str, Column], sums: Mapping[str, Column],
) -> DataFrame:
    """Join, filter, sum: the shape all warehouse extracts share.

    Tables whose measured size allows it are broadcast by Spark; filters on them are pushed below
    the joins. Sums are taken after the joins, so a left join that multiplies rows multiplies sums.
    """
    df = fact
    for link in links:
        renamed = {right: left for left, right in link.on.items()}
        df = df.join(link.table.withColumnsRenamed(renamed), list(link.on), link.how)
    for condition in where:
        df = df.filter(condition)
    return df.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()])


@dataclass(frozen=True)
class SellinTables:
    """The warehouse star: fact, product (product_id, category), calendar days (accounting_date,
    week_end) and customer (customer_id, channel, org, level1)."""

    fact: DataFrame
    product: DataFrame
    days: DataFrame
    customer: DataFrame


def sellin_extract(
    tables: SellinTables, orgs: Sequence[str], channels: Sequence[str], customers: Sequence[str], as_of,
) -> DataFrame:
    """Sell-in pounds by week end and category for one distributor's customers, complete weeks only."""
    return star_extract(
        cal.complete_weeks(tables.fact, "accounting_date", as_of),
        [Link(tables.product.select("product_id", "category"), {"product_id": "product_id"}),
         Link(tables.days.select("accounting_date", "week_end"), {"accounting_date": "accounting_date"}),
         Link(tables.customer.select("customer_id", "channel", "org", "level1"),
              {"customer_id": "customer_id", "channel": "channel", "org": "org"})],
        [F.col("org").isin(*orgs), F.col("channel").isin(*channels), F.col("level1").isin(*customers)],
        {"calendar_week": F.col("week_end"), "category_desc": F.col("category")},
        {"actual_volume_lbs": F.col("weight_lbs")},
    )


def unmatched_dates(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows and volume by week end date of the sell-in that ``prepare_sellin`` drops, as no week ends on that date."""
    dated = cal.attach_week(df, calendar, "calendar_week", "week_ending_sun").filter(F.col(WEEK).isNull())
    return dated.groupBy("calendar_week").agg(F.count("*").alias("rows"), F.coalesce(F.sum("actual_volume_lbs"), F.lit(0.0)).alias("lbs"))


def prepare_sellin(
    df: DataFrame, calendar: DataFrame, keep_unmatched: bool = False,
) -> DataFrame:
    """Dated sell-in (week end date, category_desc, actual_volume_lbs) to a weekly fact by category.

    Dates the calendar lacks are dropped; ``keep_unmatched`` puts them, like the older reports, into
    a week 0 with all other nulls as 0 too.
    """
    df = cal.attach_week(df, calendar, "calendar_week", "week_ending_sun").withColumnRenamed("actual_volume_lbs", "lbs")
    if keep_unmatched:
        df = df.fillna({WEEK: 0, "lbs": 0.0, "category_desc": "0"})
    else:
        df = cal.known_weeks_only(df)
    return df.withColumn(CATEGORY, c.category_equal(F.col("category_desc")))


def prepare_keyed_sellin(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Sell-in that brings its week key as text: unreadable keys become null, volume to double."""
    df = df.withColumnsRenamed({"actual_volume_lbs": "lbs", "calendar_week_number": WEEK, **(renames or {})})
    return df.withColumns({
        WEEK: F.col(WEEK).try_cast("int"),
        "lbs": F.col("lbs").cast("double"),
        CATEGORY: c.category_equal(F.col("category_desc")),
    })


def prepare_financial(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Financial extract under report names, week key as number."""
    df = df.withColumnsRenamed({"actual_volume_lbs": "lbs", "calendar_week_number": WEEK, **(renames or {})})
    return df.withColumn(WEEK, F.col(WEEK).cast("int"))


def analyze_sellin(fact: DataFrame, calendar: DataFrame, begin: int, end: int, prefix: str = "sellin_", **options) -> DataFrame:
    """Sell-in analysis by category with prefixed measures."""
    out = analyze(fact, [CATEGORY], calendar, begin, end, **options)
    return out.withColumnsRenamed({m: prefix + m for m in COMPARED})


def compare(
    sellin: DataFrame, sellout: DataFrame, calendar: DataFrame, distributor: str,
    begin: int = 201910, end: int = 202009, prefix: str = "sellin_",
) -> DataFrame:
    """Sell-out and sell-in side by side per week and category, missing sell-in as 0.

    Both sides are at most weeks times categories long when they meet.
    """
    other = [prefix + m for m in COMPARED]
    left = analyze(sellout, [CATEGORY], calendar, begin, end)
    right = analyze_sellin(sellin, calendar, begin, end, prefix).select(WEEK, CATEGORY, *other)
    joined = left.join(right, [WEEK, CATEGORY], "left").fillna(0.0, subset=other)
    return joined.withColumn("distributor", F.lit(distributor)).select(
        CATEGORY, "distributor", WEEK, *COMPARED, *other, *SUNDAY_WEEK, "covid_week")
