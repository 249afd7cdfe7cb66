"""Marts: compiled sell-out, product union, inventory, fair share, fill rate, orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.operators import mapping as m
from weekmart.operators.history import first_file_wins, stack
from weekmart.plans.sellin import Link, star_extract
from weekmart.session import dealt, staged

COMPILED = (
    "city", "region", "segment_l1", "segment_l2", "service_type", "consolidated_category", "distributor", "lbs",
    "week_ending_sat",
)


def compile_regions(us: DataFrame, canada: DataFrame) -> DataFrame:
    """Two countries in one table: the first dated by week start, the second by Saturday week end."""
    us = us.withColumn("week_ending_sat", d.saturday_of_sunday_week(F.col("week_beginning_date")))
    us = us.withColumnsRenamed({"state": "region", "restaurants": "service_type"})
    return stack(us.select(*COMPILED), canada.select(*COMPILED))


def product_union(
    sources: Mapping[str, tuple[DataFrame, str]], hierarchy: DataFrame, week: str = "calendar_week_year",
) -> DataFrame:
    """Volume by week, product format and distributor over several conformed sources.

    ``sources`` gives per distributor its frame (week, sku_id, measure) and the name of its measure.
    Sums come first, so the hierarchy is joined to one row per week and SKU.
    """
    parts = []
    for distributor, (frame, measure) in sources.items():
        by_sku = frame.dropna("any", subset=[week, "sku_id"]).groupBy(week, "sku_id").agg(F.sum(measure).alias("lbs"))
        parts.append(by_sku.withColumns({"distributor": F.lit(distributor), "sku_id": c.strip_decimal(F.col("sku_id"))}))
    joined = m.map_left(stack(*parts), hierarchy, {"sku_id": "product_code"}, ["format", "sub_format"])
    keys = [week, "format", "sub_format", "distributor"]
    return joined.dropna("any", subset=keys).groupBy(*keys).agg(F.sum("lbs").alias("lbs"))


def combined_sales(
    deliveries: DataFrame, skus: DataFrame, calendar: DataFrame, keep_sign: bool = True,
) -> DataFrame:
    """Weekly files as one table: first delivery of a week wins, maker SKU and week end looked up.

    ``deliveries`` has file_order, year_week, mfg_number and the text lb_current; ``skus`` has
    mfg_number, maker_sku_id and row_order (the last row of a key counts).
    """
    kept = first_file_wins(deliveries, "year_week")
    kept = kept.join(m.last_mapping(skus, "mfg_number", "maker_sku_id", "row_order"), "mfg_number", "left")
    weeks = calendar.select(F.col("calendar_week_year").alias("year_week"), "week_ending_sun").dropDuplicates(["year_week"])
    return kept.join(weeks, "year_week", "left").withColumn("lbs", c.digits_number(F.col("lb_current"), keep_sign))


def inventory(
    snapshots: DataFrame, skus: DataFrame, products: DataFrame, sales: DataFrame, attributes: Sequence[str],
) -> DataFrame:
    """Stock snapshots with week end, maker SKU, product category and sales-side attributes.

    ``snapshots`` has manufacturer_gtin and date. A SKU sold under several attribute combinations
    repeats its snapshot rows, as the left join always did.
    """
    df = snapshots.withColumn("week_ending_sun", d.sunday_on_or_after(F.col("date")))
    df = df.join(m.last_mapping(skus, "manufacturer_gtin", "maker_sku_id", "row_order"), "manufacturer_gtin", "left")
    # dealt out before the joins by SKU, the last of which multiplies rows
    df = dealt(df, "maker_sku_id").join(products, "maker_sku_id", "left")
    df = df.withColumn("consolidated_category", c.category_contains(F.col("category"), c.POTATO, keep_null=True))
    sold = sales.select("maker_sku_id", *attributes).dropna("any").distinct()
    return df.join(sold, "maker_sku_id", "left")


def fair_share(
    periods: Mapping[int, DataFrame], keys: Sequence[str], measures: Sequence[str],
    threshold_measure: str, threshold: float = 10000.0, threshold_key: str = "merch_category", keep_sign: bool = True,
) -> DataFrame:
    """Share files of several period lengths in one row per key, large categories only.

    Measures arrive as text with commas and dashes. Previous and current opportunity keep separate
    columns. ``threshold_measure`` is a measure of one period (``lb_category_current_52wk``): the totals
    that decide come from that period's file alone, and their keys are staged.
    """
    cleaned = {
        period: frame.withColumns({x: c.dash_number(F.col(x), keep_sign) for x in measures})
        for period, frame in periods.items()
    }
    columns = {f"{x}_{period}wk": (frame, x) for period, frame in cleaned.items() for x in measures}
    frame, measure = columns[threshold_measure]
    totals = frame.groupBy(threshold_key).agg(F.sum(measure).alias("_total")).filter(F.col("_total") > threshold)
    return m.combine_periods(cleaned, keys, measures).join(staged(totals.select(threshold_key)), threshold_key, "left_semi")


def fill_rate(
    orders: DataFrame, products: DataFrame, customers: DataFrame, since, orgs: Sequence[str],
    complete: str, document: str, channel: str,
) -> DataFrame:
    """Ordered and delivered cases by customer, product and week end (Saturday plus one day).

    ``orders`` has material_id, customer_id, org, channel, document_type, completion, issue_date,
    ordered and delivered.
    """
    product_keys = ("division", "category", "format", "sub_format", "material_id", "material")
    out = star_extract(
        orders,
        [Link(products, {"material_id": "material_id"}),
         Link(customers, {"customer_id": "customer_id", "org": "org", "channel": "channel"})],
        [F.col("completion") == complete, F.col("document_type") == document, F.col("channel") == channel,
         F.col("org").isin(*orgs), F.col("issue_date") > F.lit(since)],
        {"org": F.col("org"), "customer_l1": F.col("customer_l1"), "customer_l2": F.col("customer_l2"),
         **{k: F.col(k) for k in product_keys}, "week_ending": d.day_after_saturday(F.col("issue_date"))},
        {"ordered_cases": F.col("ordered").cast("double"), "delivered_cases": F.col("delivered").cast("double")},
    )
    return out.withColumn("category", c.category_contains(F.col("category"), c.POTATO))


def orders_by_week(orders: DataFrame, sold_to: str, org: str) -> DataFrame:
    """One customer's orders dated by week end and fiscal calendar.

    ``orders`` has sold_to, org, month_begin, order_date and delivered_lbs.
    """
    df = orders.filter((F.col("sold_to") == sold_to) & (F.col("org") == org))
    df = df.withColumn("week_ending_sun", d.sunday_on_or_after(F.col("order_date")))
    return d.with_fiscal(df, "month_begin")


def sellin_and_sellout_weeks(sellout: DataFrame, orders: DataFrame) -> DataFrame:
    """Weekly sell-out pounds beside delivered pounds."""
    out = sellout.groupBy("week_ending_sun").agg(F.sum("lbs").alias("lbs"))
    ordered = orders.groupBy("week_ending_sun").agg(F.sum("delivered_lbs").alias("delivered_lbs"))
    return out.join(ordered, "week_ending_sun", "full_outer")
