"""The whole weekly run of one distributor, for each delivery layout."""

from __future__ import annotations

import datetime
from functools import partial, reduce

from pyspark.sql import functions as F

from weekmart.catalog import mappings as k
from weekmart.catalog.base import BEGIN, END, analysis_ctes, calendar, iso, query, with_ctes
from weekmart.catalog.mappings import (
    MAPPED, PRODUCT_SQL, RAW, REGIONAL_LABELS, product_map, raw_lines, regional_segments, short_calendar,
)
from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.operators.calendar import WEEK
from weekmart.plans import conform, models
from weekmart.plans.analysis import ReportSpec

GRAINS = {"region": ["state_name", "segment_l1", "consolidated_category"], "product": ["l2_product", "segment_l2"]}
COLUMNS = ("city", "state", "state_name", *conform.SEGMENT_LABELS, *conform.PRODUCT_LABELS, WEEK, "lbs")
HISTORY = f"""
labelled AS (SELECT *, CASE WHEN {MAPPED} THEN coalesce(market_segment, 'NONE') END AS seg FROM raw WHERE sun_week IS NOT NULL),
delivered AS (
  SELECT {REGIONAL_LABELS}, {PRODUCT_SQL}, state_name, sun_week AS calendar_week_year, l_quantity AS lbs
  FROM labelled LEFT JOIN states ON states.state = labelled.state),
history AS (
  SELECT * REPLACE (CASE WHEN calendar_week_year <= 199752 THEN lbs * 2 ELSE lbs END AS lbs) FROM delivered)"""


@query("r1_distributor_model", with_ctes(
    ["lines", "calendar"], RAW, HISTORY, *[analysis_ctes(dims, "history", tag=f"_{name}") for name, dims in GRAINS.items()],
    select=" UNION ALL ".join(
        f"SELECT '{name}' AS report, concat_ws('|', {', '.join(dims)}) AS segment, a.calendar_week_year, lbs, sma_8, lbs_ly, lbs_baseline, "
        f"lbs_precovid, 'Regional' AS distributor FROM analyzed_{name} a" for name, dims in GRAINS.items())))
def distributor_model(spark, sf):
    """Older weeks come from the stored history (with other volumes), newer ones from the delivery."""
    raw = raw_lines(spark, sf).select(
        F.col("market_segment").alias("business_unit"), F.col("o_orderpriority").alias("sic_code"),
        F.col("o_orderstatus").alias("sic_sub"), F.col("n_name").alias("customer_city"), F.col("state").alias("customer_state"),
        F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("sku_id"),
        d.sunday_on_or_before(F.col("order_date")).cast("string").alias("week_beginning_date"),
        F.col("l_quantity").cast("string").alias("lbs"))
    maps = conform.Dictionaries(segments=regional_segments(spark, sf), products=product_map(spark, sf))
    model = models.DistributorModel(
        conform.conform_regional_us, COLUMNS, GRAINS, ReportSpec(BEGIN, END, label="Regional", segment_column=None),
        ("business_unit", "sic_code", "sic_sub"), ("sku_id",))
    calendar = short_calendar(spark)
    first_new = F.lit("1997-12-28")
    stored = conform.conform_regional_us(raw, maps, calendar).select(*COLUMNS).withColumn("lbs", F.col("lbs") * 2)
    out = models.run_model(model, raw.filter(F.col("week_beginning_date") >= first_new), maps, calendar, base=stored)
    parts = [
        out[name].select(F.lit(name).alias("report"), F.concat_ws("|", *dims).alias("segment"), WEEK, "lbs", "sma_8", "lbs_ly",
                         "lbs_baseline", "lbs_precovid", "distributor")
        for name, dims in GRAINS.items()
    ]
    return parts[0].unionByName(parts[1])


# --- every output of a run, other layouts --------------------------------------------------------

AS_OF = datetime.date(2000, 1, 3)
US_COLUMNS = ("city", "state", "state_name", *conform.SEGMENT_LABELS[:5], *conform.PRODUCT_LABELS, WEEK, "lbs")
CANADA_COLUMNS = ("province_clean", "city", *conform.CANADA_LABELS, "consolidated_category", WEEK, "lbs")
US_GRAIN, CANADA_GRAIN = ("state_name", "segment_l1", "consolidated_category"), ("province_clean", "segment_l1")
PRODUCT_CATEGORY = "CASE WHEN p_size > 3 THEN CASE WHEN p_type LIKE 'PROMO%' THEN 'Potato' ELSE 'Prepared Foods' END END"


def run_sql(delivered, is_new, before, value, category, columns, grain, segment_keys, product_keys=()):
    """Rows of every output. ``is_new`` tells the delivery in conformed rows, ``before`` in raw ones."""
    def unmapped(name, label, keys):
        return f"""
SELECT '{name}', concat_ws('|', {', '.join(keys)}), NULL, NULL, sum(lbs), NULL, 'Model 2000-01-03' FROM new WHERE {label} IS NULL
GROUP BY {', '.join(keys)}"""
    whole = " AND ".join(f"{c} IS NOT NULL" for c in grain)
    parts = [f"""
SELECT 'history' AS report, concat_ws('|', {', '.join(grain)}) AS segment, calendar_week_year, count(*) AS rows, sum(lbs) AS lbs,
  NULL::DOUBLE AS other, NULL::VARCHAR AS source FROM history GROUP BY {', '.join(grain)}, calendar_week_year""", f"""
SELECT 'region', concat_ws('|', {', '.join(grain)}), a.calendar_week_year, NULL, lbs, sma_8, 'Model' FROM analyzed_region a""", """
SELECT 'sellin_and_sellout', consolidated_category, o.calendar_week_year, NULL, o.lbs, coalesce(i.lbs, 0), 'Model'
FROM analyzed_out o LEFT JOIN analyzed_in i USING (calendar_week_year, consolidated_category)""", f"""
SELECT 'totals', 'before', NULL, count(*), sum({value}), NULL, NULL FROM raw WHERE {before}""", """
SELECT 'totals', 'after', NULL, count(*), sum(lbs), NULL, NULL FROM new""", f"""
SELECT 'totals', stage, NULL, count(*) FILTER (part), coalesce(sum(lbs) FILTER (part), 0), NULL, NULL FROM (
  SELECT lbs, unnest(['history', 'without week', 'incomplete region', 'analyzed region']) AS stage,
    unnest([true, calendar_week_year IS NULL, calendar_week_year IS NOT NULL AND NOT ({whole}), calendar_week_year IS NOT NULL AND {whole}]) AS part
  FROM history) GROUP BY stage""", """
SELECT 'invalid_weeks', '', calendar_week_year, count(*), coalesce(sum(lbs), 0), NULL, NULL FROM history
WHERE calendar_week_year IS NULL OR calendar_week_year < 100001 GROUP BY calendar_week_year""", f"""
SELECT 'incomplete_segments', 'region|' || concat_ws(', ', {', '.join(f"'{c}=' || coalesce({c}, '?')" for c in grain)}), NULL, count(*), coalesce(sum(lbs), 0), NULL, NULL
FROM history WHERE calendar_week_year IS NOT NULL AND NOT ({whole}) GROUP BY {', '.join(grain)}""", unmapped("unmapped_segments", "segment_l1", segment_keys)]
    if product_keys:
        parts.append(unmapped("unmapped_products", "consolidated_category", product_keys))
    return with_ctes(
        ["lines", "calendar"], RAW, f"delivered AS ({delivered})", f"new AS (SELECT * FROM delivered WHERE {is_new})", f"""
stored AS (
  SELECT {', '.join(c for c in columns[:-1] if c != WEEK)}, CASE WHEN lbs IN (1, 10) THEN 0 ELSE calendar_week_year END AS calendar_week_year, lbs * 2 AS lbs
  FROM delivered),
history AS (
  SELECT {', '.join(columns)} FROM stored
  WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.calendar_week_year IS NOT DISTINCT FROM stored.calendar_week_year)
  UNION ALL SELECT {', '.join(columns)} FROM new)""",
        f"sellin AS (SELECT CASE WHEN l_linenumber = 7 THEN 0 ELSE {iso('ship_date')} END AS calendar_week_year, {category} AS consolidated_category, l_quantity AS lbs FROM raw)",
        analysis_ctes(list(grain), "history", tag="_region"), analysis_ctes(["consolidated_category"], "history", tag="_out"),
        analysis_ctes(["consolidated_category"], "sellin", tag="_in"), select=" UNION ALL ".join(parts))


def whole_run(spark, sf, plan, raw, maps, weeks, is_new, category, columns, grain, segment_keys, product_keys=(), raw_value="lbs"):
    """Every output of a run in one frame: the weeks of the delivery replace those of a stored history with other volumes.

    Some stored rows and some sell-in are in a week 0, which is analyzed like others.
    """
    model = models.DistributorModel(
        plan, columns, {"region": grain}, ReportSpec(BEGIN, END, label="Model", segment_column=None), segment_keys, product_keys, raw_value)
    stored = plan(raw, maps, weeks).select(*columns).withColumns({
        WEEK: F.when(F.col("lbs").isin(1, 10), 0).otherwise(F.col(WEEK)), "lbs": F.col("lbs") * 2})
    sellin = raw_lines(spark, sf).select(
        F.when(F.col("l_linenumber") == 7, 0).otherwise(d.iso_week_key(F.col("ship_date"))).alias(WEEK), category.alias("consolidated_category"), F.col("l_quantity").alias("lbs"))
    out = models.run_model(model, raw.filter(is_new), maps, weeks, stored, sellin, AS_OF)
    history = out["history"].groupBy(*grain, WEEK).agg(F.count("*").alias("rows"), F.sum("lbs").alias("lbs"))
    dated = F.concat_ws(" ", "source", F.col("report_date").cast("string"))

    def part(name, df, keys, week=F.lit(None), rows=F.lit(None), other=F.lit(None), source=F.lit(None)):
        return df.select(
            F.lit(name).alias("report"), F.concat_ws("|", *keys).alias("segment"), week.cast("int").alias(WEEK), rows.cast("long").alias("rows"),
            "lbs", other.cast("double").alias("other"), source.cast("string").alias("source"))

    week = F.col(WEEK)
    parts = [
        part("history", history, grain, week, F.col("rows")),
        part("region", out["region"], grain, week, other=F.col("sma_8"), source=F.col("distributor")),
        part("sellin_and_sellout", out["sellin_and_sellout"], ["consolidated_category"], week, other=F.col("sellin_lbs"), source=F.col("distributor")),
        part("totals", out["totals"].unionByName(out["analyzed_totals"]), ["stage"], rows=F.col("rows")),
        part("invalid_weeks", out["invalid_weeks"], [F.lit("")], week, F.col("rows")),
        part("incomplete_segments", out["incomplete_segments"], [F.concat_ws("|", "grain", "segment")], rows=F.col("rows")),
        part("unmapped_segments", out["unmapped_segments"], segment_keys, source=dated),
    ]
    if product_keys:
        parts.append(part("unmapped_products", out["unmapped_products"], product_keys, source=dated))
    return reduce(lambda a, b: a.unionByName(b), parts)


def product_category():
    return F.when(F.col("p_size") > 3, c.category_prefix(F.col("p_type"), "PROMO"))


REPORT_KEYS, WEEKLY_KEYS, CANADA_KEYS = ("customer_class", "segment", "account_type"), ("pyramid_segment",), ("sector", "segment", "subsegment")


@query("r2_national_report_model", run_sql(
    k.REPORT.replace("{copies}", "").replace("{where}", "AND p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')"),
    "invoice_week >= DATE '1997-12-29'", "monday >= DATE '1997-12-29'", "CASE WHEN l_discount > 0 THEN l_quantity * 10 ELSE 0 END",
    PRODUCT_CATEGORY, US_COLUMNS, US_GRAIN, REPORT_KEYS, ("sku_id",)))
def national_report_model(spark, sf):
    maps = conform.Dictionaries(k.report_segments(spark, sf), k.report_products(spark, sf), k.manufacturers(spark, sf))
    return whole_run(
        spark, sf, conform.conform_national_report, k.report_raw(spark, sf), maps, short_calendar(spark), "invoice_week >= '1997-12-29'",
        product_category(), US_COLUMNS, US_GRAIN, REPORT_KEYS, ("sku_id",), "weight")


@query("r3_national_weekly_model", run_sql(
    k.WEEKLY, "calendar_week_year > 199752 OR calendar_week_year IS NULL", "sunday >= DATE '1997-12-28'", "l_quantity",
    PRODUCT_CATEGORY, US_COLUMNS, US_GRAIN, WEEKLY_KEYS, ("maker_sku_id",)))
def national_weekly_model(spark, sf):
    maps = conform.Dictionaries(k.weekly_segments(spark, sf), product_map(spark, sf, "maker_sku_id"))
    return whole_run(
        spark, sf, conform.conform_national_weekly, k.weekly_raw(spark, sf), maps, short_calendar(spark), "week_beginning_date >= '1997-12-28'",
        product_category(), US_COLUMNS, US_GRAIN, WEEKLY_KEYS, ("maker_sku_id",))


@query("r4_canada_one_file_model", run_sql(
    k.CANADA_ONE, "fiscal_week >= 199801", "year(order_date) >= 1998", "l_quantity", "p_type", CANADA_COLUMNS, CANADA_GRAIN, CANADA_KEYS))
def canada_one_file_model(spark, sf):
    return whole_run(
        spark, sf, partial(conform.conform_canada_one_file, cities=k.CITIES), k.canada_one_raw(spark, sf), k.old_canada_maps(spark, sf),
        calendar(spark), "fiscal_week >= 199801", F.col("p_type"), CANADA_COLUMNS, CANADA_GRAIN, CANADA_KEYS, raw_value="volume_lbs")


@query("r5_canada_two_file_model", run_sql(
    k.CANADA_TWO, "fiscal_year >= 1998", "year(order_date) >= 1998", "l_quantity", "'Prepared Foods'", CANADA_COLUMNS, CANADA_GRAIN, CANADA_KEYS))
def canada_two_file_model(spark, sf):
    return whole_run(
        spark, sf, partial(conform.conform_canada_two_file, cities=k.CITIES), k.canada_two_raw(spark, sf), k.old_canada_maps(spark, sf),
        calendar(spark), "fiscal_year >= 1998", F.lit("Prepared Foods"), CANADA_COLUMNS, CANADA_GRAIN, CANADA_KEYS, raw_value="total_lbs")
