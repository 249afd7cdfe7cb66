"""Analytic core: densify, prior periods, windows, composed reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from weekmart.catalog.base import BEGIN, DIMS, END, analysis_ctes, analysis_sql, calendar, query, sellout, with_ctes
from weekmart.functions import clean as c
from weekmart.operators import series as s
from weekmart.operators.calendar import WEEK, add_calendar
from weekmart.plans import analysis as a
from weekmart.plans import incremental
from weekmart.session import staging_path

KEYS = "state, segment_l1, calendar_week_year"
GRAIN = f"grain AS (SELECT {KEYS}, coalesce(sum(lbs), 0) AS lbs FROM sellout GROUP BY {KEYS})"
DENSE = f"""{GRAIN},
dense AS (
  SELECT s.state, s.segment_l1, w.calendar_week_year, coalesce(g.lbs, 0) AS lbs
  FROM (SELECT DISTINCT state, segment_l1 FROM grain WHERE state IS NOT NULL AND segment_l1 IS NOT NULL) s
  CROSS JOIN (SELECT DISTINCT calendar_week_year FROM grain) w
  LEFT JOIN grain g USING (state, segment_l1, calendar_week_year))"""
WALK = "PARTITION BY state, segment_l1 ORDER BY calendar_week_year"


def analyzed(spark, sf, **options):
    return a.analyze(sellout(spark, sf), DIMS, calendar(spark), BEGIN, END, **options)


def pick(*columns):
    """Query and SQL for some columns of the analysis."""
    names = ", ".join(columns)
    return (lambda spark, sf: analyzed(spark, sf).select(*DIMS, WEEK, *columns),
            analysis_sql(DIMS, f"SELECT {KEYS}, {names} FROM analyzed"))


@query("a1_densify", with_ctes(["sellout"], DENSE, select="SELECT * FROM dense"))
def densify(spark, sf):
    return s.densify(sellout(spark, sf), DIMS)


@query("a1b_densify_null_city", with_ctes(["sellout"], """
grain AS (SELECT coalesce(segment_l1, 'NA') AS city, state, calendar_week_year, sum(lbs) AS lbs FROM sellout GROUP BY ALL),
dense AS (
  SELECT s.city, s.state, w.calendar_week_year, coalesce(g.lbs, 0) AS lbs
  FROM (SELECT DISTINCT city, state FROM grain) s CROSS JOIN (SELECT DISTINCT calendar_week_year FROM grain) w
  LEFT JOIN grain g USING (city, state, calendar_week_year))""", select="SELECT * FROM dense"))
def densify_null_city(spark, sf):
    return s.densify(sellout(spark, sf).withColumnRenamed("segment_l1", "city"), ["city", "state"])


@query("a2_sum_to_grain", with_ctes(["sellout"], GRAIN, select="SELECT * FROM grain"))
def sum_to_grain(spark, sf):
    return s.sum_to_grain(sellout(spark, sf), DIMS)


PRIOR = with_ctes(["sellout", "calendar"], GRAIN, select="""
SELECT g.*, {columns} FROM grain g LEFT JOIN calendar c USING (calendar_week_year)
LEFT JOIN grain y ON y.state = g.state AND y.segment_l1 IS NOT DISTINCT FROM g.segment_l1 AND y.calendar_week_year = c.yoy_week
LEFT JOIN grain b ON b.state = g.state AND b.segment_l1 IS NOT DISTINCT FROM g.segment_l1 AND b.calendar_week_year = c.baseline_week""")


@query("a3_last_year", PRIOR.replace("{columns}", "y.lbs AS lbs_ly"))
def last_year(spark, sf):
    return s.add_prior_periods(sellout(spark, sf), DIMS, calendar(spark), {"lbs_ly": "yoy_week"})


@query("a4_baseline_year", PRIOR.replace("{columns}", "b.lbs AS lbs_baseline"))
def baseline_year(spark, sf):
    return s.add_prior_periods(sellout(spark, sf), DIMS, calendar(spark), {"lbs_baseline": "baseline_week"})


@query("a5_lags", with_ctes(["sellout"], DENSE, select="SELECT *, " + ", ".join(
    f"lag(lbs, {k}) OVER ({WALK}) AS lbs_lag_{k}" for k in (1, 2, 3, 4)) + " FROM dense"))
def lags(spark, sf):
    dense = s.densify(sellout(spark, sf), DIMS)
    return dense.withColumns(s.lag_columns(DIMS, WEEK, {f"lbs_lag_{k}": ("lbs", k) for k in (1, 2, 3, 4)}))


@query("a6_moving_average", with_ctes(["sellout"], DENSE, select="SELECT *, " + ", ".join(
    f"avg(lbs) OVER ({WALK} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sma_{n}" for n in (4, 8, 12)) + " FROM dense"))
def moving_average(spark, sf):
    dense = s.densify(sellout(spark, sf), DIMS)
    return dense.withColumns(s.average_columns(DIMS, WEEK, {f"sma_{n}": ("lbs", n) for n in (4, 8, 12)}))


for name, columns in {
    "a7_moving_average_last_year": ("lbs_ly", "sma_4_ly", "sma_8_ly", "sma_12_ly"),
    "a8_moving_average_baseline": ("lbs_baseline", "sma_4_baseline", "sma_8_baseline", "sma_12_baseline"),
    "a9_prior_lags": ("lbs_baseline_lag_1", "lbs_ly_lag_1"),
    "a10_average_lags": ("sma_4_lag_1", "sma_4_ly_lag_1", "sma_4_baseline_lag_1"),
}.items():
    run, sql = pick(*columns)
    query(name, sql)(run)


@query("a11_preperiod_average", with_ctes(["sellout"], DENSE, select=f"""
SELECT *, coalesce(sum(CASE WHEN calendar_week_year BETWEEN {BEGIN} AND {END} THEN lbs END)
  OVER (PARTITION BY state, segment_l1) / 52, 0) AS lbs_precovid FROM dense"""))
def preperiod_average(spark, sf):
    return s.add_preperiod(s.densify(sellout(spark, sf), DIMS), DIMS, BEGIN, END)


ATTRIBUTES = ("yoy_week", "baseline_week", "week_starting_sun", "week_ending_sat", "covid_week")


@query("a12_attach_calendar", with_ctes(["sellout", "calendar"], GRAIN, select=f"""
SELECT g.*, {', '.join(ATTRIBUTES)} FROM grain g LEFT JOIN calendar USING (calendar_week_year)"""))
def attach_calendar(spark, sf):
    return add_calendar(s.sum_to_grain(sellout(spark, sf), DIMS), calendar(spark), ATTRIBUTES)


@query("a13_round_half_even", with_ctes(["sellout"], GRAIN, select=f"""
SELECT {KEYS}, round_even(CAST(lbs / 8 AS DOUBLE), 2) AS lbs FROM grain"""))
def round_half_even(spark, sf):
    eighth = s.sum_to_grain(sellout(spark, sf), DIMS).withColumn("lbs", F.col("lbs") / 8)
    return a.round_measures(eighth, ["lbs"])


@query("a14_fill_nulls", with_ctes(["sellout"], DENSE, select=f"""
SELECT *, coalesce(lag(lbs) OVER ({WALK}), 0) AS lbs_lag_1, coalesce(lag(lbs) OVER ({WALK}), 2) AS lbs_ly_lag_1 FROM dense"""))
def fill_nulls(spark, sf):
    dense = s.densify(sellout(spark, sf), DIMS)
    return a.fill_measures(dense.withColumns(
        s.lag_columns(DIMS, WEEK, {"lbs_lag_1": ("lbs", 1), "lbs_ly_lag_1": ("lbs", 1)})))


@query("a15_analyze", analysis_sql(DIMS, "SELECT * FROM analyzed"))
def analyze(spark, sf):
    return analyzed(spark, sf)


@query("a15_incremental", analysis_sql(DIMS, "SELECT * FROM analyzed"))
def analyze_incrementally(spark, sf):
    """The first load lacks a week, has another with wrong volumes and one that should not be; the redelivery corrects all three."""
    fact = sellout(spark, sf).select(*DIMS, WEEK, "lbs")
    path = staging_path(spark, "a15-state")
    wrong = fact.withColumn("lbs", F.when(F.col(WEEK) == 199810, F.col("lbs") * 3).otherwise(F.col("lbs"))).filter(F.col(WEEK) != 199820)
    extra = fact.filter(F.col(WEEK) == 199805).withColumn(WEEK, F.lit(199866))
    options = {"begin": BEGIN, "end": END}
    incremental.refresh(wrong.unionByName(extra), path, DIMS, calendar(spark), **options)
    incremental.refresh(fact.filter(F.col(WEEK).isin(199810, 199820)), path, DIMS, calendar(spark), [199810, 199820, 199866], **options)
    return incremental.read_report(spark, path)


@query("a15b_analyze_observed", analysis_sql(DIMS, "SELECT * FROM analyzed", dense=False))
def analyze_observed(spark, sf):
    return analyzed(spark, sf, densify=False)


LABELS = {"1-URGENT": "IO", "2-HIGH": "Chain", "3-MEDIUM": "Chain"}
RELABEL = "CASE segment_l2 WHEN '1-URGENT' THEN 'IO' WHEN '2-HIGH' THEN 'Chain' WHEN '3-MEDIUM' THEN 'Chain' ELSE segment_l2 END"


@query("a16_relabel_segments", with_ctes(["sellout"], select=f"""
SELECT {RELABEL} AS segment_l2, calendar_week_year, sum(lbs) AS lbs FROM sellout GROUP BY segment_l2, calendar_week_year"""))
def relabel_segments(spark, sf):
    return c.relabel(s.sum_to_grain(sellout(spark, sf), ["segment_l2"]), "segment_l2", LABELS)


SPEC = a.ReportSpec(begin=BEGIN, end=END, label="Returns", segment_labels=LABELS)


@query("a17_segment_report", analysis_sql(
    ["state", "segment_l2"], f"SELECT * REPLACE ({RELABEL} AS segment_l2), 'Returns' AS distributor FROM analyzed"))
def segment_report(spark, sf):
    return a.segment_report(sellout(spark, sf), ["state", "segment_l2"], calendar(spark), SPEC)


@query("a18_manufacturer_report", analysis_sql(
    ["segment_l2", "category"], "SELECT *, 'US' AS country FROM analyzed",
    week_columns=("week_starting_mon", "week_ending_sun")))
def manufacturer_report(spark, sf):
    spec = a.ReportSpec(begin=BEGIN, end=END, label="US")
    return a.manufacturer_report(sellout(spark, sf), ["segment_l2", "category"], calendar(spark), spec)


@query("a19_share_of_week", analysis_sql(["brand"], """
SELECT *, 'US' AS country, lbs / nullif(sum(lbs) OVER (PARTITION BY calendar_week_year), 0) AS wt FROM analyzed""",
    week_columns=("week_starting_mon", "week_ending_sun")))
def share_of_week(spark, sf):
    spec = a.ReportSpec(begin=BEGIN, end=END, label="US", share=True)
    return a.manufacturer_report(sellout(spark, sf), ["brand"], calendar(spark), spec)


@query("a19_share_of_total", with_ctes(["sellout"], GRAIN, select="""
SELECT *, lbs / nullif(sum(lbs) OVER (PARTITION BY calendar_week_year, state), 0) AS wt FROM grain"""))
def share_of_total(spark, sf):
    return s.add_share(s.sum_to_grain(sellout(spark, sf), DIMS), [WEEK, "state"])


@query("a20_last_weeks", with_ctes(["sellout"], GRAIN, select="""
SELECT * FROM grain WHERE calendar_week_year IN (SELECT DISTINCT calendar_week_year FROM grain ORDER BY 1 DESC LIMIT 26)"""))
def last_weeks(spark, sf):
    return s.last_weeks(s.sum_to_grain(sellout(spark, sf), DIMS), 26)


@query("a20_last_26_weeks", analysis_sql(["brand", "category"], """
SELECT *, 'Returns' AS distributor FROM analyzed WHERE calendar_week_year IN (
  SELECT DISTINCT calendar_week_year FROM analyzed ORDER BY 1 DESC LIMIT 26)"""))
def last_26_weeks(spark, sf):
    spec = a.ReportSpec(begin=BEGIN, end=END, label="Returns", last_weeks=26, segment_column=None)
    return a.segment_report(sellout(spark, sf), ["brand", "category"], calendar(spark), spec)


GRAINS = {"region": ["state", "segment_l2"], "product": ["brand", "category"], "distributor": ["distributor"]}
GRAIN_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS grain, concat_ws('|', {', '.join(dims)}) AS segment, calendar_week_year, lbs, sma_12, lbs_ly, "
    f"lbs_baseline, lbs_precovid FROM analyzed_{name}" for name, dims in GRAINS.items())


@query("a21_several_grains", with_ctes(
    ["sellout", "calendar"], *[analysis_ctes(dims, tag=f"_{name}") for name, dims in GRAINS.items()], select=GRAIN_SQL))
def several_grains(spark, sf):
    spec = a.ReportSpec(begin=BEGIN, end=END, label_column="source", label="Returns", segment_column=None)
    reports = a.several_grains(sellout(spark, sf), GRAINS, calendar(spark), spec)
    parts = [
        report.select(F.lit(name).alias("grain"), F.concat_ws("|", *GRAINS[name]).alias("segment"), WEEK, "lbs",
                      "sma_12", "lbs_ly", "lbs_baseline", "lbs_precovid")
        for name, report in reports.items()
    ]
    return reduce(lambda x, y: x.unionByName(y), parts)
