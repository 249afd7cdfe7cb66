"""History merge over two overlapping deliveries of the sell-out fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekmart.catalog.base import query, sellout, with_ctes
from weekmart.operators import history as h
from weekmart.operators import mapping as m
from weekmart.operators import metrics as g
from weekmart.operators.calendar import WEEK

# base: weeks to 1999-26 as first delivered; new: weeks from 1998-26, every value delivered again as double
SLICES = """
base AS (SELECT state, calendar_week_year, lbs FROM sellout WHERE calendar_week_year <= 199926),
newer AS (SELECT state, calendar_week_year, lbs * 2 AS lbs FROM sellout WHERE calendar_week_year >= 199826)"""
BY_WEEK = "SELECT state, calendar_week_year, count(*) AS rows, sum(lbs) AS lbs FROM ({}) GROUP BY ALL"


def slices(spark, sf):
    rows = sellout(spark, sf).select("state", WEEK, "lbs")
    base = rows.filter(F.col(WEEK) <= 199926)
    newer = rows.filter(F.col(WEEK) >= 199826).withColumn("lbs", F.col("lbs") * 2)
    return base, newer


def by_week(df):
    return df.groupBy("state", WEEK).agg(F.count("*").alias("rows"), F.sum("lbs").alias("lbs"))


@query("h1_replace_weeks", with_ctes(["sellout"], SLICES, select=BY_WEEK.format("""
SELECT * FROM base WHERE calendar_week_year NOT IN (SELECT calendar_week_year FROM newer) UNION ALL SELECT * FROM newer""")))
def replace_weeks(spark, sf):
    return by_week(h.replace_weeks(*slices(spark, sf)))


@query("h2_replace_recent_weeks", with_ctes(["sellout"], SLICES, select=BY_WEEK.format("""
SELECT state, calendar_week_year, lbs FROM sellout WHERE calendar_week_year NOT IN (SELECT DISTINCT calendar_week_year FROM newer
  ORDER BY 1 DESC LIMIT 12) UNION ALL SELECT * FROM newer""")))
def replace_recent_weeks(spark, sf):
    """The whole fact as the base, so that the 12 latest delivered weeks are in it."""
    newer = slices(spark, sf)[1]
    return by_week(h.replace_recent_weeks(sellout(spark, sf).select("state", WEEK, "lbs"), newer))


# a fifth of the deliveries has lost its week; the delivery comes twice
LOST = """
lost AS (SELECT state, CASE WHEN sku_id % 5 <> 0 THEN calendar_week_year END AS calendar_week_year, lbs FROM sellout)"""


@query("h1_replace_weeks_without_key", with_ctes(["sellout"], LOST, select=BY_WEEK.format("""
SELECT state, calendar_week_year, lbs * 2 AS lbs FROM lost WHERE calendar_week_year >= 199826 OR calendar_week_year IS NULL
UNION ALL SELECT * FROM lost WHERE calendar_week_year < 199826""")))
def replace_weeks_without_key(spark, sf):
    known = F.when(F.col("sku_id") % 5 != 0, F.col(WEEK))
    rows = sellout(spark, sf).select("state", known.alias(WEEK), "lbs")
    newer = rows.filter((F.col(WEEK) >= 199826) | F.col(WEEK).isNull()).withColumn("lbs", F.col("lbs") * 2)
    return by_week(h.replace_weeks(h.replace_weeks(rows, newer), newer))


FILES = """
files AS (
  SELECT state, calendar_week_year, lbs, 1 AS file_order FROM sellout WHERE calendar_week_year <= 199726
  UNION ALL SELECT state, calendar_week_year, lbs * 2, 2 FROM sellout WHERE calendar_week_year BETWEEN 199710 AND 199926
  UNION ALL SELECT state, calendar_week_year, lbs * 3, 3 FROM sellout WHERE calendar_week_year >= 199901)"""
WINS = """
SELECT file_order, calendar_week_year, count(*) AS rows, sum(lbs) AS lbs FROM files f
JOIN (SELECT calendar_week_year, {}(file_order) AS file_order FROM files GROUP BY 1) USING (calendar_week_year, file_order) GROUP BY ALL"""


def files(spark, sf):
    rows = sellout(spark, sf).select("state", WEEK, "lbs")
    week, lbs = F.col(WEEK), F.col("lbs")
    return h.stack(
        rows.filter(week <= 199726).withColumn("file_order", F.lit(1)),
        rows.filter(week.between(199710, 199926)).withColumns({"lbs": lbs * 2, "file_order": F.lit(2)}),
        rows.filter(week >= 199901).withColumns({"lbs": lbs * 3, "file_order": F.lit(3)}))


def by_file(df):
    return df.groupBy("file_order", WEEK).agg(F.count("*").alias("rows"), F.sum("lbs").alias("lbs"))


@query("h3_latest_file_wins", with_ctes(["sellout"], FILES, select=WINS.format("max")))
def latest_file_wins(spark, sf):
    return by_file(h.latest_file_wins(files(spark, sf)))


@query("h4_first_file_wins", with_ctes(["sellout"], FILES, select=WINS.format("min")))
def first_file_wins(spark, sf):
    return by_file(h.first_file_wins(files(spark, sf)))


@query("h5_bag_union", with_ctes(["sellout"], SLICES, select="""
SELECT state, calendar_week_year, source, count(*) AS rows, sum(lbs) AS lbs FROM (
  SELECT *, NULL::VARCHAR AS source FROM base UNION ALL SELECT *, 'new' FROM newer) GROUP BY ALL"""))
def bag_union(spark, sf):
    base, newer = slices(spark, sf)
    out = h.stack(base, newer.withColumn("source", F.lit("new")))
    return out.groupBy("state", WEEK, "source").agg(F.count("*").alias("rows"), F.sum("lbs").alias("lbs"))


def listing(spark, sf):
    return sellout(spark, sf).filter("brand = 'Brand#5'").select("segment_l1").filter("segment_l1 < 'H'").distinct()


@query("h6_listed_rows", with_ctes(["sellout"], select="""
SELECT segment_l1, sum(lbs) AS lbs FROM sellout WHERE segment_l1 IN (
  SELECT segment_l1 FROM sellout WHERE brand = 'Brand#5' AND segment_l1 < 'H') GROUP BY 1"""))
def listed_rows(spark, sf):
    return m.keep_listed(sellout(spark, sf), listing(spark, sf), "segment_l1").groupBy("segment_l1").agg(F.sum("lbs").alias("lbs"))


@query("h6_unlisted_rows", with_ctes(["sellout"], select="""
SELECT segment_l1, sum(lbs) AS lbs FROM sellout s WHERE NOT EXISTS (
  SELECT 1 FROM sellout t WHERE t.brand = 'Brand#5' AND t.segment_l1 < 'H' AND t.segment_l1 = s.segment_l1) GROUP BY 1"""))
def unlisted_rows(spark, sf):
    return m.drop_listed(sellout(spark, sf), listing(spark, sf), "segment_l1").groupBy("segment_l1").agg(F.sum("lbs").alias("lbs"))


@query("h7_side_by_side", with_ctes(["sellout"], select="""
SELECT a.brand AS top_brand, a.lbs AS brand_lbs, b.state AS top_state, b.lbs AS state_lbs
FROM (SELECT *, row_number() OVER (ORDER BY lbs DESC, brand) AS n FROM (SELECT brand, sum(lbs) AS lbs FROM sellout GROUP BY 1)) a
JOIN (SELECT *, row_number() OVER (ORDER BY lbs DESC, state) AS n FROM (SELECT state, sum(lbs) AS lbs FROM sellout GROUP BY 1)) b
USING (n) WHERE n <= 10"""))
def side_by_side(spark, sf):
    rows = sellout(spark, sf)
    brands = g.top_sums(rows, ["brand"], "lbs", 10).select(
        F.col("brand").alias("top_brand"), F.col("lbs").alias("brand_lbs"), F.struct(-F.col("lbs"), "brand").alias("_a"))
    states = g.top_sums(rows, ["state"], "lbs", 10).select(
        F.col("state").alias("top_state"), F.col("lbs").alias("state_lbs"), F.struct(-F.col("lbs"), "state").alias("_b"))
    return h.side_by_side(brands, states, "_a", "_b", 10).drop("_a", "_b")
