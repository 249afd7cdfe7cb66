"""Aggregates, profiles, rankings and change metrics over the sell-out fact and the events."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from weekmart.catalog.base import query, sellout, table, with_ctes
from weekmart.operators import metrics as g
from weekmart.operators import series as s
from weekmart.operators.calendar import WEEK


def over_sellout(select):
    return with_ctes(["sellout"], select=select)


@query("g1_sum_without_null_keys", over_sellout("""
SELECT segment_l1, distributor, sum(lbs) AS lbs FROM sellout WHERE segment_l1 IS NOT NULL GROUP BY ALL"""))
def sum_without_null_keys(spark, sf):
    return g.sum_by(sellout(spark, sf), ["segment_l1", "distributor"], "lbs", keep_null=False)


@query("g2_sum_with_null_keys", over_sellout("SELECT segment_l1, distributor, sum(lbs) AS lbs FROM sellout GROUP BY ALL"))
def sum_with_null_keys(spark, sf):
    return g.sum_by(sellout(spark, sf), ["segment_l1", "distributor"], "lbs")


@query("g3_freshness", over_sellout('SELECT distributor, min(ship_date) AS "min", max(ship_date) AS "max" FROM sellout GROUP BY 1'))
def freshness(spark, sf):
    return g.span(sellout(spark, sf), "ship_date", ["distributor"])


@query("g4_value_counts", over_sellout("SELECT segment_l1, count(*) AS rows FROM sellout WHERE segment_l1 IS NOT NULL GROUP BY 1"))
def value_counts(spark, sf):
    return g.value_counts(sellout(spark, sf), "segment_l1")


@query("g4_value_counts_with_null", over_sellout("SELECT segment_l1, count(*) AS rows FROM sellout GROUP BY 1"))
def value_counts_with_null(spark, sf):
    return g.value_counts(sellout(spark, sf), "segment_l1", keep_null=True)


PROFILED = ("event_id", "user_id", "event_type", "props", "value", "ts", "day")


@query("g5_profile_columns", " UNION ALL ".join(
    f"SELECT '{x}' AS \"column\", {x}::VARCHAR AS value, count(*) AS rows FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY 2"
    for x in PROFILED))
def profile_columns(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return g.profile(events, PROFILED)


@query("g6_row_count", over_sellout("SELECT count(*) AS rows FROM sellout"))
def row_count(spark, sf):
    return g.row_count(sellout(spark, sf))


@query("g6_describe", """
SELECT 'l_quantity' AS "column", count(*) AS count, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
  min(l_quantity) AS "min", quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50,
  quantile_cont(l_quantity, 0.75) AS q75, max(l_quantity) AS "max" FROM lineitem
UNION ALL SELECT 'l_linenumber', count(*), round(avg(l_linenumber), 6), round(stddev_samp(l_linenumber), 6), min(l_linenumber),
  quantile_cont(l_linenumber::DOUBLE, 0.25), quantile_cont(l_linenumber::DOUBLE, 0.5), quantile_cont(l_linenumber::DOUBLE, 0.75), max(l_linenumber)
FROM lineitem""")
def describe(spark, sf):
    out = g.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_linenumber"])
    return out.withColumns({x: F.round(x, 6) for x in ("mean", "std")})


@query("g6_describe_text", with_ctes(["sellout"], select="\nUNION ALL ".join(f"""
SELECT '{x}' AS "column", sum(rows)::BIGINT AS count, count(*) AS "unique", arg_min(value, (-rows, value)) AS top, max(rows) AS freq
FROM (SELECT {x} AS value, count(*) AS rows FROM sellout WHERE {x} IS NOT NULL GROUP BY 1)""" for x in ("state", "segment_l1", "category"))))
def describe_text(spark, sf):
    return g.describe_text(sellout(spark, sf), ["state", "segment_l1", "category"])


@query("g7_distinct_combinations", over_sellout("""
SELECT DISTINCT state, segment_l1, segment_l2 FROM sellout WHERE segment_l1 IS NOT NULL"""))
def distinct_combinations(spark, sf):
    return g.combinations(sellout(spark, sf), ["state", "segment_l1", "segment_l2"])


@query("g8_largest_groups", over_sellout("SELECT sku_id, sum(lbs) AS lbs FROM sellout GROUP BY 1 ORDER BY lbs DESC, sku_id LIMIT 20"))
def largest_groups(spark, sf):
    return g.top_sums(sellout(spark, sf), ["sku_id"], "lbs", 20)


@query("g8_last_groups", over_sellout("SELECT ship_date, sum(lbs) AS lbs FROM sellout GROUP BY 1 ORDER BY ship_date DESC LIMIT 10"))
def last_groups(spark, sf):
    return g.last_groups(sellout(spark, sf), "ship_date", "lbs", 10)


WEEKLY = "weekly AS (SELECT calendar_week_year, sum(lbs) AS lbs FROM sellout GROUP BY 1)"


def change_sql(k, limit):
    return with_ctes(["sellout"], WEEKLY, select=f"""
SELECT calendar_week_year, lbs, (lbs - lag(lbs, {k}) OVER (ORDER BY calendar_week_year)) /
  nullif(lag(lbs, {k}) OVER (ORDER BY calendar_week_year), 0) AS change FROM weekly {limit}""")


@query("g9_percent_change", change_sql(1, ""))
def percent_change(spark, sf):
    return g.percent_change(sellout(spark, sf), WEEK, "lbs")


@query("g9_percent_change_last", change_sql(4, "ORDER BY calendar_week_year DESC LIMIT 6"))
def percent_change_last(spark, sf):
    return g.percent_change(sellout(spark, sf), WEEK, "lbs", periods=4, last=6)


def season_sql(name, change, start, end):
    return f"""
SELECT ship_date AS {name}, {change}, row_number() OVER (ORDER BY ship_date) AS n FROM (
  SELECT ship_date, (lbs - lag(lbs) OVER (ORDER BY ship_date)) / lag(lbs) OVER (ORDER BY ship_date) AS {change}
  FROM (SELECT ship_date, sum(lbs) AS lbs FROM sellout WHERE ship_date > DATE '{start}' AND ship_date <= DATE '{end}' GROUP BY 1)
  ORDER BY ship_date DESC LIMIT 5)"""


@query("g10_season_comparison", over_sellout(f"""
SELECT period, change, other_period, other_change FROM ({season_sql('period', 'change', '1999-07-01', '1999-11-27')})
JOIN ({season_sql('other_period', 'other_change', '1998-07-01', '1998-11-27')}) USING (n)"""))
def season_comparison(spark, sf):
    def window(year):
        return F.lit(datetime.date(year, 7, 1)), F.lit(datetime.date(year, 11, 27))
    return g.season_change(sellout(spark, sf), "ship_date", "lbs", window(1999), window(1998))


@query("g11_keep_large_keys", over_sellout("""
SELECT sku_id, calendar_week_year, sum(lbs) AS lbs FROM sellout WHERE sku_id IN (
  SELECT sku_id FROM sellout GROUP BY 1 HAVING sum(lbs) > 800) GROUP BY ALL"""))
def keep_large_keys(spark, sf):
    kept = g.keep_large(sellout(spark, sf), "sku_id", "lbs", 800)
    return kept.groupBy("sku_id", WEEK).agg(F.sum("lbs").alias("lbs"))


YEARS = tuple(range(1995, 2002))


@query("g12_week_year_matrix", over_sellout("SELECT (calendar_week_year % 100)::INTEGER AS week, " + ", ".join(
    f"sum(lbs) FILTER (calendar_week_year // 100 = {y}) AS y{y}" for y in YEARS) + " FROM sellout GROUP BY 1"))
def week_year_matrix(spark, sf):
    rows = sellout(spark, sf).withColumns({"week": F.col(WEEK) % 100, "year": F.floor(F.col(WEEK) / 100)})
    return g.week_year_matrix(rows, "week", "year", "lbs")


@query("g13_state_volume_recent", over_sellout("""
SELECT state, sum(lbs) AS lbs FROM sellout WHERE calendar_week_year IN (
  SELECT DISTINCT calendar_week_year FROM sellout ORDER BY 1 DESC LIMIT 26) GROUP BY 1"""))
def state_volume_recent(spark, sf):
    return g.sum_by(s.last_weeks(sellout(spark, sf), 26), ["state"], "lbs")


@query("g14_totals_and_members", over_sellout("""
SELECT calendar_week_year, 'Total' AS distributor, sum(lbs) AS lbs FROM sellout GROUP BY 1
UNION ALL SELECT calendar_week_year, distributor, sum(lbs) FROM sellout WHERE distributor IN ('A', 'R') GROUP BY 1, 2"""))
def totals_and_members(spark, sf):
    return g.totals_and_members(sellout(spark, sf), WEEK, "distributor", "lbs", ["A", "R"])


@query("g15_one_week", over_sellout("SELECT sum(lbs) AS lbs FROM sellout WHERE calendar_week_year = 199826"))
def one_week(spark, sf):
    return g.sum_where(sellout(spark, sf), F.col(WEEK) == 199826, "lbs")


@query("g16_masked_sum_of_sums", over_sellout("""
SELECT brand, sum(lbs) AS lbs FROM (SELECT brand, segment_l1, sum(lbs) AS lbs FROM sellout
  WHERE category = 'PROMO' AND distributor = 'A' AND segment_l2 = '1-URGENT' GROUP BY ALL) GROUP BY 1"""))
def masked_sum_of_sums(spark, sf):
    masks = [F.col("category") == "PROMO", F.col("distributor") == "A", F.col("segment_l2") == "1-URGENT"]
    return g.sum_of_sums(sellout(spark, sf), masks, ["brand", "segment_l1"], "brand", "lbs")
