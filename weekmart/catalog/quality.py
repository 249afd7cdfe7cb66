"""Data-quality checks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from weekmart.catalog.base import lines, query, sellout, table, with_ctes
from weekmart.catalog.mappings import PRODUCT_SQL, RAW, REGIONAL_LABELS, MAPPED, regional, regional_raw
from weekmart.functions import clean as c
from weekmart.operators import quality as q
from weekmart.operators import series as s
from weekmart.operators.calendar import WEEK
from weekmart.operators.mapping import map_left

CONFORMED = f"""
conformed AS (
  SELECT market_segment AS business_unit, o_orderpriority AS sic_code, o_orderstatus AS sic_sub, 'SKU' || l_partkey AS sku_id,
    l_quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS lbs, {REGIONAL_LABELS}, {PRODUCT_SQL}, sun_week
  FROM (SELECT *, CASE WHEN {MAPPED} THEN coalesce(market_segment, 'NONE') END AS seg FROM raw) WHERE sun_week IS NOT NULL)"""


def conformed(spark, sf):
    """The regional source after conforming, pounds as exact decimals."""
    return regional(spark, sf).withColumn("lbs", F.col("lbs").cast("decimal(12,2)"))


@query("d1_unmapped_segments", with_ctes(["lines"], RAW, CONFORMED, select="""
SELECT business_unit, sic_code, sic_sub, sum(lbs)::DOUBLE AS lbs, 'regional' AS source, DATE '2000-01-03' AS report_date
FROM conformed WHERE segment_l1 IS NULL GROUP BY ALL"""))
def unmapped_segments(spark, sf):
    out = q.unmapped_report(conformed(spark, sf), "segment_l1", ["business_unit", "sic_code", "sic_sub"], "regional", datetime.date(2000, 1, 3))
    return out.withColumn("lbs", F.col("lbs").cast("double"))


@query("d2_unmapped_products", with_ctes(["lines"], RAW, CONFORMED, select="""
SELECT sku_id, sum(lbs)::DOUBLE AS lbs, 'regional' AS source, DATE '2000-01-03' AS report_date
FROM conformed WHERE consolidated_category IS NULL GROUP BY ALL"""))
def unmapped_products(spark, sf):
    out = q.unmapped_report(conformed(spark, sf), "consolidated_category", ["sku_id"], "regional", datetime.date(2000, 1, 3))
    return out.withColumn("lbs", F.col("lbs").cast("double"))


@query("d3_before_and_after", with_ctes(["lines"], RAW, CONFORMED, select="""
SELECT 'before' AS stage, count(*) AS rows, sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE AS lbs FROM lines
UNION ALL SELECT 'after', count(*), sum(lbs)::DOUBLE FROM conformed"""))
def before_and_after(spark, sf):
    before = regional_raw(spark, sf).withColumn("lbs", c.to_number(F.col("lbs")).cast("decimal(12,2)"))
    return q.before_after(before, conformed(spark, sf)).withColumn("lbs", F.col("lbs").cast("double"))


# an order priority has up to three labels, a seventh of the sizes as many as they have types
@query("d3_fan_out", with_ctes(["lines"], """
labels AS (SELECT DISTINCT o_orderpriority, o_orderstatus AS label FROM orders WHERE o_orderpriority < '3' OR o_orderstatus = 'F'),
kinds AS (SELECT DISTINCT p_size, CASE WHEN p_size % 7 = 0 THEN p_type ELSE 'x' END AS kind FROM part WHERE p_size < 40),
sized AS (SELECT o_orderpriority, p_size, l_quantity AS lbs FROM lines JOIN part ON l_partkey = p_partkey),
joined AS (
  SELECT s.*, label, kind FROM sized s LEFT JOIN labels USING (o_orderpriority) LEFT JOIN kinds ON kinds.p_size = s.p_size),
counted AS (
  SELECT *, coalesce((SELECT count(*) FROM labels l WHERE l.o_orderpriority = s.o_orderpriority), 0) AS a,
    coalesce((SELECT count(*) FROM kinds k WHERE k.p_size = s.p_size), 0) AS b FROM sized s)""", select="""
SELECT 'labels' AS mapping, 'o_orderpriority=' || o_orderpriority AS key, sum(a - 1)::BIGINT AS rows, sum((a - 1) * lbs)::DOUBLE AS lbs
FROM counted WHERE a > 1 GROUP BY o_orderpriority
UNION ALL SELECT 'kinds', 'p_size=' || p_size, sum(greatest(a, 1) * (b - 1))::BIGINT, sum(greatest(a, 1) * (b - 1) * lbs)::DOUBLE
FROM counted WHERE b > 1 GROUP BY p_size
UNION ALL SELECT 'all', 'after - before', (SELECT count(*) FROM joined) - (SELECT count(*) FROM sized),
  (SELECT sum(lbs) FROM joined) - (SELECT sum(lbs) FROM sized)"""))
def fan_out(spark, sf):
    """Keys that multiplied rows in two joins, beside the difference of the totals."""
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    sized = lines(spark, sf).join(part, F.col("l_partkey") == F.col("p_partkey")).select("o_orderpriority", "p_size", F.col("l_quantity").alias("lbs"))
    labels = table(spark, sf, "orders").filter("o_orderpriority < '3' OR o_orderstatus = 'F'").select("o_orderpriority", F.col("o_orderstatus").alias("label"))
    kinds = table(spark, sf, "part").filter("p_size < 40").select("p_size", F.when(F.col("p_size") % 7 == 0, F.col("p_type")).otherwise("x").alias("kind"))
    joined = map_left(sized, labels, {"o_orderpriority": "o_orderpriority"}, ["label"], copy="label_copy")
    joined = map_left(joined, kinds, {"p_size": "p_size"}, ["kind"], copy="kind_copy")
    found = q.fan_out(joined, {"labels": ("label_copy", ["o_orderpriority"]), "kinds": ("kind_copy", ["p_size"])})
    both = q.totals(joined, "after").crossJoin(q.totals(sized, "before").select(F.col("rows").alias("r"), F.col("lbs").alias("v")))
    return found.unionByName(both.select(
        F.lit("all").alias("mapping"), F.lit("after - before").alias("key"), (F.col("rows") - F.col("r")).alias("rows"), (F.col("lbs") - F.col("v")).alias("lbs")))


@query("d4_missing_after_join", with_ctes(["lines"], RAW, CONFORMED, select="""
SELECT count(*) FILTER (segment_l1 IS NULL) AS missing_rows,
  round((sum(lbs) FILTER (segment_l1 IS NULL))::DOUBLE / sum(lbs)::DOUBLE, 9) AS missing_share FROM conformed"""))
def missing_after_join(spark, sf):
    out = q.unmapped_share(regional(spark, sf), "segment_l1")
    return out.withColumn("missing_share", F.round("missing_share", 9))


PAIRS = """
pairs AS (
  SELECT a.calendar_week_year, a.lbs AS before, b.lbs AS after, b.lbs - a.lbs AS change
  FROM (SELECT calendar_week_year, sum(lbs) AS lbs FROM sellout GROUP BY 1) a
  JOIN (SELECT calendar_week_year, sum(lbs + (sku_id % 3)) AS lbs FROM sellout WHERE calendar_week_year >= 199601 GROUP BY 1) b
  USING (calendar_week_year))"""


def old_and_new(spark, sf):
    old = sellout(spark, sf).select(WEEK, "lbs", "sku_id")
    new = old.filter(F.col(WEEK) >= 199601).withColumn("lbs", F.col("lbs") + F.col("sku_id") % 3)
    return old, new


@query("d5_weekly_difference", with_ctes(["sellout"], PAIRS, select="SELECT * FROM pairs"))
def weekly_difference(spark, sf):
    return q.weekly_difference(*old_and_new(spark, sf), WEEK)


@query("d5_difference_summary", with_ctes(["sellout"], PAIRS, select=" UNION ALL ".join(f"""
SELECT '{x}' AS "column", count(*) AS count, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, min({x}) AS "min",
  quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, quantile_cont({x}, 0.75) AS q75, max({x}) AS "max"
FROM pairs""" for x in ("before", "after", "change"))))
def difference_summary(spark, sf):
    out = q.difference_summary(*old_and_new(spark, sf), WEEK)
    return out.withColumns({x: F.round(x, 6) for x in ("mean", "std")})


# the p-value by Simpson's rule over the density of Student's t
@query("d6_welch_test", with_ctes(["sellout"], PAIRS, """
welch AS (
  SELECT d / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n - 1) + b * b / (n - 1)) AS df FROM (
    SELECT avg(before) - avg(after) AS d, var_samp(before) / count(*) AS a, var_samp(after) / count(*) AS b, count(*) AS n FROM pairs)),
steps AS (
  SELECT t, df, abs(t) / 2000 AS h, CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END AS c, k * abs(t) / 2000 AS x
  FROM welch CROSS JOIN (SELECT unnest(range(0, 2001)) AS k))""", select="""
SELECT round(t, 9) AS t, round(df, 6) AS df,
  round(1 - 2 * sum(h / 3 * c * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * pow(1 + x * x / df, -(df + 1) / 2)), 6) AS p
FROM steps GROUP BY t, df"""))
def welch_test(spark, sf):
    out = q.welch_test(q.weekly_difference(*old_and_new(spark, sf), WEEK))
    return out.select(F.round("t", 9).alias("t"), F.round("df", 6).alias("df"), F.round("p", 6).alias("p"))


# every seventh item has lost its week, every eleventh has a key that is no week
@query("d4_invalid_weeks", with_ctes(["sellout"], select="""
SELECT w AS calendar_week_year, count(*) AS rows, sum(lbs) AS lbs FROM (
  SELECT CASE WHEN sku_id % 7 = 0 THEN NULL WHEN sku_id % 11 = 0 THEN calendar_week_year * 10 ELSE calendar_week_year END AS w, lbs FROM sellout)
WHERE w IS NULL OR w > 999953 GROUP BY 1"""))
def invalid_weeks(spark, sf):
    week = F.when(F.col("sku_id") % 7 == 0, F.lit(None)).when(F.col("sku_id") % 11 == 0, F.col(WEEK) * 10).otherwise(F.col(WEEK))
    return s.invalid_weeks(sellout(spark, sf).withColumn(WEEK, week))


@query("d4_incomplete_segments", with_ctes(["sellout"], select="""
SELECT state, segment_l1, count(*) AS rows, sum(lbs) AS lbs FROM sellout WHERE segment_l1 IS NULL GROUP BY ALL"""))
def incomplete_segments(spark, sf):
    return s.incomplete_segments(sellout(spark, sf), ["state", "segment_l1"])
