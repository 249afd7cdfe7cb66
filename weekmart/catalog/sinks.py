"""Sinks and load modes: load twice into a staged table, read the table back."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekmart.catalog.base import query, sellout, with_ctes
from weekmart.operators.calendar import WEEK
from weekmart.session import staging_path
from weekmart.sources import readers as r
from weekmart.sources import sinks as k
from weekmart.sources import snapshots

FIRST = """
sums AS (SELECT distributor, calendar_week_year, state, sum(lbs) AS lbs FROM sellout GROUP BY ALL)"""


def sums(spark, sf):
    return sellout(spark, sf).groupBy("distributor", WEEK, "state").agg(F.sum("lbs").alias("lbs"))


def stored(spark, sf):
    """The fact as a stored table, so that one source feeds both loads."""
    path = staging_path(spark, "sums")
    sums(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def table_of(spark, path, like):
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


@query("k1_write_compressed_csv", with_ctes(["sellout"], FIRST, select="SELECT * FROM sums"))
def write_compressed_csv(spark, sf):
    rows = sums(spark, sf)
    path = staging_path(spark, "k1")
    k.write_csv(rows, path)
    return r.read_delimited(spark, path, rows.schema)


@query("k2_save_version", with_ctes(["sellout"], FIRST, select="""
SELECT 1 AS version, * FROM sums UNION ALL SELECT 2, * FROM sums WHERE distributor <> 'N'"""))
def save_version(spark, sf):
    rows, root = stored(spark, sf), staging_path(spark, "k2")
    k.save_version(rows, root, "1")
    k.save_version(rows.filter("distributor <> 'N'"), root, "2")
    return spark.read.parquet(root)


REPLACED = "SELECT distributor, calendar_week_year, state, CASE WHEN {} THEN lbs * 2 ELSE lbs END AS lbs FROM sums"


@query("k4_replace_distributor", with_ctes(["sellout"], FIRST, select=REPLACED.format("distributor = 'A'")))
def replace_distributor(spark, sf):
    rows, path = stored(spark, sf), staging_path(spark, "k4")
    snapshots.replace_partitions(rows, path, ["distributor"])
    snapshots.replace_partitions(rows.filter("distributor = 'A'").withColumn("lbs", F.col("lbs") * 2), path, ["distributor"])
    return snapshots.read_snapshot(spark, path)


def years(df):
    """Year in place of the week: the load modes only need a delivery key."""
    return df.groupBy(F.floor(F.col(WEEK) / 100).cast("int").alias("year"), "distributor", "state").agg(F.sum("lbs").alias("lbs"))


YEARS = FIRST + """,
years AS (SELECT calendar_week_year // 100 AS year, distributor, state, sum(lbs) AS lbs FROM sums GROUP BY ALL)"""


@query("k3_replace_distributor_periods", with_ctes(["sellout"], YEARS, select="""
SELECT year::INTEGER AS year, distributor, state, CASE WHEN distributor = 'R' AND year >= 1999 THEN lbs * 2 ELSE lbs END AS lbs FROM years"""))
def replace_distributor_periods(spark, sf):
    rows, path = years(stored(spark, sf)), staging_path(spark, "k3")
    keys = ["distributor", "year"]
    snapshots.replace_partitions(rows, path, keys)
    snapshots.replace_partitions(rows.filter("distributor = 'R' AND year >= 1999").withColumn("lbs", F.col("lbs") * 2), path, keys)
    return snapshots.read_snapshot(spark, path)


@query("k5_append_missing_weeks", with_ctes(["sellout"], YEARS, select="""
SELECT year::INTEGER AS year, distributor, state, CASE WHEN year >= 1999 THEN lbs * 2 ELSE lbs END AS lbs FROM years"""))
def append_missing_weeks(spark, sf):
    rows, path = years(stored(spark, sf)), staging_path(spark, "k5")
    k.append_missing_weeks(rows.filter("year < 1999"), path, "year")
    again = rows.withColumn("lbs", F.col("lbs") * 2)
    k.append_missing_weeks(again, path, "year")
    k.append_missing_weeks(again, path, "year")
    return table_of(spark, path, rows)


@query("k6_backfill_in_steps", with_ctes(["sellout"], YEARS, select="""
SELECT year::INTEGER AS year, distributor, state, lbs FROM years WHERE year IN (SELECT DISTINCT year FROM years ORDER BY 1 LIMIT 4)"""))
def backfill_in_steps(spark, sf):
    rows, path = years(stored(spark, sf)), staging_path(spark, "k6")
    k.backfill_weeks(rows, path, "year", limit=2)
    k.backfill_weeks(rows, path, "year", limit=2)
    return table_of(spark, path, rows)


@query("k7_truncate_and_reload", with_ctes(["sellout"], FIRST, select="SELECT * FROM sums WHERE distributor = 'R'"))
def truncate_and_reload(spark, sf):
    """The second load reads the table that it replaces."""
    path = staging_path(spark, "k7")
    snapshots.replace_table(sums(spark, sf), path)
    snapshots.replace_table(snapshots.read_snapshot(spark, path).filter("distributor = 'R'"), path)
    return snapshots.read_snapshot(spark, path)


@query("k8_replace_delivered_weeks", with_ctes(["sellout"], YEARS, select="""
SELECT year::INTEGER AS year, distributor, state, CASE WHEN year = 2000 THEN lbs * 2 ELSE lbs END AS lbs FROM years"""))
def replace_delivered_weeks(spark, sf):
    rows, path = years(stored(spark, sf)), staging_path(spark, "k8")
    snapshots.replace_partitions(rows, path, ["year"])
    snapshots.replace_partitions(rows.filter("year = 2000").withColumn("lbs", F.col("lbs") * 2), path, ["year"])
    return snapshots.read_snapshot(spark, path)


@query("k8_read_earlier_version", with_ctes(["sellout"], YEARS, select="""
SELECT v::INTEGER AS version, year::INTEGER AS year, distributor, state, CASE WHEN year = 1998 AND v > 1 THEN lbs * 2 WHEN year = 1999 AND v > 2 THEN lbs * 3 ELSE lbs END AS lbs
FROM years, (VALUES (1), (2), (3)) t(v)"""))
def read_earlier_version(spark, sf):
    """Three loads, then the table as each of them left it."""
    rows, path = years(stored(spark, sf)), staging_path(spark, "k8v")
    loads = [rows, *[rows.filter(f"year = {y}").withColumn("lbs", F.col("lbs") * n) for y, n in ((1998, 2), (1999, 3))]]
    numbers = [snapshots.replace_partitions(load, path, ["year"]) for load in loads]
    parts = [snapshots.read_snapshot(spark, path, n).select(F.lit(n).alias("version"), "*") for n in numbers]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("k9_send_latest_weeks", with_ctes(["sellout"], FIRST, select="""
SELECT * FROM sums WHERE calendar_week_year IN (SELECT DISTINCT calendar_week_year FROM sums ORDER BY 1 DESC LIMIT 6)"""))
def send_latest_weeks(spark, sf):
    rows, path = stored(spark, sf), staging_path(spark, "k9")
    k.replace_latest_weeks(rows, path, ["distributor", WEEK], WEEK, 6)
    return table_of(spark, path, rows)


@query("k10_several_tables", with_ctes(["sellout"], FIRST, select="""
SELECT 'by_state' AS report, state AS label, sum(lbs) AS lbs FROM sums GROUP BY ALL
UNION ALL SELECT 'by_distributor', distributor, sum(lbs) FROM sums GROUP BY ALL"""))
def several_tables(spark, sf):
    rows = stored(spark, sf)
    paths = k.write_report({
        "BY_STATE": rows.groupBy("state").agg(F.sum("lbs").alias("LBS")),
        "BY_DISTRIBUTOR": rows.groupBy("distributor").agg(F.sum("lbs").alias("LBS")),
    }, staging_path(spark, "k10"))
    states, distributors = (spark.read.parquet(paths[x]) for x in ("BY_STATE", "BY_DISTRIBUTOR"))
    return states.select(F.lit("by_state").alias("report"), F.col("state").alias("label"), "lbs").unionByName(
        distributors.select(F.lit("by_distributor").alias("report"), F.col("distributor").alias("label"), "lbs"))
