"""Incremental loads: the event table arrives as a stream of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekmart.catalog.base import query, table
from weekmart.catalog.sources import SHARED, shared_files
from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.session import staging_path
from weekmart.sources import schemas as sc
from weekmart.sources.snapshots import read_snapshot
from weekmart.streaming import loads

WEEKLY = f"""
SELECT CAST(isoyear(ts) * 100 + week(ts) AS INTEGER) AS week, event_type, count(*) AS rows,
  sum(CAST(value AS DECIMAL(12,2)))::DOUBLE AS value FROM events GROUP BY ALL"""


def delivered(spark, sf, label):
    """Events as weekly deliveries, one folder of files per ISO week."""
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("day"), "value")
    events = events.withColumn("week", d.iso_week_key(F.col("day")))
    folder = staging_path(spark, label)
    events.withColumn("folder", F.col("week")).repartition("folder").write.partitionBy("folder").parquet(folder)
    return events.schema, folder


def weekly(df):
    return df.groupBy("week", "event_type").agg(
        F.count("*").alias("rows"), F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("value"))


@query("x1_stream_append_missing", WEEKLY)
def stream_append_missing(spark, sf):
    """Two runs over the same folder: the second, from a new checkpoint, must add nothing."""
    schema, folder = delivered(spark, sf, "x1")
    target = staging_path(spark, "x1-table")
    for _ in range(2):
        stream = loads.file_stream(spark, folder, schema).drop("folder")
        loads.stream_append_missing(stream, target, staging_path(spark, "x1-progress"), "week", weekly)
    return spark.read.parquet(target).select("week", "event_type", "rows", "value")


@query("x1_stream_replace", WEEKLY)
def stream_replace(spark, sf):
    """Redelivered weeks replace their partitions."""
    schema, folder = delivered(spark, sf, "x2")
    target = staging_path(spark, "x2-table")
    for factor in (3.0, 1.0):
        stream = loads.file_stream(spark, folder, schema).drop("folder").withColumn("value", F.col("value") * factor)
        loads.stream_replace(stream, target, staging_path(spark, "x2-progress"), ["week"], weekly)
    return spark.read.parquet(target).select("week", "event_type", "rows", "value")


@query("x1_stream_dated_headers", SHARED.replace("{}", """
SELECT week_beginning_date, raw_market AS market, pyramid_segment, sum(lbs) AS lbs FROM shared GROUP BY ALL"""))
def stream_dated_headers(spark, sf):
    """Header-dated files, three a batch; a second run goes on from the first one's checkpoint, a third begins anew."""
    folders = shared_files(spark, sf)
    target, progress = staging_path(spark, "x1-shared"), staging_path(spark, "x1-shared-progress")
    for checkpoint in (progress, progress, staging_path(spark, "x1-shared-again")):
        names = ",".join(f.rsplit("/", 1)[1] for f in folders)
        files = loads.arriving_files(spark, folders[0].rsplit("/", 1)[0] + f"/{{{names}}}", files_a_batch=3 if checkpoint == progress else None)
        loads.stream_shared(files, target, checkpoint, sc.NATIONAL_US_SHARED)
    out = read_snapshot(spark, target)
    return out.groupBy("week_beginning_date", "market", "pyramid_segment").agg(F.sum(c.to_number(F.col("lbs"))).alias("lbs"))
