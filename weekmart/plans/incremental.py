"""The segment analysis kept up to date: a redelivered week renews the cells that depend on it, and no others.

Two snapshot tables, both partitioned by week, hold the weekly sums of every segment and the analysis of them. A cell depends on
its own week's value, on those of the rows its averages and lags reach back to, on the last-year and baseline weeks of all of
these, and, for the pre-period average, on the weeks of the pre-period. Read backwards this gives the weeks that a delivery
renews; only they are computed again, from the partitions of the sums that they depend on. A week that appears or vanishes moves
the rows after it, as far as an average reaches. A segment that appears adds a row to every week, one that vanishes takes its rows
away; the other rows of weeks that nothing else renews are copied, not computed. A change inside the pre-period renews all weeks.

The sums are replaced first, then the analysis. A run that dies in between is made good by running it again.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.operators import series as s
from weekmart.operators.calendar import SUNDAY_WEEK, WEEK
from weekmart.plans.analysis import analyze, week_table
from weekmart.session import staged
from weekmart.sources import snapshots

REACH = 12  # rows of the longest average; every lag is shorter


class Refreshed(NamedTuple):
    """The version of the analysis, the weeks computed again, and those whose sums were read for it."""

    version: int
    renewed: list[int]
    read: list[int]


def dependents(
    weeks: Sequence[int], changed: Iterable[int], sources: Mapping[int, Sequence[int | None]], begin: int, end: int, reach: int = REACH,
) -> set[int]:
    """Weeks among ``weeks`` (ascending) with a cell that depends on a changed week.

    ``sources`` names the other weeks whose values a week carries. A changed week may be missing from ``weeks``.
    """
    changed = set(changed)
    if any(begin <= c <= end for c in changed):
        return set(weeks)
    carriers = changed | {w for w in weeks if any(x in changed for x in sources.get(w, ()))}
    return {w for c in carriers for w in weeks[bisect_left(weeks, c): bisect_left(weeks, c) + reach]}


def windows_of(weeks: Sequence[int], chosen: Iterable[int], reach: int = REACH) -> list[int]:
    """The weeks that the averages of the chosen ones reach back to, with them."""
    return sorted({w for c in chosen for w in weeks[max(0, bisect_left(weeks, c) - reach + 1): bisect_left(weeks, c) + 1]})


def _weeks(spark: SparkSession, path: str) -> set[int]:
    held = snapshots.partitions(spark, path)
    return set() if held is None else {r[0] for r in held.collect()}  # one for each week


def _segments(spark: SparkSession, path: str, version: int, dims: Sequence[str], changes: DataFrame | None) -> DataFrame:
    """Number of weeks of every segment at a version of the sums: the version before and the changes, or counted anew."""
    try:
        counted = spark.read.parquet(f"{path}/segments/{version - 1}").unionByName(changes) if changes is not None else None
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        counted = None
    if counted is None:
        counted = snapshots.read_snapshot(spark, f"{path}/sums", version).select(*dims, F.lit(1).cast("long").alias("weeks"))
    counted.groupBy(*dims).agg(F.sum("weeks").alias("weeks")).filter("weeks > 0").write.mode("overwrite").parquet(f"{path}/segments/{version}")
    return spark.read.parquet(f"{path}/segments/{version}").select(*dims)


def refresh(
    delivered: DataFrame, path: str, dims: Sequence[str], calendar: DataFrame, weeks: Sequence[int] | None = None,
    begin: int = 201910, end: int = 202009, fix_defects: bool = False, week_columns: Sequence[str] = SUNDAY_WEEK,
) -> Refreshed:
    """Bring the analysis below ``path`` up to date with a delivery that replaces whole weeks.

    ``weeks`` names the replaced weeks, those of ``delivered`` by default; one without rows vanishes. The first delivery makes
    the tables. The analysis (``read_report``) equals ``analyze`` of all rows that the deliveries have left. Rows without a
    week, and those of segments with a null grain column, take no part; a null city counts as NA.
    """
    spark, dims, root = delivered.sparkSession, list(dims), path.rstrip("/")
    sums_path, report_path = f"{root}/sums", f"{root}/report"
    if "city" in dims:
        delivered = delivered.withColumn("city", F.coalesce("city", F.lit("NA")))
    new = staged(s.sum_to_grain(delivered.filter(F.col(WEEK).isNotNull() & s.complete_segment(dims)), dims), "delivered").select(*dims, WEEK, "lbs")
    came = {r[0] for r in new.select(WEEK).distinct().collect()}
    replaced = sorted(came | set(weeks or ()))
    kind = f"{WEEK} {new.schema[WEEK].dataType.simpleString()}"
    keys = spark.createDataFrame([(w,) for w in replaced], kind)

    changes = None
    if (before := snapshots.current(spark, sums_path)) is not None:
        old = snapshots.read_snapshot(spark, sums_path).filter(F.col(WEEK).isin(replaced))
        changes = new.select(*dims, F.lit(1).cast("long").alias("weeks")).unionByName(old.select(*dims, F.lit(-1).cast("long").alias("weeks")))
    version = snapshots.replace_partitions(new, sums_path, [WEEK], gone=keys)
    if version == 0 or (before is not None and version != before.number + 1):
        changes = None
    now = sorted(_weeks(spark, sums_path))
    segments = _segments(spark, root, version, dims, changes)

    was = _weeks(spark, report_path)
    options = {"begin": begin, "end": end, "fix_defects": fix_defects, "week_columns": week_columns}
    sums = snapshots.read_snapshot(spark, sums_path)
    if not was:
        full = analyze(sums, dims, calendar, **options)
        return Refreshed(snapshots.replace_partitions(full, report_path, [WEEK]), now, now)

    report = snapshots.read_snapshot(spark, report_path)
    carried = calendar.filter(F.col(WEEK).isin(now)).select(WEEK, *s.LOOKUPS.values()).collect()  # one row for each week
    sources = {r[0]: tuple(r[1:]) for r in carried}
    changed = set(replaced) | (was ^ set(now))
    whole = any(begin <= c <= end for c in changed)
    renewed = sorted(dependents(now, changed, sources, begin, end))
    rows = windows_of(now, renewed)
    read = now if whole else sorted(set(rows) | {x for w in rows for x in sources.get(w, ()) if x in set(now)})

    kept_week = max(was)  # every week of the analysis holds every segment
    known = report.filter(F.col(WEEK) == kept_week).select(*dims, F.col("lbs_precovid").alias("_precovid"))
    parts = []
    if renewed:
        part = sums.filter(F.col(WEEK).isin(read))
        if whole:
            parts.append(analyze(part, dims, calendar, **options))
        else:
            empty = segments.select(*dims, F.lit(rows[0]).cast(new.schema[WEEK].dataType).alias(WEEK), F.lit(0.0).alias("lbs"))
            table = week_table(spark.createDataFrame([(w,) for w in rows], kind), calendar, week_columns)
            again = analyze(part.unionByName(empty), dims, calendar, weeks=table, **options).filter(F.col(WEEK).isin(renewed))
            parts.append(again.join(known, dims, "left").withColumn("lbs_precovid", F.coalesce("_precovid", F.lit(0.0))).select(*again.columns))
    others = sorted(set(now) - set(renewed))
    here = known.select(*dims)
    appeared, vanished = segments.join(here, dims, "left_anti"), here.join(segments, dims, "left_anti")
    if others and not (appeared.isEmpty() and vanished.isEmpty()):
        appeared, vanished = staged(appeared, "appeared"), staged(vanished, "vanished")
        parts.append(report.filter(F.col(WEEK).isin(others)).join(vanished, dims, "left_anti"))
        mine = sums.filter(F.col(WEEK).isin(replaced)).join(appeared, dims, "left_semi")  # they have rows nowhere else
        parts.append(analyze(mine, dims, calendar, weeks=week_table(
            spark.createDataFrame([(w,) for w in now], kind), calendar, week_columns), **options).filter(F.col(WEEK).isin(others)))
    out = report.limit(0)
    for part in parts:
        out = out.unionByName(part.select(*report.columns))
    lost = spark.createDataFrame([(w,) for w in sorted(was - set(now))], kind)
    return Refreshed(snapshots.replace_partitions(out, report_path, [WEEK], gone=lost), renewed, read)


def read_report(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The analysis as the last delivery, or an earlier version, left it."""
    return snapshots.read_snapshot(spark, f"{path.rstrip('/')}/report", number)
