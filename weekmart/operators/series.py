"""Weekly series: densify, prior periods, lags, moving averages, pre-period averages.

The raw fact is aggregated to (segment, week) first. From then on a segment owns at most one row
per week, so hashing by the segment columns gives partitions of bounded size whatever the skew of
the raw keys was. Gaps are filled by stepping from one row to the next inside a segment, and last
year / baseline values are carried forward by a small week lookup, so there is neither a product of
two tables nor a self-join, and every step after the aggregation shares one shuffle. The aggregate
is staged where several branches of a plan start from it, so the raw fact is read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.operators.ranking import numbered
from weekmart.session import staged

LOOKUPS: Mapping[str, str] = {"lbs_ly": "yoy_week", "lbs_baseline": "baseline_week"}


def complete_segment(dims: Sequence[str]) -> Column:
    """True where no grain column is null."""
    test = F.lit(True)
    for c in dims:
        test = test & F.col(c).isNotNull()
    return test


def sum_to_grain(df: DataFrame, dims: Sequence[str], week: str = WEEK, value: str = "lbs") -> DataFrame:
    """Sum to (dims, week). Null keys form groups; a group of nulls sums to zero."""
    return df.groupBy(*dims, week).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def valid_key(week: Column) -> Column:
    """True where a key has the form YYYYWW with a week from 1 to 53."""
    return week.between(100_001, 999_953) & (week % 100).between(1, 53)


def invalid_weeks(df: DataFrame, week: str = WEEK, value: str = "lbs") -> DataFrame:
    """Rows and volume by key of missing keys and of keys that are no week.

    Rows without a key take no part in a series; the other keys do, in the order of their numbers.
    """
    kept = F.coalesce(valid_key(F.col(week)), F.lit(False))
    return df.filter(~kept).groupBy(week).agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def incomplete_segments(df: DataFrame, dims: Sequence[str], value: str = "lbs") -> DataFrame:
    """Rows and volume by segment of the segments that densifying drops because a grain column is null."""
    return df.filter(~complete_segment(dims)).groupBy(*dims).agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def distinct_weeks(df: DataFrame, week: str = WEEK) -> DataFrame:
    """Distinct weeks in the data, whatever numbers they are."""
    return df.select(week).filter(F.col(week).isNotNull()).distinct()


def present_weeks(df: DataFrame, week: str = WEEK) -> DataFrame:
    """The distinct weeks with a dense position ``_pos`` and the largest position ``_last``.

    They are staged, as they are needed before and after gaps are filled. Their size is then known: joins with them are
    broadcast below Spark's own threshold and shuffled beyond.
    """
    return numbered(distinct_weeks(df, week), [week])


def fill_gaps(df: DataFrame, dims: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Give every segment a row for each position 1.._last, with zero values where it had none.

    ``df`` holds ``dims, _pos, _last, values``, one row per segment and position. Each row emits
    itself and the empty positions up to the next row of its segment; the first row also emits
    those before it.
    """
    walk = Window.partitionBy(*dims).orderBy("_pos")
    before = F.lag("_pos").over(walk)
    after = F.lead("_pos").over(walk)
    start = F.when(before.isNull(), F.lit(1)).otherwise(F.col("_pos"))
    end = F.coalesce(after - 1, F.col("_last"))
    here = F.col("_cell") == F.col("_pos")
    return (
        df.withColumn("_span", F.sequence(start, end))
        .withColumn("_cell", F.explode("_span"))
        .select(*dims, F.col("_cell").alias("_pos"),
                *[F.when(here, F.coalesce(F.col(v), F.lit(0.0))).otherwise(F.lit(0.0)).alias(v) for v in values])
    )


def densify(df: DataFrame, dims: Sequence[str], week: str = WEEK, value: str = "lbs") -> DataFrame:
    """One row per (segment, week present in the data).

    Segments with a null in any grain column are dropped; the weeks are those of all rows. A null
    city counts as ``NA`` so that its rows survive.
    """
    if "city" in df.columns:
        df = df.withColumn("city", F.coalesce("city", F.lit("NA")))
    series = staged(sum_to_grain(df, dims, week, value), "series")
    weeks = present_weeks(series, week)
    placed = (
        series.filter(complete_segment(dims)).repartition(*dims)
        .join(weeks, week)
    )
    return (
        fill_gaps(placed, dims, [value])
        .join(weeks.select("_pos", week), "_pos")
        .select(*dims, week, value)
    )


def period_lookup(weeks: DataFrame, lookups: Mapping[str, str], week: str = WEEK) -> DataFrame:
    """For every source week, the positions it feeds and as what: itself, last year, baseline.

    ``weeks`` carries the calendar columns the lookups name. The result has at most
    ``1 + len(lookups)`` rows per week present in the data.
    """
    kind = weeks.schema[week].dataType
    roles = [F.struct(F.lit("").alias("_role"), F.col(week).alias("_source"))]
    roles += [F.struct(F.lit(name).alias("_role"), F.col(column).cast(kind).alias("_source")) for name, column in lookups.items()]
    return (
        weeks.select("_pos", "_last", F.explode(F.array(*roles)).alias("_r"))
        .select("_pos", "_last", "_r._role", F.col("_r._source").alias(week))
        .filter(F.col(week).isNotNull())
    )


def carry_periods(
    series: DataFrame, dims: Sequence[str], lookup: DataFrame, lookups: Mapping[str, str],
    week: str = WEEK, value: str = "lbs",
) -> DataFrame:
    """``dims, _pos, _last, _seen, value, lookups...``: own value and carried values per position.

    A row of week v feeds every week whose own, last-year or baseline week is v. ``_seen`` marks
    positions where the segment has a row of its own. ``series`` must be hashed by ``dims``.
    """
    own = F.col("_role") == ""
    return (
        series.join(lookup, week)
        .groupBy(*dims, "_pos")
        .agg(
            F.max("_last").alias("_last"),
            F.max(own).alias("_seen"),
            F.max(F.when(own, F.col(value))).alias(value),
            *[F.max(F.when(F.col("_role") == name, F.col(value))).alias(name) for name in lookups],
        )
    )


def add_prior_periods(
    df: DataFrame, dims: Sequence[str], calendar: DataFrame,
    lookups: Mapping[str, str] = LOOKUPS, week: str = WEEK, value: str = "lbs",
) -> DataFrame:
    """Sum to grain, then add the value of each row's last-year and baseline week (null if absent)."""
    series = staged(sum_to_grain(df, dims, week, value), "series")
    side = calendar.select(F.col(WEEK).alias(week), *lookups.values()).dropDuplicates([week])
    weeks = numbered(distinct_weeks(series, week).join(side, week, "left"), [week])
    lookup = period_lookup(weeks, lookups, week)
    carried = carry_periods(series.repartition(*dims), dims, lookup, lookups, week, value)
    return (
        carried.filter("_seen")
        .join(weeks.select("_pos", week), "_pos")
        .select(*dims, week, value, *lookups)
    )


def lag_columns(dims: Sequence[str], order: str, columns: Mapping[str, tuple[str, int]]) -> dict[str, Column]:
    """``{new: (column, periods)}`` as lag expressions inside the segment."""
    walk = Window.partitionBy(*dims).orderBy(order)
    return {name: F.lag(source, k).over(walk) for name, (source, k) in columns.items()}


def average_columns(
    dims: Sequence[str], order: str, columns: Mapping[str, tuple[str, int]], shift: int = 0,
) -> dict[str, Column]:
    """``{new: (column, rows)}`` as moving averages over the last ``rows`` rows of the segment.

    Shorter starts average what is there. ``shift=1`` gives the previous row's average directly:
    the frame ends one row earlier and is empty, hence null, on the first row.
    """
    walk = Window.partitionBy(*dims).orderBy(order)
    return {
        name: F.avg(source).over(walk.rowsBetween(-(n - 1) - shift, -shift)) for name, (source, n) in columns.items()
    }


def rolling_columns(
    dims: Sequence[str], order: str, value: str = "lbs", prior: Sequence[str] = ("lbs_ly", "lbs_baseline"),
    windows: Sequence[int] = (4, 8, 12), lags: Sequence[int] = (1, 2, 3, 4), fix_defects: bool = False,
) -> dict[str, Column]:
    """All lag and moving-average measures over one window specification.

    ``lbs_ly_lag_1`` lags the current value, as the reports always had it; ``fix_defects`` lags the
    last-year value instead.
    """
    suffix = {value: ""} | {p: "_" + p.rsplit("_", 1)[1] for p in prior}
    columns = lag_columns(dims, order, {f"{value}_lag_{k}": (value, k) for k in lags})
    columns |= average_columns(
        dims, order, {f"sma_{n}{s}": (source, n) for source, s in suffix.items() for n in windows})
    if prior:
        late = prior[0] if fix_defects else value
        columns |= lag_columns(dims, order, {f"{p}_lag_1": (p if p != prior[0] else late, 1) for p in prior})
    short = windows[0]
    columns |= average_columns(
        dims, order, {f"sma_{short}{s}_lag_1": (source, short) for source, s in suffix.items()}, shift=1)
    return columns


def add_rolling(
    df: DataFrame, dims: Sequence[str], week: str = WEEK, value: str = "lbs",
    prior: Sequence[str] = ("lbs_ly", "lbs_baseline"), windows: Sequence[int] = (4, 8, 12),
    lags: Sequence[int] = (1, 2, 3, 4), fix_defects: bool = False,
) -> DataFrame:
    """Add lags and moving averages to a frame with one row per segment and week."""
    df = df.fillna(0.0, subset=[value, *prior])
    return df.withColumns(rolling_columns(dims, week, value, prior, windows, lags, fix_defects))


def preperiod_column(
    dims: Sequence[str], order: str, begin: int, end: int, divisor: int = 52,
    week: str = WEEK, value: str = "lbs",
) -> Column:
    """Average weekly value of the segment between two weeks; the divisor is the number of weeks.

    The frame spans the whole segment on the ordered window, so it is evaluated together with the
    lags and averages instead of by a join back.
    """
    whole = Window.partitionBy(*dims).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.when(F.col(week).between(begin, end), F.col(value))).over(whole)
    return F.coalesce(total / divisor, F.lit(0.0))


def add_preperiod(
    df: DataFrame, dims: Sequence[str], begin: int, end: int, divisor: int = 52,
    week: str = WEEK, value: str = "lbs", name: str = "lbs_precovid",
) -> DataFrame:
    return df.withColumn(name, preperiod_column(dims, week, begin, end, divisor, week, value))


def add_share(df: DataFrame, over: Sequence[str], value: str = "lbs", name: str = "wt") -> DataFrame:
    """Share of each row in the total of its ``over`` group; null for a zero total.

    The totals are aggregated with map-side combine and joined back, so no task has to hold a whole
    group (one week can be a large part of the rows).
    """
    totals = df.groupBy(*over).agg(F.sum(value).alias("_total"))
    return df.join(totals, list(over), "left").withColumn(name, F.try_divide(value, "_total")).drop("_total")


def latest_weeks(df: DataFrame, n: int, week: str = WEEK) -> DataFrame:
    """The ``n`` latest distinct weeks, one row each."""
    return df.select(week).filter(F.col(week).isNotNull()).distinct().orderBy(F.desc(week)).limit(n)


def last_weeks(df: DataFrame, n: int, week: str = WEEK) -> DataFrame:
    """Rows of the ``n`` latest distinct weeks, whose ``n`` keys are staged."""
    return df.join(staged(latest_weeks(df, n, week)), week, "left_semi")
