"""The composed segment analysis and the reports built from it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.functions.clean import relabel
from weekmart.operators import series as s
from weekmart.operators.calendar import MONDAY_WEEK, SUNDAY_WEEK, WEEK, add_calendar
from weekmart.operators.ranking import numbered
from weekmart.session import staged

# fixed values: measures in report order, and the two that are filled with 2 instead of 0
LAGS = ("lbs_lag_1", "lbs_lag_2", "lbs_lag_3", "lbs_lag_4")
MEASURES = (
    "lbs", "sma_4", "sma_8", "sma_12",
    "lbs_ly", "sma_4_ly", "sma_8_ly", "sma_12_ly",
    "lbs_baseline", "sma_4_baseline", "sma_8_baseline", "sma_12_baseline",
    *LAGS, "lbs_baseline_lag_1", "lbs_ly_lag_1",
    "sma_4_lag_1", "sma_4_ly_lag_1", "sma_4_baseline_lag_1", "lbs_precovid",
)
FILLED_WITH_TWO = ("lbs_baseline_lag_1", "lbs_ly_lag_1")
# fixed values: segment labels merged in the reports
SEGMENT_LABELS: Mapping[str, str] = {
    "Independents (IOs) / Local Eateries / Takeaway": "IO",
    "All Other": "Chain",
    "National Account": "Chain",
    "Region Chains": "Chain",
    "National Accounts": "Chain",
}


@dataclass(frozen=True)
class ReportSpec:
    """What distinguishes one report family from another."""

    begin: int = 201910
    end: int = 202009
    label_column: str = "distributor"
    label: str = ""
    week_columns: Sequence[str] = SUNDAY_WEEK
    segment_column: str | None = "segment_l2"
    segment_labels: Mapping[str, str] = field(default_factory=lambda: dict(SEGMENT_LABELS))
    densify: bool = True
    last_weeks: int | None = None
    share: bool = False
    fix_defects: bool = False


def round_measures(df: DataFrame, measures: Iterable[str] = MEASURES, digits: int = 2) -> DataFrame:
    """Round half to even."""
    wanted = set(measures)
    return df.selectExpr(*[f"bround(`{c}`, {digits}) AS `{c}`" if c in wanted else f"`{c}`" for c in df.columns])


def fill_measures(df: DataFrame, measures: Iterable[str] = MEASURES, fix_defects: bool = False) -> DataFrame:
    """Nulls to 0, and to 2 in two lag columns unless ``fix_defects``."""
    two = () if fix_defects else FILLED_WITH_TWO
    fill = {m: "2D" if m in two else "0D" for m in measures}
    return df.selectExpr(*[f"coalesce(`{c}`, {fill[c]}) AS `{c}`" if c in fill else f"`{c}`" for c in df.columns])


def week_attributes(week_columns: Sequence[str]) -> list[str]:
    return ["yoy_week", "baseline_week", *week_columns, "covid_week"]


def week_table(df: DataFrame, calendar: DataFrame, week_columns: Sequence[str] = SUNDAY_WEEK) -> DataFrame:
    """The weeks present in ``df`` with position and calendar columns, staged."""
    return numbered(add_calendar(s.distinct_weeks(df), calendar, week_attributes(week_columns)), [WEEK])


def analyze(
    df: DataFrame, dims: Sequence[str], calendar: DataFrame, begin: int = 201910, end: int = 202009,
    densify: bool = True, fix_defects: bool = False, week_columns: Sequence[str] = SUNDAY_WEEK,
    last_weeks: int | None = None, share: bool = False, weeks: DataFrame | None = None,
) -> DataFrame:
    """Segment-by-week analysis of a weekly fact (``dims``, week key, ``lbs``).

    The fact is read once: its (segment, week) sums are staged. Every week key takes part, a week 0 or a number that is no
    week in the order of the numbers; rows without a key do not (``left_out`` counts them). The sums are then hashed by
    segment, and all that follows - carried periods, gap filling, windows - shares that one shuffle.
    With ``densify=False`` only observed rows are analyzed, and segments with a null key keep
    their rows but get no window measures. ``last_weeks`` keeps the latest weeks after the windows
    have seen all of them; ``share`` adds ``wt``, the part of a segment in its week's total.
    ``weeks`` is the ``week_table`` of a fact that is aggregated and staged already: it is then
    read as it is.
    """
    dims = list(dims)
    if "city" in dims and densify:
        df = df.withColumn("city", F.coalesce("city", F.lit("NA")))
    series = s.sum_to_grain(df, dims)
    if weeks is None:
        series = staged(series, "series")
        weeks = week_table(series, calendar, week_columns)
    # rows without a week go after the staging: a filter before it would compute a derived key twice
    series = series.filter(F.col(WEEK).isNotNull())
    attributes = week_attributes(week_columns)
    lookup = s.period_lookup(weeks, s.LOOKUPS)
    whole = s.complete_segment(dims)
    kept = series.filter(whole) if densify else series
    carried = s.carry_periods(kept.repartition(*dims), dims, lookup, s.LOOKUPS)
    values = ["lbs", *s.LOOKUPS]
    rows = s.fill_gaps(carried, dims, values) if densify else carried.filter("_seen").fillna(0.0, subset=values)

    if share:
        week_totals = series.filter(whole).groupBy(WEEK).agg(F.sum("lbs").alias("_total"))
        weeks = staged(weeks.join(week_totals, WEEK, "left"), "weeks")
    rows = rows.drop("_last").join(weeks, "_pos")

    measures = s.rolling_columns(dims, "_pos", fix_defects=fix_defects)
    measures["lbs_precovid"] = s.preperiod_column(dims, "_pos", begin, end)
    if not densify:
        measures = {name: F.when(whole, column) for name, column in measures.items()}
    rows = rows.withColumns(measures)
    if last_weeks is not None:
        rows = rows.filter(F.col("_pos") > F.col("_last") - last_weeks)
    weight = []
    if share:
        rows = rows.withColumn("wt", F.when(whole, F.try_divide("lbs", "_total")))
        weight = ["wt"]
    rows = fill_measures(round_measures(rows), fix_defects=fix_defects)
    return rows.select(*dims, WEEK, *MEASURES, *attributes, *weight)


def report_columns(dims: Sequence[str], spec: ReportSpec, available: Sequence[str]) -> list[str]:
    """Fixed column order of a report."""
    columns = [
        *dims, WEEK, spec.label_column, *MEASURES[:4], "yoy_week", *MEASURES[4:8], "baseline_week",
        *MEASURES[8:], *spec.week_columns, "covid_week",
    ]
    return columns + (["wt"] if "wt" in available else [])


def segment_report(
    df: DataFrame, dims: Sequence[str], calendar: DataFrame, spec: ReportSpec, weeks: DataFrame | None = None,
) -> DataFrame:
    """Analysis of one grain in the standard output layout.

    Segment labels are merged after the analysis without summing again, so a merged label repeats
    per week, as the reports always had it.
    """
    out = analyze(df, dims, calendar, spec.begin, spec.end, spec.densify, spec.fix_defects, spec.week_columns,
                  spec.last_weeks, spec.share, weeks)
    if spec.segment_column:
        out = relabel(out, spec.segment_column, spec.segment_labels)
    out = out.withColumn(spec.label_column, F.lit(spec.label))
    return out.select(*report_columns(dims, spec, out.columns))


def manufacturer_report(df: DataFrame, dims: Sequence[str], calendar: DataFrame, spec: ReportSpec) -> DataFrame:
    """Manufacturer layout: country label, Monday-Sunday weeks, share of the week for brands."""
    return segment_report(df, dims, calendar, replace(
        spec, label_column="country", week_columns=MONDAY_WEEK, segment_column=None))


def grain_lattice(df: DataFrame, grains: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Weekly sums of every grain from one pass over the fact, each from the smallest staged sums that have its columns.

    The widest sums, over the union of all columns, are staged first. Grains follow from many columns to few; one that has
    all columns of a later one is staged as well, and its rows are counted. A coarse grain then starts from the parent of
    fewest rows, not from the widest sums.
    """
    union = list(dict.fromkeys(c for dims in grains.values() for c in dims))
    base = staged(s.sum_to_grain(df, union), "series")
    held = [(frozenset(union), base, base.count())]
    order = sorted(grains, key=lambda name: -len(set(grains[name])))
    out = {}
    for k, name in enumerate(order):
        own = frozenset(grains[name])
        columns, sums, _ = min((h for h in held if own <= h[0]), key=lambda h: h[2])
        if columns != own:
            sums = s.sum_to_grain(sums, list(grains[name]))
            if any(own >= set(grains[later]) for later in order[k + 1:]):
                sums = staged(sums, f"grain-{name}")
                held.append((own, sums, sums.count()))
        out[name] = sums
    return {name: out[name] for name in grains}


def several_grains(
    df: DataFrame, grains: Mapping[str, Sequence[str]], calendar: DataFrame, spec: ReportSpec,
) -> dict[str, DataFrame]:
    """One report per grain from a single pass over the fact; the grains' sums come from each other, and all share one week table."""
    sums = grain_lattice(df, grains)
    widest = max(sums, key=lambda name: len(set(grains[name])))
    weeks = week_table(sums[widest], calendar, spec.week_columns)
    return {name: segment_report(sums[name], dims, calendar, spec, weeks) for name, dims in grains.items()}
