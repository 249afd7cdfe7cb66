"""A distributor's weekly run from raw delivery to reports."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.operators.history import replace_weeks
from weekmart.operators.quality import observe_total, observed_totals, totals, unmapped_report
from weekmart.operators.series import complete_segment, incomplete_segments, invalid_weeks
from weekmart.plans.analysis import ReportSpec, several_grains
from weekmart.plans.conform import Dictionaries
from weekmart.plans.sellin import compare
from weekmart.session import staged
from weekmart.sources.sinks import write_partitions


@dataclass(frozen=True)
class DistributorModel:
    """How one distributor is conformed and which grains it reports.

    ``columns`` are the columns of its history; ``segment_keys`` and ``product_keys`` the raw keys
    listed when a label is missing; ``raw_value`` the volume as delivered (a number, or text with commas).
    """

    conform: Callable[[DataFrame, Dictionaries, DataFrame], DataFrame]
    columns: Sequence[str]
    grains: Mapping[str, Sequence[str]]
    spec: ReportSpec
    segment_keys: Sequence[str]
    product_keys: Sequence[str] = ()
    raw_value: str = "lbs"


def run_model(
    model: DistributorModel, raw: DataFrame, maps: Dictionaries, calendar: DataFrame,
    base: DataFrame | None = None, sellin: DataFrame | None = None, as_of: datetime.date | None = None,
) -> dict[str, DataFrame]:
    """History, one report per grain, the comparison with sell-in, totals from delivery to analysis, and what was left out.

    ``totals`` has rows and volume before and after conforming, ``analyzed_totals`` those of the history and of its parts by grain:
    analyzed, without a week, with an incomplete segment; the parts add up to the history. ``invalid_weeks`` and ``incomplete_segments``
    list those rows by key, ``unmapped_segments`` and ``unmapped_products`` the raw keys without a label.
    Conformed rows and merged history feed several results each, so they are staged as Parquet, of which each reads its
    columns. The delivery's totals are observed while it is staged. ``as_of`` dates the unmapped reports.
    """
    delivered = Observation("delivered")
    value = F.replace(F.col(model.raw_value).cast("string"), F.lit(","), F.lit("")).try_cast("double")
    fact = staged(model.conform(observe_total(raw, delivered, value), maps, calendar), "fact")
    history = fact.select(*model.columns)
    if base is not None:
        history = staged(replace_weeks(base, history, model.columns), "history")
    out = {"history": history}
    out |= several_grains(history, model.grains, calendar, model.spec)
    if sellin is not None:
        out["sellin_and_sellout"] = compare(
            sellin, history, calendar, model.spec.label, model.spec.begin, model.spec.end)
    out["totals"] = observed_totals(raw, delivered, "before", value).unionByName(totals(fact, "after"))
    out["analyzed_totals"] = analyzed_totals(history, model.grains, model.spec.densify)
    out["invalid_weeks"] = invalid_weeks(history)
    if model.spec.densify:
        out["incomplete_segments"] = incomplete_by_grain(history, model.grains)
    out["unmapped_segments"] = unmapped_report(fact, "segment_l1", model.segment_keys, model.spec.label, as_of)
    if model.product_keys:
        out["unmapped_products"] = unmapped_report(fact, "consolidated_category", model.product_keys, model.spec.label, as_of)
    return out


def analyzed_totals(history: DataFrame, grains: Mapping[str, Sequence[str]], densify: bool = True) -> DataFrame:
    """Rows and volume of a history and, by grain, of what its analysis uses and leaves out, from one pass."""
    dated = F.col(WEEK).isNotNull()

    def cell(stage: str, condition: Column) -> Column:
        return F.struct(
            F.lit(stage).alias("stage"), F.count_if(condition).alias("rows"), F.coalesce(F.sum(F.when(condition, F.col("lbs"))), F.lit(0.0)).alias("lbs"))

    cells = [cell("history", F.lit(True)), cell("without week", ~dated)]
    for name, dims in grains.items():
        whole = complete_segment(grain_columns(dims)) if densify else F.lit(True)
        cells += [cell(f"incomplete {name}", dated & ~whole), cell(f"analyzed {name}", dated & whole)]
    return history.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def grain_columns(dims: Sequence[str]) -> list[str]:
    """The grain columns that a densified segment must have: a missing city counts as NA."""
    return [c for c in dims if c != "city"]


def incomplete_by_grain(history: DataFrame, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows and volume by grain and segment of dated rows whose segment lacks a column, as ``column=value`` texts."""
    parts = []
    for name, dims in grains.items():
        columns = grain_columns(dims)
        text = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("?"))) for c in columns])
        left = incomplete_segments(history.filter(F.col(WEEK).isNotNull()), columns)
        parts.append(left.select(F.lit(name).alias("grain"), text.alias("segment"), "rows", "lbs"))
    return reduce(DataFrame.unionByName, parts)


def write_unmapped(out: Mapping[str, DataFrame], folder: str) -> None:
    """The unmapped reports of a run, a table each, by source and report date; the same day's run replaces its own rows."""
    for name in ("unmapped_segments", "unmapped_products"):
        if name in out:
            write_partitions(out[name], f"{folder.rstrip('/')}/{name}", ["source", "report_date"])
