"""The composed analysis against an independent pandas computation."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.plans import analysis as a

DIMS = ["state", "seg"]
BEGIN, END = 201910, 202009


@pytest.fixture(scope="module")
def pdf():
    draw = random.Random(7)
    weeks = [y * 100 + w for y in (2019, 2020, 2021) for w in range(1, 53 + (y == 2020))]
    picked = [w for w in weeks if draw.random() < 0.8]
    records = [
        (draw.choice(["NY", "TX", "ON"]), draw.choice(["x", "y", None]), draw.choice(picked), draw.randrange(0, 4000) / 8)
        for _ in range(1500)
    ]
    return pd.DataFrame(records, columns=[*DIMS, WEEK, "lbs"])


@pytest.fixture(scope="module")
def fact(spark, pdf):
    return spark.createDataFrame([tuple(r) for r in pdf.astype(object).where(pdf.notna(), None).itertuples(index=False)],
                                 f"state string, seg string, {WEEK} int, lbs double").cache()


def by_hand(pdf, times, dense):
    """Straightforward pandas: product of segments and weeks, merges, rolling."""
    if dense:
        segments = pdf[DIMS].dropna().drop_duplicates()
        spine = segments.merge(pdf[[WEEK]].drop_duplicates(), how="cross")
        pdf = spine.merge(pdf, how="left", on=[*DIMS, WEEK])
    base = pdf.groupby([*DIMS, WEEK], dropna=False)["lbs"].sum().reset_index()
    out = base.merge(times, how="left", on=WEEK)
    for name, column in (("lbs_ly", "yoy_week"), ("lbs_baseline", "baseline_week")):
        other = base.rename(columns={"lbs": name, WEEK: column})
        out = out.merge(other, how="left", on=[*DIMS, column])
    out[["lbs_ly", "lbs_baseline"]] = out[["lbs_ly", "lbs_baseline"]].fillna(0.0)
    out = out.sort_values([*DIMS, WEEK]).reset_index(drop=True)
    group = out.groupby(DIMS)
    for k in (1, 2, 3, 4):
        out[f"lbs_lag_{k}"] = group["lbs"].shift(k)
    for suffix, column in (("", "lbs"), ("_ly", "lbs_ly"), ("_baseline", "lbs_baseline")):
        for n in (4, 8, 12):
            out[f"sma_{n}{suffix}"] = group[column].transform(lambda x, n=n: x.rolling(n, min_periods=1).mean())
    out["lbs_baseline_lag_1"] = group["lbs_baseline"].shift(1)
    out["lbs_ly_lag_1"] = group["lbs"].shift(1)
    for suffix in ("", "_ly", "_baseline"):
        out[f"sma_4{suffix}_lag_1"] = out.groupby(DIMS)[f"sma_4{suffix}"].shift(1)
    pre = out[out[WEEK].between(BEGIN, END)].groupby(DIMS)["lbs"].sum() / 52
    out = out.merge(pre.rename("lbs_precovid"), how="left", left_on=DIMS, right_index=True)
    out.loc[out[DIMS].isna().any(axis=1), "lbs_precovid"] = np.nan
    measures = list(a.MEASURES)
    out[measures] = out[measures].round(2)
    return out.fillna({m: 2.0 if m in a.FILLED_WITH_TWO else 0.0 for m in measures})


@pytest.mark.parametrize("dense", [True, False])
def test_against_pandas(fact, pdf, calendar, dense):
    times = calendar.select(WEEK, "yoy_week", "baseline_week").toPandas()
    want = by_hand(pdf, times, dense)
    got = a.analyze(fact, DIMS, calendar, BEGIN, END, densify=dense).toPandas()
    key = [*DIMS, WEEK]
    def ordered(x):
        return x[[*key, *a.MEASURES]].astype({"seg": object}).fillna({"seg": "~"}).sort_values(key).reset_index(drop=True)
    left, right = ordered(got), ordered(want)
    assert left[key].values.tolist() == right[key].values.tolist()
    for m in a.MEASURES:
        # averages of floats may sit on a half cent; anything beyond that is a difference
        worst = (left[m] - right[m]).abs().max()
        assert worst < 0.0101, (m, worst)
        assert ((left[m] - right[m]).abs() > 1e-9).mean() < 0.002, m


def test_defect_flag(fact, calendar):
    old = a.analyze(fact, DIMS, calendar, BEGIN, END).filter(F.col(WEEK) == fact.agg(F.min(WEEK)).first()[0])
    new = a.analyze(fact, DIMS, calendar, BEGIN, END, fix_defects=True).filter(F.col(WEEK) == fact.agg(F.min(WEEK)).first()[0])
    assert {r[0] for r in old.select("lbs_ly_lag_1").collect()} == {2.0}
    assert {r[0] for r in new.select("lbs_ly_lag_1").collect()} == {0.0}


def test_report_layout(fact, calendar):
    spec = a.ReportSpec(label="North", segment_column="seg", segment_labels={"x": "IO"})
    report = a.segment_report(fact, DIMS, calendar, spec)
    assert report.columns == [
        "state", "seg", WEEK, "distributor", "lbs", "sma_4", "sma_8", "sma_12", "yoy_week", "lbs_ly", "sma_4_ly", "sma_8_ly",
        "sma_12_ly", "baseline_week", "lbs_baseline", "sma_4_baseline", "sma_8_baseline", "sma_12_baseline", "lbs_lag_1",
        "lbs_lag_2", "lbs_lag_3", "lbs_lag_4", "lbs_baseline_lag_1", "lbs_ly_lag_1", "sma_4_lag_1", "sma_4_ly_lag_1",
        "sma_4_baseline_lag_1", "lbs_precovid", "week_starting_sun", "week_ending_sat", "covid_week"]
    assert {r[0] for r in report.select("seg").distinct().collect()} == {"IO", "y"}
    assert {r[0] for r in report.select("distributor").distinct().collect()} == {"North"}


def test_last_weeks_keep_their_history(fact, calendar, rows):
    whole = a.segment_report(fact, DIMS, calendar, a.ReportSpec(segment_column=None))
    short = a.segment_report(fact, DIMS, calendar, a.ReportSpec(segment_column=None, last_weeks=3))
    weeks = sorted({r[0] for r in fact.select(WEEK).distinct().collect()})[-3:]
    assert rows(short) == rows(whole.filter(F.col(WEEK).isin(weeks)))


def test_share_uses_unrounded_values(spark, calendar, rows):
    fact = spark.createDataFrame([("a", 202001, 0.004), ("b", 202001, 0.012)], f"brand string, {WEEK} int, lbs double")
    spec = a.ReportSpec(label="US", share=True)
    report = a.manufacturer_report(fact, ["brand"], calendar, spec)
    assert rows(report, "brand", "wt") == [("a", 0.25), ("b", 0.75)]
    assert "week_starting_mon" in report.columns and "country" in report.columns


def test_arguments_are_not_changed(fact, calendar):
    dims = list(DIMS)
    a.segment_report(fact, dims, calendar, a.ReportSpec(segment_column=None))
    assert dims == DIMS


def test_several_grains_equal_single_reports(fact, calendar, rows):
    spec = a.ReportSpec(segment_column=None)
    reports = a.several_grains(fact, {"s": ["state"], "both": DIMS}, calendar, spec)
    assert rows(reports["s"]) == rows(a.segment_report(fact, ["state"], calendar, spec))
    assert rows(reports["both"]) == rows(a.segment_report(fact, DIMS, calendar, spec))
