import datetime as dt
import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from weekmart.operators import metrics as g
from weekmart.operators import quality as q


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("b", 2, 0.0), ("b", 3, 4.0), (None, 3, 8.0), ("a", 4, None)],
                                 "k string, w int, lbs double")


def test_sums(fact, rows):
    assert rows(g.sum_by(fact, ["k"], "lbs")) == [("a", 5.0), ("b", 4.0), (None, 8.0)]
    assert rows(g.sum_by(fact, ["k"], "lbs", keep_null=False)) == [("a", 5.0), ("b", 4.0)]
    assert rows(g.sum_by(fact, ["w"], "lbs"))[-1] == (4, 0.0)


def test_counts_in_order(fact):
    assert [tuple(r) for r in g.value_counts(fact, "k", keep_null=True).collect()] == [("a", 3), ("b", 2), (None, 1)]
    assert [tuple(r) for r in g.value_counts(fact, "k").collect()] == [("a", 3), ("b", 2)]


def test_profile(fact, rows):
    assert rows(g.profile(fact, ["k", "w"])) == [
        ("k", "a", 3), ("k", "b", 2), ("w", "1", 1), ("w", "2", 2), ("w", "3", 2), ("w", "4", 1)]


def test_percent_change(fact, rows):
    assert rows(g.percent_change(fact, "w", "lbs")) == [(1, 2.0, None), (2, 3.0, 0.5), (3, 12.0, 3.0), (4, None, None)]
    zero = fact.filter("w < 4").withColumn("lbs", F.when(F.col("w") == 1, 0.0).otherwise(F.col("lbs")))
    assert rows(g.percent_change(zero, "w", "lbs"), "change") == [(3.0,), (None,), (None,)]
    assert rows(g.percent_change(fact, "w", "lbs", periods=2, last=2), "w", "change") == [(3, 5.0), (4, None)]


def test_totals_and_members(fact, rows):
    assert rows(g.totals_and_members(fact, "w", "k", "lbs", ["b"])) == [
        (1, "Total", 2.0), (2, "Total", 3.0), (2, "b", 0.0), (3, "Total", 12.0), (3, "b", 4.0), (4, "Total", None)]


def test_keep_large_drops_null_keys(fact, rows):
    assert rows(g.keep_large(fact, "k", "lbs", 4.5), "k") == [("a",)] * 3


def test_matrix(spark, rows):
    frame = spark.createDataFrame([(1, 2020, 5.0), (1, 2021, 7.0), (2, 2020, 9.0)], "week int, year int, lbs double")
    assert rows(g.week_year_matrix(frame, "week", "year", "lbs")) == [(1, 5.0, 7.0), (2, 9.0, None)]


def test_top_and_last(fact):
    assert [r.k for r in g.top_sums(fact.dropna(), ["k"], "lbs", 1).collect()] == ["a"]
    assert [r.w for r in g.last_groups(fact, "w", "lbs", 2).collect()] == [4, 3]


def test_unmapped_and_totals(spark, fact, rows):
    labelled = fact.withColumn("label", F.when(F.col("k") == "a", "A"))
    assert rows(q.unmapped(labelled, "label", ["k"])) == [("b", 4.0), (None, 8.0)]
    report = q.unmapped_report(labelled, "label", ["k"], "src", dt.date(2024, 1, 1))
    assert set(report.columns) == {"k", "lbs", "source", "report_date"}
    doubled = fact.unionByName(fact.filter("k = 'b'"))
    assert rows(q.before_after(fact, doubled)) == [("after", 8, 21.0), ("before", 6, 17.0)]
    assert q.unmapped_share(labelled, "label").first() == (3, 12.0 / 17.0)


def test_observed_totals(fact):
    seen = Observation()
    q.observe_total(fact, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 6, "lbs": 17.0}


def test_welch(spark):
    a, b = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9], [27.1, 22.0, 20.8, 23.4, 23.4, 23.5]
    row = q.welch(spark.createDataFrame(list(zip(a, b)), "before double, after double")).first()
    ma, mb = sum(a) / 6, sum(b) / 6
    va, vb = sum((x - ma) ** 2 for x in a) / 5 / 6, sum((x - mb) ** 2 for x in b) / 5 / 6
    assert math.isclose(row.t, (ma - mb) / math.sqrt(va + vb), rel_tol=1e-12)
    assert math.isclose(row.df, (va + vb) ** 2 / (va**2 / 5 + vb**2 / 5), rel_tol=1e-12)


@pytest.mark.parametrize("t, df, p", [(0.0, 5.0, 1.0), (2.0, 10.0, 0.07338803), (-1.0, 1.0, 0.5), (12.706204736, 1.0, 0.05), (1.959964, 1e7, 0.05)])
def test_p_value(t, df, p):
    assert math.isclose(q.two_sided_p(t, df), p, rel_tol=2e-6)
