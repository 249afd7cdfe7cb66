import pytest
from pyspark.sql import functions as F

from weekmart.operators import series as s
from weekmart.operators.calendar import WEEK

SCHEMA = f"seg string, {WEEK} int, lbs double"


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([
        ("a", 202001, 1.0), ("a", 202001, 2.0), ("a", 202003, 4.0), ("b", 202002, 8.0), ("b", 202101, None), (None, 202004, 16.0),
    ], SCHEMA)


def test_grain_keeps_null_keys_and_sums_nulls_to_zero(fact, rows):
    assert rows(s.sum_to_grain(fact, ["seg"])) == [
        ("a", 202001, 3.0), ("a", 202003, 4.0), ("b", 202002, 8.0), ("b", 202101, 0.0), (None, 202004, 16.0)]


def test_densify_uses_weeks_of_all_rows_and_drops_null_segments(fact, rows):
    assert rows(s.densify(fact, ["seg"])) == [
        ("a", 202001, 3.0), ("a", 202002, 0.0), ("a", 202003, 4.0), ("a", 202004, 0.0), ("a", 202101, 0.0),
        ("b", 202001, 0.0), ("b", 202002, 8.0), ("b", 202003, 0.0), ("b", 202004, 0.0), ("b", 202101, 0.0)]


def test_densify_keeps_rows_without_city(spark, rows):
    fact = spark.createDataFrame([(None, 202001, 1.0), ("X", 202002, 2.0)], f"city string, {WEEK} int, lbs double")
    assert rows(s.densify(fact, ["city"])) == [("NA", 202001, 1.0), ("NA", 202002, 0.0), ("X", 202001, 0.0), ("X", 202002, 2.0)]


def test_densify_size_is_segments_times_weeks(spark):
    fact = spark.range(500).select(
        (F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b"),
        (F.lit(202001) + (F.col("id") * 13 % 29)).cast("int").alias(WEEK), F.lit(1.0).alias("lbs"))
    dense = s.densify(fact, ["a", "b"])
    assert dense.count() == fact.select("a", "b").distinct().count() * fact.select(WEEK).distinct().count()
    assert dense.agg(F.sum("lbs")).first()[0] == 500.0


def test_any_week_key_takes_part_and_odd_ones_are_counted(spark, rows):
    fact = spark.createDataFrame([("a", 20200101, 1.0), ("a", 202054, 2.0), ("a", None, 4.0), ("a", 202001, 8.0), ("a", 0, 16.0), ("b", -3, 32.0)], SCHEMA)
    dense = [(-3, 0.0), (0, 16.0), (202001, 8.0), (202054, 2.0), (20200101, 1.0)]
    assert rows(s.densify(fact, ["seg"]).filter("seg = 'a'"), WEEK, "lbs") == sorted(dense, key=lambda r: tuple((False, str(v)) for v in r))
    assert rows(s.invalid_weeks(fact)) == [(-3, 1, 32.0), (0, 1, 16.0), (20200101, 1, 1.0), (202054, 1, 2.0), (None, 1, 4.0)]
    assert rows(s.incomplete_segments(fact.withColumn("seg", F.nullif("seg", F.lit("a"))), ["seg"])) == [(None, 5, 31.0)]


def test_keys_of_any_size(spark):
    fact = spark.createDataFrame([("a", 10**12, 1.0), ("a", 5, 2.0)], f"seg string, {WEEK} long, lbs double")
    assert sorted((r[WEEK], r.lbs) for r in s.densify(fact, ["seg"]).collect()) == [(5, 2.0), (10**12, 1.0)]


def test_prior_periods_across_a_53_week_year(spark, calendar, rows):
    fact = spark.createDataFrame([
        ("a", 201952, 1.0), ("a", 202001, 2.0), ("a", 202053, 4.0), ("a", 202101, 8.0), (None, 202001, 16.0), (None, 202053, 32.0),
    ], SCHEMA)
    got = {(r.seg, r[WEEK]): (r.lbs, r.lbs_ly, r.lbs_baseline) for r in s.add_prior_periods(fact, ["seg"], calendar).collect()}
    # 52 weeks before 2020-W53 is 2020-W01; before 2021-W01 is 2020-W02; the baseline of week 53 is 2019-W52
    assert got == {
        ("a", 201952): (1.0, None, 1.0), ("a", 202001): (2.0, None, None), ("a", 202053): (4.0, 2.0, 1.0),
        ("a", 202101): (8.0, None, None), (None, 202001): (16.0, None, None), (None, 202053): (32.0, 16.0, None)}


def test_rolling_by_hand(spark, rows):
    fact = spark.createDataFrame(
        [("a", 202000 + i, float(v), float(v) * 10, 0.0) for i, v in enumerate([4, 8, 0, 12, 16], 1)],
        f"{SCHEMA}, lbs_ly double, lbs_baseline double")
    out = s.add_rolling(fact, ["seg"])
    got = [tuple(r) for r in out.orderBy(WEEK).select("lbs_lag_1", "sma_4", "sma_4_ly", "sma_4_lag_1", "lbs_ly_lag_1").collect()]
    assert got == [(None, 4.0, 40.0, None, None), (4.0, 6.0, 60.0, 4.0, 4.0), (8.0, 4.0, 40.0, 6.0, 8.0),
                   (0.0, 6.0, 60.0, 4.0, 0.0), (12.0, 9.0, 90.0, 6.0, 12.0)]
    fixed = s.add_rolling(fact, ["seg"], fix_defects=True).orderBy(WEEK).select("lbs_ly_lag_1").collect()
    assert [r[0] for r in fixed] == [None, 40.0, 80.0, 0.0, 120.0]


def test_preperiod_divides_by_52(spark, rows):
    fact = spark.createDataFrame([("a", 202001, 26.0), ("a", 202002, 26.0), ("a", 202003, 9.0), ("b", 202003, 1.0)], SCHEMA)
    out = s.add_preperiod(fact, ["seg"], 202001, 202002)
    assert rows(out.select("seg", "lbs_precovid").distinct()) == [("a", 1.0), ("b", 0.0)]


def test_share_of_zero_total_is_null(spark, rows):
    fact = spark.createDataFrame([("a", 202001, 1.0), ("b", 202001, 3.0), ("a", 202002, 0.0)], SCHEMA)
    assert rows(s.add_share(fact, [WEEK]), "seg", WEEK, "wt") == [("a", 202001, 0.25), ("a", 202002, None), ("b", 202001, 0.75)]


def test_last_weeks_counts_weeks_not_rows(spark, rows):
    fact = spark.createDataFrame([("a", 202001, 1.0), ("a", 202002, 1.0), ("b", 202002, 1.0), ("a", 202003, 1.0)], SCHEMA)
    assert rows(s.last_weeks(fact, 2), WEEK) == [(202002,), (202002,), (202003,)]


def test_hot_segment_gives_the_same_result(spark, rows):
    """A third of all rows in one segment and one week."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    fact = spark.range(n).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 97).cast("string"))).alias("seg"),
        F.when(hot, F.lit(202010)).otherwise((F.lit(202001) + F.col("id") % 20)).cast("int").alias(WEEK), F.lit(1.0).alias("lbs"))
    dense = s.densify(fact, ["seg"])
    assert dense.count() == 98 * 20
    assert dense.filter("seg = 'hot'").agg(F.sum("lbs"), F.max("lbs")).first() == (n / 3, n / 3)
    assert dense.agg(F.sum("lbs")).first()[0] == n
