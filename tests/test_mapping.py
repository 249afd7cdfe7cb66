import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekmart.operators import calendar as cal
from weekmart.operators import mapping as m
from weekmart.operators.calendar import WEEK


@pytest.fixture(scope="module")
def segments(spark):
    rows = [("Bars", "S1", None, "L1"), ("Bars", "S1", None, "L1"), ("CAFE", "S2", "t", "L2")]
    return spark.createDataFrame(rows, "unit string, code string, sub string, segment_l1 string")


def test_duplicates_do_not_multiply_and_nulls_match(spark, segments, rows):
    fact = spark.createDataFrame([(1, "bars", "s1", None), (2, "Cafe", "S2", "T"), (3, "Cafe", "S2", None), (4, None, None, None)],
                                 "id int, unit string, code string, sub string")
    out = m.map_left(fact, segments, {"unit": "unit", "code": "code", "sub": "sub"}, ["segment_l1"], m.lowered)
    assert rows(out, "id", "segment_l1") == [(1, "L1"), (2, "L2"), (3, None), (4, None)]
    assert out.columns == ["id", "unit", "code", "sub", "segment_l1"]


def test_plain_keys_are_case_sensitive(spark, segments, rows):
    fact = spark.createDataFrame([(1, "bars"), (2, "Bars")], "id int, unit string")
    out = m.map_left(fact, segments, {"unit": "unit"}, ["segment_l1"])
    assert rows(out, "id", "segment_l1") == [(1, None), (2, "L1")]
    assert m.map_left(fact, segments, {"unit": "unit"}, ["segment_l1"], dedupe=False).count() == 3


def test_rule_per_key(spark, rows):
    mapping = spark.createDataFrame([("A", "x")], "k string, l string")
    fact = spark.createDataFrame([(1, " a ", "x"), (2, "a", "X")], "id int, k string, l string")
    out = m.map_left(fact, mapping.withColumn("v", F.lit(1)), {"k": "k", "l": "l"}, ["v"], {"k": m.trimmed_lower})
    assert rows(out, "id", "v") == [(1, 1), (2, None)]


def test_states(spark, rows):
    assert m.states(spark).count() == 56
    fact = spark.createDataFrame([(1, "TX"), (2, "tn"), (3, "XX"), (4, None)], "id int, state string")
    assert rows(m.attach_state(fact, repairs={"tn": "TN"}), "id", "state", "state_name") == [
        (1, "TX", "Texas"), (2, "TN", "Tennessee"), (3, "None", "None"), (4, "None", "None")]
    assert rows(m.attach_state(fact, unmatched=None), "id", "state", "state_name") == [
        (1, "TX", "Texas"), (2, "tn", None), (3, "XX", None), (4, None, None)]


def test_province_zero_is_other(spark, rows):
    provinces = spark.createDataFrame([("ON", "Ontario"), ("QC", "0")], "province string, province_clean string")
    fact = spark.createDataFrame([("ON",), ("QC",), ("BC",)], "province string")
    assert rows(m.attach_province(fact, provinces)) == [("BC", "Other"), ("ON", "Ontario"), ("QC", "Other")]


def test_market_is_replaced(spark, rows):
    markets = spark.createDataFrame([("m1", "M One", "East", "NY")], "market string, market_clean string, region string, state string")
    fact = spark.createDataFrame([(1, "m1"), (2, "m2")], "id int, market string")
    assert rows(m.attach_market(fact, markets), "id", "market", "region", "state") == [(1, "M One", "East", "NY"), (2, None, None, None)]


def test_listings_and_nulls(spark, rows):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    listing = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(m.keep_listed(fact, listing, "k")) == [("a",), ("a",)]
    assert rows(m.drop_listed(fact, listing, "k")) == [("b",), (None,)]
    assert rows(m.excluded_counts(fact, listing, "k")) == [("b", 1)]


def test_last_mapping_row_counts(spark, rows):
    mapping = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "k string, v string, n int")
    assert rows(m.last_mapping(mapping, "k", "v", "n")) == [("a", "new")]


def test_outer_combination(spark, rows):
    a = spark.createDataFrame([("x", 1.0)], "k string, v double")
    b = spark.createDataFrame([("x", 2.0), ("y", 3.0)], "k string, v double")
    assert rows(m.combine_periods({13: a, 26: b}, ["k"], ["v"]), "k", "v_13wk", "v_26wk") == [("x", 1.0, 2.0), ("y", None, 3.0)]


def test_repeated_keys_of_a_period_lose_no_volume(spark, rows):
    a = spark.createDataFrame([("x", 1.0), ("x", 5.0), (None, 7.0)], "k string, v double")
    b = spark.createDataFrame([("x", 2.0), ("y", 3.0), (None, 4.0), (None, 4.0)], "k string, v double")
    out = m.combine_periods({13: a, 26: b}, ["k"], ["v"])
    assert rows(out, "k", "v_13wk", "v_26wk") == [("x", 1.0, 2.0), ("x", 5.0, None), ("y", None, 3.0), (None, 7.0, 4.0), (None, None, 4.0)]
    assert out.agg(F.sum("v_13wk"), F.sum("v_26wk")).first() == (13.0, 13.0)


@pytest.fixture()
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def test_hot_keys_are_joined_apart(spark, rows, no_broadcast):
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, " HOT").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 4001).cast("string")))
    fact = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("row"))
    mapping = spark.range(2000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").cast("string").alias("label"))
    mapping = mapping.unionByName(spark.createDataFrame([("hot", "h1"), ("hot", "h2"), ("hot", "h1"), (None, "blank")], "key string, label string"))
    plain = m.map_left(fact, mapping, {"k": "key"}, ["label"], m.trimmed_lower)
    assert rows(m.frequent_keys(fact, ["k"])) == [(" HOT",), (None,)]
    split = m.map_split(fact, mapping, {"k": "key"}, ["label"], m.trimmed_lower)
    assert rows(split) == rows(plain) and split.columns == plain.columns
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    shuffled = split.filter("k like 'k%'").count()
    # what is left to the shuffle is dealt evenly: the largest partition by key has at most twice the median
    rest = fact.filter("k like 'k%'").repartition(8, "k").groupBy(F.spark_partition_id().alias("p")).count().orderBy("count").collect()
    assert rest[-1]["count"] <= 2 * rest[len(rest) // 2]["count"] and shuffled == n // 3
    assert rows(m.map_split(fact, mapping, {"k": "key"}, ["label"], m.trimmed_lower, most=1)) == rows(plain)
    even = fact.filter("k like 'k%'")
    assert m.frequent_keys(even, ["k"]).isEmpty()
    assert rows(m.map_split(even, mapping, {"k": "key"}, ["label"])) == rows(m.map_left(even, mapping, {"k": "key"}, ["label"]))


def test_week_lookups(spark, calendar, rows):
    fact = spark.createDataFrame([(dt.date(2020, 12, 27),), (dt.date(2020, 12, 28),), (None,)], "day date")
    assert rows(cal.attach_week(fact, calendar, "day", "week_starting_sun"), WEEK) == [(202053,), (None,), (None,)]
    assert rows(cal.attach_week(fact, calendar, "day", "week_starting_mon"), WEEK) == [(202053,), (None,), (None,)]
    keys = spark.createDataFrame([(202053,), (202153,)], "w int")
    assert rows(cal.valid_week(keys, calendar, "w"), WEEK) == [(202053,), (None,)]
    assert rows(cal.known_weeks_only(cal.valid_week(keys, calendar, "w")), WEEK) == [(202053,)]


def test_calendar_rules(calendar):
    week = {r[WEEK]: r for r in calendar.collect()}
    assert len(week) == 6 * 52 + 1
    assert week[202053].yoy_week == 202001 and week[202053].baseline_week == 201952
    assert week[202101].yoy_week == 202002 and week[202101].baseline_week == 201901
    assert week[202101].week_starting_sun == dt.date(2021, 1, 3) and week[202101].week_ending_sun == dt.date(2021, 1, 10)
    assert week[202010].covid_week is None and week[202011].covid_week == 1 and week[202012].covid_week == 2


def test_current_and_complete_weeks(spark, calendar, rows):
    weeks = spark.createDataFrame([(202010,), (202011,), (202012,)], f"{WEEK} int")
    assert rows(cal.before_current_week(weeks, calendar, dt.date(2020, 3, 11))) == [(202010,)]
    days = spark.createDataFrame([(dt.date(2020, 3, 7),), (dt.date(2020, 3, 8),), (dt.date(2020, 3, 9),)], "day date")
    for as_of in (dt.date(2020, 3, 9), dt.date(2020, 3, 15)):
        assert rows(cal.complete_weeks(days, "day", as_of)) == [(dt.date(2020, 3, 7),), (dt.date(2020, 3, 8),)]
    assert rows(cal.complete_weeks(days, "day", dt.date(2020, 3, 8))) == []
