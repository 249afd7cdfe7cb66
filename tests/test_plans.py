"""Physical plans: what is scanned, broadcast and shuffled."""

import pytest
from pyspark.sql import functions as F

from weekmart.operators import history as h
from weekmart.operators import metrics as g
from weekmart.operators import series as s
from weekmart.operators.calendar import WEEK
from weekmart.plans import analysis as a

DIMS = ["seg", "part"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "t")
    spark.range(20_000).select(
        (F.col("id") % 17).cast("string").alias("seg"), (F.col("id") % 5).cast("string").alias("part"),
        (F.lit(202001) + F.col("id") % 50).cast("int").alias(WEEK), (F.col("id") % 9).cast("double").alias("lbs"),
        F.repeat(F.lit("x"), 50).alias("unused")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_analysis_shuffles_segments_once(stored, calendar):
    text = plan(a.analyze(stored, DIMS, calendar, 202001, 202010))
    by_segment = [line for line in text.splitlines() if "Exchange hashpartitioning(seg" in line]
    assert len(by_segment) == 1 and "REPARTITION_BY_COL" in by_segment[0]
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "SortMergeJoin" not in text
    assert stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://") not in text  # the fact itself was read once, before the staging


def test_grain_reads_only_its_columns(stored):
    text = plan(s.sum_to_grain(stored.filter(F.col(WEEK) > 202010), DIMS))
    assert "unused" not in text
    assert f"GreaterThan({WEEK},202010)" in text
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_history_is_not_shuffled(stored):
    new = stored.filter(F.col(WEEK) > 202040)
    text = plan(h.replace_weeks(stored, new))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning" not in text
    text = plan(h.latest_file_wins(stored.withColumn("file_order", F.lit(1))))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_prior_periods_need_no_self_join(stored, calendar):
    text = plan(s.add_prior_periods(stored, DIMS, calendar))
    assert len([line for line in text.splitlines() if "Exchange hashpartitioning(seg" in line]) == 1
    assert stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://") not in text


def test_weeks_beyond_the_broadcast_threshold_are_shuffled(stored, calendar, rows, no_auto_broadcast):
    shuffled = a.analyze(stored, DIMS, calendar, 202001, 202010)
    assert "SortMergeJoin" in plan(shuffled) and "Broadcast" not in plan(shuffled)
    told = rows(shuffled)
    stored.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert told == rows(a.analyze(stored, DIMS, calendar, 202001, 202010))


def test_keys_do_not_read_the_fact_again(stored):
    for df in (h.latest_file_wins(stored.withColumn("file_order", F.lit(1))), s.last_weeks(stored, 3), g.keep_large(stored, DIMS[0], "lbs", 1.0)):
        assert plan(df).count("FileScan") == 2  # the fact and the staged keys
