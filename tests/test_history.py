import pytest

from weekmart.operators import history as h
from weekmart.operators.calendar import WEEK
from weekmart.session import staging_path
from weekmart.sources import sinks as k
from weekmart.streaming import loads

SCHEMA = f"distributor string, {WEEK} int, lbs double"


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([("a", 202001, 1.0), ("a", 202002, 2.0), ("b", 202002, 3.0), ("a", None, 9.0)], SCHEMA)


@pytest.fixture(scope="module")
def new(spark):
    return spark.createDataFrame([("a", 202002, 20.0), ("a", 202003, 30.0)], SCHEMA)


def test_new_weeks_win_and_it_is_idempotent(base, new, rows):
    once = h.replace_weeks(base, new)
    assert rows(once) == [("a", 202001, 1.0), ("a", 202002, 20.0), ("a", 202003, 30.0), ("a", None, 9.0)]
    assert rows(h.replace_weeks(once, new)) == rows(once)


def test_recent_rule_duplicates_older_overlap(spark, base, rows):
    new = spark.createDataFrame([("a", 202001, 10.0), ("a", 202002, 20.0)], SCHEMA)
    assert rows(h.replace_recent_weeks(base, new, last=1)) == [
        ("a", 202001, 1.0), ("a", 202001, 10.0), ("a", 202002, 20.0), ("a", None, 9.0)]


def test_file_order(spark, rows):
    files = spark.createDataFrame([(1, 202001, 1.0), (1, 202002, 2.0), (2, 202002, 20.0), (2, 202002, 21.0), (3, 202003, 30.0)],
                                  f"file_order int, {WEEK} int, lbs double")
    assert rows(h.latest_file_wins(files), "lbs") == [(1.0,), (20.0,), (21.0,), (30.0,)]
    assert rows(h.first_file_wins(files), "lbs") == [(1.0,), (2.0,), (30.0,)]


def test_stack_fills_missing_columns(spark, rows):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    assert rows(h.stack(a, b)) == [(1, None), (2, "q")]


def test_side_by_side(spark, rows):
    a, b = spark.createDataFrame([(2, "b"), (1, "a")], "i int, l string"), spark.createDataFrame([(9, "y"), (5, "x")], "j int, r string")
    assert rows(h.side_by_side(a, b, "i", "j", 2), "l", "r") == [("a", "x"), ("b", "y")]


def test_rows_without_a_week_are_replaced_once(spark, base, rows):
    new = spark.createDataFrame([("a", None, 90.0), ("a", 202001, 10.0)], SCHEMA)
    once = h.replace_weeks(base, new)
    assert rows(once, "lbs") == [(10.0,), (2.0,), (3.0,), (90.0,)] and rows(h.replace_weeks(once, new)) == rows(once)


def test_missing_weeks_with_nulls_and_a_half_written_week(spark, rows):
    path = staging_path(spark, "k5-half")
    week = spark.createDataFrame([("a", 202001, 1.0), ("a", None, 9.0)], SCHEMA)
    for _ in range(2):
        k.append_missing_weeks(week, path, WEEK)
    assert rows(read(spark, path)) == [("a", 202001, 1.0), ("a", None, 9.0)]
    more = spark.createDataFrame([("a", 202002, 2.0), ("b", 202002, 3.0)], SCHEMA)
    more.limit(1).write.mode("append").partitionBy(WEEK).parquet(path)  # what a failed load left
    for _ in range(2):
        k.append_missing_weeks(more, path, WEEK)
    assert rows(read(spark, path)) == [("a", 202001, 1.0), ("a", 202002, 2.0), ("a", None, 9.0), ("b", 202002, 3.0)]


def read(spark, path):
    return spark.read.schema(SCHEMA).parquet(path).select("distributor", WEEK, "lbs")


def test_partitions_are_replaced_exactly(spark, base, new, rows):
    path, keys = staging_path(spark, "k3"), ["distributor", WEEK]
    k.write_partitions(base.dropna(), path, keys)
    for _ in range(2):
        k.write_partitions(new, path, keys)
        assert rows(read(spark, path)) == [("a", 202001, 1.0), ("a", 202002, 20.0), ("a", 202003, 30.0), ("b", 202002, 3.0)]


def test_append_missing_is_idempotent(spark, base, new, rows):
    path = staging_path(spark, "k5")
    for _ in range(2):
        k.append_missing_weeks(base.dropna(), path, WEEK)
    for _ in range(2):
        k.append_missing_weeks(new, path, WEEK)
    assert rows(read(spark, path)) == [("a", 202001, 1.0), ("a", 202002, 2.0), ("a", 202003, 30.0), ("b", 202002, 3.0)]


def test_backfill_moves_on(spark, rows):
    weeks = spark.createDataFrame([("a", 202000 + i, float(i)) for i in range(1, 6)], SCHEMA)
    path = staging_path(spark, "k6")
    for expected in (2, 4, 5, 5):
        k.backfill_weeks(weeks, path, WEEK, limit=2)
        assert read(spark, path).count() == expected


def test_version_is_never_overwritten(spark, base):
    root = staging_path(spark, "k2")
    k.save_version(base, root, "1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        k.save_version(base, root, "1")


def test_reload_and_report(spark, base, new, rows):
    path = staging_path(spark, "k7")
    k.reload(base, path)
    k.reload(new, path)
    assert rows(spark.read.parquet(path)) == rows(new)
    paths = k.write_report({"R": new.withColumnRenamed("lbs", "LBS")}, staging_path(spark, "k10"))
    assert spark.read.parquet(paths["R"]).columns == ["distributor", WEEK, "lbs"]


def test_streams_equal_batch_loads(spark, base, new, rows):
    incoming, target, progress = (staging_path(spark, x) for x in ("in", "table", "progress"))
    def arrive(df):
        df.write.mode("append").parquet(incoming)
    def load():
        stream = loads.file_stream(spark, incoming, base.schema)
        loads.stream_append_missing(stream, target, progress, WEEK, lambda df: df.dropna())
    arrive(base)
    load()
    arrive(new)
    load()
    load()  # nothing new
    assert rows(read(spark, target)) == [("a", 202001, 1.0), ("a", 202002, 2.0), ("a", 202003, 30.0), ("b", 202002, 3.0)]

    replaced = staging_path(spark, "replaced")
    stream = loads.file_stream(spark, incoming, base.schema)
    k.write_partitions(base.dropna().withColumn("lbs", base.lbs * 7), replaced, ["distributor", WEEK])
    loads.stream_replace(stream, replaced, staging_path(spark, "p2"), ["distributor", WEEK], lambda df: df.dropna())
    got = rows(read(spark, replaced))
    assert ("a", 202001, 1.0) in got and ("b", 202002, 3.0) in got and ("a", 202003, 30.0) in got and len(got) == 5
