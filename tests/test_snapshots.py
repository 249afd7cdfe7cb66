import threading

import pytest
from pyspark.sql import functions as F

from weekmart.sources import snapshots as t

SCHEMA = "distributor string, week int, lbs double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture()
def path(tmp_path):
    return f"{tmp_path}/table"


def held(spark, path, number=None):
    rows = t.read_snapshot(spark, path, number).collect()
    return sorted((tuple(r) for r in rows), key=str)


FIRST = [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 4.0)]


def test_loads_replace_whole_partitions_and_keep_versions(spark, path):
    assert t.replace_partitions(frame(spark, *FIRST), path, ["distributor"]) == 1
    assert t.replace_partitions(frame(spark, ("a", 9, 8.0)), path, ["distributor"]) == 2
    assert held(spark, path) == [("a", 9, 8.0), ("b", 1, 4.0)]
    assert held(spark, path, 1) == sorted(FIRST, key=str)
    assert t.replace_partitions(frame(spark).limit(0), path, ["distributor"]) == 2
    assert t.replace_table(t.read_snapshot(spark, path).filter("lbs > 5"), path, ["distributor"]) == 3  # reads what it replaces
    assert held(spark, path) == [("a", 9, 8.0)] and t.versions(spark, path) == [1, 2, 3]
    assert t.replace_table(frame(spark).limit(0), path) == 4 and held(spark, path) == []


def test_null_and_odd_keys(spark, path):
    keys = [None, "", "a b", "50%", "x/y", "k=v", "é:*?", "01"]
    rows = [(k, n, float(n)) for n, k in enumerate(keys)]
    t.replace_partitions(frame(spark, *rows), path, ["distributor", "week"])
    read = {(r.week, r.distributor, r.lbs) for r in t.read_snapshot(spark, path).collect()}
    assert read == {(n, k or None, float(n)) for n, k in enumerate(keys)}  # partitioned writes keep no empty text
    t.replace_partitions(frame(spark, (None, 0, 9.0), ("50%", 3, 9.0)), path, ["distributor", "week"])
    assert {r.week: r.lbs for r in t.read_snapshot(spark, path).collect()} == {n: 9.0 if n in (0, 3) else float(n) for n in range(8)}


def test_a_load_that_dies_leaves_the_table_as_it_was(spark, path, monkeypatch):
    t.replace_partitions(frame(spark, *FIRST), path, ["distributor"])
    before = t.read_snapshot(spark, path)
    halfway = frame(spark, ("a", 1, 5.0), ("b", 1, 5.0), ("c", 1, 5.0)).repartition(3, "distributor").withColumn(
        "lbs", F.when(F.col("distributor") == "c", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("lbs")))
    with pytest.raises(Exception, match="lost"):
        t.replace_partitions(halfway, path, ["distributor"])
    assert held(spark, path) == sorted(FIRST, key=str)
    monkeypatch.setattr(t, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):  # everything written, nothing named
        t.replace_partitions(frame(spark, ("a", 1, 5.0)), path, ["distributor"])
    monkeypatch.undo()
    assert held(spark, path) == sorted(FIRST, key=str)
    t.replace_partitions(frame(spark, ("a", 1, 7.0)), path, ["distributor"])
    assert held(spark, path) == [("a", 1, 7.0), ("b", 1, 4.0)]
    assert sorted(map(tuple, before.collect()), key=str) == sorted(FIRST, key=str)  # readers of the old version are not disturbed


def together(spark, path, *loads):
    """Loads that all begin at the same version and publish at the same moment."""
    barrier, results = threading.Barrier(len(loads)), [None] * len(loads)
    publish = t._publish
    waited = threading.local()

    def meet(*args):
        if not getattr(waited, "once", False):
            waited.once = True
            barrier.wait(60)
        return publish(*args)

    def run(k):
        try:
            results[k] = t.replace_partitions(frame(spark, *loads[k]), path, ["distributor"])
        except t.ConflictError as error:
            results[k] = error

    t._publish = meet
    try:
        threads = [threading.Thread(target=run, args=(k,)) for k in range(len(loads))]
        [x.start() for x in threads]
        [x.join(120) for x in threads]
    finally:
        t._publish = publish
    return results


def test_two_loads_of_one_partition_end_in_one_winner(spark, path):
    t.replace_partitions(frame(spark, *FIRST), path, ["distributor"])
    results = together(spark, path, [("a", 1, 10.0)], [("a", 1, 20.0)])
    won = [k for k, r in enumerate(results) if r == 2]
    assert len(won) == 1 and isinstance(results[1 - won[0]], t.ConflictError)
    assert held(spark, path) == [("a", 1, 10.0 * (won[0] + 1)), ("b", 1, 4.0)]


def test_loads_of_different_partitions_both_take_effect(spark, path):
    t.replace_partitions(frame(spark, *FIRST), path, ["distributor"])
    results = together(spark, path, [("a", 1, 10.0)], [("b", 1, 20.0)], [("c", 1, 30.0)])
    assert sorted(results) == [2, 3, 4]
    assert held(spark, path) == [("a", 1, 10.0), ("b", 1, 20.0), ("c", 1, 30.0)]


def test_other_keys_or_columns_are_an_error(spark, path):
    t.replace_partitions(frame(spark, *FIRST), path, ["distributor"])
    with pytest.raises(ValueError):
        t.replace_partitions(frame(spark, *FIRST), path, ["week"])
    with pytest.raises(ValueError):
        t.replace_partitions(frame(spark, *FIRST).withColumn("more", F.lit(1)), path, ["distributor"])
    with pytest.raises(FileNotFoundError):
        t.read_snapshot(spark, path + "-none")


def test_expired_versions_leave_what_is_read(spark, path):
    for n in range(4):
        t.replace_partitions(frame(spark, ("a" if n % 2 else "b", n, float(n))), path, ["distributor"])
    assert t.expire(spark, path, 2) == [1, 2] and t.versions(spark, path) == [3, 4]
    assert held(spark, path) == [("a", 3, 3.0), ("b", 2, 2.0)] and held(spark, path, 3) == [("a", 1, 1.0), ("b", 2, 2.0)]
    assert t.expire(spark, path, 2) == []


def test_filters_on_keys_read_only_their_folders(spark, path):
    t.replace_partitions(frame(spark, *FIRST), path, ["distributor"])
    plan = t.read_snapshot(spark, path).filter("distributor = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(distributor" in plan
