import datetime
import threading

from pyspark.sql import functions as F

from weekmart import session
from weekmart.catalog import base, sources
from weekmart.plans.marts import inventory
from weekmart.plans.sellin import Link, star_extract


def test_larger_facts_make_more_tasks(spark, tmp_path, monkeypatch):
    spark.range(40).selectExpr("id AS l_orderkey", "id % 7 AS l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).selectExpr("id AS o_orderkey", "current_timestamp() AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    own = spark.newSession()
    monkeypatch.setattr(session, "TASK_ROWS", 2)
    assert base.order_lines(own, str(tmp_path)).count() == 40
    assert own.conf.get(session.TASK_BYTES_SETTING) == session.TASK_BYTES
    assert own.conf.get(session.PARTITIONS_SETTING) == "20"


def test_settings_of_the_user_stay(spark):
    own = spark.newSession()
    own.conf.set(session.TASK_BYTES_SETTING, "32m")
    own.conf.set(session.PARTITIONS_SETTING, "500")
    session.bound_tasks(own, 10_000_000)
    assert own.conf.get(session.TASK_BYTES_SETTING) == "32m" and own.conf.get(session.PARTITIONS_SETTING) == "500"
    small = spark.newSession()
    session.bound_tasks(small, 100)
    assert small.conf.get(session.PARTITIONS_SETTING, None) is None


def test_dimensions_are_not_broadcast_by_the_size_of_their_files(spark, tmp_path):
    """A file of 1 MB is under Spark's threshold, its rows times six are not."""
    spark.range(40).selectExpr("id AS l_orderkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).selectExpr("id AS o_orderkey", "current_timestamp() AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(300_000).selectExpr("id AS customer_id", "repeat('x', 20) AS name").write.parquet(f"{tmp_path}/customer.parquet")
    own = spark.newSession()
    base.order_lines(own, str(tmp_path))
    side = own.read.parquet(f"{tmp_path}/customer.parquet").withColumn("channel", F.explode(F.array(*map(F.lit, "ABCDEF"))))
    facts = own.createDataFrame([(1, "A", 2.0), (2, "B", 3.0), (9, "Z", 5.0)], "customer_id long, channel string, lbs double")
    out = star_extract(facts, [Link(side, {"customer_id": "customer_id", "channel": "channel"})], [], {"name": F.col("name")}, {"lbs": F.col("lbs")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [tuple(r) for r in out.collect()] == [("x" * 20, 5.0)]


def test_broadcasts_measured_and_settings_of_the_user(spark):
    own = spark.newSession()
    session.bound_tasks(own, 10)
    assert own.conf.get(session.FILE_BROADCAST_SETTING) == "256k" and own.conf.get(session.MEASURED_BROADCAST_SETTING) == "10m"
    assert own.conf.get(session.SPLIT_BYTES_SETTING) == "32m" and own.conf.get(session.OPEN_COST_SETTING) == "1m"
    other = spark.newSession()
    other.conf.set(session.FILE_BROADCAST_SETTING, "-1")
    session.bound_tasks(other, 10)
    assert other.conf.get(session.FILE_BROADCAST_SETTING) == "-1" and other.conf.get(session.MEASURED_BROADCAST_SETTING, None) is None


def test_inventory_is_dealt_out_by_rows(spark, rows):
    own = spark.newSession()
    own.conf.set(session.PARTITIONS_SETTING, "23")
    day = datetime.date(2020, 4, 1)
    snapshots = own.createDataFrame([("1", day, 2.0), ("2", day, 3.0)], "manufacturer_gtin string, date date, on_hand double")
    skus = own.createDataFrame([("1", "M1", 1), ("2", "M2", 1)], "manufacturer_gtin string, maker_sku_id string, row_order int")
    products = own.createDataFrame([("M1", "Sweet Potato")], "maker_sku_id string, category string")
    sales = own.createDataFrame([("M1", "A"), ("M1", "B"), ("M1", "B"), ("M2", None)], "maker_sku_id string, brand_type string")
    out = inventory(snapshots, skus, products, sales, ["brand_type"])
    assert out.rdd.getNumPartitions() == 23  # not merged by bytes
    assert rows(out, "maker_sku_id", "category", "brand_type", "on_hand") == [
        ("M1", "Sweet Potato", "A", 2.0), ("M1", "Sweet Potato", "B", 2.0), ("M2", None, None, 3.0)]


def test_wide_sheet_is_pivoted(spark, rows, monkeypatch):
    """Each sum goes to its cell at once: no condition for every week."""
    facts = spark.createDataFrame([("a", "x", 200001, 20.0), ("a", "x", 200001, 6.0), ("a", "x", 200002, 1.5), ("b", "y", 200002, None)],
                                  "state string, category string, calendar_week_year int, lbs double")
    monkeypatch.setattr(sources, "sellout", lambda *_: facts)
    out = sources.wide_to_long(spark, "")
    assert "pivotfirst" in out._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(out, "state", "category", "calendar_week", "lbs") == [
        ("a", "x", 200001, None), ("a", "x", 200002, 1.5), ("b", "y", 200001, None), ("b", "y", 200002, None)]


def test_years_are_written_side_by_side(spark, monkeypatch):
    raw = spark.createDataFrame([(1, "N", "5-LOW", None, 3, "p", 4.0, datetime.date(y, 2, 1)) for y in (1999, 2000)],
        "c_nationkey int, n_name string, o_orderpriority string, market_segment string, l_partkey long, p_name string, l_quantity double, order_date date")
    monkeypatch.setattr(sources, "raw_lines", lambda *_: raw)
    both, write = threading.Barrier(2, timeout=60), sources.csv_folder

    def waiting(*args, **options):
        both.wait()
        return write(*args, **options)
    monkeypatch.setattr(sources, "csv_folder", waiting)
    paths = sources.shared_files(spark, "")
    assert [spark.read.option("header", "true").csv(p).columns[-1] for p in paths] == ["1999-01-07 1", "2000-01-07 1"]
