import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.plans import marts, models, sellin
from weekmart.plans.analysis import ReportSpec
from weekmart.plans.conform import Dictionaries, conform_canada_one


@pytest.fixture(scope="module")
def dated(spark):
    return spark.createDataFrame([
        (dt.date(2020, 3, 15), "Sweet Potato", 1.0), (dt.date(2020, 3, 15), "Potato", 2.0), (dt.date(2020, 3, 15), None, 4.0),
        (dt.date(2020, 3, 22), "Onion", 8.0), (dt.date(2020, 3, 18), "Potato", 16.0),
    ], "calendar_week date, category_desc string, actual_volume_lbs double")


def test_prepare_drops_or_keeps_unmatched_dates(dated, calendar, rows):
    weekly = sellin.prepare_sellin(dated, calendar).groupBy(WEEK, sellin.CATEGORY).agg(F.sum("lbs"))
    assert rows(weekly) == [(202011, "Potato", 3.0), (202011, "Prepared Foods", 4.0), (202012, "Prepared Foods", 8.0)]
    kept = sellin.prepare_sellin(dated, calendar, keep_unmatched=True).groupBy(WEEK, sellin.CATEGORY).agg(F.sum("lbs"))
    assert (0, "Potato", 16.0) in rows(kept)


def test_keyed_sellin_coerces_weeks(spark, rows):
    keyed = spark.createDataFrame([("202011", "Potato", "1.5"), ("#", "x", "2")], "calendar_week_number string, category_desc string, actual_volume_lbs string")
    assert rows(sellin.prepare_keyed_sellin(keyed), WEEK, sellin.CATEGORY, "lbs") == [(202011, "Potato", 1.5), (None, "Prepared Foods", 2.0)]


def test_left_join_multiplies_sums(spark, rows):
    fact = spark.createDataFrame([(1, 10.0)], "order_id int, lbs double")
    fulfilment = spark.createDataFrame([(1,), (1,)], "id int")
    out = sellin.star_extract(fact, [sellin.Link(fulfilment, {"order_id": "id"}, "left")], [], {"order_id": F.col("order_id")}, {"lbs": F.col("lbs")})
    assert rows(out) == [(1, 20.0)]


def test_compare_fills_missing_sellin(spark, dated, calendar, rows):
    sellout = spark.createDataFrame([("Potato", 202011, 5.0), ("Potato", 202013, 7.0)], f"{sellin.CATEGORY} string, {WEEK} int, lbs double")
    out = sellin.compare(sellin.prepare_sellin(dated, calendar), sellout, calendar, "North")
    assert len(out.columns) == 38
    assert rows(out, WEEK, "lbs", "sellin_lbs", "sellin_sma_4", "distributor") == [
        (202011, 5.0, 3.0, 3.0, "North"), (202013, 7.0, 0.0, 0.0, "North")]


def test_fair_share(spark, rows):
    def period(*values):
        return spark.createDataFrame(values, "merch_category string, market string, lbs string, gap string")
    out = marts.fair_share(
        {13: period(("a", "m", "9,000", "-")), 52: period(("a", "m", "10,001", "-5"), ("b", "m", "10,000", "1"))},
        ["merch_category", "market"], ["lbs", "gap"], "lbs_52wk")
    assert rows(out) == [("a", "m", 9000.0, 0.0, 10001.0, -5.0)]


def test_combined_sales_takes_first_delivery(spark, calendar, rows):
    files = spark.createDataFrame([(1, 202011, "7", "1,000"), (2, 202011, "7", "9"), (2, 202012, "8", "-2")],
                                  "file_order int, year_week int, mfg_number string, lb_current string")
    skus = spark.createDataFrame([("7", "old", 1), ("7", "new", 2)], "mfg_number string, maker_sku_id string, row_order int")
    out = marts.combined_sales(files, skus, calendar)
    assert rows(out, "year_week", "maker_sku_id", "week_ending_sun", "lbs") == [
        (202011, "new", dt.date(2020, 3, 15), 1000.0), (202012, None, dt.date(2020, 3, 22), -2.0)]


def test_inventory(spark, rows):
    snapshots = spark.createDataFrame([("g1", dt.date(2023, 7, 2), 5.0), ("g2", dt.date(2023, 7, 3), 6.0)], "manufacturer_gtin string, date date, cases double")
    skus = spark.createDataFrame([("g1", "s1", 1)], "manufacturer_gtin string, maker_sku_id string, row_order int")
    products = spark.createDataFrame([("s1", "Sweet Potato")], "maker_sku_id string, category string")
    sales = spark.createDataFrame([("s1", "b1"), ("s1", "b2"), ("s1", "b2"), ("s1", None)], "maker_sku_id string, brand string")
    out = marts.inventory(snapshots, skus, products, sales, ["brand"])
    assert rows(out, "manufacturer_gtin", "week_ending_sun", "consolidated_category", "brand") == [
        ("g1", dt.date(2023, 7, 2), "Potato", "b1"), ("g1", dt.date(2023, 7, 2), "Potato", "b2"), ("g2", dt.date(2023, 7, 9), None, None)]


def test_fill_rate_week_end(spark, rows):
    orders = spark.createDataFrame(
        [("m", "c", "US", "10", "Z", "done", dt.date(2021, 2, 6), 5, 4), ("m", "c", "US", "10", "Z", "open", dt.date(2021, 2, 6), 9, 9)],
        "material_id string, customer_id string, org string, channel string, document_type string, completion string, issue_date date, ordered int, delivered int")
    products = spark.createDataFrame([("m", "D", "Sweet Potato", "F", "S", "desc")],
                                     "material_id string, division string, category string, format string, sub_format string, material string")
    customers = spark.createDataFrame([("c", "US", "10", "L1", "L2")], "customer_id string, org string, channel string, customer_l1 string, customer_l2 string")
    out = marts.fill_rate(orders, products, customers, dt.date(2021, 1, 1), ["US"], "done", "Z", "10")
    assert rows(out, "week_ending", "category", "ordered_cases", "delivered_cases") == [(dt.date(2021, 2, 7), "Potato", 5.0, 4.0)]


def test_compiled_regions(spark, rows):
    us = spark.createDataFrame([("c", "TX", "L1", "L2", "R", "Potato", "D", 1.0, dt.date(2020, 3, 8))],
                               "city string, state string, segment_l1 string, segment_l2 string, restaurants string, consolidated_category string, "
                               "distributor string, lbs double, week_beginning_date date")
    canada = spark.createDataFrame([("NA", "ON", "L1", "L2", "T", "Potato", "E", 2.0, dt.date(2020, 3, 14))],
                                   "city string, region string, segment_l1 string, segment_l2 string, service_type string, consolidated_category string, "
                                   "distributor string, lbs double, week_ending_sat date")
    out = marts.compile_regions(us, canada)
    assert rows(out, "region", "service_type", "lbs", "week_ending_sat") == [
        ("ON", "T", 2.0, dt.date(2020, 3, 14)), ("TX", "R", 1.0, dt.date(2020, 3, 14))]


def test_whole_model(spark, dated, calendar, rows, tmp_path):
    labels = "segment_l1 string, segment_l2 string, restaurants string, service_type string"
    segments = spark.createDataFrame([("S", "g", "u", "Casual", "All Other", "R", "T")], f"sector string, segment string, subsegment string, {labels}")
    raw = spark.createDataFrame([("S", "g", "u", "POT", dt.date(2020, 3, 14), 5.0), ("Q", "g", "u", "x", dt.date(2020, 3, 21), 6.0)],
                                "sector string, segment string, subsegment string, category string, period_end date, lbs double")
    columns = ("segment_l1", "segment_l2", sellin.CATEGORY, WEEK, "lbs")
    base = spark.createDataFrame([("Casual", "All Other", "Potato", 202010, 3.0), ("Casual", "All Other", "Potato", 202011, 99.0)],
                                 f"segment_l1 string, segment_l2 string, {sellin.CATEGORY} string, {WEEK} int, lbs double")
    model = models.DistributorModel(conform_canada_one, columns, {"region": ["segment_l1", "segment_l2"]}, ReportSpec(label="CA One"),
                                    ("sector", "segment", "subsegment"))
    day = dt.date(2020, 4, 1)
    out = models.run_model(model, raw, Dictionaries(segments), calendar, base, sellin.prepare_sellin(dated, calendar), day)
    assert rows(out["history"], WEEK, "lbs") == [(202010, 3.0), (202011, 5.0), (202012, 6.0)]
    assert rows(out["region"], "segment_l2", WEEK, "lbs", "lbs_lag_1") == [
        ("Chain", 202010, 3.0, 0.0), ("Chain", 202011, 5.0, 3.0), ("Chain", 202012, 0.0, 5.0)]
    assert rows(out["unmapped_segments"]) == [("Q", "g", "u", 6.0, "CA One", day)]
    assert rows(out["totals"]) == [("after", 2, 11.0), ("before", 2, 11.0)]
    assert out["sellin_and_sellout"].count() == 6
    for _ in range(2):  # the second run of a day replaces the first
        models.write_unmapped(out, str(tmp_path))
    written = spark.read.parquet(f"{tmp_path}/unmapped_segments")
    assert rows(written, "sector", "segment", "subsegment", "lbs", "source", "report_date") == [("Q", "g", "u", 6.0, "CA One", day)]


def test_model_of_an_empty_delivery(spark, calendar, rows):
    labels = "segment_l1 string, segment_l2 string, restaurants string, service_type string"
    segments = spark.createDataFrame([], f"sector string, segment string, subsegment string, {labels}")
    raw = spark.createDataFrame([], "sector string, segment string, subsegment string, category string, period_end date, lbs double")
    model = models.DistributorModel(conform_canada_one, ("segment_l1", WEEK, "lbs"), {"region": ["segment_l1"]}, ReportSpec(label="CA One"),
                                    ("sector", "segment", "subsegment"))
    out = models.run_model(model, raw, Dictionaries(segments), calendar)
    assert rows(out["totals"]) == [("after", 0, 0.0), ("before", 0, 0.0)]
    assert out["history"].count() == out["region"].count() == out["unmapped_segments"].count() == 0
