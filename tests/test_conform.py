import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.plans import conform as p

LABELS = "segment_l1 string, segment_l2 string, restaurants string, restaurants_sub string, service_type string, cuisine_type string"
L = ("L1", "L2", "R", "RS", "T", "C")
PRODUCTS = "consolidated_category string, l1_product string, l2_product string"


@pytest.fixture(scope="module")
def regional_maps(spark):
    segments = spark.createDataFrame([("Bars", "S1", "T1", *L)] * 2 + [(None, "S1", "T1", "LN", *L[1:])],
                                     f"business_unit string, sic_code string, sic_sub string, {LABELS}")
    products = spark.createDataFrame([("M1", "Potato", "P1", "P2")] * 2, f"mfg_id string, {PRODUCTS}")
    return p.Dictionaries(segments=segments, products=products)


def test_regional_us(spark, regional_maps, calendar, rows):
    raw = spark.createDataFrame([
        ("BARS", "s1", "t1", "austin", "TX", "m1", "2020-03-08", "1,000.5"),
        (None, "S1", "T1", None, "ZZ", "m9", "2020-03-15", "2"),
        ("Bars", "S1", "T1", "x", "TX", "m1", "2020-03-09", "4"),
        ("Bars", "S1", "T1", "x", "TX", "m1", None, "8"),
    ], "business_unit string, sic_code string, sic_sub string, customer_city string, customer_state string, sku_id string, "
       "week_beginning_date string, lbs string")
    out = p.conform_regional_us(raw, regional_maps, calendar)
    assert rows(out, "segment_l1", "consolidated_category", WEEK, "lbs", "state", "state_name", "city") == [
        ("L1", "Potato", 202011, 1000.5, "TX", "Texas", "NA"), ("LN", None, 202012, 2.0, "ZZ", None, "NA")]


def test_national_report(spark, calendar, rows):
    segments = spark.createDataFrame([("Class", "seg ", " acc", *L)] * 2, f"customer_class string, segment string, account_type string, {LABELS}")
    products = spark.createDataFrame([("7", "Potato", "P1", "P2", 5.0)] * 2, f"mfr_sku string, {PRODUCTS}, case_weight double")
    manufacturers = spark.createDataFrame([("in", "Include"), ("out", "Exclude")], "manufacturer string, inclusion string")
    raw = spark.createDataFrame([
        ("in", "CLASS", " Seg", "ACC ", "7", 2.0, 0.0, "2020-03-09", "tn"),
        ("in", "class", "seg", "acc", "7", 0.0, 0.0, "2020-03-09", "NY"),
        ("in", "class", "seg", "acc", "8", 3.0, 9.0, "2020-03-09", "QQ"),
        ("out", "class", "seg", "acc", "7", 1.0, 1.0, "2020-03-09", "NY"),
        ("in", "class", "seg", "acc", "7", 1.0, 1.0, "2020-03-10", "NY"),
    ], "manufacturer string, customer_class string, segment string, account_type string, mfr_sku string, qty double, weight double, "
       "invoice_week string, state string")
    maps = p.Dictionaries(segments, products, manufacturers)
    out = p.conform_national_report(raw, maps, calendar)
    assert rows(out, "sku_id", "lbs", "segment_l1", "state", "state_name", WEEK) == [
        ("7", 0.0, "L1", "NY", "New York", 202011), ("7", 10.0, "L1", "TN", "Tennessee", 202011), ("8", 9.0, "L1", "None", "None", 202011)]
    export = p.conform_national_export(raw, maps, calendar)
    assert export.count() == 7  # the excluded maker stays, and its product map is taken with the duplicate


def test_national_weekly_keeps_unknown_weeks(spark, calendar, rows):
    segments = spark.createDataFrame([("Seg", *L[:5])] * 2, "pyramid_segment string, " + LABELS.rsplit(",", 1)[0])
    products = spark.createDataFrame([("1", "Potato", "P1", "P2")], f"maker_sku_id string, {PRODUCTS}")
    raw = spark.createDataFrame([("SEG", "1", dt.date(2020, 3, 8), "TX", 1.0), ("seg", "2", dt.date(2020, 3, 9), None, 2.0)],
                                "pyr_segment string, maker_sku_id string, week_beginning_date date, state string, lbs double")
    out = p.conform_national_weekly(raw, p.Dictionaries(segments, products), calendar)
    assert rows(out, "segment_l1", "consolidated_category", WEEK, "state", "city", "lbs") == [
        ("L1", "Potato", 202011, "TX", "NA", 1.0), ("L1", None, None, "None", "NA", 2.0)]


def test_canada_blanks_and_slashes(spark, calendar, rows):
    labels = "segment_l1 string, segment_l2 string, restaurants string, service_type string"
    segments = spark.createDataFrame([("AB", " seg", None, "L1", "L2", "R", "T"), ("AB", None, None, "LB", "L2", "R", "T")],
                                     f"sector string, segment string, subsegment string, {labels}")
    raw = spark.createDataFrame([
        (" A/B ", "seg", "", "FRZ POT", dt.date(2020, 3, 14), 1.0), ("AB", "  ", " ", None, dt.date(2020, 3, 13), 2.0),
        ("AB", "\t", None, "x", dt.date(2020, 3, 14), 4.0),
    ], "sector string, segment string, subsegment string, category string, period_end date, lbs double")
    one = p.conform_canada_one(raw, p.Dictionaries(segments), calendar)
    assert rows(one, "lbs", "segment_l1", "consolidated_category", WEEK, "city", "region") == [
        (1.0, "L1", "Potato", 202011, "NA", "NA"), (2.0, "LB", "Prepared Foods", None, "NA", "NA"),
        (4.0, "LB", "Prepared Foods", 202011, "NA", "NA")]
    two = p.conform_canada_two(raw, p.Dictionaries(segments), calendar)
    assert rows(two, "lbs", "segment_l1") == [(1.0, "L1"), (2.0, "LB"), (4.0, None)]


def test_volume_is_conserved_with_duplicate_mappings(spark, regional_maps, calendar):
    raw = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "bars").otherwise("other").alias("business_unit"), F.lit("s1").alias("sic_code"), F.lit("t1").alias("sic_sub"),
        F.lit("c").alias("customer_city"), F.lit("TX").alias("customer_state"), F.lit("m1").alias("sku_id"),
        F.lit("2020-03-08").alias("week_beginning_date"), F.lit("1").alias("lbs"))
    out = p.conform_regional_us(raw, regional_maps, calendar)
    assert out.agg(F.count("*"), F.sum("lbs")).first() == (5000, 5000.0)


def test_raw_regional_loader(spark, rows):
    columns = list(p.REGIONAL_COLUMNS)
    base = {c: "x" for c in columns} | {"customer_nbr": "12.0", "customer_zip": "00123.0", "prod_nbr": "7", "week_of": "2020-03-08", "lbs": "1.5"}
    raw = spark.createDataFrame([tuple(base[c] for c in columns), tuple({**base, "week_of": None}[c] for c in columns)],
                                ", ".join(f"{c} string" for c in columns))
    assert rows(p.load_regional_us(raw), "customer_number", "customer_zip", "product_number", "week_beginning_date", "lbs") == [
        ("12", "00123", "7", dt.date(2020, 3, 8), 1.5)]
