import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from weekmart.plans import conform as p
from weekmart.sources import readers as r
from weekmart.sources import schemas as sc


@pytest.fixture()
def folder(tmp_path):
    """Folder with a blank in its name, as deliveries have."""
    path = tmp_path / "Weekly Files"
    path.mkdir()
    return path


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_regional_report(spark, folder, rows):
    header = ",".join(sc.REGIONAL_US.fieldNames())
    line = lambda branch, unit, week, lbs: ",".join([branch, unit, *["x"] * 17, week, "m", f'"{lbs}"'])
    path = write(folder / "r.csv", "\n".join([header, line("N", "Bars", "2020-03-08", "1,234.5"), line("N", " ", " ", "7"), line("Total", " ", " ", "9,999")]))
    out = r.read_regional(spark, path, sc.REGIONAL_US)
    assert rows(out, "business_unit", "week_of", "lbs") == [("Bars", "2020-03-08", 1234.5), (None, None, 7.0)]


def test_sections(spark, folder, rows):
    schema = sc.text("Week of", "LBS")
    first = write(folder / "a.csv", "Week of,Unnamed: 21\n1,2\n")
    second = write(folder / "b.csv", "3,4\n5,6\n")
    assert rows(r.read_sections(spark, first, [second], schema)) == [("1", "2"), ("3", "4"), ("5", "6")]


def test_wide_to_long(spark, rows):
    wide = spark.createDataFrame([("a", None, "1,000", "-"), ("b", None, " 2 ", None)], "`id` string, ` ` string, `202001` string, `202002` string")
    assert rows(r.wide_to_long(wide, ["id"])) == [("a", 202001, 1000.0), ("a", 202002, None), ("b", 202001, 2.0), ("b", 202002, None)]


def test_dates_from_paths(spark, folder, rows):
    write(folder / "2024-05-10" / "Sales (2024-04-29 - 2024-05-05).csv", "v\n1\n")
    write(folder / "Inv" / "21 May 2023.csv", "v\n2\n")
    files = r.read_delimited(spark, str(folder), sc.text("v"), recursive=True)
    dated = r.with_file_date(files, "folder_date")
    dated = r.with_file_date(dated, "snapshot", r.DAY_MONTH_YEAR, "dd MMM yyyy").withColumn("names", r.dates_in(r.file_name()))
    assert rows(dated, "v", "folder_date", "snapshot", "names") == [
        ("1", dt.date(2024, 5, 10), None, [dt.date(2024, 4, 29), dt.date(2024, 5, 5)]), ("2", None, dt.date(2023, 5, 21), [])]


def test_report_folder(spark, folder, rows):
    names = sc.NATIONAL_US_REPORT.fieldNames()
    value = {"City": "austin", "State": "tx", "Account Number": "12.0", "Pack": "6/5 LB", "Size": "each", "Qty": "1,000", "Segment": " s "}
    write(folder / "x" / "Sales_Report (2024-04-29 - 2024-05-05).csv", ",".join(names) + "\n" + ",".join(f'"{value.get(n, n)}"' for n in names) + "\n")
    out = p.load_national_report(p.read_national_report_folder(spark, str(folder), sc.NATIONAL_US_REPORT, "Sales_Report*"))
    assert rows(out, "city", "state", "account_number", "pack", "size", "qty", "segment", "week_beginning_date") == [
        ("AUSTIN", "TX", "12", "6", "5 LB", 1000.0, "s", dt.date(2024, 4, 28))]


def test_date_in_last_header(spark, folder, rows):
    head = "Area,Market,Pyramid Segment,ASYS Code,ASYS,GTIN,MFG Number"
    write(folder / "one.csv", f"{head},2024-03-24 11\nA,m1,seg,5.0,n,g,1,\"1,000.5\"\nA,,seg,5.0,n,g,1,2\n")
    write(folder / "two.csv", f"{head},2024-03-31 12\nA,m1,a - b,5.0,n,g,1,3\nA,m2,,6,n,g,1,4\n")
    raw = r.read_shared(spark, str(folder), sc.NATIONAL_US_SHARED)
    assert rows(raw, "week_beginning_date", "lbs") == [
        (dt.date(2024, 3, 24), "1,000.5"), (dt.date(2024, 3, 24), "2"), (dt.date(2024, 3, 31), "3"), (dt.date(2024, 3, 31), "4")]
    regions = spark.createDataFrame([("m1", "M1", "East", "NY")], "market string, market_clean string, region string, state string")
    assert rows(p.load_national_shared(raw, regions), "market", "region", "asys_id", "week_beginning_date", "lbs") == [
        ("M1", "East", "5", dt.date(2024, 3, 24), 1000.5), (None, None, "6", dt.date(2024, 3, 31), 4.0)]


def test_matching_files_with_different_layouts(spark, folder, rows):
    write(folder / "sellout_region_a.csv", "Region,LBS,Consolidated Category\nE,1,Perpared Foods\n")
    write(folder / "sellout_region_b.csv", "LBS,Distributor\n2,D\n")
    write(folder / "other.csv", "LBS\n9\n")
    out = r.read_matching(spark, str(folder), "region", {"Perpared Foods": "Prepared Foods"})
    assert rows(out, "region", "lbs", "consolidated category", "distributor") == [("E", "1", "Prepared Foods", None), (None, "2", None, "D")]


def test_releases(spark, folder, rows):
    write(folder / "releases.json", json.dumps({"releases": [{"id": 1, "name": "Sales", "press_release": True}, {"id": 2, "name": "Other"}]}, indent=1))
    out = r.read_releases(spark, str(folder / "releases.json"), sc.RELEASES, contains="Sal")
    assert rows(out, "id", "name", "press_release") == [(1, "Sales", True)]


def test_gzip_tsv(spark, folder, rows):
    with gzip.open(folder / "a.tsv.gz", "wt") as f:
        f.write("a\tb\n1\t2\n")
    assert rows(r.read_delimited(spark, str(folder / "a.tsv.gz"), sc.text("a", "b"), sep="\t")) == [("1", "2")]


def test_latin_text(spark, folder, rows):
    (folder / "c.csv").write_bytes("city\nMontréal – “x” €\n".encode("cp1252"))
    assert rows(r.read_delimited(spark, str(folder / "c.csv"), sc.text("city"), encoding="cp1252")) == [("Montréal – “x” €",)]


def test_warehouse_join_kinds(spark, rows):
    fact = spark.createDataFrame([("o1", "00p1", 1, 1.0, 1.0), ("o2", "00p1", 1, 2.0, 1.0), ("o1", "p2", 2, 4.0, 1.0)],
                                 "operator_id string, product_id string, provider_id int, sales_lbs double, sales_cases double")
    fact = fact.withColumns({"period_start": F.lit("s"), "period_end": F.lit("e")})
    account = spark.createDataFrame([("o1", "S", " seg ", "sub")], "operator_id string, sector string, segment string, subsegment string")
    product = spark.createDataFrame([("p1", "POT ")], "product_id string, category string")
    provider = spark.createDataFrame([(1, "One"), (2, "Two")], "provider_id int, provider_name string")
    left = r.warehouse_sellout(fact, account, product, provider, "One")
    assert rows(left, "sector", "segment", "category", "lbs") == [("S", "seg", "POT", 1.0), (None, None, "POT", 2.0)]
    inner = r.warehouse_sellout(fact, account, product, provider, "One", "inner")
    assert rows(inner, "sector", "lbs") == [("S", 1.0)]
    assert r.warehouse_sellout(fact, account, product, provider).count() == 3
