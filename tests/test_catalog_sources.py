import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekmart.catalog import sources
from weekmart.operators.calendar import WEEK


@pytest.fixture()
def raw(spark):
    """Order lines of two years, made by five tasks."""
    rows = [(k % 25, f"n{k % 25}", "5-LOW", "S", k, "p", 1.0 + k, dt.date(1996 + k % 2, 3, 1)) for k in range(40)]
    return spark.createDataFrame(rows, "c_nationkey int, n_name string, o_orderpriority string, market_segment string, l_partkey int, p_name string, "
                                       "l_quantity double, order_date date").repartition(5)


@pytest.mark.parametrize("most, files", [(4_000_000, 1), (10, 2)])
def test_files_by_lines_not_by_tasks(spark, monkeypatch, raw, most, files):
    monkeypatch.setattr(sources, "raw_lines", lambda spark, sf: raw)
    monkeypatch.setattr(sources, "LINES_A_FILE", most)
    folders = sources.shared_files(spark, "")
    assert len(folders) == 2
    for folder in folders:
        written = spark.read.option("header", "true").csv(folder)
        assert written.count() == 20 and len(written.inputFiles()) <= files


def test_sheet_is_made_of_sums_by_week(spark, monkeypatch):
    fact = spark.createDataFrame([("a", "x", 202001, 2.0), ("a", "x", 202001, 3.0), ("a", "x", 202002, 26.0), ("b", "x", 202002, 1.0)],
                                 f"state string, category string, {WEEK} int, lbs double")
    sheets, to_long = [], sources.r.wide_to_long
    monkeypatch.setattr(sources, "sellout", lambda spark, sf: fact)
    monkeypatch.setattr(sources.r, "wide_to_long", lambda wide, ids: sheets.append(wide) or to_long(wide, ids))
    out = sources.wide_to_long(spark, "")
    got = {(x.state, x.calendar_week): x.lbs for x in out.collect()}
    assert got == {("a", 202001): 5.0, ("a", 202002): None, ("b", 202001): None, ("b", 202002): 1.0}
    read = sheets[0].inputFiles()
    assert read and spark.read.parquet(*read).agg(F.count("*")).first()[0] == 3  # of four lines
