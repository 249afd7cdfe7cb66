import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekmart.functions import dates as d

MON, WED, SAT, SUN = dt.date(2024, 3, 18), dt.date(2024, 3, 20), dt.date(2024, 3, 23), dt.date(2024, 3, 24)


@pytest.fixture(scope="module")
def evaluate(spark):
    def run(expression, *days):
        frame = spark.createDataFrame([(x,) for x in days], "day date")
        return [r[0] for r in frame.select(expression(F.col("day"))).collect()]
    return run


@pytest.mark.parametrize("expression, expected", [
    (d.sunday_on_or_after, [SUN, SUN, SUN, SUN]),
    (d.sunday_before, [dt.date(2024, 3, 17)] * 4),
    (d.sunday_on_or_before, [dt.date(2024, 3, 17)] * 3 + [SUN]),
    (d.monday_on_or_before, [MON] * 4),
    (d.monday_after, [dt.date(2024, 3, 25)] * 4),
    (d.day_after_saturday, [SUN] * 3 + [dt.date(2024, 3, 31)]),
    (d.day_before, [dt.date(2024, 3, 17), dt.date(2024, 3, 19), dt.date(2024, 3, 22), SAT]),
    (d.saturday_of_sunday_week, [dt.date(2024, 3, 24), dt.date(2024, 3, 26), dt.date(2024, 3, 29), dt.date(2024, 3, 30)]),
])
def test_week_days(evaluate, expression, expected):
    assert evaluate(expression, MON, WED, SAT, SUN) == expected


def test_iso_key_at_year_ends(evaluate):
    days = [dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.date(2021, 1, 3), dt.date(2021, 1, 4), dt.date(2018, 12, 31)]
    assert evaluate(d.iso_week_key, *days) == [202053, 202053, 202053, 202101, 201901]


def test_fiscal_calendar(spark, rows):
    frame = spark.createDataFrame([(dt.date(2023, m, 1),) for m in range(1, 13)], "day date")
    got = rows(d.with_fiscal(frame, "day"), "fiscal_year", "fiscal_period", "fiscal_quarter")
    assert got == sorted(
        [(2023, 7, 3), (2023, 8, 3), (2023, 9, 3), (2023, 10, 4), (2023, 11, 4), (2023, 12, 4),
         (2024, 1, 1), (2024, 2, 1), (2024, 3, 1), (2024, 4, 2), (2024, 5, 2), (2024, 6, 2)], key=str)


def test_unreadable_dates_are_null(spark):
    frame = spark.createDataFrame([("2024-03-18",), ("n/a",), (None,)], "t string")
    assert [r[0] for r in frame.select(d.parse_date(F.col("t"))).collect()] == [MON, None, None]


def test_padded_week_key(spark):
    frame = spark.createDataFrame([(2024, 3), (2024, 12)], "y int, w int")
    assert [r[0] for r in frame.select(d.year_week_text(F.col("y"), F.col("w"))).collect()] == [202403, 202412]
