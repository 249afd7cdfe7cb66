"""Date and week expressions over order and ship dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekmart.catalog.base import lines, query, table, with_ctes
from weekmart.functions import dates as d
from weekmart.sources.readers import dates_in

ORDERS = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)"


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


def column(name, sql, expression, out="result"):
    """Register one date expression over all order dates."""
    @query(name, f"SELECT o_orderkey, {sql} AS {out} FROM {ORDERS}")
    def run(spark, sf):
        return orders(spark, sf).select("o_orderkey", expression(F.col("day")).alias(out))


column("e1_parse_date", "CASE WHEN day < DATE '1999-01-01' THEN day END",
       lambda day: d.parse_date(F.when(day < "1999-01-01", F.date_format(day, "MM/dd/yyyy")).otherwise("n/a"), "MM/dd/yyyy"))
column("e2_saturday_of_sunday_week", "day - dayofweek(day)::INT + 6",
       lambda day: d.saturday_of_sunday_week(d.sunday_on_or_before(day)))
column("e3_sunday_on_or_after", "day + (7 - isodow(day))::INT", d.sunday_on_or_after)
column("e4_sunday_before", "day - isodow(day)::INT", d.sunday_before)
column("e6_year_week_key", "(year(day) * 100 + (dayofyear(day) - 1) // 7 + 1)::INTEGER",
       lambda day: d.year_week(F.year(day), F.floor((F.dayofyear(day) - 1) / 7) + 1))
column("e8_monday_after", "day + (8 - isodow(day))::INT", d.monday_after)
column("e9_day_after_saturday", "day + (6 - dayofweek(day))::INT + 1", d.day_after_saturday)
column("e10_day_before_file_date", "day - 1",
       lambda day: d.day_before(F.get(dates_in(F.concat(F.lit("Report ("), day.cast("string"), F.lit(").csv"))), 0)))


@query("e5_fiscal_calendar", f"""
SELECT o_orderkey, (year(day) + (month(day) >= 7)::INT)::INTEGER AS fiscal_year,
  (CASE WHEN month(day) > 6 THEN month(day) - 6 ELSE month(day) + 6 END)::INTEGER AS fiscal_period,
  (CASE WHEN month(day) BETWEEN 7 AND 9 THEN 1 WHEN month(day) >= 10 THEN 2 WHEN month(day) <= 3 THEN 3 ELSE 4 END)::INTEGER AS fiscal_quarter
FROM {ORDERS}""")
def fiscal_calendar(spark, sf):
    return d.with_fiscal(orders(spark, sf), "day").drop("day")


@query("e7_iso_week_and_year", f"SELECT o_orderkey, week(day)::INTEGER AS week, isoyear(day)::INTEGER AS year FROM {ORDERS}")
def iso_week_and_year(spark, sf):
    day = F.col("day")
    return orders(spark, sf).select("o_orderkey", d.iso_week(day).alias("week"), d.iso_year(day).alias("year"))


@query("e11_weekly_sum", with_ctes(["lines"], select="""
SELECT ship_date + (7 - isodow(ship_date))::INT AS week_ending_sun, l_returnflag, sum(l_quantity) AS l_quantity FROM lines GROUP BY ALL"""))
def weekly_sum(spark, sf):
    return d.weekly_sum(lines(spark, sf), "ship_date", "l_quantity", ("l_returnflag",))
