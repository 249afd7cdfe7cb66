"""Sell-in extracts, preparation and the comparison with sell-out."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from weekmart.catalog.base import (
    BEGIN, END, analysis_ctes, calendar, iso, lines, query, sellout, table, with_ctes,
)
from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.operators import calendar as cal
from weekmart.operators.calendar import WEEK
from weekmart.plans import sellin as p
from weekmart.plans.sellin import Link

AS_OF = datetime.date(2000, 6, 15)
CUTOFF = "DATE '2000-06-11'"


def fact(spark, sf):
    """Order lines under warehouse names: the customer is known per channel and organisation."""
    return lines(spark, sf).select(
        F.col("l_orderkey").alias("order_id"), F.lpad(F.col("l_partkey").cast("string"), 10, "0").alias("material_id"),
        F.col("l_partkey").alias("product_id"), F.col("o_custkey").alias("customer_id"),
        F.col("order_date").alias("accounting_date"), F.col("l_linestatus").alias("channel"),
        F.col("l_returnflag").alias("org"), F.col("l_quantity").alias("weight_lbs"),
        F.col("l_extendedprice").alias("gross"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


def product(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("material_id"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), F.col("p_name").alias("description"),
        (F.col("p_size") % 5).alias("division_id"), F.lower("p_brand").alias("pricing_group_id"))


def days(spark, sf):
    """Calendar days that occur as order dates."""
    day = F.col("accounting_date")
    return table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("accounting_date")).distinct().select(
        day, d.sunday_on_or_after(day).alias("week_end"), d.iso_week_key(day).alias("week_key"),
        d.fiscal_year(day).alias("fiscal_year"))


def customer(spark, sf):
    nation = table(spark, sf, "nation")
    return (
        table(spark, sf, "customer").join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .withColumn("channel", F.explode(F.array(F.lit("F"), F.lit("O"))))
        .withColumn("org", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))))
        .select(F.col("c_custkey").alias("customer_id"), "channel", "org", F.col("n_name").alias("level1"),
                F.concat(F.lit("00000"), F.lpad(F.col("c_nationkey").cast("string"), 10, "0")).alias("level1_id"),
                F.col("c_name").alias("customer_name"))
    )


def divisions(spark, sf):
    return product(spark, sf).select("division_id").distinct().withColumn(
        "division", F.concat(F.lit("Division "), F.col("division_id").cast("string")))


def pricing_groups(spark, sf):
    return product(spark, sf).select("pricing_group_id").distinct().withColumn("pricing_group", F.upper("pricing_group_id"))


def material_sales(spark, sf):
    """Pricing group per material, channel and organisation."""
    return (
        product(spark, sf).select("material_id", "pricing_group_id")
        .withColumn("channel", F.explode(F.array(F.lit("F"), F.lit("O"))))
        .withColumn("org", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))))
    )


CUSTOMER_KEYS = {"customer_id": "customer_id", "channel": "channel", "org": "org"}
ID = {"product_id": "product_id"}
DAY = {"accounting_date": "accounting_date"}
# order dates are whole days, so the week end is the Sunday on or after
WEEK_END = "order_date + CAST((7 - isodow(order_date)) AS INTEGER)"
STAR = """
star AS (
  SELECT *, {week_end} AS week_end, {key} AS week_key, p_size % 5 AS division_id
  FROM lines JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)""".replace("{week_end}", WEEK_END).replace("{key}", iso("order_date"))


@query("b1_sellin_extract", with_ctes(["lines"], STAR, select=f"""
SELECT week_end AS calendar_week, p_type AS category_desc, sum(l_quantity) AS actual_volume_lbs FROM star
WHERE l_returnflag IN ('N') AND l_linestatus IN ('O') AND n_name IN ('NATION_3', 'NATION_7') AND order_date <= {CUTOFF}
GROUP BY 1, 2"""))
def sellin_extract(spark, sf):
    tables = p.SellinTables(fact(spark, sf), product(spark, sf), days(spark, sf), customer(spark, sf))
    return p.sellin_extract(tables, ["N"], ["O"], ["NATION_3", "NATION_7"], AS_OF)


def wide_links(spark, sf):
    return [
        Link(product(spark, sf).drop("pricing_group_id", "product_id"), {"material_id": "material_id"}),
        Link(days(spark, sf), DAY),
        Link(material_sales(spark, sf), {"material_id": "material_id", "channel": "channel", "org": "org"}),
        Link(customer(spark, sf), CUSTOMER_KEYS),
        Link(divisions(spark, sf), {"division_id": "division_id"}),
        Link(pricing_groups(spark, sf), {"pricing_group_id": "pricing_group_id"}),
    ]


def wide_keys(*names):
    keys = {
        "fiscal_year": F.col("fiscal_year"), "calendar_week_number": F.col("week_key"),
        "calendar_week": F.concat_ws(" ", F.col("week_key").cast("string"), F.col("week_end").cast("string")),
        "customer_l1_id": c.last_chars(F.col("level1_id"), 10), "customer_l1": F.col("level1"),
        "customer_name": F.col("customer_name"),
        "division": F.col("division"), "category_desc": F.col("category"), "brand": F.col("brand"),
        "pricing_group_id": F.col("pricing_group_id"), "pricing_group": F.col("pricing_group"),
        "material_id": c.strip_zeros(F.col("material_id")), "material": F.col("description"),
    }
    return {n: keys[n] for n in names}


WIDE_SQL = {
    "fiscal_year": "CAST(year(order_date) + (month(order_date) >= 7)::INT AS INTEGER)", "calendar_week_number": "week_key",
    "calendar_week": "week_key || ' ' || week_end", "customer_l1_id": "lpad(c_nationkey::VARCHAR, 10, '0')",
    "customer_l1": "n_name", "customer_name": "c_name", "division": "'Division ' || division_id", "category_desc": "p_type",
    "brand": "p_brand", "pricing_group_id": "lower(p_brand)", "pricing_group": "upper(p_brand)",
    "material_id": "ltrim(l_partkey::VARCHAR, '0')", "material": "p_name",
}


def wide_sql(names, where, measure="sum(l_quantity) AS actual_volume_lbs", source="star"):
    shown = ", ".join(f"{WIDE_SQL[n]} AS {n}" for n in names)
    return with_ctes(["lines"], STAR, select=f"SELECT {shown}, {measure} FROM {source} WHERE {where} GROUP BY ALL")


WIDE = ("fiscal_year", "calendar_week_number", "calendar_week", "customer_l1_id", "customer_l1", "division", "category_desc",
        "brand", "pricing_group_id", "pricing_group", "material_id", "material")


@query("b2_sellin_extract_wide", wide_sql(
    WIDE, "l_returnflag = 'N' AND l_linestatus = 'O' AND lpad(c_nationkey::VARCHAR, 10, '0') IN ('0000000003', '0000000007') "
          "AND week_key < 200024"))
def sellin_extract_wide(spark, sf):
    extract = p.star_extract(
        fact(spark, sf), wide_links(spark, sf),
        [F.col("org") == "N", F.col("channel") == "O",
         c.last_chars(F.col("level1_id"), 10).isin("0000000003", "0000000007")],
        wide_keys(*WIDE), {"actual_volume_lbs": F.col("weight_lbs")})
    return cal.before_current_week(extract, calendar(spark), AS_OF, "calendar_week_number")


CA = ("calendar_week_number", "customer_l1", "customer_name", "category_desc", "brand")


@query("b3_extract_with_exclusions", wide_sql(
    CA, "l_returnflag = 'A' AND o_custkey NOT IN (3, 5, 8, 13) AND p_brand NOT IN ('Brand#1', 'Brand#2') "
        "AND p_name LIKE '%small%' AND week_key BETWEEN 199701 AND 199926"))
def extract_with_exclusions(spark, sf):
    return p.star_extract(
        fact(spark, sf), wide_links(spark, sf)[:4],
        [F.col("org") == "A", ~F.col("customer_id").isin(3, 5, 8, 13), ~F.col("brand").isin("Brand#1", "Brand#2"),
         F.col("description").like("%small%"), F.col("week_key").between(199701, 199926)],
        wide_keys(*CA), {"actual_volume_lbs": F.col("weight_lbs")})


SALES = ("fiscal_year", "calendar_week_number", "customer_l1", "division", "category_desc", "pricing_group")


@query("b4_sales_with_fulfilment", wide_sql(
    SALES, "l_linestatus = 'O' AND fiscal_year_code IN (1997, 1998, 1999)", source="""(
  SELECT s.*, CAST(year(order_date) + (month(order_date) >= 7)::INT AS INTEGER) AS fiscal_year_code
  FROM star s LEFT JOIN (SELECT l_orderkey AS fo, l_partkey AS fp FROM lineitem WHERE l_returnflag = 'R') f
    ON s.l_orderkey = f.fo AND s.l_partkey = f.fp)"""))
def sales_with_fulfilment(spark, sf):
    fulfilment = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"), F.lpad(F.col("l_partkey").cast("string"), 10, "0").alias("material_id"))
    return p.star_extract(
        fact(spark, sf),
        [*wide_links(spark, sf), Link(fulfilment, {"order_id": "order_id", "material_id": "material_id"}, "left")],
        [F.col("channel") == "O", F.col("fiscal_year").isin(1997, 1998, 1999)],
        wide_keys(*SALES), {"actual_volume_lbs": F.col("weight_lbs")})


BRAND = ("calendar_week_number", "division", "category_desc", "brand", "pricing_group_id")


@query("b5_brand_extract", wide_sql(
    BRAND, "l_linestatus = 'O' AND p_brand IN ('Brand#3', 'Brand#5', 'Brand#8') AND o_custkey NOT IN (1, 2, 3)"))
def brand_extract(spark, sf):
    return p.star_extract(
        fact(spark, sf), wide_links(spark, sf)[:5],
        [F.col("channel") == "O", F.col("brand").isin("Brand#3", "Brand#5", "Brand#8"), ~F.col("customer_id").isin(1, 2, 3)],
        wide_keys(*BRAND), {"actual_volume_lbs": F.col("weight_lbs")})


MONEY = ("gross_sales", "net_sales", "gross_profit", "cost_of_goods_sold", "cost_of_sales")


def financial(spark, sf):
    """Six sums; amounts as decimals, so that they are exact in any order of addition."""
    gross, off, tax = (F.col(x).cast("decimal(12,2)") for x in ("gross", "discount", "tax"))
    share = F.lit(Decimal("0.4"))
    day = F.col("accounting_date")
    out = p.star_extract(
        fact(spark, sf),
        [Link(product(spark, sf).drop("material_id"), ID), Link(divisions(spark, sf), {"division_id": "division_id"})],
        [F.col("channel") == "O", day.between(F.lit(datetime.date(1996, 1, 1)), F.lit(AS_OF)), F.col("org").isin("N", "A")],
        {"week_end_date": d.monday_after(day),
         "calendar_week_number": F.format_string("%04d%02d", d.iso_year(day), d.iso_week(day)),
         "sales_org": F.col("org"), "division_name": F.col("division"), "brand_desc": F.col("brand"),
         "consolidated_category": c.category_inside(F.col("category"), "PROMOTIONAL")},
        {"actual_volume_lbs": F.col("weight_lbs"), "gross_sales": gross, "net_sales": gross * (1 - off),
         "gross_profit": gross * (1 - off) * share, "cost_of_goods_sold": gross * (1 - share), "cost_of_sales": gross * tax})
    return out.withColumns({x: F.col(x).cast("double") for x in MONEY})


FINANCIAL = with_ctes(["lines"], STAR, """
amounts AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS g, CAST(l_discount AS DECIMAL(4,2)) AS o, CAST(l_tax AS DECIMAL(4,2)) AS t
  FROM star WHERE l_linestatus = 'O' AND l_returnflag IN ('N', 'A') AND order_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-15'),
financial AS (
  SELECT order_date + CAST(8 - isodow(order_date) AS INTEGER) AS week_end_date, week_key::VARCHAR AS calendar_week_number,
    l_returnflag AS sales_org, 'Division ' || division_id AS division_name, p_brand AS brand_desc,
    CASE WHEN instr('PROMOTIONAL', p_type) > 0 THEN 'Potato' ELSE 'Prepared Foods' END AS consolidated_category,
    sum(l_quantity) AS actual_volume_lbs, sum(g)::DOUBLE AS gross_sales, sum(g * (1 - o))::DOUBLE AS net_sales,
    sum(g * (1 - o) * 0.4)::DOUBLE AS gross_profit, sum(g * 0.6)::DOUBLE AS cost_of_goods_sold, sum(g * t)::DOUBLE AS cost_of_sales
  FROM amounts GROUP BY ALL)""", select="SELECT {} FROM financial")


@query("b6_financial_extract", FINANCIAL.replace("{}", "*"))
def financial_extract(spark, sf):
    return financial(spark, sf)


@query("b7_complete_weeks", with_ctes(["lines"], select=f"""
SELECT max(order_date) AS latest, count(*) AS rows, sum(l_quantity) AS lbs FROM lines WHERE order_date <= {CUTOFF}"""))
def complete_weeks(spark, sf):
    rows = cal.complete_weeks(lines(spark, sf), "order_date", AS_OF)
    return rows.agg(F.max("order_date").alias("latest"), F.count("*").alias("rows"), F.sum("l_quantity").alias("lbs"))


@query("b8_before_current_week", with_ctes(["sellout"], select="""
SELECT calendar_week_year, sum(lbs) AS lbs FROM sellout WHERE calendar_week_year < 200024 GROUP BY 1"""))
def before_current_week(spark, sf):
    weeks = cal.before_current_week(sellout(spark, sf), calendar(spark), AS_OF)
    return weeks.groupBy(WEEK).agg(F.sum("lbs").alias("lbs"))


# --- preparation and comparison ------------------------------------------------------------------

NAMED = "CASE p_type WHEN 'PROMO' THEN 'Potato' WHEN 'SMALL' THEN 'Sweet Potato' WHEN 'LARGE' THEN NULL ELSE p_type END"
TWO = "CASE WHEN {} IN ('Potato', 'Sweet Potato') THEN 'Potato' ELSE 'Prepared Foods' END"


def named(category):
    """Test categories under report names, one of them missing."""
    return (F.when(category == "PROMO", "Potato").when(category == "SMALL", "Sweet Potato")
            .when(category == "LARGE", F.lit(None)).otherwise(category))


def dated_sellin(spark, sf):
    """Weekly sell-in by order week end; the first quarter's dates are shifted off the calendar's days."""
    out = p.star_extract(
        fact(spark, sf), [Link(product(spark, sf).select("product_id", "category"), ID), Link(days(spark, sf), DAY)], [],
        {"calendar_week": F.col("week_end"), "category_desc": named(F.col("category"))},
        {"actual_volume_lbs": F.col("weight_lbs")})
    early = F.col("calendar_week") < F.lit(datetime.date(1995, 4, 1))
    return out.withColumn("calendar_week", F.when(early, F.date_add("calendar_week", 2)).otherwise(F.col("calendar_week")))


SELLIN = f"""
dated AS (
  SELECT {WEEK_END} AS calendar_week, {NAMED} AS category_desc, sum(l_quantity) AS lbs
  FROM lines JOIN part ON l_partkey = p_partkey GROUP BY ALL),
sellin AS (
  SELECT calendar_week_year, {TWO.format('category_desc')} AS consolidated_category, lbs
  FROM dated JOIN calendar ON calendar_week = week_ending_sun WHERE calendar_week >= DATE '1995-04-01')"""


@query("b9_prepare_sellin", with_ctes(["lines", "calendar"], SELLIN, analysis_ctes(["consolidated_category"], "sellin"),
                                      select="SELECT * FROM analyzed"))
def prepare_sellin(spark, sf):
    weekly = p.prepare_sellin(dated_sellin(spark, sf), calendar(spark))
    return p.analyze_sellin(weekly, calendar(spark), BEGIN, END, prefix="")


@query("b9_unmatched_dates", with_ctes(["lines"], f"""
dated AS (
  SELECT CAST({WEEK_END} AS DATE) AS calendar_week, {NAMED} AS category_desc, sum(l_quantity) AS lbs
  FROM lines JOIN part ON l_partkey = p_partkey GROUP BY ALL)""", select="""
SELECT CAST(calendar_week + 2 AS DATE) AS calendar_week, count(*) AS rows, sum(lbs) AS lbs FROM dated
WHERE calendar_week < DATE '1995-04-01' GROUP BY 1"""))
def unmatched_dates(spark, sf):
    return p.unmatched_dates(dated_sellin(spark, sf), calendar(spark))


@query("b9_prepare_sellin_week_zero", with_ctes(["lines", "calendar"], f"""
dated AS (
  SELECT {WEEK_END} AS calendar_week, {NAMED} AS category_desc, sum(l_quantity) AS lbs
  FROM lines JOIN part ON l_partkey = p_partkey GROUP BY ALL)""", select=f"""
SELECT coalesce(calendar_week_year, 0) AS calendar_week_year, {TWO.format('category_desc')} AS consolidated_category, sum(lbs) AS lbs
FROM dated LEFT JOIN calendar ON calendar_week = week_ending_sun AND calendar_week >= DATE '1995-04-01' GROUP BY 1, 2"""))
def prepare_sellin_week_zero(spark, sf):
    weekly = p.prepare_sellin(dated_sellin(spark, sf), calendar(spark), keep_unmatched=True)
    return weekly.groupBy(WEEK, p.CATEGORY).agg(F.sum("lbs").alias("lbs"))


@query("b9_analyze_week_zero", with_ctes(["lines", "calendar"], f"""
dated AS (
  SELECT {WEEK_END} AS calendar_week, {NAMED} AS category_desc, sum(l_quantity) AS lbs
  FROM lines JOIN part ON l_partkey = p_partkey GROUP BY ALL),
sellin AS (
  SELECT coalesce(calendar_week_year, 0) AS calendar_week_year, {TWO.format('category_desc')} AS consolidated_category, lbs
  FROM dated LEFT JOIN calendar ON calendar_week = week_ending_sun AND calendar_week >= DATE '1995-04-01')""",
                                         analysis_ctes(["consolidated_category"], "sellin"), select="SELECT * FROM analyzed"))
def analyze_week_zero(spark, sf):
    """The older reports' analysis: unmatched dates are a week 0, the first of all weeks, with lags and averages of its own."""
    weekly = p.prepare_sellin(dated_sellin(spark, sf), calendar(spark), keep_unmatched=True)
    return p.analyze_sellin(weekly, calendar(spark), BEGIN, END, prefix="")


KEYED = f"""
keyed AS (
  SELECT CASE WHEN p_type = 'MEDIUM' THEN NULL ELSE {iso('order_date')} END AS calendar_week_year,
    {TWO.format(NAMED)} AS consolidated_category, l_quantity AS lbs FROM lines JOIN part ON l_partkey = p_partkey)"""


def keyed_sellin(spark, sf):
    """Sell-in whose week arrives as text; one category's weeks are unreadable."""
    rows = fact(spark, sf).join(product(spark, sf).select("product_id", "category"), "product_id")
    key = d.iso_week_key(F.col("accounting_date")).cast("string")
    return rows.select(
        F.when(F.col("category") == "MEDIUM", "n/a").otherwise(key).alias("calendar_week_number"),
        named(F.col("category")).alias("category_desc"),
        F.col("weight_lbs").cast("decimal(18,2)").alias("actual_volume_lbs"))


@query("b10_prepare_keyed_sellin", with_ctes(["lines", "calendar"], KEYED, analysis_ctes(["consolidated_category"], "keyed"),
                                             select="SELECT * FROM analyzed"))
def prepare_keyed_sellin(spark, sf):
    weekly = p.prepare_keyed_sellin(keyed_sellin(spark, sf))
    return p.analyze_sellin(weekly, calendar(spark), BEGIN, END, prefix="")


@query("b11_financial_names", FINANCIAL.replace(
    "{}", "week_end_date, calendar_week_number::INTEGER AS calendar_week_year, sales_org, division_name AS division, "
          "brand_desc AS brand, consolidated_category, actual_volume_lbs AS lbs, gross_sales"))
def financial_names(spark, sf):
    out = p.prepare_financial(financial(spark, sf), {"division_name": "division", "brand_desc": "brand"})
    return out.drop("net_sales", "gross_profit", "cost_of_goods_sold", "cost_of_sales")


SELLIN_COLUMNS = ", ".join(f"coalesce(i.{m}, 0) AS sellin_{m}" for m in p.COMPARED)


@query("b12_compare", with_ctes(
    ["sellout", "calendar"], KEYED, f"categorized AS (SELECT *, {TWO.format(NAMED.replace('p_type', 'category'))} AS consolidated_category FROM sellout)",
    analysis_ctes(["consolidated_category"], "keyed", tag="_in"),
    analysis_ctes(["consolidated_category"], "categorized", tag="_out"), select=f"""
SELECT o.consolidated_category, 'Returns' AS distributor, o.calendar_week_year, {', '.join('o.' + m for m in p.COMPARED)},
  {SELLIN_COLUMNS}, o.week_starting_sun, o.week_ending_sat, o.covid_week
FROM analyzed_out o LEFT JOIN analyzed_in i USING (calendar_week_year, consolidated_category)"""))
def compare(spark, sf):
    out = sellout(spark, sf).withColumn(p.CATEGORY, c.category_equal(named(F.col("category"))))
    return p.compare(p.prepare_keyed_sellin(keyed_sellin(spark, sf)), out, calendar(spark), "Returns", BEGIN, END)
