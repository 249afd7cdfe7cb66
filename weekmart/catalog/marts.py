"""Marts over the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from weekmart.catalog.base import (
    BEGIN, END, analysis_ctes, calendar, iso, lines, query, sellout, table, with_ctes,
)
from weekmart.functions import dates as d
from weekmart.operators.calendar import WEEK
from weekmart.plans import analysis as a
from weekmart.plans import marts as p


@query("m1_compile_regions", with_ctes(["sellout"], select="""
SELECT state AS city, state AS region, segment_l1, segment_l2, 'Dine' AS service_type, category AS consolidated_category, distributor,
  sum(lbs) AS lbs, CAST(ship_date - dayofweek(ship_date)::INT + 6 AS DATE) AS week_ending_sat FROM sellout WHERE distributor <> 'N' GROUP BY ALL
UNION ALL SELECT 'NA', state, segment_l1, segment_l2, 'Other', category, distributor, sum(lbs),
  CAST(ship_date - dayofweek(ship_date)::INT + 6 AS DATE) FROM sellout WHERE distributor = 'N' GROUP BY ALL"""))
def compile_regions(spark, sf):
    rows = sellout(spark, sf).withColumn("week_beginning_date", d.sunday_on_or_before(F.col("ship_date")))
    rows = rows.withColumnRenamed("category", "consolidated_category")
    keys = ["state", "segment_l1", "segment_l2", "consolidated_category", "distributor", "week_beginning_date"]
    sums = rows.groupBy(*keys).agg(F.sum("lbs").alias("lbs"))
    us = sums.filter("distributor <> 'N'").withColumns({"city": F.col("state"), "restaurants": F.lit("Dine")})
    canada = sums.filter("distributor = 'N'").withColumns({
        "city": F.lit("NA"), "region": F.col("state"), "service_type": F.lit("Other"),
        "week_ending_sat": d.saturday_of_sunday_week(F.col("week_beginning_date"))})
    return p.compile_regions(us, canada)


@query("m2_product_union", with_ctes(["sellout"], select="""
SELECT calendar_week_year, p_type AS format, p_brand AS sub_format, 'Source ' || distributor AS distributor,
  sum(CASE WHEN distributor = 'N' THEN p_size ELSE lbs END)::DOUBLE AS lbs
FROM sellout JOIN part ON sku_id = p_partkey WHERE p_size > 3 GROUP BY ALL"""))
def product_union(spark, sf):
    """One source sums case weights instead of pounds."""
    part = table(spark, sf, "part")
    rows = sellout(spark, sf).join(part.select("p_partkey", F.col("p_size").cast("double").alias("case_weight")), F.col("sku_id") == F.col("p_partkey"))
    rows = rows.withColumn("sku_id", F.concat(F.col("sku_id").cast("string"), F.lit(".0")))
    hierarchy = part.filter("p_size > 3").select(
        F.col("p_partkey").cast("string").alias("product_code"), F.col("p_type").alias("format"), F.col("p_brand").alias("sub_format"))
    return p.product_union({
        f"Source {x}": (rows.filter(F.col("distributor") == x), "case_weight" if x == "N" else "lbs") for x in "ANR"}, hierarchy)


@query("m3_combined_sales", with_ctes(["lines", "calendar"], f"""
deliveries AS (
  SELECT 1 AS file_order, {iso('order_date')} AS year_week, l_partkey, l_quantity FROM lines WHERE order_date < DATE '1998-07-01'
  UNION ALL SELECT 2, {iso('order_date')}, l_partkey, l_quantity FROM lines WHERE order_date >= DATE '1998-01-01')""", select="""
SELECT file_order, year_week, maker_sku_id, week_ending_sun, sum(l_quantity) * 1000 AS lbs
FROM deliveries JOIN (SELECT year_week, min(file_order) AS file_order FROM deliveries GROUP BY 1) USING (year_week, file_order)
JOIN (SELECT p_partkey, 'M' || (p_partkey // 2) AS maker_sku_id FROM part) ON p_partkey = l_partkey
LEFT JOIN calendar c ON c.calendar_week_year = year_week GROUP BY ALL"""))
def combined_sales(spark, sf):
    """Two overlapping files; the SKU map holds an outdated row for every key."""
    rows = lines(spark, sf).select(
        d.iso_week_key(F.col("order_date")).alias("year_week"), F.col("l_partkey").alias("mfg_number"), "order_date",
        F.format_number(F.col("l_quantity") * 1000, 0).alias("lb_current"))
    files = rows.filter("order_date < '1998-07-01'").withColumn("file_order", F.lit(1)).unionByName(
        rows.filter("order_date >= '1998-01-01'").withColumn("file_order", F.lit(2)))
    part = table(spark, sf, "part")
    skus = part.select(F.col("p_partkey").alias("mfg_number"), F.lit("old").alias("maker_sku_id"), F.lit(1).alias("row_order")).unionByName(
        part.select(F.col("p_partkey").alias("mfg_number"), F.concat(F.lit("M"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("maker_sku_id"),
                    F.lit(2).alias("row_order")))
    out = p.combined_sales(files, skus, calendar(spark))
    return out.groupBy("file_order", "year_week", "maker_sku_id", "week_ending_sun").agg(F.sum("lbs").alias("lbs"))


@query("m4_inventory", with_ctes(["lines"], """
sold AS (SELECT DISTINCT 'M' || l_partkey AS maker_sku_id, l_returnflag AS brand_type FROM lines)""", select="""
SELECT o_orderdate::DATE AS date, CAST(o_orderdate::DATE + (7 - isodow(o_orderdate))::INT AS DATE) AS week_ending_sun, maker_sku_id, category,
  CASE WHEN category IS NULL THEN NULL WHEN contains(category, 'Potato') THEN 'Potato' ELSE 'Prepared Foods' END AS consolidated_category,
  brand_type, sum(l_quantity) AS on_hand
FROM (SELECT o_orderdate, l_partkey, 'M' || l_partkey AS maker_sku_id, l_quantity FROM lines)
LEFT JOIN (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Sweet Potato' ELSE p_type END AS category FROM part WHERE p_size > 3) ON p_partkey = l_partkey
LEFT JOIN sold USING (maker_sku_id) GROUP BY ALL"""))
def inventory(spark, sf):
    """Stock per order date and item; attributes come from all order lines."""
    raw = lines(spark, sf)
    snapshots = raw.groupBy(F.lpad(F.col("l_partkey").cast("string"), 14, "0").alias("manufacturer_gtin"), F.col("order_date").alias("date")).agg(
        F.sum("l_quantity").alias("on_hand"))
    part = table(spark, sf, "part")
    skus = part.select(
        F.lpad(F.col("p_partkey").cast("string"), 14, "0").alias("manufacturer_gtin"),
        F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("maker_sku_id"), F.lit(1).alias("row_order"))
    products = part.filter("p_size > 3").select(
        F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("maker_sku_id"),
        F.when(F.col("p_type") == "PROMO", "Sweet Potato").otherwise(F.col("p_type")).alias("category"))
    sales = raw.select(
        F.concat(F.lit("M"), F.col("l_partkey").cast("string")).alias("maker_sku_id"), F.col("l_returnflag").alias("brand_type"))
    out = p.inventory(snapshots, skus, products, sales, ["brand_type"])
    keys = ["date", "week_ending_sun", "maker_sku_id", "category", "consolidated_category", "brand_type"]
    return out.groupBy(*keys).agg(F.sum("on_hand").alias("on_hand"))


SHARE_KEYS = ["merch_category", "market", "pyramid_segment", "date"]
SHARE_MEASURES = ["lb_category_previous", "lb_category_current", "opportunity_current"]
PERIODS = {13: ("1998-10-01", "1998-12-31"), 26: ("1998-07-01", "1998-12-31"), 52: ("1998-01-01", "1998-12-31")}


def share_sql(n):
    start, end = PERIODS[n]
    inside = f"ship_date BETWEEN DATE '{start}' AND DATE '{end}'"
    return (f"sum(lbs) FILTER (distributor = 'A' AND {inside}) AS a{n}, sum(lbs) FILTER ({inside}) AS c{n}, "
            f"sum(-lbs) FILTER (distributor = 'R' AND {inside}) AS r{n}, count(*) FILTER ({inside}) AS n{n}")


@query("m5_fair_share", with_ctes(["sellout"], f"""
sums AS (SELECT brand AS merch_category, state AS market, segment_l1 AS pyramid_segment, {', '.join(share_sql(n) for n in PERIODS)}
  FROM sellout GROUP BY ALL),
shares AS (SELECT merch_category, market, pyramid_segment, DATE '1999-01-08' AS date, {', '.join(
    f"CASE WHEN n{n} > 0 THEN coalesce(a{n}, 0) END AS lb_category_previous_{n}wk, c{n} AS lb_category_current_{n}wk, "
    f"CASE WHEN n{n} > 0 THEN coalesce(r{n}, 0) END AS opportunity_current_{n}wk" for n in PERIODS)}
  FROM sums WHERE {' + '.join(f'n{n}' for n in PERIODS)} > 0)""", select="""
SELECT * FROM shares WHERE merch_category IN (SELECT merch_category FROM shares GROUP BY 1 HAVING sum(lb_category_current_52wk) > 8500)"""))
def fair_share(spark, sf):
    """Share files of 13, 26 and 52 weeks as text: commas, dashes for nothing, negative opportunities."""
    rows = sellout(spark, sf)
    def text(column):
        return F.coalesce(F.format_number(column, 0), F.lit("-"))
    files = {}
    for n, (start, end) in PERIODS.items():
        files[n] = rows.filter(F.col("ship_date").between(start, end)).groupBy(
            F.col("brand").alias("merch_category"), F.col("state").alias("market"), F.col("segment_l1").alias("pyramid_segment"),
        ).agg(text(F.sum(F.when(F.col("distributor") == "A", F.col("lbs")))).alias("lb_category_previous"),
              text(F.sum("lbs")).alias("lb_category_current"),
              text(F.sum(F.when(F.col("distributor") == "R", -F.col("lbs")))).alias("opportunity_current"),
              ).withColumn("date", F.lit(datetime.date(1999, 1, 8)))
    return p.fair_share(files, SHARE_KEYS, SHARE_MEASURES, "lb_category_current_52wk", 8500)


@query("m6_fill_rate", with_ctes(["lines"], select="""
SELECT l_returnflag AS org, n_name AS customer_l1, c_mktsegment AS customer_l2, p_size % 5 AS division,
  CASE WHEN contains(p_type, 'Potato') THEN 'Potato' ELSE 'Prepared Foods' END AS category, p_brand AS format, p_brand AS sub_format,
  l_partkey AS material_id, p_name AS material, ship_date + (6 - dayofweek(ship_date))::INT + 1 AS week_ending,
  sum(l_quantity) AS ordered_cases, sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE l_quantity - 1 END) AS delivered_cases
FROM lines JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND l_linestatus = 'O' AND l_returnflag IN ('A', 'R') AND ship_date > DATE '1997-01-01'
GROUP BY ALL"""))
def fill_rate(spark, sf):
    orders = lines(spark, sf).select(
        F.col("l_partkey").alias("material_id"), F.col("o_custkey").alias("customer_id"), F.col("l_returnflag").alias("org"),
        F.col("l_linestatus").alias("channel"), F.col("o_orderpriority").alias("document_type"), F.col("o_orderstatus").alias("completion"),
        F.col("ship_date").alias("issue_date"), F.col("l_quantity").alias("ordered"),
        F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).otherwise(F.col("l_quantity") - 1).alias("delivered"))
    kind = F.when(F.col("p_type") == "PROMO", "PROMO").otherwise(F.col("p_type"))
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("material_id"), (F.col("p_size") % 5).alias("division"), kind.alias("category"),
        F.col("p_brand").alias("format"), F.col("p_brand").alias("sub_format"), F.col("p_name").alias("material"))
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.explode(F.array(F.lit("A"), F.lit("R"), F.lit("N"))).alias("org"),
        F.lit("O").alias("channel"), F.col("n_name").alias("customer_l1"), F.col("c_mktsegment").alias("customer_l2"))
    return p.fill_rate(orders, products, customers, datetime.date(1997, 1, 1), ["A", "R"], "F", "1-URGENT", "O")


ORDERS = """
ordered AS (
  SELECT order_date, CAST(order_date + (7 - isodow(order_date))::INT AS DATE) AS week_ending_sun,
    CAST(date_trunc('month', order_date) AS DATE) AS month_begin, l_quantity
  FROM lines JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY' AND l_returnflag = 'A')"""


def machinery_orders(spark, sf):
    orders = lines(spark, sf).join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("sold_to"), F.col("l_returnflag").alias("org"), F.trunc("order_date", "month").alias("month_begin"),
        "order_date", F.col("l_quantity").alias("delivered_lbs"))
    return p.orders_by_week(orders, "MACHINERY", "A")


@query("m7_orders_fiscal", with_ctes(["lines"], ORDERS, select="""
SELECT week_ending_sun, (year(month_begin) + (month(month_begin) >= 7)::INT)::INTEGER AS fiscal_year,
  ((month(month_begin) + 5) % 12 + 1)::INTEGER AS fiscal_period, (((month(month_begin) + 5) % 12) // 3 + 1)::INTEGER AS fiscal_quarter,
  sum(l_quantity) AS delivered_lbs FROM ordered GROUP BY ALL"""))
def orders_fiscal(spark, sf):
    keys = ["week_ending_sun", "fiscal_year", "fiscal_period", "fiscal_quarter"]
    return machinery_orders(spark, sf).groupBy(*keys).agg(F.sum("delivered_lbs").alias("delivered_lbs"))


@query("m7_sellin_and_sellout_weeks", with_ctes(["sellout"], ORDERS, select="""
SELECT week_ending_sun, a.lbs, b.delivered_lbs
FROM (SELECT CAST(ship_date + (7 - isodow(ship_date))::INT AS DATE) AS week_ending_sun, sum(lbs) AS lbs FROM sellout GROUP BY 1) a
FULL JOIN (SELECT week_ending_sun, sum(l_quantity) AS delivered_lbs FROM ordered GROUP BY 1) b USING (week_ending_sun)"""))
def sellin_and_sellout_weeks(spark, sf):
    out = sellout(spark, sf).withColumn("week_ending_sun", d.sunday_on_or_after(F.col("ship_date")))
    return p.sellin_and_sellout_weeks(out, machinery_orders(spark, sf))


GRAINS = {"division": ["distributor", "category"], "pricing_group": ["segment_l2", "category"], "customer": ["distributor", "state"]}


@query("m8_manufacturer_marts", with_ctes(
    ["sellout", "calendar"],
    *[analysis_ctes(dims, tag=f"_{name}") for name, dims in GRAINS.items()],
    "retail AS (SELECT * FROM sellout WHERE distributor = 'R')", analysis_ctes(["brand"], "retail", tag="_family"),
    select=" UNION ALL ".join(
        f"SELECT '{name}' AS mart, concat_ws('|', {', '.join(dims)}) AS segment, calendar_week_year, 'US' AS country, lbs, sma_4, "
        f"sma_8_ly, lbs_baseline FROM analyzed_{name}" for name, dims in {**GRAINS, "family": ["brand"]}.items())))
def manufacturer_marts(spark, sf):
    """Three marts of all sales, and the family mart of the retail division only."""
    rows = sellout(spark, sf)
    spec = a.ReportSpec(begin=BEGIN, end=END, label="US", label_column="country", segment_column=None)
    reports = a.several_grains(rows, GRAINS, calendar(spark), spec)
    reports["family"] = a.manufacturer_report(rows.filter("distributor = 'R'"), ["brand"], calendar(spark), spec)
    out = None
    for name, report in reports.items():
        dims = GRAINS.get(name, ["brand"])
        part = report.select(F.lit(name).alias("mart"), F.concat_ws("|", *dims).alias("segment"), WEEK, "country", "lbs",
                             "sma_4", "sma_8_ly", "lbs_baseline")
        out = part if out is None else out.unionByName(part)
    return out
