"""Conforming joins and the conform plan of every delivery layout.

The raw deliveries are built from the given tables: order lines become sales lines, order and
customer labels become segment keys. Mapping tables are derived from the dimension tables, with an
exact duplicate of every row, mixed letter case and a null key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weekmart.catalog.base import calendar, described_lines, iso, lines, query, sellout, table, with_ctes
from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.operators import calendar as cal
from weekmart.operators import mapping as m
from weekmart.operators import quality as q
from weekmart.operators.calendar import WEEK
from weekmart.plans import conform as p

SEGMENT_SQL = "nullif(c_mktsegment, 'BUILDING')"
CODES = list(m.STATE_NAMES)
CODE_LIST = "[" + ", ".join(f"'{x}'" for x in CODES) + "]"
STATES_SQL = "states AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in m.STATE_NAMES.items()) + ") t(state, state_name))"


def doubled(df):
    """Every row twice: joins must not multiply the fact."""
    return df.unionByName(df)


def raw_lines(spark, sf):
    """Order lines with customer and part, the material of all raw layouts.

    One market segment is missing; ``state`` is a code by nation number, one of them unknown.
    """
    codes = F.array(*[F.lit(x) for x in CODES])
    code = F.get(codes, F.col("c_nationkey") * 2)
    return described_lines(spark, sf).withColumns({
        "market_segment": F.nullif("c_mktsegment", F.lit("BUILDING")),
        "state": F.when(F.col("c_nationkey") == 3, "XX").when(F.col("c_nationkey") == 4, "tn").otherwise(code),
    })


RAW = f"""
raw AS (
  SELECT *, nullif(c_mktsegment, 'BUILDING') AS market_segment,
    CASE c_nationkey WHEN 3 THEN 'XX' WHEN 4 THEN 'tn' ELSE {CODE_LIST}[c_nationkey * 2 + 1] END AS state,
    order_date - dayofweek(order_date)::INT AS sunday, order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS monday,
    CASE WHEN order_date >= DATE '2001-07-29' THEN NULL ELSE {iso('(order_date - dayofweek(order_date)::INT + 1)')} END AS sun_week
  FROM lines JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
{STATES_SQL}"""


# first days of the last weeks with orders and shipments
LAST_ORDERED, LAST_SHIPPED = "2001-07-29", "2001-10-28"


def short_calendar(spark, edge=LAST_ORDERED):
    """Calendar without the last week of the data, which is unknown to the mapping."""
    return calendar(spark).filter(F.col("week_starting_sun") < edge)


def segment_labels(key):
    """Report labels from a market segment."""
    return {
        "segment_l1": F.concat(F.lit("L1 "), key), "segment_l2": F.concat(F.lit("L2 "), F.substring(key, 1, 4)),
        "restaurants": F.when(key < "H", "Restaurants"), "restaurants_sub": F.lower(key),
        "service_type": F.when(key < "H", "Sit Down").otherwise("Other"), "cuisine_type": F.upper(F.substring(key, 1, 1)),
    }


def label_sql(key, alias=""):
    return (f"'L1 ' || {key} AS segment_l1, 'L2 ' || substr({key}, 1, 4) AS segment_l2, "
            f"CASE WHEN {key} < 'H' THEN 'Restaurants' END AS restaurants, lower({key}) AS restaurants_sub, "
            f"CASE WHEN {key} < 'H' THEN 'Sit Down' WHEN {key} >= 'H' THEN 'Other' END AS service_type")


def regional_segments(spark, sf):
    """Segment map on (market segment, priority, status) without the urgent finished orders."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), "o_orderpriority", "o_orderstatus").distinct()
        .filter(F.coalesce("seg", F.lit("")) != "FURNITURE")
        .filter(~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")))
    )
    return doubled(rows.select(
        F.lower("seg").alias("business_unit"), F.upper("o_orderpriority").alias("sic_code"),
        F.lower("o_orderstatus").alias("sic_sub"), *[v.alias(k) for k, v in segment_labels(F.coalesce("seg", F.lit("NONE"))).items()]))


MAPPED = ("(market_segment IS DISTINCT FROM 'FURNITURE' AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'))")
REGIONAL_LABELS = label_sql("seg") + ", upper(substr(seg, 1, 1)) AS cuisine_type"


def product_map(spark, sf, key="mfg_id"):
    """Products by id as text; the small ones are not mapped."""
    part = table(spark, sf, "part").filter("p_size > 3")
    return doubled(part.select(
        F.concat(F.lit("Sku"), F.col("p_partkey").cast("string")).alias(key),
        c.category_prefix(F.col("p_type"), "PROMO").alias("consolidated_category"),
        F.col("p_type").alias("l1_product"), F.col("p_brand").alias("l2_product")))


PRODUCT_SQL = ("CASE WHEN p_size > 3 THEN CASE WHEN p_type LIKE 'PROMO%' THEN 'Potato' ELSE 'Prepared Foods' END END "
               "AS consolidated_category, CASE WHEN p_size > 3 THEN p_type END AS l1_product, "
               "CASE WHEN p_size > 3 THEN p_brand END AS l2_product")


def regional_raw(spark, sf):
    raw = raw_lines(spark, sf)
    return raw.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("market_segment").alias("business_unit"), F.col("o_orderpriority").alias("sic_code"),
        F.col("o_orderstatus").alias("sic_sub"), F.col("n_name").alias("customer_city"), F.col("state").alias("customer_state"),
        F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("sku_id"),
        d.sunday_on_or_before(F.col("order_date")).cast("string").alias("week_beginning_date"),
        F.format_number("l_extendedprice", 2).alias("lbs"))


REGIONAL = with_ctes(["lines"], RAW, f"""
labelled AS (
  SELECT *, CASE WHEN {MAPPED} THEN coalesce(market_segment, 'NONE') END AS seg FROM raw WHERE sun_week IS NOT NULL),
conformed AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, market_segment AS business_unit, o_orderpriority AS sic_code,
    o_orderstatus AS sic_sub, 'NA' AS city, labelled.state, 'SKU' || l_partkey AS sku_id, sunday AS week_starting,
    l_extendedprice AS lbs, {REGIONAL_LABELS}, {PRODUCT_SQL}, sun_week AS calendar_week_year, state_name
  FROM labelled LEFT JOIN states ON states.state = labelled.state)""", select="SELECT {} FROM conformed")


def regional(spark, sf):
    maps = p.Dictionaries(segments=regional_segments(spark, sf), products=product_map(spark, sf))
    return p.conform_regional_us(regional_raw(spark, sf), maps, short_calendar(spark))


@query("t1_conform_regional_us", REGIONAL.replace("{}", "*"))
def conform_regional_us(spark, sf):
    return regional(spark, sf).drop("week_beginning_date")


# --- single mapping operators --------------------------------------------------------------------

@query("j1_distinct_mapping", """
SELECT nullif(c_mktsegment, 'BUILDING') AS market_segment, c_nationkey FROM customer GROUP BY ALL""")
def distinct_mapping(spark, sf):
    customer = table(spark, sf, "customer").withColumn("market_segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return m.distinct_mapping(doubled(customer), ["market_segment", "c_nationkey"])


@query("j2_map_case_insensitive", with_ctes(["lines"], RAW, select=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, {label_sql('seg')}, upper(substr(seg, 1, 1)) AS cuisine_type
FROM (SELECT *, CASE WHEN {MAPPED} THEN coalesce(market_segment, 'NONE') END AS seg FROM raw)"""))
def map_case_insensitive(spark, sf):
    keys = {k: k for k in ("business_unit", "sic_code", "sic_sub")}
    out = m.map_left(regional_raw(spark, sf), regional_segments(spark, sf), keys, p.SEGMENT_LABELS, m.trimmed_lower)
    return out.select("order_id", "line", *p.SEGMENT_LABELS)


@query("j2_map_split", with_ctes(["lines"], RAW, select=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, {label_sql('seg')}, upper(substr(seg, 1, 1)) AS cuisine_type
FROM (SELECT *, CASE WHEN {MAPPED} THEN coalesce(market_segment, 'NONE') END AS seg FROM raw)"""))
def map_split(spark, sf):
    """The same labels where frequent keys meet their few mapping rows apart; keys of at least 1.5 % of the rows are frequent."""
    keys = {k: k for k in ("business_unit", "sic_code", "sic_sub")}
    out = m.map_split(regional_raw(spark, sf), regional_segments(spark, sf), keys, p.SEGMENT_LABELS, m.trimmed_lower, share=0.015)
    return out.select("order_id", "line", *p.SEGMENT_LABELS)


def canada_raw(spark, sf):
    """Period sales with blanks, slashes and missing categories in the labels."""
    raw = raw_lines(spark, sf)
    return raw.groupBy(
        d.sunday_on_or_before(F.col("order_date")).alias("period_start"),
        F.date_add(d.sunday_on_or_before(F.col("order_date")), 6).alias("period_end"),
        F.concat(F.lit(" "), F.substring("o_orderpriority", 1, 1), F.lit("/X ")).alias("sector"),
        F.coalesce("market_segment", F.lit("  ")).alias("segment"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.col("o_orderstatus"), F.lit(" "))).alias("subsegment"),
        F.when(F.col("p_type") == "PROMO", "FROZEN POT").when(F.col("p_type") != "LARGE", F.col("p_type")).alias("category"),
    ).agg(F.sum("l_quantity").alias("lbs"), F.count("*").cast("double").alias("cases"))


def canada_segments(spark, sf):
    rows = raw_lines(spark, sf).filter("o_orderpriority <> '5-LOW'").select(
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit("X")).alias("sector"),
        F.concat(F.col("market_segment"), F.lit(" ")).alias("segment"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("subsegment")).distinct()
    labels = segment_labels(F.coalesce(F.trim("segment"), F.lit("NONE")))
    return doubled(rows.withColumns({k: labels[k] for k in p.CANADA_LABELS}))


CANADA = with_ctes(["lines"], RAW, """
periods AS (
  SELECT sunday AS period_start, sunday + 6 AS period_end, substr(o_orderpriority, 1, 1) || 'X' AS sector,
    market_segment AS segment, nullif(o_orderstatus, 'P') AS subsegment, o_orderpriority,
    CASE WHEN p_type = 'PROMO' THEN 'FROZEN POT' WHEN p_type <> 'LARGE' THEN p_type END AS category, sun_week,
    sum(l_quantity) AS lbs, count(*)::DOUBLE AS cases FROM raw GROUP BY ALL)""", select=f"""
SELECT period_start, period_end, sector, segment, subsegment, category, lbs, cases,
  CASE WHEN category LIKE '%POT%' THEN 'Potato' ELSE 'Prepared Foods' END AS consolidated_category,
  {label_sql('seg').replace('lower(seg) AS restaurants_sub, ', '')}, 'NA' AS city, 'NA' AS region, sun_week AS calendar_week_year
FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN coalesce(segment, 'NONE') END AS seg FROM periods)""")


@query("t5_conform_canada_one", CANADA)
def conform_canada_one(spark, sf):
    return p.conform_canada_one(canada_raw(spark, sf), p.Dictionaries(segments=canada_segments(spark, sf)), short_calendar(spark))


@query("t6_conform_canada_two", CANADA)
def conform_canada_two(spark, sf):
    return p.conform_canada_two(canada_raw(spark, sf), p.Dictionaries(segments=canada_segments(spark, sf)), short_calendar(spark))


@query("j3_map_blank_keys", with_ctes(["lines"], RAW, select=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, {label_sql('seg')} FROM (
  SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN coalesce(market_segment, 'NONE') END AS seg FROM raw)"""))
def map_blank_keys(spark, sf):
    raw = raw_lines(spark, sf).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit("/X")).alias("sector"),
        F.coalesce("market_segment", F.lit("\t ")).alias("segment"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("subsegment"))
    raw = raw.withColumn("sector", F.replace("sector", F.lit("/"), F.lit("")))
    labels = segment_labels(F.coalesce(F.trim("segment"), F.lit("NONE")))
    segments = canada_segments(spark, sf).withColumn("restaurants_sub", labels["restaurants_sub"])
    keys = {k: k for k in ("sector", "segment", "subsegment")}
    wanted = [*p.CANADA_LABELS, "restaurants_sub"]
    return m.map_left(raw, segments, keys, wanted, c.blank_to_null).select("order_id", "line", *wanted)


@query("j4_map_products_by_text_id", with_ctes(["lines"], RAW, select=f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, {PRODUCT_SQL} FROM raw"""))
def map_products_by_text_id(spark, sf):
    out = m.map_left(regional_raw(spark, sf), product_map(spark, sf), {"sku_id": "mfg_id"}, p.PRODUCT_LABELS, m.lowered)
    return out.select("order_id", "line", *p.PRODUCT_LABELS)


@query("j5_map_case_weight", """
SELECT l_orderkey AS order_id, l_linenumber AS line, CASE WHEN p_size > 3 THEN p_size::DOUBLE END AS case_weight
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def map_case_weight(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("mfr_sku"))
    return m.map_left(items, report_products(spark, sf), {"mfr_sku": "mfr_sku"}, ["case_weight"]).drop("mfr_sku")


@query("j6_map_number_ids", """
SELECT l_orderkey AS order_id, l_linenumber AS line, p_brand AS brand FROM lineitem JOIN part ON l_partkey = p_partkey""")
def map_number_ids(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.concat(F.col("l_partkey").cast("string"), F.lit(".0")).alias("item_number"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("item_number"), F.col("p_brand").alias("brand"))
    return m.map_left(items, doubled(parts), {"item_number": "item_number"}, ["brand"], c.strip_decimal).drop("item_number")


for name, calendar_day, shift in (
    ("sunday_start", "week_starting_sun", lambda x: d.sunday_on_or_before(x)),
    ("monday_start", "week_starting_mon", lambda x: d.monday_on_or_before(x)),
    ("saturday_end", "week_ending_sat", lambda x: F.date_add(d.sunday_on_or_before(x), 6)),
    ("sunday_end", "week_ending_sun", lambda x: d.sunday_on_or_after(x)),
):
    def week_of(spark, sf, calendar_day=calendar_day, shift=shift):
        orders = table(spark, sf, "orders").select("o_orderkey", shift(F.col("o_orderdate").cast("date")).alias("day"))
        return cal.attach_week(orders, short_calendar(spark), "day", calendar_day)
    day_sql = {
        "sunday_start": "o.d - dayofweek(o.d)::INT", "monday_start": "o.d - CAST(isodow(o.d) - 1 AS INTEGER)",
        "saturday_end": "o.d - dayofweek(o.d)::INT + 6", "sunday_end": "o.d + CAST(7 - isodow(o.d) AS INTEGER)"}[name]
    query(f"j7_week_of_{name}", with_ctes(["calendar"], select=f"""
SELECT o_orderkey, CAST({day_sql} AS DATE) AS day, calendar_week_year
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) o
LEFT JOIN calendar c ON c.{calendar_day} = {day_sql} AND c.week_starting_sun < DATE '2001-07-29'"""))(week_of)


FISCAL = """
SELECT o_orderkey, calendar_week_year FROM orders o LEFT JOIN calendar c
ON c.fiscal_week = year(o.o_orderdate) * 100 + (dayofyear(o.o_orderdate) - 1) // 7 + 1"""


@query("j8_fiscal_week", with_ctes(["calendar"], select=FISCAL))
def fiscal_week(spark, sf):
    day = F.col("o_orderdate").cast("date")
    number = F.floor((F.dayofyear(day) - 1) / 7) + 1
    orders = table(spark, sf, "orders").select("o_orderkey", d.year_week_text(F.year(day), number).alias("fiscal"))
    return cal.attach_fiscal_week(orders, calendar(spark), "fiscal", "fiscal_week_two").drop("fiscal")


@query("j9_valid_week", with_ctes(["sellout", "calendar"], select="""
SELECT c.calendar_week_year, sum(lbs) AS lbs FROM sellout s LEFT JOIN calendar c
ON c.calendar_week_year = s.calendar_week_year AND c.week_starting_sun < DATE '2001-10-28' GROUP BY 1"""))
def valid_week(spark, sf):
    rows = sellout(spark, sf).withColumnRenamed(WEEK, "raw_week")
    return cal.valid_week(rows, short_calendar(spark, LAST_SHIPPED), "raw_week").groupBy(WEEK).agg(F.sum("lbs").alias("lbs"))


@query("j10_drop_unknown_weeks", with_ctes(["sellout", "calendar"], select="""
SELECT calendar_week_year, sum(lbs) AS lbs FROM sellout JOIN calendar USING (calendar_week_year)
WHERE week_starting_sun < DATE '2001-10-28' GROUP BY 1"""))
def drop_unknown_weeks(spark, sf):
    rows = cal.valid_week(sellout(spark, sf).withColumnRenamed(WEEK, "raw_week"), short_calendar(spark, LAST_SHIPPED), "raw_week")
    return cal.known_weeks_only(rows).groupBy(WEEK).agg(F.sum("lbs").alias("lbs"))


@query("j11_state_names", with_ctes(["lines"], RAW, select="""
SELECT state, state_name, sum(l_quantity) AS lbs FROM raw LEFT JOIN states USING (state) GROUP BY ALL"""))
def state_names(spark, sf):
    return m.attach_state(raw_lines(spark, sf), unmatched=None).groupBy("state", "state_name").agg(F.sum("l_quantity").alias("lbs"))


@query("j11_state_codes", with_ctes(["lines"], RAW, select="""
SELECT state_name, s.state AS state_code, sum(l_quantity) AS lbs
FROM (SELECT coalesce(state_name, raw.state) AS state_name, l_quantity FROM raw LEFT JOIN states USING (state))
LEFT JOIN states s USING (state_name) GROUP BY ALL"""))
def state_codes(spark, sf):
    named = m.attach_state(raw_lines(spark, sf), unmatched=None).withColumn("state_name", F.coalesce("state_name", "state"))
    return m.state_code(named).groupBy("state_name", "state_code").agg(F.sum("l_quantity").alias("lbs"))


@query("j12_state_or_none", with_ctes(["lines"], RAW, select="""
SELECT CASE WHEN state_name IS NULL THEN 'None' ELSE r.state END AS state, coalesce(state_name, 'None') AS state_name, sum(l_quantity) AS lbs
FROM (SELECT l_quantity, CASE state WHEN 'tn' THEN 'TN' ELSE state END AS state FROM raw) r LEFT JOIN states USING (state) GROUP BY ALL"""))
def state_or_none(spark, sf):
    rows = m.attach_state(raw_lines(spark, sf), repairs=p.STATE_REPAIRS)
    return rows.groupBy("state", "state_name").agg(F.sum("l_quantity").alias("lbs"))


def provinces(spark, sf):
    nation = table(spark, sf, "nation").filter("n_nationkey <> 5")
    clean = F.when(F.col("n_nationkey") == 6, "0").otherwise(F.initcap(F.replace("n_name", F.lit("_"), F.lit(" "))))
    return doubled(nation.select(F.col("n_name").alias("province"), clean.alias("province_clean")))


PROVINCE_SQL = "CASE WHEN n_nationkey IN (5, 6) THEN 'Other' ELSE 'Nation ' || n_nationkey END"


@query("j13_province", with_ctes(["lines"], RAW, select=f"""
SELECT n_name AS province, {PROVINCE_SQL} AS province_clean, sum(l_quantity) AS lbs FROM raw GROUP BY ALL"""))
def province(spark, sf):
    rows = raw_lines(spark, sf).withColumnRenamed("n_name", "province")
    return m.attach_province(rows, provinces(spark, sf)).groupBy("province", "province_clean").agg(F.sum("l_quantity").alias("lbs"))


def regions(spark, sf):
    """Market to clean market, region and state code; one market is missing."""
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    codes = F.array(*[F.lit(x) for x in CODES])
    return doubled(nation.filter("n_nationkey <> 5").select(
        F.col("n_name").alias("market"), F.concat(F.lit("Market "), F.col("n_nationkey").cast("string")).alias("market_clean"),
        F.col("r_name").alias("region"), F.get(codes, F.col("n_nationkey")).alias("state")))


REGION_SQL = f"""CASE WHEN n_nationkey <> 5 THEN 'Market ' || n_nationkey END AS market, CASE WHEN n_nationkey <> 5 THEN r_name END AS region,
  CASE WHEN n_nationkey <> 5 THEN {CODE_LIST}[n_nationkey + 1] END AS state"""


@query("j14_market_regions", with_ctes(["lines"], f"""
m AS (SELECT {REGION_SQL}, l_quantity FROM lines JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""", select="""
SELECT market, region, state, sum(l_quantity) AS lbs FROM m GROUP BY ALL"""))
def market_regions(spark, sf):
    rows = raw_lines(spark, sf).select(F.col("n_name").alias("market"), "l_quantity")
    return m.attach_market(rows, regions(spark, sf)).groupBy("market", "region", "state").agg(F.sum("l_quantity").alias("lbs"))


@query("j15_inner_calendar", with_ctes(["sellout", "calendar"], select="""
SELECT week_starting_sun, sum(lbs) AS lbs FROM sellout JOIN calendar USING (calendar_week_year)
WHERE week_starting_sun < DATE '2001-10-28' GROUP BY 1"""))
def inner_calendar(spark, sf):
    rows = sellout(spark, sf).join(short_calendar(spark, LAST_SHIPPED).select(WEEK, "week_starting_sun"), WEEK)
    return rows.groupBy("week_starting_sun").agg(F.sum("lbs").alias("lbs"))


@query("j16_product_hierarchy", """
SELECT p_type AS format, p_brand AS sub_format, sum(l_quantity) AS lbs FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey AND p_size > 3 GROUP BY ALL""")
def product_hierarchy(spark, sf):
    items = table(spark, sf, "lineitem").select(F.concat(F.col("l_partkey").cast("string"), F.lit(".0")).alias("sku_id"), "l_quantity")
    hierarchy = table(spark, sf, "part").filter("p_size > 3").select(
        F.col("p_partkey").cast("string").alias("product_code"), F.col("p_type").alias("format"), F.col("p_brand").alias("sub_format"))
    items = items.withColumn("sku_id", c.strip_decimal(F.col("sku_id")))
    out = m.map_left(items, hierarchy, {"sku_id": "product_code"}, ["format", "sub_format"])
    return out.groupBy("format", "sub_format").agg(F.sum("l_quantity").alias("lbs"))


@query("j17_unmapped_share", """
SELECT count(*) FILTER (p_partkey IS NULL) AS missing_rows,
  sum(CASE WHEN p_partkey IS NULL THEN l_quantity ELSE 0 END) / sum(l_quantity) AS missing_share
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 3""")
def unmapped_share(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("sku_id"), F.col("l_quantity").alias("lbs"))
    parts = table(spark, sf, "part").filter("p_size > 3").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return q.unmapped_share(m.map_left(items, parts, {"sku_id": "id"}, ["brand"]), "brand")


def manufacturers(spark, sf):
    """Inclusion list of brands."""
    flag = F.when(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"), "Exclude").otherwise("Include")
    return table(spark, sf, "part").select(F.col("p_brand").alias("manufacturer"), flag.alias("inclusion")).distinct()


@query("j18_keep_listed", with_ctes(["sellout"], select="""
SELECT brand AS manufacturer, sum(lbs) AS lbs FROM sellout WHERE brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1"""))
def keep_listed(spark, sf):
    listing = manufacturers(spark, sf).filter("inclusion = 'Include'")
    rows = m.keep_listed(sellout(spark, sf).withColumnRenamed("brand", "manufacturer"), listing, "manufacturer")
    return rows.groupBy("manufacturer").agg(F.sum("lbs").alias("lbs"))


@query("j18_excluded_counts", with_ctes(["sellout"], select="""
SELECT brand AS manufacturer, count(*) AS rows FROM sellout WHERE brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1"""))
def excluded_counts(spark, sf):
    listing = manufacturers(spark, sf).filter("inclusion = 'Include'")
    return m.excluded_counts(sellout(spark, sf).withColumnRenamed("brand", "manufacturer"), listing, "manufacturer")


@query("j19_outer_periods", with_ctes(["sellout"], select="""
SELECT state, segment_l1, sum(lbs) FILTER (ship_date < DATE '1996-01-01') AS lbs_13wk,
  sum(lbs) FILTER (ship_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31') AS lbs_26wk,
  sum(lbs) FILTER (ship_date >= DATE '1997-01-01') AS lbs_52wk FROM sellout GROUP BY ALL"""))
def outer_periods(spark, sf):
    rows = sellout(spark, sf).filter(F.col("lbs").isNotNull())
    parts = {13: rows.filter("ship_date < '1996-01-01'"), 26: rows.filter("ship_date between '1996-01-01' and '1996-12-31'"),
             52: rows.filter("ship_date >= '1997-01-01'")}
    sums = {n: part.groupBy("state", "segment_l1").agg(F.sum("lbs").alias("lbs")) for n, part in parts.items()}
    return m.combine_periods(sums, ["state", "segment_l1"], ["lbs"])


@query("j20_last_mapping", with_ctes(["lines"], select="""
SELECT label, sum(l_quantity) AS lbs FROM lines
LEFT JOIN (SELECT p_size, max_by(p_name, p_partkey) AS label FROM part GROUP BY 1) ON p_size = l_quantity GROUP BY 1"""))
def last_mapping(spark, sf):
    mapping = m.last_mapping(table(spark, sf, "part"), "p_size", "p_name", "p_partkey")
    rows = lines(spark, sf).withColumn("size", F.col("l_quantity").cast("int"))
    out = m.map_left(rows, mapping.withColumnRenamed("p_name", "label"), {"size": "p_size"}, ["label"])
    return out.groupBy("label").agg(F.sum("l_quantity").alias("lbs"))


# --- national sources ----------------------------------------------------------------------------

def report_raw(spark, sf):
    """Report lines with a weight of zero where no discount was given."""
    raw = raw_lines(spark, sf)
    return raw.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("p_brand").alias("manufacturer"),
        F.col("o_orderpriority").alias("customer_class"), F.concat(F.col("market_segment"), F.lit("  ")).alias("segment"),
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("account_type"), F.col("l_partkey").cast("string").alias("mfr_sku"),
        F.col("l_quantity").alias("qty"), F.when(F.col("l_discount") > 0, F.col("l_quantity") * 10).otherwise(0.0).alias("weight"),
        d.monday_on_or_before(F.col("order_date")).cast("string").alias("invoice_week"), "state", F.col("n_name").alias("city"))


def report_segments(spark, sf):
    return regional_segments(spark, sf).withColumnsRenamed(
        {"business_unit": "segment", "sic_code": "customer_class", "sic_sub": "account_type"})


def report_products(spark, sf):
    return product_map(spark, sf, "mfr_sku").join(
        table(spark, sf, "part").select(F.concat(F.lit("Sku"), F.col("p_partkey").cast("string")).alias("mfr_sku"), "p_size"), "mfr_sku"
    ).withColumns({"mfr_sku": F.substring("mfr_sku", 4, 20), "case_weight": F.col("p_size").cast("double")}).drop("p_size")


REPORT_SQL = """
SELECT l_orderkey AS order_id, l_linenumber AS line, p_brand AS manufacturer, o_orderpriority AS customer_class,
  trim(market_segment) AS segment, ' ' || o_orderstatus AS account_type, l_partkey::VARCHAR AS sku_id, l_quantity AS qty,
  CASE WHEN l_discount > 0 THEN l_quantity * 10 WHEN p_size > 3 THEN p_size::DOUBLE * l_quantity {zero} END AS lbs,
  monday AS invoice_week, CASE WHEN state_name IS NULL THEN 'None' ELSE r.state END AS state, n_name AS city,
  {labels}, {product}, CASE WHEN p_size > 3 THEN p_size::DOUBLE END AS case_weight,
  {week} AS calendar_week_year, coalesce(state_name, 'None') AS state_name
FROM (SELECT * REPLACE (CASE state WHEN 'tn' THEN 'TN' ELSE state END AS state),
        CASE WHEN {mapped} THEN coalesce(market_segment, 'NONE') END AS seg FROM raw) r
LEFT JOIN states ON states.state = r.state {copies} WHERE monday < DATE '2001-07-30' {where}"""
REPORT = REPORT_SQL.replace("{zero}", "").replace("{labels}", REGIONAL_LABELS).replace("{product}", PRODUCT_SQL).replace(
    "{week}", iso("monday")).replace("{mapped}", MAPPED)


@query("t2_conform_national_report", with_ctes(["lines"], RAW, select=REPORT.replace("{copies}", "").replace(
    "{where}", "AND p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')")))
def conform_national_report(spark, sf):
    maps = p.Dictionaries(report_segments(spark, sf), report_products(spark, sf), manufacturers(spark, sf))
    return p.conform_national_report(report_raw(spark, sf), maps, short_calendar(spark))


@query("t3_conform_national_export", with_ctes(["lines"], RAW, select=REPORT.replace(
    "{copies}", "JOIN (SELECT unnest([1, 2]) AS n) ON n = 1 OR p_size > 3").replace("{where}", "")))
def conform_national_export(spark, sf):
    maps = p.Dictionaries(report_segments(spark, sf), report_products(spark, sf))
    return p.conform_national_export(report_raw(spark, sf), maps, short_calendar(spark))


def weekly_raw(spark, sf):
    raw = raw_lines(spark, sf)
    return raw.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("market_segment").alias("pyr_segment"),
        F.concat(F.lit("Sku"), F.col("l_partkey").cast("string")).alias("maker_sku_id"), F.col("n_name").alias("division"),
        d.sunday_on_or_before(F.col("order_date")).alias("week_beginning_date"), "state", F.col("l_quantity").alias("lbs"))


def weekly_segments(spark, sf):
    segment = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("seg")).distinct().filter("seg not in ('FURNITURE', 'BUILDING')")
    return doubled(segment.select(F.lower("seg").alias("pyramid_segment"), *[v.alias(k) for k, v in segment_labels(F.col("seg")).items()]))


WEEKLY = f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, market_segment AS pyramid_segment, 'Sku' || l_partkey AS maker_sku_id,
  n_name AS market, CASE WHEN state_name IS NULL THEN 'None' ELSE r.state END AS state, l_quantity AS lbs, {label_sql('seg')},
  {PRODUCT_SQL}, sun_week AS calendar_week_year, coalesce(state_name, 'None') AS state_name, 'NA' AS city
FROM (SELECT *, nullif(market_segment, 'FURNITURE') AS seg FROM raw) r LEFT JOIN states ON states.state = r.state"""


@query("t4_conform_national_weekly", with_ctes(["lines"], RAW, select=WEEKLY))
def conform_national_weekly(spark, sf):
    maps = p.Dictionaries(weekly_segments(spark, sf), product_map(spark, sf, "maker_sku_id"))
    return p.conform_national_weekly(weekly_raw(spark, sf), maps, short_calendar(spark))


CITIES = ("NATION_1", "NATION_2")
OLD_CANADA = f"""
SELECT l_orderkey AS order_id, l_linenumber AS line,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'MEU' WHEN '2-HIGH' THEN 'MEU' ELSE o_orderpriority END AS sector,
  market_segment AS segment, o_orderstatus AS subsegment, n_name AS province, {PROVINCE_SQL} AS province_clean,
  CASE WHEN n_name LIKE 'NATION_1%' THEN 'NATION_1' WHEN n_name LIKE 'NATION_2%' THEN 'NATION_2' ELSE 'NA' END AS city,
  l_quantity AS lbs, {{category}} AS consolidated_category, {{fiscal}}, {label_sql('seg').replace('lower(seg) AS restaurants_sub, ', '')},
  calendar_week_year
FROM (SELECT *, CASE WHEN market_segment IS DISTINCT FROM 'FURNITURE' THEN coalesce(market_segment, 'NONE') END AS seg FROM raw)
LEFT JOIN calendar c ON c.fiscal_week = year(order_date) * 100 + (dayofyear(order_date) - 1) // 7 + 1"""
CANADA_ONE = OLD_CANADA.replace("{category}", "p_type").replace(
    "{fiscal}", "year(order_date) * 100 + (dayofyear(order_date) - 1) // 7 + 1 AS fiscal_week")
CANADA_TWO = OLD_CANADA.replace("{category}", "'Prepared Foods'").replace(
    "{fiscal}", "year(order_date) AS fiscal_year, (dayofyear(order_date) - 1) // 7 + 1 AS fiscal_week")


def old_canada_raw(spark, sf):
    day = F.col("order_date")
    raw = raw_lines(spark, sf)
    sector = F.when(F.col("o_orderpriority") == "1-URGENT", "MEU-IO").when(F.col("o_orderpriority") == "2-HIGH", "MEU - Unit").otherwise(
        F.col("o_orderpriority"))
    return raw.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), sector.alias("sector"),
        F.col("market_segment").alias("segment"), F.col("o_orderstatus").alias("subsegment"), F.col("n_name").alias("province"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("city"), F.col("l_quantity").alias("lbs"), F.col("p_type").alias("category"),
        F.year(day).alias("fiscal_year"), (F.floor((F.dayofyear(day) - 1) / 7) + 1).cast("int").alias("fiscal_week"))


def old_canada_segments(spark, sf):
    rows = old_canada_raw(spark, sf).select(
        F.upper(F.when(F.col("sector").startswith("MEU"), "meu").otherwise(F.col("sector"))).alias("sector"),
        F.lower("segment").alias("segment"), "subsegment", F.col("segment").alias("seg"))
    rows = rows.filter(F.col("seg").isNull() | (F.col("seg") != "FURNITURE")).distinct()
    labels = segment_labels(F.coalesce("seg", F.lit("NONE")))
    return doubled(rows.withColumns({k: labels[k] for k in p.CANADA_LABELS}).drop("seg"))


def canada_one_raw(spark, sf):
    raw = old_canada_raw(spark, sf).withColumn("fiscal_week", d.year_week(F.col("fiscal_year"), F.col("fiscal_week"))).drop("fiscal_year")
    return raw.withColumnRenamed("lbs", "volume_lbs")


def canada_two_raw(spark, sf):
    return old_canada_raw(spark, sf).withColumnsRenamed({"lbs": "total_lbs", "category": "product_category"})


def old_canada_maps(spark, sf):
    return p.Dictionaries(segments=old_canada_segments(spark, sf), provinces=provinces(spark, sf))


@query("t5_conform_canada_one_file", with_ctes(["lines", "calendar"], RAW, select=CANADA_ONE))
def conform_canada_one_file(spark, sf):
    return p.conform_canada_one_file(canada_one_raw(spark, sf), old_canada_maps(spark, sf), calendar(spark), CITIES)


@query("t6_conform_canada_two_file", with_ctes(["lines", "calendar"], RAW, select=CANADA_TWO))
def conform_canada_two_file(spark, sf):
    return p.conform_canada_two_file(canada_two_raw(spark, sf), old_canada_maps(spark, sf), calendar(spark), CITIES)
