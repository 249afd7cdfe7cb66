"""Readers and raw loaders. The given tables are first written out in each delivery's layout, whole,
below the shared folder, and then read back through the reader under test."""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from weekmart.catalog.base import calendar, iso, lines, query, sellout, table, with_ctes
from weekmart.catalog.mappings import CODE_LIST, RAW, REGION_SQL, raw_lines, regions, segment_labels, weekly_segments
from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.operators import mapping as m
from weekmart.operators.calendar import WEEK
from weekmart.plans import conform as p
from weekmart.session import staged, staging_path
from weekmart.sources import readers as r
from weekmart.sources import schemas as sc
from weekmart.sources import sinks


def csv_folder(df, label, header=True, compression="none", sep=",", partition=()):
    """Write a frame as delimited files and return the folder."""
    path = staging_path(df.sparkSession, label)
    writer = df.write.option("header", str(header).lower()).option("compression", compression).option("sep", sep)
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    (writer.partitionBy(*partition) if partition else writer).csv(path)
    return path


def regional_file(spark, sf):
    """Lines in the regional report layout, with a subtotal row per market segment."""
    raw = raw_lines(spark, sf)
    blank = F.lit(" ")
    row = {
        "Branch": F.lit("North"), "Business Unit": F.coalesce("market_segment", blank), "SIC Code": F.col("o_orderpriority"),
        "SIC Sub": F.col("o_orderstatus"), "Customer Nbr.": F.concat(F.col("o_custkey").cast("string"), F.lit(".0")),
        "Customer Name": F.col("c_name"), "Customer Address1": blank, "Customer Address2": blank,
        "Customer City": F.col("n_name"), "Customer State": F.col("state"),
        "Customer Zip": F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")), "Family": F.col("p_type"),
        "Brand": F.col("p_brand"), "Group": blank, "Manufacture Prod.Nbr.": F.col("l_partkey").cast("string"),
        "Prod Nbr": F.concat(F.col("l_partkey").cast("string"), F.lit(".0")), "Product": F.col("p_name"),
        "Pack / Size": blank, "Product Ext.Description": blank,
        "Week of": F.when(F.col("l_linenumber") == 7, blank).otherwise(d.sunday_on_or_before(F.col("ship_date")).cast("string")),
        "Month": F.month("ship_date").cast("string"), "LBS": F.format_number("l_extendedprice", 2),
    }
    rows = raw.select(*[v.alias(k) for k, v in row.items()])
    subtotal = raw.groupBy("c_mktsegment").agg(F.format_number(F.sum("l_quantity"), 2).alias("LBS"))
    subtotal = subtotal.select(*[F.lit("Total").alias(k) if k == "Branch" else F.col("LBS") if k == "LBS" else blank.alias(k) for k in row])
    return rows.unionByName(subtotal)


REGIONAL_SUMS = """
SELECT market_segment AS business_unit, o_orderstatus AS sic_sub, count(*) AS rows, sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE AS lbs
FROM raw {} GROUP BY ALL"""


def cents(column="lbs"):
    """Exact sum of amounts with two decimals."""
    return F.sum(F.col(column).cast("decimal(12,2)")).cast("double").alias(column)


@query("s1_read_regional_report", with_ctes(["lines"], RAW, select=REGIONAL_SUMS.format("")))
def read_regional_report(spark, sf):
    path = csv_folder(regional_file(spark, sf), "s1")
    out = r.read_regional(spark, path, sc.REGIONAL_US)
    return out.groupBy("business_unit", "sic_sub").agg(F.count("*").alias("rows"), cents())


@query("s2_read_sections", with_ctes(["lines"], RAW, select=REGIONAL_SUMS.format("")))
def read_sections(spark, sf):
    """The first section has the header, the sections by order status follow without one."""
    rows = r.without_totals(regional_file(spark, sf), "Branch")
    first = csv_folder(rows.filter(F.col("`SIC Sub`") == "F"), "s2a")
    others = [csv_folder(rows.filter(F.col("`SIC Sub`") == x), "s2b", header=False) for x in ("O", "P")]
    out = r.read_sections(spark, first, others, sc.REGIONAL_US)
    out = out.withColumns({"lbs": c.to_number(F.col("lbs")), "business_unit": c.blank_to_null(F.col("business_unit"))})
    return out.groupBy("business_unit", "sic_sub").agg(F.count("*").alias("rows"), cents())


def weekly_file(spark, sf):
    raw = raw_lines(spark, sf)
    row = {
        "Region": F.lit("East"), "Area": F.lit("A"), "Market": F.col("n_name"), "Pyramid Segment": F.col("market_segment"),
        "Business Unit": F.col("o_orderpriority"), "Merch Category": F.col("p_type"), "PIM Group": F.col("p_brand"),
        "MFG #": F.lpad(F.col("l_partkey").cast("string"), 10, "0"), "PIM #": F.lit("1"), "ASYS #": F.col("l_partkey").cast("string"),
        "Product Description": F.col("p_name"), "Pack Size": F.lit("6/5 LB"), "Vendor #": F.lpad(F.col("l_suppkey").cast("string"), 6, "0"),
        "Vendor": F.lit("V"), "Brand": F.col("p_brand"), "Brand Type": F.lit("B"),
        **{f"Attribute {k}": F.lit(f"a{k}") for k in range(1, 6)},
        "Year Week": d.iso_week_key(F.col("ship_date")).cast("string"), "LB Current": F.format_number(F.col("l_quantity") * 100, 0),
    }
    return raw.select(*[v.alias(k) for k, v in row.items()])


def weekly_files(spark, sf):
    """Two deliveries of the weekly report: one in the usual layout, one in another order with a further column."""
    rows = weekly_file(spark, sf)
    odd = F.col("`MFG #`").cast("int") % 2 == 1
    other = rows.withColumn("Remark", F.lit("x, y")).filter(odd)
    return [csv_folder(rows.filter(~odd), "s3a"), csv_folder(other.select(*other.columns[::-1]), "s3b")]


@query("s3_read_weekly_report", """
SELECT lpad(l_partkey::VARCHAR, 10, '0') AS mfg_number, lpad(l_suppkey::VARCHAR, 6, '0') AS vendor_number,
  CAST(isoyear(l_shipdate) AS INTEGER) AS year, sum(l_quantity) * 100 AS lbs
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def read_weekly_report(spark, sf):
    out = r.read_weekly(spark, weekly_files(spark, sf), sc.NATIONAL_US_WEEKLY)
    year = F.floor(F.col("calendar_week") / 100).cast("int").alias("year")
    return out.groupBy("mfg_number", "vendor_number", year).agg(F.sum("lbs").alias("lbs"))


@query("s4_wide_to_long", with_ctes(["sellout"], select="""
SELECT state, category, w AS calendar_week, x.lbs FROM (SELECT DISTINCT state, category FROM sellout)
CROSS JOIN (SELECT DISTINCT calendar_week_year AS w FROM sellout) LEFT JOIN (
  SELECT state, category, calendar_week_year AS w, nullif(sum(lbs), 26) AS lbs FROM sellout GROUP BY ALL) x USING (state, category, w)"""))
def wide_to_long(spark, sf):
    """A sheet with one column per week, a blank column, and dashes for missing values."""
    # summed by week first, so that the cells of a row are not looked through for every order line
    sums = staged(sellout(spark, sf).groupBy("state", "category", WEEK).agg(F.sum("lbs").alias("lbs")), "s4")
    weeks = sorted(row[0] for row in sums.select(WEEK).distinct().collect())
    # pivoted, a sum goes to its own cell; a condition for each week would look at every sum once a week
    cells = [F.coalesce(F.nullif(F.col(f"`{w}`"), F.lit(26.0)).cast("string"), F.lit("-")).alias(str(w)) for w in weeks]
    wide = sums.groupBy("state", "category").pivot(WEEK, weeks).agg(F.sum("lbs"))
    wide = wide.select("state", "category", F.lit(None).cast("string").alias(" "), *cells)
    return r.wide_to_long(wide, ["state", "category"])


def report_rows(raw):
    """Lines in the national report layout."""
    row = {
        "Division": F.lit(" D1 "), "Sales Manager": F.lit("m"), "Sales Rep Number": F.lit("7"), "Sales Rep": F.lit("r"), "Account Number": F.concat(F.col("o_custkey").cast("string"), F.lit(".0")),
        "Account Name": F.lower("c_name"), "Address": F.lit(" street "), "City": F.lower("n_name"), "State": F.lower("state"),
        "Postal Code": F.col("c_nationkey").cast("string"), "Customer Class": F.col("o_orderpriority"),
        "Segment": F.concat(F.coalesce("market_segment", F.lit("")), F.lit(" ")), "Account Type": F.col("o_orderstatus"),
        "Vendor": F.lit("V"), "Manufacturer": F.col("p_brand"), "Brand": F.col("p_brand"), "Brand Type": F.lit("B"),
        "Product Category": F.lit("c"), "Sub-Category": F.col("p_type"),
        "GTIN": F.col("l_partkey").cast("string"), "MFR SKU": F.col("l_partkey").cast("string"), "Dist SKU": F.col("l_suppkey").cast("string"),
        "Item Name": F.col("p_name"),
        "Pack": F.when(F.col("p_size") > 10, F.concat(F.col("p_size").cast("string"), F.lit("/5 LB/x"))).otherwise("6"),
        "Size": F.lit("each"), "Unit Type": F.lit("CS"), "Qty": F.format_number("l_quantity", 0),
        "Weight": F.format_number("l_extendedprice", 2),
    }
    return [v.alias(k) for k, v in row.items()]


@query("s5_date_from_file_name", with_ctes(["lines"], select="""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS delivered, count(*) AS rows FROM lines GROUP BY 1"""))
def date_from_file_name(spark, sf):
    """One folder of files per delivery month, named by the date."""
    month = F.trunc("order_date", "month").cast("string").alias("delivery")
    path = csv_folder(lines(spark, sf).select(month, "l_orderkey", "l_quantity"), "s5", partition=("delivery",))
    files = r.read_delimited(spark, path, sc.text("l_orderkey", "l_quantity"), recursive=True)
    dated = r.with_file_date(files, "delivered")
    return dated.groupBy("delivered").agg(F.count("*").alias("rows"))


@query("s6_folders_by_name", """
SELECT l_returnflag AS flag, count(*) AS rows, sum(l_quantity) AS lbs FROM lineitem GROUP BY 1""")
def folders_by_name(spark, sf):
    """A folder per flag, with a second, compressed copy of the rows whose file names do not match."""
    items = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("folder"), F.col("l_returnflag").alias("flag"), "l_quantity")
    path = csv_folder(items, "s6", partition=("folder",))
    items.write.mode("append").option("header", "true").option("compression", "gzip").partitionBy("folder").csv(path)
    out = r.read_delimited(spark, path, sc.text("flag", "l_quantity"), recursive=True, name_pattern=r"^part-\d+-.*\.csv$")
    return out.groupBy("flag").agg(F.count("*").alias("rows"), F.sum(c.to_number(F.col("l_quantity"))).alias("lbs"))


@query("s7_read_selected_columns", with_ctes(["sellout"], select="""
SELECT state AS market, calendar_week_year AS calendar_week, sum(lbs) * 100 AS lbs FROM sellout GROUP BY ALL"""))
def read_selected_columns(spark, sf):
    out = r.read_weekly(spark, weekly_files(spark, sf), sc.NATIONAL_US_WEEKLY)
    return out.select("market", "calendar_week", "lbs").groupBy("market", "calendar_week").agg(F.sum("lbs").alias("lbs"))


LINES_A_FILE = 4_000_000


def shared_files(spark, sf):
    """One folder of files per year; the last header names the year's first Sunday.

    A file has at most about LINES_A_FILE lines, however many tasks made the rows.
    """
    raw = raw_lines(spark, sf)
    row = {
        "Area": F.lit("A"), "Market": F.when(F.col("c_nationkey") != 9, F.col("n_name")),
        "Pyramid Segment": F.when(F.col("o_orderpriority") == "5-LOW", "a - b").otherwise(F.col("market_segment")),
        "ASYS Code": F.concat(F.col("l_partkey").cast("string"), F.lit(".0")), "ASYS": F.col("p_name"),
        "GTIN": F.lpad(F.col("l_partkey").cast("string"), 12, "0"), "MFG Number": F.col("l_partkey").cast("string"),
    }
    stored = staging_path(spark, "s8")
    raw.select(*[v.alias(k) for k, v in row.items()], F.format_number("l_quantity", 1).alias("LBS"),
               F.year("order_date").alias("year")).write.partitionBy("year").parquet(stored)
    rows = spark.read.parquet(stored)

    def one_year(year, count):
        part = rows.filter(F.col("year") == year).drop("year").withColumnRenamed("LBS", f"{year}-01-07 1")
        return csv_folder(part.coalesce(-(-count // LINES_A_FILE)), f"s8-{year}")

    years = sorted(tuple(row) for row in rows.groupBy("year").count().collect())
    with ThreadPoolExecutor(8) as pool:  # a year has fewer files than there are cores
        return list(pool.map(lambda year: one_year(*year), years))


SHARED = with_ctes(["lines"], RAW, f"""
shared AS (
  SELECT 'A' AS area, CASE WHEN c_nationkey <> 9 THEN n_name END AS raw_market,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'a - b' ELSE market_segment END AS pyramid_segment, l_partkey::VARCHAR AS asys_id,
    p_name AS asys_description, lpad(l_partkey::VARCHAR, 12, '0') AS manufacturer_gtin, l_partkey::VARCHAR AS maker_sku_id,
    make_date(year(order_date), 1, 7) AS week_beginning_date, l_quantity AS lbs, {REGION_SQL}
  FROM raw JOIN region ON n_regionkey = r_regionkey)""", select="{}")


@query("s8_date_in_last_header", SHARED.replace("{}", """
SELECT week_beginning_date, raw_market AS market, pyramid_segment, sum(lbs) AS lbs FROM shared GROUP BY ALL"""))
def date_in_last_header(spark, sf):
    out = r.read_shared(spark, shared_files(spark, sf), sc.NATIONAL_US_SHARED)
    return out.groupBy("week_beginning_date", "market", "pyramid_segment").agg(F.sum(c.to_number(F.col("lbs"))).alias("lbs"))


@query("t9_load_national_shared", SHARED.replace("{}", """
SELECT area, region, market, state, pyramid_segment, asys_id, asys_description, manufacturer_gtin, maker_sku_id,
  week_beginning_date, lbs FROM shared WHERE raw_market IS NOT NULL AND pyramid_segment IS DISTINCT FROM 'a - b'"""))
def load_national_shared(spark, sf):
    raw = r.read_shared(spark, shared_files(spark, sf), sc.NATIONAL_US_SHARED)
    return p.load_national_shared(raw, regions(spark, sf))


@query("s9_quoted_line_breaks", with_ctes(["sellout"], select="""
SELECT state, category || chr(10) || 'sagt "' || segment_l2 || '", für ' || distributor || chr(10) || chr(10) || '– Ende' AS remark,
  'net' || chr(10) || 'lbs' AS measure, sum(lbs) AS lbs, count(*) AS rows FROM sellout WHERE distributor <> 'R' GROUP BY ALL
UNION ALL SELECT state, category || chr(10) || 'sagt "' || segment_l2 || '", für ' || distributor || chr(10) || chr(10) || '« Ende', 'net' || chr(10) || 'lbs',
  sum(lbs), count(*) FROM sellout WHERE distributor = 'R' GROUP BY ALL"""))
def quoted_line_breaks(spark, sf):
    """Remarks of several lines with quotes, a column name of two lines, files in UTF-8 and in Latin-1, in other column orders."""
    rows = staged(sellout(spark, sf).select("distributor", "state", "category", "segment_l2", "lbs"), "s9q-rows")
    remark = F.concat(
        "category", F.lit('\nsagt "'), "segment_l2", F.lit('", für '), "distributor", F.lit("\n\n"),
        F.when(F.col("distributor") == "R", "« Ende").otherwise("– Ende"))
    every = rows.select("distributor", F.col("state").alias("State"), remark.alias("Remark"), F.col("lbs").alias("net\nlbs"))
    root = staging_path(spark, "s9q")
    for name, part, encoding in (("one", every.filter("distributor <> 'R'"), "UTF-8"), ("two", every.filter("distributor = 'R'"), "ISO-8859-1")):
        columns = ["State", "Remark", "net\nlbs"][:: 1 if name == "one" else -1]
        (part.select(*columns).write.option("header", "true").option("quoteAll", "true").option("escape", '"').option("encoding", encoding)
         .csv(f"{root}/{name}"))
    out = r.read_by_header(spark, root, ["State", "Remark", "net\nlbs"], lower=False)
    return out.groupBy(F.col("State").alias("state"), F.col("Remark").alias("remark"), F.lit("net\nlbs").alias("measure")).agg(
        F.sum(c.to_number(F.col("net\nlbs"))).alias("lbs"), F.count("*").alias("rows"))


@query("s9_read_matching_files", with_ctes(["sellout"], select="""
SELECT distributor, CASE category WHEN 'PROMO' THEN 'Prepared Foods' ELSE category END AS "consolidated category",
  CASE WHEN distributor <> 'N' THEN state END AS region, sum(lbs) AS lbs FROM sellout GROUP BY ALL"""))
def read_matching_files(spark, sf):
    """Files of three distributors; one layout lacks the region, another has its columns in another order."""
    rows = staged(sellout(spark, sf).select(
        F.col("state").alias("Region"), F.when(F.col("category") == "PROMO", "Perpared Foods").otherwise(F.col("category")).alias(
            "Consolidated Category"), F.col("distributor").alias("Distributor"), F.col("lbs").alias("LBS")), "s9-rows")
    root = staging_path(spark, "s9")
    for flag, columns in (("A", rows.columns), ("N", rows.columns[1:]), ("R", rows.columns[::-1])):
        part = rows.filter(F.col("Distributor") == flag).select(*columns)
        part.write.option("header", "true").csv(f"{root}/sellout_region_{flag}")
    out = r.read_matching(spark, root, ".csv", {"Perpared Foods": "Prepared Foods"})
    return out.groupBy("distributor", "consolidated category", "region").agg(F.sum(c.to_number(F.col("lbs"))).alias("lbs"))


def warehouse(spark, sf):
    items = lines(spark, sf)
    fact = items.select(
        d.sunday_on_or_before(F.col("ship_date")).alias("period_start"),
        F.date_add(d.sunday_on_or_before(F.col("ship_date")), 6).alias("period_end"),
        F.col("o_custkey").alias("operator_id"), F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("product_id"),
        F.col("l_suppkey").alias("provider_id"), F.col("l_quantity").alias("sales_lbs"), F.col("l_linenumber").cast("double").alias("sales_cases"))
    account = table(spark, sf, "customer").filter("c_nationkey <> 9").select(
        F.col("c_custkey").alias("operator_id"), F.col("c_mktsegment").alias("sector"),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("segment"), F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 1)).alias("subsegment"))
    product = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"), F.concat(F.col("p_type"), F.lit(" ")).alias("category"))
    provider = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("provider_id"),
                                                   F.concat(F.lit("Provider "), (F.col("s_nationkey") % 5).cast("string")).alias("provider_name"))
    return fact, account, product, provider


def warehouse_sql(join, where=""):
    return with_ctes(["lines"], select=f"""
SELECT CAST(ship_date - dayofweek(ship_date)::INT AS DATE) AS period_start, CAST(ship_date - dayofweek(ship_date)::INT + 6 AS DATE) AS period_end,
  c_mktsegment AS sector, c_mktsegment AS segment, substr(c_mktsegment, 1, 1) AS subsegment, p_type AS category,
  sum(l_quantity) AS lbs, sum(l_linenumber)::DOUBLE AS cases
FROM lines {join} (SELECT * FROM customer WHERE c_nationkey <> 9) ON o_custkey = c_custkey
LEFT JOIN part ON ltrim(l_partkey::VARCHAR, '0') = p_partkey::VARCHAR LEFT JOIN supplier ON l_suppkey = s_suppkey {where} GROUP BY ALL""")


@query("s10_warehouse_sellout", warehouse_sql("LEFT JOIN", "WHERE s_nationkey % 5 = 2"))
def warehouse_sellout(spark, sf):
    return r.warehouse_sellout(*warehouse(spark, sf), provider_name="Provider 2")


@query("s11_warehouse_sellout_inner", warehouse_sql("JOIN", "WHERE s_nationkey % 5 = 3"))
def warehouse_sellout_inner(spark, sf):
    return r.warehouse_sellout(*warehouse(spark, sf), provider_name="Provider 3", account_join="inner")


def stored(spark, sf):
    rows = sellout(spark, sf)
    return rows.withColumn("week_beginning_date", d.sunday_on_or_before(F.col("ship_date")).cast("string"))


@query("s12_stored_table", with_ctes(["sellout"], select="""
SELECT state, segment_l1, CAST(ship_date - dayofweek(ship_date)::INT AS DATE) AS week_beginning_date, sum(lbs) AS lbs FROM sellout GROUP BY ALL"""))
def stored_table(spark, sf):
    path = staging_path(spark, "s12")
    stored(spark, sf).select("state", "segment_l1", "week_beginning_date", "lbs").write.parquet(path)
    return r.stored_sellout(r.read_table(spark, "parquet", path), ["state", "segment_l1"])


@query("s13_stored_table_one_city", with_ctes(["sellout"], select="""
SELECT 'Not Available' AS city, segment_l1, distributor, CAST(ship_date - dayofweek(ship_date)::INT AS DATE) AS week_beginning_date,
  sum(lbs) AS lbs FROM sellout GROUP BY state, segment_l1, distributor, 4"""))
def stored_table_one_city(spark, sf):
    rows = stored(spark, sf).withColumnRenamed("state", "city")
    return r.stored_sellout(rows, ["city", "segment_l1", "distributor"], city="Not Available")


@query("s14_product_dimension", """
SELECT p_partkey AS sku_id, p_type AS category, p_size AS net_weight FROM part""")
def product_dimension(spark, sf):
    return r.product_dimension(table(spark, sf, "part"), {"p_partkey": "sku_id", "p_type": "category", "p_size": "net_weight"})


@query("s15_weeks_in_table", with_ctes(["sellout"], select="SELECT DISTINCT calendar_week_year FROM sellout"))
def weeks_in_table(spark, sf):
    return r.weeks_in(sellout(spark, sf), WEEK)


@query("s16_read_back", with_ctes(["sellout"], select="""
SELECT segment_l1, calendar_week_year, sum(lbs) AS lbs FROM sellout WHERE segment_l1 NOT IN ('MACHINERY') GROUP BY ALL"""))
def read_back(spark, sf):
    path = staging_path(spark, "s16")
    sellout(spark, sf).groupBy("segment_l1", WEEK).agg(F.sum("lbs").alias("lbs")).write.parquet(path)
    return r.read_back(r.read_table(spark, "parquet", path), "segment_l1", ["MACHINERY"])


@query("s17_gzip_tsv", """
SELECT event_type, count(*) AS rows, sum(CAST(value AS DECIMAL(12,2)))::DOUBLE AS value FROM events GROUP BY 1""")
def gzip_tsv(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    path = csv_folder(events, "s17", compression="gzip", sep="\t")
    out = r.read_delimited(spark, path, sc.text("event_id", "event_type", "value"), sep="\t")
    return out.groupBy("event_type").agg(F.count("*").alias("rows"), cents("value"))


@query("s18_json_records", """
SELECT event_id AS id, event_type AS name, CAST(ts AS DATE)::VARCHAR AS realtime_start FROM events WHERE event_type LIKE '%r%'""")
def json_records(spark, sf):
    """One document per day, a file of its own, with the array of the day's events."""
    events = table(spark, sf, "events").select(
        "user_id", F.col("event_id").alias("id"), F.col("event_type").alias("name"), F.col("ts").cast("date").cast("string").alias("realtime_start"))
    documents = events.withColumn("day", F.col("realtime_start")).groupBy("day").agg(
        F.collect_list(F.struct("id", "realtime_start", "name")).alias("releases"))
    path = staging_path(spark, "s18")
    documents.write.partitionBy("day").json(path)
    return r.read_releases(spark, path, sc.RELEASES, contains="r").select("id", "name", "realtime_start")


@query("s19_snapshot_date", with_ctes(["lines"], select="""
SELECT CAST(date_trunc('month', ship_date) AS DATE) AS date, sum(l_quantity) AS on_hand FROM lines GROUP BY 1"""))
def snapshot_date(spark, sf):
    month = F.date_format(F.trunc("ship_date", "month"), "dd MMM yyyy").alias("snapshot")
    path = csv_folder(lines(spark, sf).select(month, "l_quantity"), "s19", partition=("snapshot",))
    files = r.read_delimited(spark, path, sc.text("l_quantity"), recursive=True)
    dated = r.with_file_date(files, "date", r.DAY_MONTH_YEAR, "dd MMM yyyy")
    return dated.groupBy("date").agg(F.sum(c.to_number(F.col("l_quantity"))).alias("on_hand"))


@query("s20_dates_in_name", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS first_date, CAST(o_orderdate AS DATE) + 6 AS last_date FROM orders""")
def dates_in_name(spark, sf):
    day = F.col("o_orderdate").cast("date")
    name = F.concat(F.lit("Sales_Report_("), day.cast("string"), F.lit(" - "), F.date_add(day, 6).cast("string"), F.lit(").csv"))
    found = r.dates_in(name)
    return table(spark, sf, "orders").select("o_orderkey", F.get(found, 0).alias("first_date"), F.get(found, 1).alias("last_date"))


@query("s21_date_from_folder", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS folder_date, count(*) AS rows FROM orders GROUP BY 1""")
def date_from_folder(spark, sf):
    """One folder of files per month of orders, named by its first day."""
    day = F.trunc(F.col("o_orderdate").cast("date"), "month").cast("string").alias("folder")
    path = csv_folder(table(spark, sf, "orders").select(day, "o_orderkey"), "s21", partition=("folder",))
    files = r.read_delimited(spark, path, sc.text("o_orderkey"), recursive=True)
    return r.with_file_date(files, "folder_date").groupBy("folder_date").agg(F.count("*").alias("rows"))


@query("s22_read_history", with_ctes(["sellout"], select="""
SELECT state, calendar_week_year, sum(lbs) AS lbs FROM sellout GROUP BY ALL"""))
def read_history(spark, sf):
    sums = sellout(spark, sf).groupBy("state", WEEK).agg(F.sum("lbs").alias("lbs"))
    path = csv_folder(sums, "s22", compression="gzip")
    return r.read_delimited(spark, path, sums.schema)


# --- raw loaders ---------------------------------------------------------------------------------

@query("t7_load_regional_us", with_ctes(["lines"], RAW, select="""
SELECT 'North' AS branch, market_segment AS business_unit, o_orderpriority AS sic_code, o_orderstatus AS sic_sub,
  o_custkey::VARCHAR AS customer_number, c_name AS customer_name, NULL::VARCHAR AS customer_address1, NULL::VARCHAR AS customer_address2,
  n_name AS customer_city, state AS customer_state, c_nationkey::VARCHAR AS customer_zip, l_partkey::VARCHAR AS maker_sku_id,
  l_partkey::VARCHAR AS product_number, p_name AS product_description, CAST(ship_date - dayofweek(ship_date)::INT AS DATE) AS week_beginning_date,
  l_extendedprice AS lbs FROM raw WHERE l_linenumber <> 7"""))
def load_regional_us(spark, sf):
    path = csv_folder(regional_file(spark, sf), "t7")
    return p.load_regional_us(r.read_regional(spark, path, sc.REGIONAL_US))


@query("t8_load_national_report", with_ctes(["lines"], RAW, select="""
SELECT 'D1' AS division, o_custkey::VARCHAR AS account_number, upper(c_name) AS account_name, 'STREET' AS address, n_name AS city,
  upper(state) AS state, c_nationkey::VARCHAR AS postal_code, o_orderpriority AS customer_class, market_segment AS segment,
  o_orderstatus AS account_type, 'V' AS vendor, p_brand AS manufacturer, l_partkey::VARCHAR AS manufacturer_gtin,
  l_partkey::VARCHAR AS maker_sku_id, l_suppkey::VARCHAR AS dist_sku, p_name AS item_name,
  CASE WHEN p_size > 10 THEN p_size::VARCHAR ELSE '6' END AS pack, CASE WHEN p_size > 10 THEN '5 LB/x' ELSE 'each' END AS size,
  'CS' AS unit_type, l_quantity AS qty, l_extendedprice AS weight, make_date(year(order_date) - 1, 12, 31) AS week_beginning_date
FROM raw"""))
def load_national_report(spark, sf):
    """Files named by two dates, one folder per year; the layout has no blanks in its null segments."""
    root = staging_path(spark, "t8")
    raw = raw_lines(spark, sf)
    raw.select(*report_rows(raw), F.concat(F.year("order_date").cast("string"), F.lit("-01-01 - "), F.year("order_date").cast("string"),
               F.lit("-01-07")).alias("report")).write.option("header", "true").partitionBy("report").csv(root)
    files = r.read_by_header(spark, root, sc.NATIONAL_US_REPORT.fieldNames())
    named = r.snake_headers(files.withColumn("first_date", F.get(r.dates_in(F.col(r.FILE)), 0)).drop(r.FILE))
    return p.load_national_report(named).withColumn("segment", F.nullif("segment", F.lit("")))


@query("t10_national_history", with_ctes(["lines"], RAW, f"""
history AS (
  SELECT CASE WHEN order_date < DATE '1999-01-01' THEN 'old' ELSE 'new' END AS calendar, n_name AS market,
    CASE WHEN n_nationkey <> 5 THEN r_name END AS region, CASE WHEN n_nationkey <> 5 THEN {CODE_LIST}[n_nationkey + 1] END AS state,
    l_partkey::VARCHAR AS asys_id, CASE WHEN p_size > 3 THEN 'M' || l_partkey END AS maker_sku_id, market_segment AS pyramid_segment,
    CASE WHEN order_date >= DATE '1999-01-01' THEN 'L1 ' || nullif(market_segment, 'FURNITURE') END AS segment_l1, l_quantity
  FROM raw JOIN region ON n_regionkey = r_regionkey)""", select="""
SELECT * EXCLUDE (l_quantity), sum(l_quantity) AS lbs FROM history GROUP BY ALL"""))
def national_history(spark, sf):
    raw = raw_lines(spark, sf).select(
        F.col("n_name").alias("market"), F.col("market_segment").alias("pyramid_segment"),
        F.concat(F.col("l_partkey").cast("string"), F.lit(".0")).alias("asys_id"), "order_date",
        F.col("order_date").alias("week_beginning_date"), F.col("l_quantity").alias("lbs"))
    products = table(spark, sf, "part").filter("p_size > 3").select(
        F.col("p_partkey").cast("double").cast("decimal(18,1)").cast("string").alias("asys_id"),
        F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("maker_sku_id"),
        F.col("p_type").alias("consolidated_category"), F.col("p_type").alias("l1_product"), F.col("p_brand").alias("l2_product"))
    segments = weekly_segments(spark, sf).withColumn("pyramid_segment", F.upper("pyramid_segment"))
    old = raw.filter("order_date < '1999-01-01'").withColumn("calendar", F.lit("old"))
    new = raw.filter("order_date >= '1999-01-01'").withColumns({"calendar": F.lit("new"), "area": F.lit("A")})
    out = p.conform_national_history(old, new, segments, regions(spark, sf), products)
    keys = ["calendar", "market", "region", "state", "asys_id", "maker_sku_id", "pyramid_segment", "segment_l1"]
    return out.groupBy(*keys).agg(F.sum("lbs").alias("lbs"))


@query("t11_load_mapping", """
SELECT DISTINCT o_orderpriority AS sic_code, o_orderstatus AS sic_sub, lower(o_orderpriority) AS segment_l1, o_orderstatus || '!' AS service_type FROM orders""")
def load_mapping(spark, sf):
    sheet = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("sic_code"), F.col("o_orderstatus").alias("sic_sub"),
        F.lower("o_orderpriority").alias("COVID Segmentation - L1"),
        F.concat(F.col("o_orderstatus"), F.lit("!")).alias("Restaurant Service Type"), F.lit("x").alias("Note")).distinct()
    path = staging_path(spark, "t11")
    sinks.reload(p.load_mapping(sheet, ("sic_code", "sic_sub"), {
        "COVID Segmentation - L1": "segment_l1", "Restaurant Service Type": "service_type"}), path)
    return spark.read.parquet(path)
