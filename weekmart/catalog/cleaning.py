"""Cleaning operators over text made from the given columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekmart.catalog.base import lines, query, sellout, table, with_ctes
from weekmart.functions import clean as c
from weekmart.operators.calendar import WEEK

LINE = "l_orderkey, l_linenumber"


def items(spark, sf):
    return table(spark, sf, "lineitem")


def line(df, **columns):
    return df.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in columns.items()])


def signed():
    """Amounts as text with thousands commas, returns negative."""
    amount = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return F.format_number(amount, 2)


SIGNED = "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END"


@query("c1_text_to_number", f"SELECT {LINE}, CASE WHEN l_linenumber < 7 THEN {SIGNED} END AS number FROM lineitem")
def text_to_number(spark, sf):
    text = F.when(F.col("l_linenumber") < 7, signed()).otherwise("n/a")
    return line(items(spark, sf), number=c.to_number(text))


@query("c2_digits_only", f"SELECT {LINE}, {SIGNED} AS number, l_extendedprice AS unsigned FROM lineitem")
def digits_only(spark, sf):
    text = F.concat(signed(), F.lit(" lb"))
    return line(items(spark, sf), number=c.digits_number(text), unsigned=c.digits_number(text, keep_sign=False))


@query("c2_dash_is_zero", f"""
SELECT {LINE}, CASE WHEN l_linenumber < 7 THEN {SIGNED} ELSE 0 END AS number,
  CASE WHEN l_linenumber < 7 THEN l_extendedprice ELSE 0 END AS unsigned FROM lineitem""")
def dash_is_zero(spark, sf):
    text = F.when(F.col("l_linenumber") < 7, signed()).otherwise("-")
    return line(items(spark, sf), number=c.dash_number(text), unsigned=c.dash_number(text, keep_sign=False))


@query("c3_impute_weight", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 AND l_quantity > 0 THEN p_size * l_quantity
  WHEN l_discount = 0 THEN 0 ELSE l_quantity * 10 END AS weight FROM lineitem JOIN part ON l_partkey = p_partkey""")
def impute_weight(spark, sf):
    df = items(spark, sf).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    weight = F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity") * 10)
    return line(df, weight=c.impute_weight(weight, F.col("l_quantity"), F.col("p_size").cast("double")))


def category(name, expression, sql):
    @query(name, f"SELECT category, {sql} AS consolidated, count(*) AS rows FROM ("
                 f"SELECT CASE p_type WHEN 'PROMO' THEN 'Potato' WHEN 'SMALL' THEN 'Sweet Potato' WHEN 'LARGE' THEN NULL "
                 f"WHEN 'MEDIUM' THEN 'FROZEN POT' WHEN 'ECONOMY' THEN 'Potato Skins' ELSE p_type END AS category "
                 f"FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY ALL")
    def run(spark, sf):
        kind = F.col("p_type")
        named = (F.when(kind == "PROMO", "Potato").when(kind == "SMALL", "Sweet Potato").when(kind == "LARGE", F.lit(None))
                 .when(kind == "MEDIUM", "FROZEN POT").when(kind == "ECONOMY", "Potato Skins").otherwise(kind))
        df = items(spark, sf).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        df = df.select(named.alias("category"))
        return df.groupBy("category", expression(F.col("category")).alias("consolidated")).agg(F.count("*").alias("rows"))


def either(test):
    return f"CASE WHEN {test} THEN 'Potato' ELSE 'Prepared Foods' END"


category("c4a_category_by_equality", c.category_equal, either("category IN ('Potato', 'Sweet Potato')"))
category("c4b_category_by_substring", lambda x: c.category_contains(x, "POT"), either("contains(coalesce(category, ''), 'POT')"))
category("c4c_category_by_prefix", c.category_prefix, either("category LIKE 'Potato%'"))
category("c4d_category_contains_label", lambda x: c.category_contains(x, c.POTATO, keep_null=True),
         f"CASE WHEN category IS NOT NULL THEN {either(chr(39).join(['contains(category, ', 'Potato', ')']))} END")
category("c4e_category_inside_label", c.category_inside, either("instr('Potato', category) > 0"))


CITY = "(SELECT l_quantity, CASE WHEN n_nationkey <> 7 THEN n_name END AS name FROM lines JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"


@query("c5_clean_city", with_ctes(["lines"], select=f"""
SELECT CASE WHEN name LIKE 'NATION_1%' THEN 'NATION_1' WHEN name LIKE 'NATION_2%' THEN 'NATION_2' ELSE 'NA' END AS city,
  sum(l_quantity) AS lbs FROM {CITY} GROUP BY 1"""))
def clean_city(spark, sf):
    df = lines(spark, sf).join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    df = df.withColumn("city", F.when(F.col("n_nationkey") != 7, F.concat(F.lit(" "), F.lower("n_name"))))
    return c.with_clean_city(df, ["NATION_1", "NATION_2"]).groupBy("city").agg(F.sum("l_quantity").alias("lbs"))


@query("c6_repair_labels", with_ctes(["lines"], select="""
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MEU' ELSE o_orderpriority END AS sector, sum(l_quantity) AS lbs
FROM lines GROUP BY 1"""))
def repair_labels(spark, sf):
    sector = F.when(F.col("o_orderpriority") == "1-URGENT", "MEU-IO").when(F.col("o_orderpriority") == "2-HIGH", "MEU0IO").otherwise(
        F.col("o_orderpriority"))
    df = c.relabel(lines(spark, sf).withColumn("sector", sector), "sector", {"MEU-IO": "MEU", "MEU0IO": "MEU"})
    return df.groupBy("sector").agg(F.sum("l_quantity").alias("lbs"))


@query("c7_strip_decimal", f"SELECT {LINE}, l_partkey::VARCHAR AS sku_id FROM lineitem")
def strip_decimal(spark, sf):
    return line(items(spark, sf), sku_id=c.strip_decimal(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))))


@query("c8_trim_and_upper", "SELECT p_partkey, upper(p_name) AS p_name, p_brand FROM part")
def trim_and_upper(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.col("p_name")).alias("p_name"), F.concat(F.col("p_brand"), F.lit(" ")).alias("p_brand"))
    return c.upper_columns(c.trim_columns(part, ["p_name", "p_brand"]), ["p_name"])


@query("c9_split_pack", """
SELECT p_partkey, CASE WHEN p_size > 10 THEN p_size::VARCHAR ELSE '6' END AS pack,
  CASE WHEN p_size > 10 THEN '5 LB/x' ELSE 'each' END AS size FROM part""")
def split_pack(spark, sf):
    pack = F.when(F.col("p_size") > 10, F.concat(F.col("p_size").cast("string"), F.lit("/5 LB/x"))).otherwise("6")
    return c.split_pack(table(spark, sf, "part").select("p_partkey", pack.alias("pack"), F.lit("each").alias("size")))


@query("c10_drop_dashed", """
SELECT segment, count(*) AS rows FROM (SELECT CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '3-MEDIUM' THEN 'plain' ELSE o_orderpriority END
  AS segment FROM orders) WHERE segment IS NULL OR segment NOT LIKE '%-%' GROUP BY 1""")
def drop_dashed(spark, sf):
    label = F.col("o_orderpriority")
    segment = F.when(label == "5-LOW", F.lit(None)).when(label == "3-MEDIUM", "plain").otherwise(label)
    df = c.drop_containing(table(spark, sf, "orders").select(segment.alias("segment")), "segment")
    return df.groupBy("segment").agg(F.count("*").alias("rows"))


@query("c11_id_text", """
SELECT l_orderkey, l_linenumber, ltrim(l_partkey::VARCHAR, '0') AS material_id, right('0000' || lpad(l_suppkey::VARCHAR, 10, '0'), 10) AS customer_id,
  l_returnflag || ' ' || l_linestatus AS label FROM lineitem""")
def id_text(spark, sf):
    return line(
        items(spark, sf), material_id=c.strip_zeros(F.lpad(F.col("l_partkey").cast("string"), 18, "0")),
        customer_id=c.last_chars(F.concat(F.lit("0000"), F.lpad(F.col("l_suppkey").cast("string"), 10, "0")), 10),
        label=F.concat_ws(" ", "l_returnflag", "l_linestatus"))


@query("c12_text_filters", """
SELECT p_type, count(*) AS rows FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE contains(p_name, 'ring') OR regexp_matches(p_brand, '.*#2[0-4]$') GROUP BY 1""")
def text_filters(spark, sf):
    df = items(spark, sf).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    df = df.filter(F.col("p_name").contains("ring") | F.col("p_brand").rlike(".*#2[0-4]$"))
    return df.groupBy("p_type").agg(F.count("*").alias("rows"))


@query("c13_collapse_others", with_ctes(["sellout"], select="""
SELECT CASE WHEN segment_l1 IN ('MACHINERY', 'HOUSEHOLD') THEN segment_l1 ELSE 'Non-Commercial' END AS segment_l1, sum(lbs) AS lbs
FROM sellout GROUP BY 1"""))
def collapse_others(spark, sf):
    label = c.collapse_others(F.col("segment_l1"), ["MACHINERY", "HOUSEHOLD"], "Non-Commercial")
    return sellout(spark, sf).groupBy(label.alias("segment_l1")).agg(F.sum("lbs").alias("lbs"))


@query("c14_rename_and_project", "SELECT p_partkey AS sku, p_brand AS brand, 'Returns' AS distributor FROM part")
def rename_and_project(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand").withColumnsRenamed({"p_partkey": "SKU", "p_brand": "Brand"})
    return c.lower_headers(part.withColumn("Distributor", F.lit("Returns")))


@query("c15_plain_headers", "SELECT s_suppkey AS suppkey, s_name AS name FROM supplier")
def plain_headers(spark, sf):
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("SAP_SuppKey"), F.col("s_name").alias("SAP_Name"))
    return c.plain_headers(names, "SAP_")


@query("c16_blank_geography", with_ctes(["sellout"], select="""
SELECT 'NA' AS city, 'NA' AS state, 'Returns' AS source, segment_l1, sum(lbs) AS lbs FROM sellout GROUP BY segment_l1"""))
def blank_geography(spark, sf):
    df = c.set_columns(c.default_column(sellout(spark, sf), "source", "Returns"), ["city", "state"])
    return df.groupBy("city", "state", "source", "segment_l1").agg(F.sum("lbs").alias("lbs"))


@query("c17_drop_prefix", with_ctes(["sellout"], select="""
SELECT segment_l1, sum(lbs) AS lbs FROM sellout WHERE segment_l1 IS NULL OR segment_l1 NOT LIKE 'MACH%' GROUP BY 1"""))
def drop_prefix(spark, sf):
    return c.drop_prefix(sellout(spark, sf), "segment_l1", "MACH").groupBy("segment_l1").agg(F.sum("lbs").alias("lbs"))


@query("c18_date_range", with_ctes(["sellout"], select="""
SELECT calendar_week_year, sum(lbs) AS lbs FROM sellout WHERE ship_date > DATE '1998-12-29' AND ship_date < DATE '1999-03-03' GROUP BY 1"""))
def date_range(spark, sf):
    df = sellout(spark, sf).filter((F.col("ship_date") > "1998-12-29") & (F.col("ship_date") < "1999-03-03"))
    return df.groupBy(WEEK).agg(F.sum("lbs").alias("lbs"))
