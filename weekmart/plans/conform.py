"""Conforming plans: one per delivery layout, from raw columns to the shared sell-out fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.functions import clean as c
from weekmart.functions import dates as d
from weekmart.operators import calendar as cal
from weekmart.operators import mapping as m
from weekmart.sources import readers as r

SEGMENT_LABELS = ("segment_l1", "segment_l2", "restaurants", "restaurants_sub", "service_type", "cuisine_type")
CANADA_LABELS = ("segment_l1", "segment_l2", "restaurants", "service_type")
PRODUCT_LABELS = ("consolidated_category", "l1_product", "l2_product")
# fixed values: sector labels that mean the same
SECTOR_REPAIRS: Mapping[str, str] = {"MEU-IO": "MEU", "MEU0IO": "MEU", "MEU - IO": "MEU", "MEU - Unit": "MEU"}
STATE_REPAIRS: Mapping[str, str] = {"tn": "TN"}


@dataclass(frozen=True)
class Dictionaries:
    """Mapping tables of one source. Which of them a plan needs is said in its docstring."""

    segments: DataFrame | None = None
    products: DataFrame | None = None
    manufacturers: DataFrame | None = None
    regions: DataFrame | None = None
    provinces: DataFrame | None = None


def conform_regional_us(df: DataFrame, maps: Dictionaries, calendar: DataFrame) -> DataFrame:
    """Regional US source: segments by three keys, products by maker id, Sunday weeks.

    Needs ``segments`` (business_unit, sic_code, sic_sub) and ``products`` (mfg_id).
    """
    df = df.withColumnsRenamed({"customer_city": "city", "customer_state": "state"})
    keys = {k: k for k in ("business_unit", "sic_code", "sic_sub")}
    df = m.map_left(df, maps.segments, keys, SEGMENT_LABELS, m.lowered)
    df = df.withColumn("sku_id", F.col("sku_id").cast("string"))
    products = maps.products.withColumn("mfg_id", F.col("mfg_id").cast("string"))
    df = m.map_left(df, products, {"sku_id": "mfg_id"}, PRODUCT_LABELS, m.lowered)
    df = df.withColumn("week_starting", d.parse_date(F.col("week_beginning_date").cast("string")))
    df = cal.known_weeks_only(cal.attach_week(df, calendar, "week_starting", "week_starting_sun"))
    df = df.withColumn("lbs", c.to_number(F.col("lbs"), strict=True))
    return c.with_clean_city(m.attach_state(df, unmatched=None))


def _national_report(df: DataFrame, maps: Dictionaries, calendar: DataFrame, dedupe_products: bool) -> DataFrame:
    df = df.withColumns({
        "segment": F.trim("segment"),
        "invoice_week": d.parse_date(F.col("invoice_week").cast("string")),
        "mfr_sku": F.col("mfr_sku").cast("string"),
    })
    keys = {k: k for k in ("customer_class", "segment", "account_type")}
    rules = {"customer_class": m.lowered, "segment": m.trimmed_lower, "account_type": m.trimmed_lower}
    df = m.map_left(df, maps.segments, keys, SEGMENT_LABELS, rules)
    products = maps.products.withColumns({
        "mfr_sku": F.col("mfr_sku").cast("string"), "case_weight": F.col("case_weight").cast("double")})
    df = m.map_left(df, products, {"mfr_sku": "mfr_sku"}, [*PRODUCT_LABELS, "case_weight"], dedupe=dedupe_products)
    weight, qty = F.col("weight").cast("double"), F.col("qty").cast("double")
    df = df.withColumns({"qty": qty, "weight": c.impute_weight(weight, qty, F.col("case_weight"))})
    df = cal.known_weeks_only(cal.attach_week(df, calendar, "invoice_week", "week_starting_mon"))
    df = df.withColumnsRenamed({"weight": "lbs", "mfr_sku": "sku_id"})
    return m.attach_state(df, repairs=STATE_REPAIRS)


def conform_national_report(df: DataFrame, maps: Dictionaries, calendar: DataFrame) -> DataFrame:
    """National US report source: listed manufacturers only, imputed weights, Monday weeks.

    Needs ``manufacturers`` (manufacturer, inclusion), ``segments`` (customer_class, segment,
    account_type) and ``products`` (mfr_sku, case_weight).
    """
    included = maps.manufacturers.filter(F.col("inclusion") == "Include")
    return _national_report(m.keep_listed(df, included, "manufacturer"), maps, calendar, dedupe_products=True)


def conform_national_export(df: DataFrame, maps: Dictionaries, calendar: DataFrame) -> DataFrame:
    """The same source for the full export: all manufacturers, product map taken as it is."""
    return _national_report(df, maps, calendar, dedupe_products=False)


def conform_national_weekly(df: DataFrame, maps: Dictionaries, calendar: DataFrame) -> DataFrame:
    """National US weekly source: segments by one key, products by maker SKU, Sunday weeks, no city.

    Rows of unknown weeks stay (with a null week). Needs ``segments`` (pyramid_segment) and
    ``products`` (maker_sku_id).
    """
    df = df.withColumnsRenamed({
        "pyr_segment": "pyramid_segment", "division": "market", "mfg_number": "manufacturer_item_number",
        "product": "product_description"})
    df = m.map_left(df, maps.segments, {"pyramid_segment": "pyramid_segment"}, SEGMENT_LABELS[:5], m.lowered)
    df = m.map_left(df, maps.products, {"maker_sku_id": "maker_sku_id"}, PRODUCT_LABELS)
    df = cal.attach_week(df, calendar, "week_beginning_date", "week_starting_sun").drop("week_beginning_date")
    return m.attach_state(df).withColumn("city", F.lit(c.NO_CITY))


def _conform_canada(df: DataFrame, maps: Dictionaries, calendar: DataFrame, any_space: bool) -> DataFrame:
    keys = ("sector", "segment", "subsegment")
    tidy = {k: c.blank_to_null(F.col(k), any_space) for k in keys}
    df = df.withColumn("consolidated_category", c.category_contains(F.col("category"), "POT")).withColumns(tidy)
    df = df.withColumn("sector", F.replace("sector", F.lit("/"), F.lit("")))
    df = m.map_left(df, maps.segments.withColumns(tidy), {k: k for k in keys}, CANADA_LABELS)
    df = df.withColumns({"city": F.lit(c.NO_CITY), "region": F.lit(c.NO_CITY),
                         "period_end": d.parse_date(F.col("period_end").cast("string"))})
    return cal.attach_week(df, calendar, "period_end", "week_ending_sat")


def conform_canada_one(df: DataFrame, maps: Dictionaries, calendar: DataFrame) -> DataFrame:
    """First Canadian source. Any white space counts as blank. Needs ``segments``
    (sector, segment, subsegment)."""
    return _conform_canada(df, maps, calendar, any_space=True)


def conform_canada_two(df: DataFrame, maps: Dictionaries, calendar: DataFrame) -> DataFrame:
    """Second Canadian source. Only empty text counts as blank after trimming."""
    return _conform_canada(df, maps, calendar, any_space=False)


def _conform_canada_file(df: DataFrame, maps: Dictionaries, cities: tuple[str, ...]) -> DataFrame:
    df = c.relabel(df, "sector", SECTOR_REPAIRS)
    keys = {k: k for k in ("sector", "segment", "subsegment")}
    df = m.map_left(df, maps.segments, keys, CANADA_LABELS, m.lowered)
    return c.with_clean_city(m.attach_province(df, maps.provinces), cities)


def conform_canada_one_file(df: DataFrame, maps: Dictionaries, calendar: DataFrame, cities: tuple[str, ...] = ()) -> DataFrame:
    """Older file of the first Canadian source: province, city list, distributor fiscal week."""
    df = _conform_canada_file(df, maps, cities)
    df = cal.attach_fiscal_week(df, calendar, "fiscal_week", "fiscal_week_one")
    return df.withColumnsRenamed({"volume_lbs": "lbs", "category": "consolidated_category"})


def conform_canada_two_file(df: DataFrame, maps: Dictionaries, calendar: DataFrame, cities: tuple[str, ...] = ()) -> DataFrame:
    """Older file of the second Canadian source: fiscal year and week as separate numbers."""
    df = _conform_canada_file(df, maps, cities)
    df = df.withColumn("fiscal_key", d.year_week_text(F.col("fiscal_year"), F.col("fiscal_week")))
    df = cal.attach_fiscal_week(df, calendar, "fiscal_key", "fiscal_week_two").drop("fiscal_key")
    df = df.withColumnsRenamed({"total_lbs": "lbs", "product_category": "consolidated_category"})
    return df.withColumn("consolidated_category", c.category_prefix(F.col("consolidated_category")))


# --- raw loaders: delivered file to stored table -------------------------------------------------

REGIONAL_COLUMNS: Mapping[str, str] = {
    "branch": "branch", "business_unit": "business_unit", "sic_code": "sic_code", "sic_sub": "sic_sub",
    "customer_nbr": "customer_number", "customer_name": "customer_name", "customer_address1": "customer_address1",
    "customer_address2": "customer_address2", "customer_city": "customer_city", "customer_state": "customer_state",
    "customer_zip": "customer_zip", "manufacture_prod_nbr": "maker_sku_id", "prod_nbr": "product_number",
    "product": "product_description", "week_of": "week_beginning_date", "lbs": "lbs",
}


def load_regional_us(raw: DataFrame) -> DataFrame:
    """Regional US file to its table: 16 columns, rows with a week only, ids without ``.0``."""
    df = raw.dropna(subset=["week_of"]).select([F.col(old).alias(new) for old, new in REGIONAL_COLUMNS.items()])
    return df.withColumns({
        **{k: c.strip_decimal(F.col(k)) for k in ("customer_number", "customer_zip", "product_number")},
        "lbs": c.to_number(F.col("lbs").cast("string"), strict=True),
        "week_beginning_date": d.parse_date(F.col("week_beginning_date").cast("string")),
    })


REPORT_COLUMNS = (
    "division", "account_number", "account_name", "address", "city", "state", "postal_code", "customer_class",
    "segment", "account_type", "vendor", "manufacturer", "manufacturer_gtin", "maker_sku_id", "dist_sku",
    "item_name", "pack", "size", "unit_type", "qty", "weight", "week_beginning_date",
)


def maker_sku(df: DataFrame) -> DataFrame:
    """The maker's item number under one name; where a file has both columns, the first filled one counts."""
    known = [x for x in ("mfr_sku", "mfg_number") if x in df.columns]
    return df.withColumn("maker_sku_id", F.coalesce(*known)).drop(*known) if known else df


def load_national_report(raw: DataFrame, name_date: str = "first_date") -> DataFrame:
    """National report file to its table; the week starts the day before the first date in its name."""
    df = maker_sku(raw).withColumnRenamed("gtin", "manufacturer_gtin")
    df = df.withColumns({
        "manufacturer_gtin": F.col("manufacturer_gtin").cast("string"),
        "account_number": c.strip_decimal(F.col("account_number")),
        "week_beginning_date": d.day_before(F.col(name_date)),
        "qty": c.to_number(F.col("qty")),
        "weight": c.to_number(F.col("weight")),
    })
    df = c.upper_columns(df, ["account_name", "address", "city", "state"])
    df = c.trim_columns(df, list(REPORT_COLUMNS[:12]))
    return c.split_pack(df).select(*REPORT_COLUMNS)


SHARED_COLUMNS = (
    "area", "region", "market", "state", "pyramid_segment", "asys_id", "asys_description", "manufacturer_gtin",
    "maker_sku_id", "week_beginning_date", "lbs",
)


def load_national_shared(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """Shared-table file to its table: rows with a market and a plain segment, market cleaned."""
    df = maker_sku(raw).withColumnsRenamed({"asys": "asys_description", "asys_code": "asys_id", "gtin": "manufacturer_gtin"})
    df = c.drop_containing(df.dropna(subset=["market"]), "pyramid_segment")
    df = df.withColumns({"asys_id": c.strip_decimal(F.col("asys_id")), "lbs": c.to_number(F.col("lbs"))})
    return m.attach_market(df, regions).select(*SHARED_COLUMNS)


def conform_national_history(
    weekly: DataFrame, shared: DataFrame, segments: DataFrame, regions: DataFrame, products: DataFrame,
) -> DataFrame:
    """Older weekly files and newer shared files as one history.

    ``weekly`` carries market, pyramid_segment, asys_id, week_beginning_date, lbs; ``shared`` the
    same plus area. Products match by asys id; ids lose a trailing ``.0`` on both sides.
    """
    skus = products.filter(F.col("asys_id").isNotNull()).withColumn("asys_id", c.strip_decimal(F.col("asys_id")))

    def dress(df: DataFrame) -> DataFrame:
        df = df.withColumn("asys_id", c.strip_decimal(F.col("asys_id")))
        df = m.attach_market(df, regions, clean=False)
        return m.map_left(df, skus, {"asys_id": "asys_id"}, ["maker_sku_id", *PRODUCT_LABELS])

    new = m.map_left(dress(shared), segments, {"pyramid_segment": "pyramid_segment"}, SEGMENT_LABELS[:5])
    return new.unionByName(dress(weekly), allowMissingColumns=True)


def load_mapping(raw: DataFrame, keys: tuple[str, ...], renames: Mapping[str, str]) -> DataFrame:
    """Mapping sheet to its table: chosen columns under their stored names."""
    return raw.select(*keys, *[F.col(old).alias(new) for old, new in renames.items()])


def read_national_report_folder(spark, folder: str, schema, glob: str | None = None) -> DataFrame:
    """All report files below a folder, with the first date of each file's name."""
    df = r.read_by_header(spark, folder, schema.fieldNames(), glob)
    return r.snake_headers(df.withColumn("first_date", F.get(r.dates_in(r.last_part(F.col(r.FILE))), 0)).drop(r.FILE))
