"""Registry, the conformed fact the queries share, and its SQL counterpart."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weekmart.functions import dates as d
from weekmart.operators.calendar import WEEK, build_calendar
from weekmart.session import bound_tasks

FIRST_YEAR, LAST_YEAR, BASELINE_YEAR = 1994, 2002, 1996
COVID_START = datetime.date(1999, 1, 4)
BEGIN, END = 199601, 199652
DIMS = ["state", "segment_l1"]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that must give the same rows."""
    def add(run):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run
    return add


SCHEMAS: dict[str, StructType] = {}
COUNTS: dict[str, int] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file footer once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The largest table, whose joins and sums are dealt over tasks by its rows, counted from the file footers once per process."""
    items, path = table(spark, sf, "lineitem"), f"{sf}/lineitem"
    if path not in COUNTS:
        COUNTS[path] = items.count()
    bound_tasks(spark, COUNTS[path])
    return items


def calendar(spark: SparkSession) -> DataFrame:
    return build_calendar(spark, FIRST_YEAR, LAST_YEAR, BASELINE_YEAR, COVID_START)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their order: the raw fact before any dimension."""
    items, orders = order_lines(spark, sf), table(spark, sf, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).withColumns({
        "ship_date": F.col("l_shipdate").cast("date"), "order_date": F.col("o_orderdate").cast("date")})


def described_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with part, order, customer and nation.

    Customers are joined to orders before the orders meet their lines: that join then moves one row
    per order, not one per line.
    """
    items = order_lines(spark, sf)
    orders, customer, nation, part = (table(spark, sf, t) for t in ("orders", "customer", "nation", "part"))
    buyers = orders.join(
        customer.join(nation, customer.c_nationkey == nation.n_nationkey), orders.o_custkey == customer.c_custkey)
    return (
        items.join(part, items.l_partkey == part.p_partkey)
        .join(buyers, items.l_orderkey == F.col("o_orderkey"))
        .withColumns({"ship_date": F.col("l_shipdate").cast("date"), "order_date": F.col("o_orderdate").cast("date")})
    )


def sellout(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as a conformed weekly sell-out fact; one market segment has lost its label."""
    return (
        described_lines(spark, sf)
        .select(
            d.iso_week_key(F.col("ship_date")).alias(WEEK), "ship_date", "order_date",
            F.col("n_name").alias("state"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment_l1"),
            F.col("o_orderpriority").alias("segment_l2"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_returnflag").alias("distributor"),
            F.col("l_quantity").alias("lbs"),
        )
    )


# --- SQL side ------------------------------------------------------------------------------------

def iso(day: str) -> str:
    return f"CAST(isoyear({day}) * 100 + week({day}) AS INTEGER)"


CTES = {
    "lines": """
lines AS (
  SELECT *, CAST(l_shipdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "sellout": f"""
sellout AS (
  SELECT {iso('ship_date')} AS calendar_week_year, ship_date, order_date, n_name AS state,
    nullif(c_mktsegment, 'BUILDING') AS segment_l1, o_orderpriority AS segment_l2, p_type AS category,
    p_brand AS brand, l_partkey AS sku_id, l_returnflag AS distributor, l_quantity AS lbs
  FROM lines JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)""",
    "calendar": f"""
mondays AS (
  SELECT CAST(t.d AS DATE) AS mon
  FROM generate_series(DATE '1994-01-03', DATE '2002-12-23', INTERVAL 7 DAY) t(d)),
calendar AS (
  SELECT {iso('mon')} AS calendar_week_year, mon - 1 AS week_starting_sun, mon + 5 AS week_ending_sat,
    mon AS week_starting_mon, mon + 6 AS week_ending_sun, {iso('(mon - 364)')} AS yoy_week,
    CAST({BASELINE_YEAR} * 100 + least(week(mon), 52) AS INTEGER) AS baseline_week,
    CASE WHEN mon >= DATE '{COVID_START}' THEN CAST((mon - DATE '{COVID_START}') // 7 + 1 AS INTEGER) END AS covid_week,
    CAST((year(mon) + (month(mon) >= 7)::INT) * 100
      + ceil((mon - make_date(year(mon) + (month(mon) >= 7)::INT - 1, 7, 1) + 1) / 7.0) AS INTEGER) AS fiscal_week
  FROM mondays)""",
}
NEEDS = {"sellout": ["lines"]}


def with_ctes(names: Sequence[str], *more: str, select: str) -> str:
    """SQL text with the named shared CTEs, further CTEs and the final select."""
    order: list[str] = []
    for name in names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in order:
                order.append(needed)
    parts = [CTES[name] for name in order] + list(more)
    return "WITH " + ",".join(parts) + "\n" + select


def same(a: str, b: str, columns: Sequence[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in columns) or "true"


def analysis_ctes(
    dims: Sequence[str], fact: str = "sellout", begin: int = BEGIN, end: int = END, dense: bool = True, tag: str = "",
    week_columns: Sequence[str] = ("week_starting_sun", "week_ending_sat"),
) -> str:
    """CTE chain ending in ``analyzed{tag}``: product of segments and weeks, self-joins, windows."""
    keys = ", ".join(dims)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in dims)
    p = f"PARTITION BY {keys} ORDER BY calendar_week_year"
    base = (
        f"""base{tag} AS (
  SELECT s.*, w.calendar_week_year, coalesce(g.lbs, 0) AS lbs
  FROM (SELECT DISTINCT {keys} FROM grain{tag} WHERE {whole}) s
  CROSS JOIN (SELECT DISTINCT calendar_week_year FROM grain{tag}) w
  LEFT JOIN grain{tag} g ON {same('g', 's', dims)} AND g.calendar_week_year = w.calendar_week_year)"""
        if dense else f"base{tag} AS (SELECT * FROM grain{tag})")
    sources = {"": "lbs", "_ly": "lbs_ly", "_baseline": "lbs_baseline"}
    averages = ", ".join(
        f"avg({v}) OVER ({p} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sma_{n}{s}"
        for s, v in sources.items() for n in (4, 8, 12))
    lags = ", ".join(f"lag(lbs, {k}) OVER ({p}) AS lbs_lag_{k}" for k in (1, 2, 3, 4))
    measures = (
        ["lbs", "sma_4", "sma_8", "sma_12", "lbs_ly", "sma_4_ly", "sma_8_ly", "sma_12_ly", "lbs_baseline",
         "sma_4_baseline", "sma_8_baseline", "sma_12_baseline", "lbs_lag_1", "lbs_lag_2", "lbs_lag_3", "lbs_lag_4",
         "lbs_baseline_lag_1", "lbs_ly_lag_1", "sma_4_lag_1", "sma_4_ly_lag_1", "sma_4_baseline_lag_1", "lbs_precovid"])
    windowed = [m for m in measures if m not in ("lbs", "lbs_ly", "lbs_baseline")]
    shown = ", ".join(
        f"coalesce(round_even(CAST({('CASE WHEN ' + whole + ' THEN ' + m + ' END') if m in windowed else m} AS DOUBLE), 2), "
        f"{2 if m in ('lbs_baseline_lag_1', 'lbs_ly_lag_1') else 0}) AS {m}" for m in measures)
    return f"""
grain{tag} AS (
  SELECT {keys}, calendar_week_year, coalesce(sum(lbs), 0) AS lbs FROM {fact}
  WHERE calendar_week_year IS NOT NULL GROUP BY {keys}, calendar_week_year),
{base},
prior{tag} AS (
  SELECT b.*, c.* EXCLUDE (calendar_week_year), coalesce(y.lbs, 0) AS lbs_ly, coalesce(z.lbs, 0) AS lbs_baseline
  FROM base{tag} b LEFT JOIN calendar c ON c.calendar_week_year = b.calendar_week_year
  LEFT JOIN base{tag} y ON {same('y', 'b', dims)} AND y.calendar_week_year = c.yoy_week
  LEFT JOIN base{tag} z ON {same('z', 'b', dims)} AND z.calendar_week_year = c.baseline_week),
rolled{tag} AS (
  SELECT *, {lags}, {averages}, lag(lbs_baseline) OVER ({p}) AS lbs_baseline_lag_1, lag(lbs) OVER ({p}) AS lbs_ly_lag_1,
    sum(CASE WHEN calendar_week_year BETWEEN {begin} AND {end} THEN lbs END) OVER (PARTITION BY {keys}) / 52 AS lbs_precovid
  FROM prior{tag}),
lagged{tag} AS (
  SELECT *, lag(sma_4) OVER ({p}) AS sma_4_lag_1, lag(sma_4_ly) OVER ({p}) AS sma_4_ly_lag_1,
    lag(sma_4_baseline) OVER ({p}) AS sma_4_baseline_lag_1
  FROM rolled{tag}),
analyzed{tag} AS (
  SELECT {keys}, calendar_week_year, {shown}, yoy_week, baseline_week, {', '.join(week_columns)}, covid_week
  FROM lagged{tag})"""


def analysis_sql(dims: Sequence[str], select: str, fact: str = "sellout", *more: str, **options) -> str:
    return with_ctes(["sellout", "calendar"], *more, analysis_ctes(dims, fact, **options), select=select)
