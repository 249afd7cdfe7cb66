import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekmart.operators import metrics as g
from weekmart.operators import ranking as r


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbers_follow_the_order_over_all_partitions(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = r.numbered(spark.range(0, 60_000, 1, 7).select((F.col("id") * 7919 % 60_013).alias("k"), F.lit("x").alias("other")), ["k"])
        rows = out.orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert [x._pos for x in rows] == list(range(1, 60_001)) and {x._last for x in rows} == {60_000}
    assert r.numbered(spark.range(0).select(F.col("id").alias("k")), ["k"]).count() == 0


def test_only_the_counts_reach_the_driver(spark):
    plan = r.numbered(spark.range(1000).select(F.col("id").alias("k")), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def plain(values, share):
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    if not values:
        return None
    at = share * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if at == math.floor(at) or low == high else low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("parts", [1, 16])
def test_quantiles_equal_a_sorted_list(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.gauss(0, 1), rng.randint(0, 3), float(rng.choice([5, 7, None]) or math.nan) if k % 2 else None, None, math.inf if k % 3 else -1.0)
            for k in range(4001)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double, e double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = {x.column: x.quantiles for x in r.quantiles(df, df.columns, shares).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert set(found) == {"a", "b", "c", "e"}
    for k, name in enumerate(df.columns):
        values = [float(x[k]) for x in rows if x[k] is not None]
        for share, got in zip(shares, found.get(name, [])):
            assert got == pytest.approx(plain(values, share), nan_ok=True, abs=1e-12)


def test_describe_holds_no_buffer_of_values(spark):
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") * 7919 % 200_003 / 7).alias("v"), F.lit(None).cast("int").alias("n"))
    out = g.describe(df, ["v", "n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan and "ObjectHashAggregate" not in plan and "collect_" not in plan
    told = {x.column: x for x in out.collect()}
    values = np.sort(np.array([x.v for x in df.select("v").collect()]))
    assert [told["v"].q25, told["v"].q50, told["v"].q75] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist(), rel=1e-12)
    assert told["v"]["count"] == 200_000 and told["n"]["count"] == 0 and told["n"].q50 is None
