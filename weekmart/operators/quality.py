"""Data-quality checks: unmapped keys, totals around joins, old against new."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.operators.metrics import describe


def unmapped(df: DataFrame, label: str, keys: Sequence[str], value: str = "lbs") -> DataFrame:
    """Volume by raw keys of the rows that got no label, nulls kept as keys."""
    missing = df.filter(F.col(label).isNull())
    return missing.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def unmapped_report(df: DataFrame, label: str, keys: Sequence[str], source: str, as_of, value: str = "lbs") -> DataFrame:
    """The unmapped rows with the source name and report date, ready to be written."""
    return unmapped(df, label, keys, value).withColumns({"source": F.lit(source), "report_date": F.lit(as_of).cast("date")})


def totals(df: DataFrame, stage: str, value: str = "lbs") -> DataFrame:
    return df.agg(F.lit(stage).alias("stage"), F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def before_after(before: DataFrame, after: DataFrame, value: str = "lbs", before_value: str | None = None) -> DataFrame:
    """Row counts and totals on both sides of a join: a duplicate mapping key shows at once."""
    return totals(before.withColumnRenamed(before_value or value, value), "before", value).unionByName(
        totals(after, "after", value))


def fan_out(joined: DataFrame, maps: Mapping[str, tuple[str, Sequence[str]]], value: str = "lbs") -> DataFrame:
    """Which mapping keys multiplied rows: ``mapping, key, rows, value`` added by each, for joins in the order of ``maps``.

    ``maps`` names each mapping with its ``copy`` column of ``map_left`` and the fact columns of its key. A row was added by
    the last join in which it is not the first copy; so every added row counts for one key, and the added rows and volume
    of all keys sum to the difference between the totals after and before the joins.
    """
    mapping, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (copy, keys) in maps.items():
        added = F.col(copy) > 1
        text = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("?"))) for k in keys])
        mapping, key = F.when(added, F.lit(name)).otherwise(mapping), F.when(added, text).otherwise(key)
    copied = joined.select(mapping.alias("mapping"), key.alias("key"), value).filter(F.col("mapping").isNotNull())
    return copied.groupBy("mapping", "key").agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


def observe_total(df: DataFrame, observation, value: Column | str = "lbs") -> DataFrame:
    """Record row count and total while the data flows through, without another pass."""
    return df.observe(observation, F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias("lbs"))


def observed_totals(df: DataFrame, observation, stage: str, value: Column | str = "lbs") -> DataFrame:
    """What ``observe_total`` recorded, as a row like that of ``totals``.

    A step over an empty input can be planned away with its observation; then ``df`` is read for its totals.
    """
    try:
        seen = observation.get
    except Py4JJavaError:
        return df.agg(F.lit(stage).alias("stage"), F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0.0)).alias("lbs"))
    return df.sparkSession.range(1).select(
        F.lit(stage).alias("stage"), F.lit(seen["rows"]).cast("long").alias("rows"), F.lit(seen["lbs"]).cast("double").alias("lbs"))


def unmapped_share(df: DataFrame, label: str, value: str = "lbs") -> DataFrame:
    """Rows and share of volume without a label."""
    missing = F.col(label).isNull()
    return df.agg(
        F.count_if(missing).alias("missing_rows"),
        F.try_divide(F.sum(F.when(missing, F.col(value)).otherwise(0.0)), F.sum(value)).alias("missing_share"),
    )


def weekly_difference(old: DataFrame, new: DataFrame, week: str, value: str = "lbs") -> DataFrame:
    """Weekly totals of two datasets where both have the week: before, after, change."""
    a = old.groupBy(week).agg(F.sum(value).alias("before"))
    b = new.groupBy(week).agg(F.sum(value).alias("after"))
    return a.join(b, week).withColumn("change", F.col("after") - F.col("before"))


def difference_summary(old: DataFrame, new: DataFrame, week: str, value: str = "lbs") -> DataFrame:
    return describe(weekly_difference(old, new, week, value), ["before", "after", "change"])


def welch(pairs: DataFrame, a: str = "before", b: str = "after") -> DataFrame:
    """Welch statistic and its degrees of freedom of two columns, in one aggregate."""
    va, vb = F.var_samp(a) / F.count(a), F.var_samp(b) / F.count(b)
    return (
        pairs.agg((F.avg(a) - F.avg(b)).alias("_d"), va.alias("_a"), vb.alias("_b"), F.count(a).alias("_na"), F.count(b).alias("_nb"))
        .select(
            F.try_divide(F.col("_d"), F.sqrt(F.col("_a") + F.col("_b"))).alias("t"),
            F.try_divide(
                F.pow(F.col("_a") + F.col("_b"), 2),
                F.pow(F.col("_a"), 2) / (F.col("_na") - 1) + F.pow(F.col("_b"), 2) / (F.col("_nb") - 1),
            ).alias("df"),
        )
    )


def welch_test(pairs: DataFrame, a: str = "before", b: str = "after") -> DataFrame:
    """Statistic, degrees of freedom and two-sided p-value: one row, from the one row ``welch`` returns."""
    row = welch(pairs, a, b).first()
    p = None if row.t is None or row.df is None else two_sided_p(row.t, row.df)
    return pairs.sparkSession.createDataFrame([(row.t, row.df, p)], "t double, df double, p double")


def two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t: the regularized incomplete beta function by its continued
    fraction. Applied to the single row ``welch`` returns."""
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)

    def fraction(p: float, q: float, z: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1.0 - (p + q) * z / (p + 1.0)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 500):
            for top in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
                        -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1.0 + top * d
                d = 1.0 / (d if abs(d) > tiny else tiny)
                c = 1.0 + top / c
                c = c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1.0) < 1e-15:
                break
        return h

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * fraction(a, b, x) / a
    return 1.0 - front * fraction(b, a, 1.0 - x) / b
