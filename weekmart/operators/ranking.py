"""Distributed numbering and exact selection: ranges of a sorted frame, counts by partition, prefix sums.

A frame is dealt out by ranges of its order, sorted inside each partition and staged with a number that holds the partition
and the place in it. The counts by partition, one row each, give every partition's offset. No task sorts or counts more than
its range, so neither the number of rows nor the form of the keys bounds what can be numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekmart.session import staged

AT = "_at"  # partition in the upper bits, place in the partition in the lower 33
PLACE_BITS = 33


def ordered(df: DataFrame, order: Sequence[str], label: str = "ordered") -> DataFrame:
    """``df`` staged in ranges of ``order`` with each row's partition and place in AT."""
    return staged(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(AT, F.monotonically_increasing_id()), label)


def part() -> Column:
    return F.shiftright(AT, PLACE_BITS).cast("int")


def place() -> Column:
    return F.col(AT).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def numbered(df: DataFrame, order: Sequence[str], position: str = "_pos", last: str = "_last") -> DataFrame:
    """``df``, whose rows differ in ``order``, with positions from 1 in that order and the largest position.

    Only the number of rows in each partition is seen by the driver.
    """
    kept = ordered(df, order, "numbered")
    counts = dict(kept.groupBy(part().alias("part")).count().collect())
    offsets, before = [], 0
    for k in range(max(counts, default=0) + 1):
        offsets.append(before)
        before += counts.get(k, 0)
    offset = F.get(F.array(*[F.lit(o).cast("long") for o in offsets]), part())
    wide = "int" if before < 1 << 31 else "long"
    return kept.withColumns({position: (offset + place() + 1).cast(wide), last: F.lit(before).cast(wide)}).drop(AT)


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of numeric columns: ``column`` and an array ``quantiles`` in the order of ``shares``.

    The different values of each column are counted and dealt out by ranges; sums by partition tell which partitions hold the
    ranks asked for, and only those partitions are numbered row by row. No buffer grows with the number of different values.
    Nulls are left out, NaN counts as the largest value; a column without values has nulls.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("rows"))
    kept = ordered(counted, ["column", "value"], "values")
    parts = staged(kept.groupBy("column", part().alias("part")).agg(F.sum("rows").alias("held")), "value-parts")
    before = Window.partitionBy("column").orderBy("part")  # one row for each partition
    parts = parts.withColumns({
        "before": F.sum("held").over(before) - F.col("held"), "total": F.sum("held").over(Window.partitionBy("column"))})
    exact = [F.lit(s) * (F.col("total") - 1) for s in shares]
    asked = F.array(*[F.struct(F.lit(k).alias("share"), r.alias("rank"), F.floor(r).alias("low"), F.ceil(r).alias("high")) for k, r in enumerate(exact)])
    wanted = parts.withColumn("asked", F.filter(asked, lambda a: (a["high"] >= F.col("before")) & (a["low"] < F.col("before") + F.col("held"))))
    wanted = wanted.filter(F.size("asked") > 0).select(F.col("column").alias("of"), "part", "before", "asked")
    near = kept.withColumn("_part", part()).join(wanted, (F.col("column") == F.col("of")) & (F.col("_part") == F.col("part")))
    running = Window.partitionBy("column", "part").orderBy("value")
    ends = near.withColumn("end", F.col("before") + F.sum("rows").over(running))  # ranks from 0: this value has [end - rows, end)
    inside = ends.select("column", "value", F.explode("asked").alias("a"), (F.col("end") - F.col("rows")).alias("first"), "end")

    def value_at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) >= F.col("first")) & (F.col(rank) < F.col("end")), F.col("value")))

    found = inside.select("column", "value", "first", "end", "a.*").filter("(low >= first and low < end) or (high >= first and high < end)")
    low, high, beyond = F.col("at_low"), F.col("at_high"), F.col("rank") - F.col("low")
    found = found.groupBy("column", "share", "rank", "low").agg(value_at("low").alias("at_low"), value_at("high").alias("at_high"))
    # equal ends are taken as they are: infinite ones have no difference
    cell = F.when((beyond == 0) | (low == high), low).otherwise(low + (high - low) * beyond)
    return found.groupBy("column").agg(F.array(*[F.max(F.when(F.col("share") == k, cell)) for k in range(len(shares))]).alias("quantiles"))
