"""Joins that conform raw labels to shared dimensions.

Mapping tables come from the caller, so their joins carry no hint: Spark broadcasts a side when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond that it sorts and merges, and
adaptive execution splits hot keys. Key listings are counted before they are broadcast. Only the
state table, whose 56 rows are fixed here, is broadcast as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmart.session import staged

# fixed values: US state and territory names by abbreviation
STATE_NAMES: Mapping[str, str] = {
    "AL": "Alabama", "AK": "Alaska", "AS": "American Samoa", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "GU": "Guam", "HI": "Hawaii",
    "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky",
    "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan",
    "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska",
    "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "MP": "Northern Mariana Islands", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "PR": "Puerto Rico", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VI": "Virgin Islands", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}
NO_STATE = "None"


def as_is(value: Column) -> Column:
    return value


def lowered(value: Column) -> Column:
    return F.lower(value)


def trimmed_lower(value: Column) -> Column:
    return F.lower(F.trim(value))


def distinct_mapping(mapping: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct mapping rows, nulls kept: exact duplicates must not multiply the fact."""
    return mapping.select(*columns).distinct()


def last_mapping(mapping: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key: the one with the largest ``order``."""
    return mapping.groupBy(key).agg(F.max_by(value, order).alias(value))


def map_left(
    df: DataFrame, mapping: DataFrame, keys: Mapping[str, str], values: Sequence[str],
    normalize: Callable[[Column], Column] | Mapping[str, Callable[[Column], Column]] = as_is,
    dedupe: bool = True, copy: str | None = None,
) -> DataFrame:
    """Left join on normalized keys ``{fact column: mapping column}``, adding ``values``.

    ``normalize`` is one function for all keys or one per fact column. A null key matches a null
    key in the mapping, as the reports have always treated blanks. ``copy`` names a column that
    numbers the copies of a row from 1, where several mapping rows have its key; ``fan_out`` tells
    from it which keys multiplied rows.
    """
    rule = {c: normalize if callable(normalize) else normalize.get(c, as_is) for c in keys}
    side = mapping.select(
        *[rule[c](F.col(m)).alias(f"_k{i}") for i, (c, m) in enumerate(keys.items())], *values)
    if dedupe:
        side = side.distinct()
    condition = F.lit(True)
    for i, column in enumerate(keys):
        condition = condition & rule[column](df[column]).eqNullSafe(side[f"_k{i}"])
    if copy is not None:
        side = side.withColumn(copy, F.row_number().over(Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy(*values)))
    out = df.join(side, condition, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    return out if copy is None else out.withColumn(copy, F.coalesce(copy, F.lit(1)))


def states(spark: SparkSession) -> DataFrame:
    """State dimension: abbreviation and name."""
    rows = [F.struct(F.lit(code).alias("state"), F.lit(name).alias("state_name")) for code, name in STATE_NAMES.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def attach_state(df: DataFrame, unmatched: str | None = NO_STATE, repairs: Mapping[str, str] | None = None) -> DataFrame:
    """State name by abbreviation. Unmatched rows get ``unmatched`` in both columns, if given."""
    if repairs:
        df = df.replace(dict(repairs), subset=["state"])
    df = df.join(F.broadcast(states(df.sparkSession)), "state", "left")
    if unmatched is None:
        return df
    unknown = F.col("state_name").isNull()
    return df.withColumns({
        "state": F.when(unknown, unmatched).otherwise(F.col("state")),
        "state_name": F.when(unknown, unmatched).otherwise(F.col("state_name")),
    })


def state_code(df: DataFrame, name: str = "state_name", code: str = "state_code") -> DataFrame:
    """State abbreviation by name; null if unknown."""
    side = states(df.sparkSession).select(F.col("state_name").alias(name), F.col("state").alias(code))
    return df.join(F.broadcast(side), name, "left")


def attach_province(
    df: DataFrame, provinces: DataFrame, column: str = "province", clean: str = "province_clean", other: str = "Other",
) -> DataFrame:
    """Clean province name; ``0`` or unmatched becomes ``Other``."""
    df = map_left(df, provinces, {column: column}, [clean])
    known = F.col(clean).isNotNull() & (F.col(clean) != "0")
    return df.withColumn(clean, F.when(known, F.col(clean)).otherwise(other))


def attach_market(df: DataFrame, markets: DataFrame, clean: bool = True) -> DataFrame:
    """Region and state by market; the market name is replaced by its cleaned form."""
    df = map_left(df, markets, {"market": "market"}, ["market_clean", "region", "state"])
    if clean:
        return df.drop("market").withColumnRenamed("market_clean", "market")
    return df.drop("market_clean")


def keep_listed(df: DataFrame, listing: DataFrame, column: str) -> DataFrame:
    """Rows whose value is in the listing (semi join; null never is)."""
    return df.join(staged(listing.select(column).distinct()), column, "left_semi")


def drop_listed(df: DataFrame, listing: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not in the listing; rows with a null value stay."""
    return df.join(staged(listing.select(column).distinct()), column, "left_anti")


def excluded_counts(df: DataFrame, listing: DataFrame, column: str) -> DataFrame:
    """Row counts of the non-null values outside the listing."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
        .join(listing.select(column), column, "left_anti")
    )


def combine_periods(
    frames: Mapping[int, DataFrame], keys: Sequence[str], measures: Sequence[str], suffix: str = "_{}wk",
) -> DataFrame:
    """Full outer combination of period frames on their keys: measures per period, one row per key and occurrence.

    The frames are stacked and pivoted, which needs one shuffle instead of one per join. A key that a period's frame repeats
    keeps all its rows: the first of one period stands beside the first of the other, in the order of the measures, and a
    row without a counterpart has nulls. So no volume is lost or counted twice.
    """
    stacked = None
    for period, frame in frames.items():
        part = frame.select(*keys, *measures, F.lit(period).alias("_period"))
        stacked = part if stacked is None else stacked.unionByName(part)
    cells = [
        F.max(F.when(F.col("_period") == period, F.col(m))).alias(m + suffix.format(period))
        for period in frames for m in measures
    ]
    same_key = Window.partitionBy(*keys, "_period").orderBy(*measures)
    placed = stacked.repartition(*keys).withColumn("_occurrence", F.row_number().over(same_key))
    return placed.groupBy(*keys, "_occurrence").agg(*cells).drop("_occurrence")


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01, fraction: float = 0.02, seed: int = 7) -> DataFrame:
    """Key combinations that hold at least ``share`` of the rows: proposed by a sample, then counted over all rows.

    At most 1 / ``share`` combinations can be. A key that the sample misses is not listed; ``map_split`` then leaves it to the
    shuffled join, with the same rows.
    """
    rows = df.select(*keys)
    sampled = rows.sample(fraction=fraction, seed=seed).groupBy(*keys).agg(F.count("*").alias("_rows"))
    likely = sampled.withColumn("_all", F.sum("_rows").over(Window.partitionBy())).filter(F.col("_rows") >= F.col("_all") * share / 2)
    likely = staged(likely.orderBy(F.desc("_rows")).limit(int(2 / share)).select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]), "likely")
    hot = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)])
    # a left join with the few likely keys counts them and all rows at once
    counted = rows.join(F.broadcast(likely.withColumn("_likely", F.lit(True))), hot, "left").groupBy(
        *[f"_h{i}" for i in range(len(keys))], "_likely").agg(F.count("*").alias("_rows"))
    counted = counted.withColumn("_all", F.sum("_rows").over(Window.partitionBy()))
    return staged(counted.filter(F.col("_likely") & (F.col("_rows") >= F.col("_all") * share)).select(
        *[F.col(f"_h{i}").alias(k) for i, k in enumerate(keys)]), "frequent")


def map_split(
    df: DataFrame, mapping: DataFrame, keys: Mapping[str, str], values: Sequence[str],
    normalize: Callable[[Column], Column] | Mapping[str, Callable[[Column], Column]] = as_is,
    dedupe: bool = True, share: float = 0.01, most: int = 100_000,
) -> DataFrame:
    """``map_left`` for a fact with hot raw keys and a mapping beyond the broadcast threshold: the same rows.

    Rows of the frequent keys meet only those keys' mapping rows, which are counted and broadcast if they are at most ``most``;
    they are not shuffled, however many they are. All other rows are joined as usual.
    """
    columns = list(keys)
    frequent = frequent_keys(df, columns, share)
    rule = {c: normalize if callable(normalize) else normalize.get(c, as_is) for c in keys}
    flagged = frequent.select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(columns)], F.lit(True).alias("_hot"))
    of_key = reduce(lambda a, b: a & b, [df[c].eqNullSafe(flagged[f"_h{i}"]) for i, c in enumerate(columns)])
    asked = frequent.select(*[rule[c](F.col(c)).alias(f"_r{i}") for i, c in enumerate(columns)]).distinct()
    needed = reduce(lambda a, b: a & b, [rule[c](mapping[m]).eqNullSafe(asked[f"_r{i}"]) for i, (c, m) in enumerate(keys.items())])
    few = staged(mapping.join(F.broadcast(asked), needed, "left_semi"), "frequent-mapping")
    if frequent.isEmpty() or few.count() > most:
        return map_left(df, mapping, keys, values, normalize, dedupe)
    marked = df.join(F.broadcast(flagged), of_key, "left").drop(*[f"_h{i}" for i in range(len(columns))])
    hot = marked.filter(F.col("_hot")).drop("_hot")
    rest = marked.filter(F.col("_hot").isNull()).drop("_hot")
    return map_left(hot, few.hint("broadcast"), keys, values, normalize, dedupe).unionByName(map_left(rest, mapping, keys, values, normalize, dedupe))
