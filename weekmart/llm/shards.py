"""Uniform shuffle into shards of exact size, with a hypergeometric communication matrix.

Every input partition permutes its rows at random. How many of them go to which shard is drawn once for all partitions,
from the law that a uniform permutation of all rows would give (multivariate hypergeometric, exact row and column
sums). The first rows of a partition's permutation go to shard 0, the next to shard 1, and so on; in each shard the
rows are permuted again. Only DataFrame functions touch the rows; the driver draws one small matrix.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekmart.session import staging_path

LARGEST_DRAW = 10**9
SLOT_ROWS = 65_536


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``good`` are among ``drawn`` of all; for very large numbers by inversion around the mode."""
    if good + bad < LARGEST_DRAW:
        return int(rng.hypergeometric(good, bad, drawn)) if good + bad else 0
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    total = good + bad
    spread = int(40 * math.sqrt(drawn / total * good * bad / total * max(1, total - drawn) / total) + 50)
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=float)
    steps = np.log((good - k[:-1]) / (k[:-1] + 1)) + np.log((drawn - k[:-1]) / (bad - drawn + k[:-1] + 1))
    log_weight = np.append(0.0, np.cumsum(steps))
    weight = np.exp(log_weight - log_weight.max())
    return int(k[min(len(k) - 1, int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum())))])


def communication_matrix(rows: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows of each partition that go to each shard: row sums ``rows``, column sums ``sizes``.

    The partitions are halved again and again; each half's shares of the shards are drawn from what its parent has.
    """
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(rows), len(sizes)), np.int64)
    before = np.append(0, np.cumsum(rows))
    open_parts = [(0, len(rows), list(sizes))] if rows else []
    while open_parts:
        first, last, held = open_parts.pop()
        if last - first == 1:
            matrix[first] = held
            continue
        middle = (first + last) // 2
        wanted, left, part = int(before[middle] - before[first]), sum(held), []
        for share in held:
            left -= share
            part.append(draw_hypergeometric(rng, share, left, wanted))
            wanted -= part[-1]
        open_parts += [(first, middle, part), (middle, last, [a - b for a, b in zip(held, part)])]
    return matrix


def uniform_shards(rows: DataFrame, shards: int, seed: int = 11) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard), uniformly at random.

    Shard sizes differ by one row at most. Every row counts for itself: nulls, empty and repeated rows are shuffled like
    others. Columns of ``rows`` named shard or slot are replaced. The permuted rows are written once to the shared
    folder, so a lost executor changes no draw. An empty table gives no rows; fewer rows than shards leave some empty.
    """
    spark = rows.sparkSession
    stored = staging_path(spark, "permuted")
    kept = rows.drop("shard", "slot")
    index = F.monotonically_increasing_id()
    (kept.select(F.struct("*").alias("row"), F.rand(seed).alias("u"), F.rand(seed + 1).alias("v")).sortWithinPartitions("u")
     .select("row", "v", F.shiftrightunsigned(index, 33).cast("int").alias("part"), index.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
     .write.parquet(stored))
    permuted = spark.read.parquet(stored)
    parts = permuted.groupBy("part").count().orderBy("part").collect()
    counts = [r["count"] for r in parts]
    total = sum(counts)
    matrix = communication_matrix(counts, [total // shards + (k < total % shards) for k in range(shards)], seed)
    bounds = spark.createDataFrame(
        [(r["part"], b) for r, b in zip(parts, np.cumsum(matrix, axis=1).tolist())], "part int, bounds array<bigint>")
    bins = max(1, total // (shards * SLOT_ROWS))
    placed = permuted.join(bounds, "part").select(
        "row", "v", "part", "place", F.size(F.filter("bounds", lambda b: b <= F.col("place"))).alias("shard"),
        F.floor(F.col("v") * bins).cast("int").alias("bin"))
    sizes = placed.groupBy("shard", "bin").count()
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bin").orderBy("v", "part", "place")
    slot = F.col("start") + F.row_number().over(within) - 1
    return placed.join(starts, ["shard", "bin"]).select("row", "shard", slot.alias("slot")).select("row.*", "shard", "slot")
