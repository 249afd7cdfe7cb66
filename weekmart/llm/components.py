"""Connected components of links between long integers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.session import staging_path


def _stage(df: DataFrame, label: str) -> DataFrame:
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b): the root is the smallest node reachable.

    Each round connects every neighbour of a node to the smallest one, first the larger neighbours, then the smaller
    ones; the rounds needed grow with the logarithm of the nodes. Minima are aggregated before they are joined back, so
    a node with very many links is reduced on the map side and its join can be split. Each round is written to the
    shared folder. Links of a node to itself, repeated links and links with a null do no harm; no links give no rows.
    """
    edges = _stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        count, total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if count == 0 or (count, total) == state:
            break
        state = (count, total)
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        edges = _stage(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", "m").toDF("a", "b")).distinct(),
            "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
