"""Exact top-k inner products: vectors by descending length, rotated partial sums, Cauchy-Schwarz bounds.

The candidates are sorted by length and packed into chunks. A rotation from the singular vectors of a bounded sample
moves most of a product into its first components; it is orthogonal, so results do not depend on it. For a block of
candidates, partial products over the first rotated components plus the product of the residual lengths bound each
score from above. Queries and candidates whose bounds all stay below the query's k-th best score are dropped, step by
step; what is left is scored exactly in integers. The longest vectors are scored first, so thresholds are high from
the start.

Queries are a stated part of the rows, in blocks of QUERY_ROWS. GROUP_CHUNKS neighbouring chunks are a part, GROUP_BLOCKS
blocks a slice; a part and a slice meet in one place, to which each chunk and each block is sent once. A part that is too
short for a block does not get it, and one that is too short for a whole slice is not sent there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekmart.llm.text import prepare
from weekmart.session import staged, staging_path

FIT_ROWS, SEED_ROWS = 4096, 2048
CHUNK_ROWS, QUERY_ROWS, BLOCK_ROWS = 1024, 512, 256
GROUP_CHUNKS, GROUP_BLOCKS = 8, 32
PART_BITS = 32
EXACT = float(1 << 53)
LOWEST = np.iinfo(np.int64).min


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(finite, F.lit(False)), whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, short ones padded with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _rows(content: bytes, width: int) -> np.ndarray:
    return np.frombuffer(content, np.int64).reshape(-1, width)


def exact_scores(queries: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond what a double holds exactly they are computed in whole numbers, bounded by a long."""
    largest = np.abs(queries).max(initial=0).astype(float) * np.abs(items).max(initial=0).astype(float) * queries.shape[1]
    if largest < EXACT:
        return (queries.astype(float) @ items.astype(float).T).astype(np.int64)
    info = np.iinfo(np.int64)
    return np.clip(queries.astype(object) @ items.astype(object).T, info.min, info.max).astype(np.int64)


class Turned:
    """Vectors with their rotation, and the lengths of what each step leaves of them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, rotation: np.ndarray):
        width = rows.shape[1]
        self.ids, self.rows, self.steps = ids, rows, sorted({max(1, width // 4), max(1, width // 2), width})
        self.turned = rows.astype(float) @ rotation
        self.rest = np.stack([np.sqrt((self.turned[:, s:] ** 2).sum(1)) for s in [0, *self.steps]])


class Searcher:
    """Running best ``k`` candidates of a block of queries."""

    def __init__(self, queries: Turned, floors: np.ndarray, k: int):
        self.queries, self.floors, self.k = queries, floors.copy(), k
        self.best = (np.zeros(0, np.int64),) * 3

    def add(self, items: Turned) -> None:
        """Score candidates, which come by descending length."""
        for k in range(0, len(items.ids), BLOCK_ROWS):
            self._block(items, np.arange(k, min(k + BLOCK_ROWS, len(items.ids))))

    def _block(self, items: Turned, cols: np.ndarray) -> None:
        own, top = self.queries, items.rest[0][cols].max(initial=0)
        slack = 1e-6 + 1e-9 * own.rest[0] * top
        among = np.flatnonzero(own.rest[0] * top + slack >= self.floors)
        partial, done = np.zeros((len(among), len(cols))), 0
        for n, step in enumerate(own.steps, 1):
            partial += own.turned[among, done:step] @ items.turned[cols, done:step].T
            possible = partial + own.rest[n][among][:, None] * items.rest[n][cols][None, :] + slack[among][:, None] >= self.floors[among][:, None]
            live_rows, live_cols = possible.any(1), possible.any(0)
            if not live_rows.any():
                return
            among, cols, partial = among[live_rows], cols[live_cols], partial[live_rows][:, live_cols]
            done = step
        scores = exact_scores(own.rows[among], items.rows[cols])
        ids = items.ids[cols]
        r, c = np.nonzero((scores >= self.floors[among][:, None]) & (ids[None, :] != own.ids[among][:, None]))
        self._merge(among[r], ids[c], scores[r, c])

    def _merge(self, query: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        query, item, score = (np.concatenate(x) for x in zip(self.best, (query, item, score)))
        order = np.lexsort((item, ~score, query))
        query, item, score = query[order], item[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.best = (query[kept], item[kept], score[kept])
        last = rank == self.k - 1
        self.floors[query[last]] = np.maximum(self.floors[query[last]], score[last])


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "vector", fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The ``k`` rows of highest inner product for every query: query_id, rank (from 1), ``id``, score.

    ``vector`` holds whole numbers. Queries are the rows where ``is_query`` holds, candidates all rows but those with the
    query's own id. Ties go to the smaller id. Rows with a null id or vector take no part; shorter vectors count as
    filled up with zeros. Candidates that repeat an id are candidates each; of queries that repeat an id the smallest
    vector asks. Fewer candidates than ``k`` give fewer ranks. ``fit_rows`` bounds the sample for the rotation and
    SEED_ROWS the longest vectors that set the first thresholds; both only change how much is skipped. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = (
        vectors.where(is_query.isNotNull()).select(vectors[id].cast("long").alias("id"), vectors[vector].alias("v"), is_query.alias("asks"))
        .where("id is not null and v is not null and forall(v, x -> x is not null)"))
    rows = rows.withColumn("length", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id}` long, score long")
    width = max(1, width)
    sample = rows.orderBy(F.xxhash64("id")).limit(fit_rows).select("v").toArrow()["v"].combine_chunks()
    basis = _matrix(sample, width).astype(float)
    rotation = np.ascontiguousarray(np.linalg.eigh(basis.T @ basis)[1][:, ::-1])
    longest = rows.orderBy(F.desc("length"), "id").limit(SEED_ROWS).select("id", "v").toArrow()
    seeds = spark.sparkContext.broadcast((
        longest["id"].to_numpy(), _matrix(longest["v"].combine_chunks(), width).astype(np.int64), rotation))

    def pack(size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, values, made = np.zeros(0, np.int64), np.zeros((0, width), np.int64), 0
            for batch in batches:
                ids = np.concatenate([ids, batch.column(0).to_numpy()])
                values = np.concatenate([values, _matrix(batch.column(1), width)])
                while len(ids) >= size:
                    yield packed(ids[:size], values[:size], made)
                    ids, values, made = ids[size:], values[size:], made + 1
            if len(ids):
                yield packed(ids, values, made)
        return run

    def packed(ids: np.ndarray, values: np.ndarray, made: int) -> pa.RecordBatch:
        top = float(np.sqrt((values.astype(float) ** 2).sum(1).max()))
        part = (TaskContext.get().partitionId() << PART_BITS) + made // GROUP_CHUNKS
        return pa.RecordBatch.from_pydict({
            "ids": pa.array([ids.tobytes()], pa.binary()), "rows": pa.array([np.ascontiguousarray(values).tobytes()], pa.binary()),
            "top": [top], "part": [part]})

    def first_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_ids, seed_rows, turn = seeds.value
        longest = Turned(seed_ids, seed_rows, turn)
        for batch in batches:
            floors, needs = [], []
            for ids, content in zip(batch.column("ids").to_pylist(), batch.column("rows").to_pylist()):
                search = Searcher(asking := Turned(np.frombuffer(ids, np.int64), _rows(content, width), turn), np.full(len(ids) // 8, LOWEST), k)
                search.add(longest)
                floors.append(search.floors.tobytes())
                lengths = asking.rest[0]
                reach = np.where(lengths > 0, search.floors / np.maximum(lengths, 1e-300), np.where(search.floors > 0, np.inf, -np.inf))
                needs.append(float(reach.min()) * (1 - 1e-9) - 1e-6 if reach.min() > 0 else -1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), batch.column("rows"), pa.array(floors, pa.binary()), pa.array(needs)], ["ids", "rows", "floors", "needs"])

    kind = "ids binary, rows binary, top double, part long"
    chunks = staged(
        rows.repartitionByRange(F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id").select("id", "v")
        .mapInArrow(pack(CHUNK_ROWS), kind), "vector-chunks")
    asked = rows.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    blocks = staged(
        asked.select("id", "v").mapInArrow(pack(QUERY_ROWS), kind).mapInArrow(first_scores, "ids binary, rows binary, floors binary, needs double"),
        "query-blocks")
    slices = max(1, -(-blocks.count() // GROUP_BLOCKS))
    blocks = blocks.withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    least = blocks.groupBy("slice").agg(F.min("needs").alias("least"))
    parts = chunks.groupBy("part").agg(F.max("top").alias("longest")).select("part", "longest", every).join(least, "slice").where("longest >= least")
    parts = staged(parts.select("part", "slice", "longest"), "parts")  # names and lengths only
    asking = blocks.join(parts, "slice").where("longest >= needs").select("part", "slice", "ids", "rows", "needs", "floors")
    offered = chunks.select("part", every, "ids", "rows", "top").join(least, "slice").where("top >= least").select(
        "part", "slice", "ids", "rows", F.col("top").alias("needs"), F.lit(None).cast("binary").alias("floors"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, at, held = seeds.value[2], None, []
        for batch in batches:
            for n in range(len(batch)):
                x = batch.slice(n, 1).to_pylist()[0]
                if (x["part"], x["slice"]) != at:
                    at, held = (x["part"], x["slice"]), []
                here = Turned(np.frombuffer(x["ids"], np.int64), _rows(x["rows"], width), turn)
                if x["floors"] is None:
                    held.append((x["needs"], here))
                    continue
                running = Searcher(here, np.frombuffer(x["floors"], np.int64), k)
                for top, items in held:
                    if top >= x["needs"]:
                        running.add(items)
                query, item, score = running.best
                yield pa.RecordBatch.from_arrays([pa.array(here.ids[query]), pa.array(item), pa.array(score)], ["query_id", "id", "score"])

    met = offered.unionByName(asking).repartition("part", "slice").sortWithinPartitions("part", "slice", F.col("floors").isNotNull(), F.desc("needs"))
    found = met.mapInArrow(search, "query_id long, id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id), "score")
