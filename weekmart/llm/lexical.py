"""Ranked lexical search: impact vectors in buckets by length, pruned by Cauchy-Schwarz and coordinate bounds, exact scores.

A document is the vector of its terms' impacts, an item the vector of its terms' weights times their repeats; the score is
their inner product. Only terms of the items can count, so the vectors keep those alone. They are ordered by length and
packed into buckets of similar length. A bucket whose longest vector cannot reach an item's k-th best score, by the product
of the lengths, is passed over. Inside a bucket the item's largest coordinates are looked at: the angle that the threshold
allows bounds each coordinate of a normalised vector from below and above, and the product over those coordinates plus the
product of what is left of both lengths bounds the score. What passes is scored in 64-bit integers.

Thresholds begin with the scores in the buckets of longest vectors and rise within each task. They are exact, so no result
depends on how buckets are dealt out. Items are a stated query set, taken in blocks of BLOCK_PAIRS item terms: a block's
vocabulary and weights are broadcast, which bounds what a task holds whatever the number of items and documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmart.llm.text import pieces, prepare, runs, same_spans, span_hashes, spread, utf8
from weekmart.session import staged, staging_path

BLOCK_PAIRS = 500_000
BUCKET_ROWS, BUCKET_ENTRIES, SEED_BUCKETS = 1024, 1 << 18, 2
FOCUS = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLACK = 1e-9

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def terms_of(text: Column) -> Column:
    """The terms of a text in order; null has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


class Vocabulary(NamedTuple):
    """Different terms in the order of their hashes: bytes, starts, ends, hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray


def vocabulary(terms: list[str]) -> Vocabulary:
    coded = [t.encode() for t in terms]
    ends = np.cumsum([len(t) for t in coded], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if coded else np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(coded), np.uint8)
    hashes = span_hashes(data, starts, ends)
    order = np.argsort(hashes, kind="stable")
    return Vocabulary(data, starts[order], ends[order], hashes[order])


def _listed(known: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of each span's term in the vocabulary, -1 for other terms. Hashes propose, contents decide."""
    hashes = span_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(known.hashes, hashes), max(len(known.hashes) - 1, 0))
    if not len(known.hashes):
        return np.full(len(starts), -1)
    found = np.flatnonzero(known.hashes[at] == hashes)
    lengths, like = (ends - starts)[found], at[found]
    same = len(np.unique(known.hashes)) == len(known.hashes) and bool((lengths == (known.ends - known.starts)[like]).all())
    if same and same_spans(data, starts[found], known.data, known.starts[like], lengths):
        out = np.full(len(starts), -1)
        out[found] = like
        return out
    number = {known.data[a:b].tobytes(): k for k, (a, b) in enumerate(zip(known.starts.tolist(), known.ends.tolist()))}
    return np.array([number.get(data[a:b].tobytes(), -1) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)


def _counts(known: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, how many different listed ones, and the listed ones' numbers and counts, text by text."""
    data, offsets = utf8(column)
    out = []
    for a, b in pieces(offsets):
        part = _LOWER[data[offsets[a]: offsets[b]]]
        borders = offsets[a: b + 1] - offsets[a]
        starts, ends = runs(_IN_TERM[part], borders)
        terms = _listed(known, part, starts, ends)
        sizes = np.diff(np.searchsorted(starts, borders))
        texts = np.repeat(np.arange(b - a), sizes)[terms >= 0]
        keys, times = np.unique(texts * len(known.hashes) + terms[terms >= 0], return_counts=True)
        texts, terms = np.divmod(keys, max(len(known.hashes), 1))
        out.append((sizes, np.bincount(texts, minlength=b - a), terms, times))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def impacts(times: np.ndarray, terms: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impact of a term that occurs so many times in a document of so many terms, in whole numbers."""
    wide = object if 25 * int(terms.max(initial=0)) * documents >= 1 << 63 else np.int64
    m = (75 + 25 * terms.astype(wide) * documents // total).astype(np.int64)
    return 1_000_000_000 * times // (1000 * times + 12 * m)


class Query(NamedTuple):
    """An item: its terms by falling weight, their whole-number weights, and the length of that vector."""

    terms: np.ndarray
    weights: np.ndarray
    length: float


class Bucket:
    """Documents of similar length: rows of listed terms and impacts, and the same by term where it is asked for."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.ids, self.sizes, self.terms, self.values = ids, sizes, terms, values
        self.starts = np.cumsum(sizes) - sizes
        self.lengths = np.sqrt(np.add.reduceat(values.astype(float) ** 2, self.starts)) if len(values) else np.zeros(len(ids))
        self.longest = float(self.lengths.max(initial=0))
        self._by_term: tuple[np.ndarray, ...] | None = None

    def coordinates(self, wanted: np.ndarray) -> np.ndarray:
        """Normalised vectors at some terms, a row per document."""
        if self._by_term is None:
            order = np.argsort(self.terms, kind="stable")
            rows = np.repeat(np.arange(len(self.ids)), self.sizes)[order]
            self._by_term = (self.terms[order], rows, self.values[order] / self.lengths[rows])
        terms, rows, values = self._by_term
        first, last = np.searchsorted(terms, wanted), np.searchsorted(terms, wanted, "right")
        out = np.zeros((len(self.ids), len(wanted)))
        at = spread(first, last - first)
        out[rows[at], np.repeat(np.arange(len(wanted)), last - first)] = values[at]
        return out

    def survivors(self, query: Query, floor: int) -> np.ndarray:
        """Documents whose bounds reach ``floor``."""
        least = floor / (query.length * self.longest)
        focus = query.weights[:FOCUS] / query.length
        here = self.coordinates(query.terms[:FOCUS])
        angle, own = math.acos(min(1.0, least)), np.arccos(np.minimum(1.0, focus))
        low, high = np.cos(np.minimum(math.pi, own + angle)) - SLACK, np.cos(np.maximum(0.0, own - angle)) + SLACK
        kept = ((here >= low) & (here <= high)).all(1)
        rest = math.sqrt(max(0.0, 1 - float(focus @ focus))) * np.sqrt(np.maximum(0.0, 1 - (here * here).sum(1)))
        bound = (here @ focus + rest) * self.lengths * query.length
        return np.flatnonzero(kept & (bound * (1 + SLACK) + 1e-6 >= floor))

    def scores(self, rows: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; each has a listed term at least."""
        sizes = self.sizes[rows]
        at = spread(self.starts[rows], sizes)
        return np.add.reduceat(weight_of[self.terms[at]] * self.values[at], np.cumsum(sizes) - sizes)


class Search:
    """Running best ``k`` documents of every item of a block."""

    def __init__(self, queries: list[Query], floors: list[int], terms: int, k: int):
        self.queries, self.floors, self.k = queries, list(floors), k
        self.weight_of = np.zeros(terms, np.int64)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]

    def add(self, bucket: Bucket) -> None:
        for n, query in enumerate(self.queries):
            floor = self.floors[n]
            if not query.length or query.length * bucket.longest * (1 + SLACK) + 1e-6 < floor:
                continue
            rows = bucket.survivors(query, floor)
            if not len(rows):
                continue
            self.weight_of[query.terms] = query.weights
            scores = bucket.scores(rows, self.weight_of)
            self.weight_of[query.terms] = 0
            enough = scores >= floor
            if not enough.any():
                continue
            ids = np.concatenate([self.best[n][0], bucket.ids[rows[enough]]])
            scores = np.concatenate([self.best[n][1], scores[enough]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.best[n] = (ids[order], scores[order])
            if len(order) == self.k:
                self.floors[n] = max(floor, int(scores[order[-1]]))

    def found(self) -> pa.RecordBatch:
        sizes = [len(b[0]) for b in self.best]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)), pa.array(np.concatenate([b[0] for b in self.best])),
            pa.array(np.concatenate([b[1] for b in self.best]))], ["item", "id", "score"])


def _vectors(docs: DataFrame, known) -> DataFrame:
    """id, terms of the text, and its listed terms with counts, a row for each text that has a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, listed, terms, times = _counts(known.value, batch.column("text"))
            borders = pa.array(np.concatenate([[0], np.cumsum(listed)]), pa.int32())
            rows = pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(sizes), pa.ListArray.from_arrays(borders, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(borders, pa.array(times, pa.int64()))], ["id", "size", "terms", "times"])
            yield rows.filter(pa.array(sizes > 0))

    return staged(docs.mapInArrow(run, "id long, size long, terms array<int>, times array<long>"), "term-counts")


def _buckets(vectors: DataFrame, documents: int, total: int) -> DataFrame:
    """Impact vectors of documents that have a listed term, by falling length, packed."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("times")
            sizes = np.diff(listed.offsets.to_numpy())
            values = impacts(listed.flatten().to_numpy(), np.repeat(batch.column("size").to_numpy(), sizes), documents, total)
            starts = np.cumsum(sizes) - sizes
            lengths = np.sqrt(np.add.reduceat(values.astype(float) ** 2, starts)) if len(values) else np.zeros(0)
            borders = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            terms = pa.ListArray.from_arrays(borders, pa.array(batch.column("terms").flatten()))
            rows = pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(lengths), terms, pa.ListArray.from_arrays(borders, pa.array(values.astype(np.int32)))],
                ["id", "length", "terms", "values"])
            yield rows.filter(pa.array(lengths > 0))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            ids, lengths = batch.column("id").to_numpy(), batch.column("length").to_numpy()
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            terms, values = (batch.column(c).flatten().to_numpy() for c in ("terms", "values"))
            for a, b in pieces(np.concatenate([[0], np.cumsum(sizes)]), BUCKET_ENTRIES):
                for a in range(a, b, BUCKET_ROWS):
                    c = min(b, a + BUCKET_ROWS)
                    low, high = starts[a], starts[c - 1] + sizes[c - 1]
                    part = (ids[a:c], sizes[a:c].astype(np.int64), terms[low:high], values[low:high], lengths[a:c])
                    if held and (sum(len(h[0]) for h in held) + c - a > BUCKET_ROWS or sum(len(h[2]) for h in held) + high - low > BUCKET_ENTRIES):
                        yield closed(held)
                        held = []
                    held.append(part)
        if held:
            yield closed(held)

    def closed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, sizes, terms, values, lengths = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_pydict({"top": [float(lengths.max())]} | {
            c: pa.array([x.tobytes()], pa.binary()) for c, x in (("ids", ids), ("sizes", sizes), ("terms", terms), ("values", values))})

    listed = vectors.where("id is not null and size(terms) > 0").mapInArrow(measured, "id long, length double, terms array<int>, values array<int>")
    ordered = listed.repartitionByRange(F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
    return staged(ordered.mapInArrow(packed, "top double, ids binary, sizes binary, terms binary, values binary"), "norm-buckets")


def _searched(buckets: DataFrame, block, k: int) -> DataFrame:
    """The best documents of each item among the buckets of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors, terms = block.value
        search = Search(queries, floors, terms, k)
        for batch in batches:
            for row in batch.to_pylist():
                search.add(Bucket(
                    np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["terms"], np.int32),
                    np.frombuffer(row["values"], np.int32)))
        yield search.found()

    return buckets.mapInArrow(run, "item int, id long, score long")


def _block_queries(pairs: list, known: Vocabulary, frequencies: dict[int, int], documents: int) -> tuple[list, list[Query]]:
    """The items of a block and their vectors of terms that occur; a term's weight is floor(1000 * ln((2N + 2) / (2df + 1)))."""
    number = {known.data[a:b].tobytes().decode(): k for k, (a, b) in enumerate(zip(known.starts.tolist(), known.ends.tolist()))}
    by_item: dict = {}
    for item, term, times in pairs:
        if df := frequencies.get(number[term]):
            weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
            by_item.setdefault(item, []).append((-times * weight, number[term]))
    items = sorted(by_item, key=lambda v: (v is None, v if v is not None else 0))
    queries = []
    for item in items:
        cells = np.array(sorted(by_item[item]), np.int64)
        queries.append(Query(cells[:, 1], -cells[:, 0], math.sqrt(float((cells[:, 0].astype(float) ** 2).sum()))))
    return items, queries


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``k`` documents of highest score for every item: ``item``, rank (from 1), ``id``, score; only scores above 0.

    Ties go to the smaller id. A null or empty document counts for nothing; one with a null id counts in the statistics
    but is not ranked; documents that repeat an id are documents each. Of items that repeat an id the smallest text asks; a
    null item id is an id like others. Items without terms, or without a document that has one, give no rows. Other columns
    are not read. The documents are tokenised once for each block of BLOCK_PAIRS different (item, term) pairs; an item of
    more has a block of its own.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(docs[id].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    asked = items.select(items[item].alias("item"), items[item_text].alias("text")).groupBy("item").agg(F.min("text").alias("text"))
    pairs = staged(asked.select("item", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item", "term").agg(F.count("*").alias("times")), "item-terms")
    blocks = max(1, -(-pairs.count() // BLOCK_PAIRS))
    found = []
    for number in range(blocks):
        rows = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        listed = [tuple(r) for r in rows.collect()]
        if listed:
            found.append(_block(spark, texts, listed, pairs.schema["item"].dataType.simpleString(), k))
    if not found:
        return spark.createDataFrame([], f"`{item}` {pairs.schema['item'].dataType.simpleString()}, rank int, `{id}` long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    return every.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        F.col("item").alias(item), "rank", F.col("id").alias(id), "score")


def _block(spark: SparkSession, texts: DataFrame, pairs: list, kind: str, k: int) -> DataFrame:
    """item, id and score of what can be among the best ``k`` of a block's items."""
    known = vocabulary(sorted({p[1] for p in pairs}))
    vectors = _vectors(texts, spark.sparkContext.broadcast(known))
    documents, total = vectors.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    frequencies = {r[0]: r[1] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    items, queries = _block_queries(pairs, known, frequencies, documents)
    if not queries:
        return spark.createDataFrame([], f"item {kind}, id long, score long")
    buckets = _buckets(vectors, documents, max(total, 1))
    block = spark.sparkContext.broadcast((queries, [1] * len(queries), len(known.hashes)))
    first = _searched(buckets.orderBy(F.desc("top"), F.xxhash64("ids")).limit(SEED_BUCKETS), block, k)
    floors = [1] * len(queries)
    ranked = first.withColumn("n", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "id")))
    for number, score in ranked.where(F.col("n") == k).select("item", "score").collect():
        floors[number] = max(1, score)
    block = spark.sparkContext.broadcast((queries, floors, len(known.hashes)))
    path = staging_path(spark, "ranked")
    _searched(buckets, block, k).write.parquet(path)
    names = spark.createDataFrame(list(enumerate(items)), f"item int, name {kind}")
    return spark.read.parquet(path).join(F.broadcast(names), "item").select(F.col("name").alias("item"), "id", "score")
