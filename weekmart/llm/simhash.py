"""SimHash near-duplicates: fingerprints of word shingles, linked through deletion-variant signatures.

The 64 bits are cut into few segments, so that of two fingerprints within ``max_bits`` differing bits one segment
differs by one bit at most (for an even limit, one further segment may be asked to be equal). Each fingerprint is
indexed under every variant of a segment with one bit taken out; fingerprints that share a variant meet in a bucket and
are verified by their differing bits. Buckets hold different fingerprints only. A bucket that outgrows WIDE times BUCKET is
divided by the same scheme applied to its remaining bits, if that saves copies. Any other over BUCKET is cut into chunks,
and each pair of chunks becomes a bucket of its own, so no task gathers an unbounded one. A bucket emits a spanning
forest of its links, not all pairs; components are then found over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.llm.components import connected_components
from weekmart.llm.skew import join_by_size
from weekmart.llm.text import prepare, column_udf, utf8
from weekmart.session import staged, staging_path

SHINGLE, MAX_BITS, SEED = 4, 4, 42
BUCKET = 1024
WIDE = 64
SMALL = 8
HOT_KEYS = 50_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the words between ASCII white space, A-Z in lower case; without words zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps[: len(words) - shingle] + 1).tolist()]
        ends = [*gaps[shingle - 1:].tolist(), len(joined)]
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends)])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
    count, ones = len(bits), np.zeros(64, np.int64)
    for k in range(0, count, 128):  # sums of at most 128 bits fit a byte
        ones += np.add.reduce(bits[k: k + 128], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with its texts' fingerprints as (signed) long; null counts as empty, a column of that name is replaced."""
    prepare(docs.sparkSession)

    def opened():
        def apply(column: pa.Array) -> pa.Array:
            data, offsets = utf8(column)
            content, at = memoryview(data), offsets.tolist()
            prints = [fingerprint(bytes(content[a:b]), shingle) for a, b in zip(at[:-1], at[1:])]
            return pa.array(np.array(prints, np.uint64).view(np.int64))
        return apply

    return docs.withColumn(name, column_udf("bigint", opened)(docs[text]))


def segments(max_bits: int, bits: int = 64) -> list[tuple[int, int, bool]]:
    """(lowest bit, width, whether one bit may differ) of each segment for links of up to ``max_bits`` differing bits.

    m segments that may differ by one bit and e that must be equal find every link if 2 m + e > max_bits.
    """
    loose, exact = (max_bits + 1) // 2, (max_bits + 1) % 2
    narrow = max(1, bits // (loose + exact) - 3) if loose else bits
    widths, left = [], bits - narrow * exact
    for k in range(loose):
        widths.append((left // (loose - k), True))
        left -= widths[-1][0]
    widths += [(narrow, False)] * exact
    placed, low = [], 0
    for width, wild in widths:
        placed.append((low, width, wild))
        low += width
    return placed


def variants(max_bits: int, word: Column | str = "fp", bits: int = 64) -> Column:
    """Array of the index keys of the lowest ``bits`` of a word: number of the variant, then the segment without one bit."""
    keys, number, word = [], 0, F.col(word) if isinstance(word, str) else word
    for low, width, wild in segments(max_bits, bits):
        part = F.shiftrightunsigned(word, low).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else word
        for bit in range(width) if wild else [None]:
            mask = ((1 << width) - 1) & ~(1 << bit) if bit is not None else 0
            left = part if bit is None else part.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
            keys.append(F.xxhash64(F.lit(number), left) if width > 32 else F.lit(number << 32).bitwiseOR(left))
            number += 1
    return F.array(*keys)


def inner_variants(max_bits: int) -> Column:
    """Keys of the bits that a bucket leaves open, by ``number``, that of its variant; null where it leaves none."""
    keys, number = F.lit(None).cast("array<bigint>"), 0
    for low, width, wild in segments(max_bits):
        last = number + (width if wild else 1)
        if width < 64:
            above = F.shiftrightunsigned("fp", low + width) if low + width < 64 else F.lit(0).cast("long")
            rest = F.shiftleft(above, low).bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << low) - 1)))
            keys = F.when(F.col("number").between(number, last - 1), variants(max_bits, rest, 64 - width)).otherwise(keys)
        number = last
    return keys


def copies(count: Column) -> Column:
    """Rows that the pairs of chunks of a bucket make."""
    return count * F.greatest(F.ceil(count / F.lit(BUCKET)) - 1, F.lit(1))


def divided(keys: DataFrame, wide: DataFrame, max_bits: int) -> DataFrame:
    """Rows (fp, number, key) in which the buckets listed in ``wide`` give way to inner ones where that makes fewer copies."""
    inside = F.explode(F.when(F.col("inner").isNotNull(), F.col("inner")).otherwise(F.array(F.lit(0).cast("long"))))
    split = (
        keys.join(wide, "key").withColumn("inner", inner_variants(max_bits))
        .select("fp", "number", "key", "count", inside.alias("part")).withColumn("part", F.xxhash64("key", "part")))
    cost = split.groupBy("key", "count", "part").agg(F.count("*").alias("n")).groupBy("key", "count").agg(F.sum(copies(F.col("n"))).alias("cost"))
    chosen = staged(cost.where(F.col("cost") < copies(F.col("count"))).select("key"), "divided-buckets")
    return keys.join(chosen, "key", "left_anti").select("fp", "number", "key").union(
        split.join(chosen, "key", "left_semi").select("fp", "number", F.col("part").alias("key")))


def bucket_links(buckets: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each run of equal ``buckets``, what links of up to ``max_bits`` bits connect."""
    starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(buckets)))
    left, right = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
        at = np.flatnonzero((buckets[:-step] == buckets[step:]) & small[step:])
        at = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= max_bits]
        left.append(prints[at])
        right.append(prints[at + step])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        rest = np.unique(prints[start: start + size])
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                near = np.bitwise_count(rest ^ (here := queue.pop())) <= max_bits
                if near.any():
                    found, rest = rest[near], rest[~near]
                    left.append(np.full(len(found), here, np.uint64))
                    right.append(found)
                    queue.extend(found)
    return (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between the different fingerprints in the column fp: enough to connect all that are near."""
    prepare(prints.sparkSession)
    keys = prints.select("fp", F.posexplode(variants(max_bits)).alias("number", "key"))

    def over(limit: int) -> tuple[DataFrame, int, int]:
        hot = staged(keys.groupBy("key").count().where(F.col("count") > limit), "hot-buckets")
        return hot, *hot.agg(F.count("*"), F.coalesce(F.max("count"), F.lit(0))).first()

    hot, number, largest = over(BUCKET)
    if largest > WIDE * BUCKET:
        keys = divided(keys, hot.where(F.col("count") > WIDE * BUCKET), max_bits)
        hot, number, largest = over(BUCKET)
    if number:
        hot = F.broadcast(hot) if number <= HOT_KEYS else hot
        chunks = F.ceil(F.col("count") / F.lit(BUCKET)).cast("int")
        own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
        pairs = F.expr("transform(filter(sequence(0, chunks - 1), i -> i <> own), i -> xxhash64(key, least(i, own), greatest(i, own)))")
        keys = (
            keys.join(hot, "key", "left").withColumn("chunks", chunks).withColumn("own", own)
            .select("fp", F.explode(F.when(F.col("chunks").isNull(), F.array("key")).otherwise(pairs)).alias("key")))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        for batch in batches:
            buckets = np.concatenate([held[0], batch.column(0).to_numpy()])
            values = np.concatenate([held[1], batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(buckets, buckets[-1])) if len(buckets) else 0
            held = (buckets[last:], values[last:])
            yield packed(*bucket_links(buckets[:last], values[:last], max_bits))
        yield packed(*bucket_links(*held, max_bits))

    def packed(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return keys.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(link, "a long, b long")


def grouped(docs: DataFrame, id: str, text: str, shingle: int, max_bits: int) -> DataFrame:
    """Rows (id, fp, root, component_id): root is the smallest fingerprint reachable, component_id the smallest id."""
    rows = staged(
        with_fingerprint(docs.select(docs[id].alias("id"), docs[text].alias("text")), "text", "fp", shingle).select("id", "fp"), "fingerprints")
    prints = staged(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("rows")), "distinct-fingerprints")
    members = connected_components(near_links(prints.select("fp"), max_bits))
    placed = staged(prints.join(members, prints.fp == members.node, "left").select("fp", "first", "rows", "root"), "linked-fingerprints")
    linked = placed.where("root is not null")
    groups = staged(linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("prints")), "components")
    alone = placed.where("root is null").select("fp", "rows", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    found = join_by_size(linked, groups, "root", "prints").select("fp", "rows", "root", "component_id").union(alone)
    return join_by_size(rows, staged(found, "classes"), "fp", "rows").select("id", "fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row a row of ``docs``: its id, ``fp`` (fingerprint as long) and ``component_id``, the smallest id reachable.

    Texts without words (null ones too) share the fingerprint zero and are linked like any others. Rows that repeat an
    id are linked by their own texts, not by the id. A null id is never the smallest while its component has another;
    a component of null ids has a null ``component_id``. Other columns are not read; an empty table gives no rows.
    """
    return grouped(docs, id, text, shingle, max_bits).select(F.col("id").alias(id), "fp", "component_id")


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one of smallest id; columns stay as they are.

    Where several rows of a group repeat that smallest id, one of them stays. A group of null ids keeps one row.
    """
    spark = docs.sparkSession
    path = staging_path(spark, "groups")
    grouped(docs, id, text, shingle, max_bits).write.parquet(path)
    found = spark.read.parquet(path)
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    body = docs.select(F.struct("*").alias("row"), docs[id].alias("id"), docs[text].alias("text"))
    repeated = found.groupBy("id").count().where("count > 1 or id is null").select(F.col("id").alias("again"))
    if repeated.isEmpty():
        return body.join(kept.select("id"), "id", "left_semi").select("row.*")
    is_repeated = F.col("id").eqNullSafe(F.col("again"))
    once = body.join(repeated, is_repeated, "left_anti").join(kept.select("id"), "id", "left_semi")
    again = with_fingerprint(body.join(repeated, is_repeated, "left_semi"), "text", "fp", shingle)
    roots = kept.select(F.col("id").alias("kept_id"), F.col("fp").alias("kept_fp"), "root").distinct()
    one = again.join(roots, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp"))).dropDuplicates(["root"])
    return once.select("row.*").union(one.select("row.*"))
