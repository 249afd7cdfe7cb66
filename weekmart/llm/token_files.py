"""Token ids in binary files of Simple-8b words, with escapes and block offsets.

A 64-bit word holds a 4-bit selector and 60 bits with as many equally wide ids as the selector says. An id too wide
for that is an escape: its word holds the place of the whole id in the block's escape list. Each block of BLOCK_IDS
ids starts at a recorded word and escape, so any block can be decoded alone, all words of one selector at a time.

File layout, little-endian: magic, then counts (documents, ids, blocks, words, escapes) as int64; document ids int64,
flags of null document ids uint8, ids a document int64; first word and first escape of each block int64, one more each
as the end; words uint64; escapes uint64; crc32 of all before, uint32.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmart.llm.bpe import Definition, PreTokenCoder, Vocabulary, byte_letters, kept_coder
from weekmart.llm.text import prepare, pieces, utf8

MAGIC = b"TOKS8B01"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 22
READ_BYTES = 4 << 20
#: Ids and bits an id in one word, by selector; selector 0 is an escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
FULL = np.uint64(60)
_SMALL = np.array([max(1, k.bit_length()) for k in range(1 << 16)], np.uint8)


def library_ids(model: tokenizers.models.Model, letters: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids that the library's merges give each pre-token, one after another, and the number of ids of each."""
    table, space = dict(enumerate(letters)), letters[32]
    spelt = [  # printable ASCII signs but the space stand for themselves
        w.replace(" ", space) if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(table) for w in words]
    each = [[t.id for t in tokens] for tokens in map(model.tokenize, spelt)]
    return np.array([i for e in each for i in e], np.int32), np.array([len(e) for e in each], np.int64)


def library_coder(vocabulary: Vocabulary, definition: str) -> PreTokenCoder:
    model, letters = tokenizers.Tokenizer.from_str(definition).model, byte_letters()
    return PreTokenCoder(vocabulary, lambda words: library_ids(model, letters, words))


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, 1 at least."""
    if ids.max() < len(_SMALL):
        return _SMALL[ids.astype(np.int64)]
    bits = np.ones(len(ids), np.uint8)
    for width in range(1, 64):
        over = ids >= np.uint64(1 << width)
        if not over.any():
            break
        bits += over
    return bits


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of one block: each word takes as many of the next ids as fit."""
    ids = ids.astype(np.uint64)
    count = len(ids)
    if not count:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    bits = _widths(ids)
    selector = np.zeros(count, np.int8)
    widest, span = bits.copy(), 1
    for s in range(len(COUNTS) - 1, 0, -1):
        while span < COUNTS[s]:  # widest[i]: of the next `span` ids; past the end nothing is needed
            widest[:max(0, count - span)] = np.maximum(widest[:max(0, count - span)], bits[span:])
            span += 1
        fits = widest <= WIDTHS[s]
        if not fits.any():
            break
        np.copyto(selector, np.int8(s), where=fits)
    step = COUNTS[selector].tolist()
    starts, at = [], 0
    while at < count:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << FULL
    padded = np.append(ids, np.zeros(60, np.uint64))
    escapes = ids[starts[chosen == 0]]
    words[chosen == 0] |= np.arange(len(escapes), dtype=np.uint64)
    for s in range(1, len(COUNTS)):
        of = np.flatnonzero(chosen == s)
        at, word = starts[of], words[of]
        for k in range(COUNTS[s]) if len(of) else ():
            word |= padded[at + k] << np.uint64(k * WIDTHS[s])
        words[of] = word
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` ids of a block."""
    selector = (words >> FULL).astype(np.int64)
    payload = words & np.uint64((1 << 60) - 1)
    starts = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    out = np.zeros(count + 60, np.uint64)
    out[starts[selector == 0]] = escapes[payload[selector == 0].astype(np.int64)]
    for s in range(1, len(COUNTS)):
        of = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(COUNTS[s]) if len(of) else ():
            at = starts[of] + k
            within = at < count
            out[at[within]] = (payload[of][within] >> np.uint64(k * WIDTHS[s])) & mask
    return out[:count]


def to_file(doc_ids: np.ndarray, absent: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The file's bytes. ``absent`` flags documents whose id is null."""
    words, escapes, word_at, escape_at = [], [], [0], [0]
    for first in range(0, len(ids), BLOCK_IDS):
        block, wide = pack(ids[first: first + BLOCK_IDS])
        words.append(block)
        escapes.append(wide)
        word_at.append(word_at[-1] + len(block))
        escape_at.append(escape_at[-1] + len(wide))
    head = np.array([len(doc_ids), len(ids), len(words), word_at[-1], escape_at[-1]], "<i8")
    body = b"".join([
        MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(), absent.astype(np.uint8).tobytes(), counts.astype("<i8").tobytes(),
        np.array(word_at, "<i8").tobytes(), np.array(escape_at, "<i8").tobytes(),
        *[w.astype("<u8").tobytes() for w in words], *[e.astype("<u8").tobytes() for e in escapes]])
    return body + np.array([zlib.crc32(body)], "<u4").tobytes()


class TokenFile:
    """A file's bytes, opened for decoding any range of ids."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC or zlib.crc32(content[:-4]) != int(np.frombuffer(content[-4:], "<u4")[0]):
            raise ValueError("not a whole token file")
        self.place = 8
        self.content = content
        docs, self.ids, blocks, words, escapes = self._take("<i8", 5).tolist()
        self.doc_ids, self.absent, self.counts = self._take("<i8", docs), self._take("u1", docs) > 0, self._take("<i8", docs)
        self.word_at, self.escape_at = self._take("<i8", blocks + 1), self._take("<i8", blocks + 1)
        self.words, self.escapes = self._take("<u8", words), self._take("<u8", escapes)

    def _take(self, kind: str, count: int) -> np.ndarray:
        values = np.frombuffer(self.content, kind, count, self.place)
        self.place += values.nbytes
        return values

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive); only the blocks that hold them are decoded."""
        blocks = range(first // BLOCK_IDS, -(-last // BLOCK_IDS)) if last > first else ()
        parts = [
            unpack(self.words[self.word_at[b]: self.word_at[b + 1]], self.escapes[self.escape_at[b]: self.escape_at[b + 1]],
                   min(BLOCK_IDS, self.ids - b * BLOCK_IDS)) for b in blocks]
        base = first // BLOCK_IDS * BLOCK_IDS
        return np.concatenate(parts)[first - base: last - base] if parts else np.zeros(0, np.uint64)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system's scheme, so that tasks find the one Spark itself uses."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").rstrip("/") + folder


def _at(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame, definition: Definition, folder: str, id: str = "doc_id", text: str = "text", end_id: int | None = None,
) -> DataFrame:
    """Encode whole texts and write their ids in ascending order of ``id``; returns the manifest.

    Texts are cut into pre-tokens here, and the tokenizers library's merges give each different one its ids.
    The texts are spread by ranges of ``id`` and, of equal ids, of their place in the input (nulls first), each task encodes its range and writes files
    of about FILE_IDS ids that it names itself. The manifest, a Parquet table that Spark commits in ``folder/manifest``, lists
    those of successful attempts only: a lost executor's files are left out. Null and empty texts have no ids but ``end_id``.
    Columns other than these two are not read. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(definition)
    folder = qualified(spark, folder)
    extra = [] if end_id is None else [end_id]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_coder(shared.value, "library", lambda vocabulary: library_coder(vocabulary, shared.value.model))
        system, root = _at(folder)
        system.create_dir(f"{root}/ids", recursive=True)
        part, held, size, number = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            doc_ids, absent, counts, ids = (np.concatenate(x) for x in zip(*held))
            name = f"ids/{part:06d}-{number:05d}-{uuid.uuid4().hex}.s8b"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(to_file(doc_ids, absent, counts, ids))
            row = {"part": [part], "number": [number], "name": [name], "n_docs": [len(doc_ids)], "n_ids": [len(ids)]}
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            absent = np.asarray(batch.column(0).is_null())
            for a, b in pieces(offsets):
                ids, counts = coder.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if extra:
                    whole = np.full(len(ids) + len(counts), end_id, np.int32)
                    taken = np.ones(len(whole), bool)
                    taken[np.cumsum(counts + 1) - 1] = False
                    whole[taken] = ids
                    ids, counts = whole, counts + 1
                held.append((keys[a:b], absent[a:b], counts, ids))
                size += len(ids)
                if size >= FILE_IDS:
                    yield flush()
        if held:
            yield flush()

    placed = docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text"), F.monotonically_increasing_id().alias("place"))
    ordered = placed.repartitionByRange("id", "place").sortWithinPartitions("id", "place")
    ordered.select("id", "text").mapInArrow(write, "part long, number long, name string, n_docs long, n_ids long").write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, id: str = "doc_id") -> DataFrame:
    """One row a document: its id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (uint32, little-endian)."""
    folder = qualified(spark, folder)
    manifest = spark.read.parquet(f"{folder}/manifest")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(earlier.partitionBy("part").orderBy("number")), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # one row for each task that wrote
    parts = parts.select("part", F.coalesce(F.sum("ids").over(earlier.orderBy("part")), F.lit(0)).alias("parts_before"))
    files = manifest.join(parts, "part").select("name", (F.col("parts_before") + within).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _at(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{root}/{name}") as stream:
                    file = TokenFile(stream.read())
                bounds = np.append(0, np.cumsum(file.counts))
                for a, b in pieces(bounds * 4, READ_BYTES):
                    ids = file.read(int(bounds[a]), int(bounds[b])).astype("<u4")
                    ends = pa.array((bounds[a: b + 1] - bounds[a]) * 4, pa.int64()).cast(pa.int32())
                    content = pa.Array.from_buffers(pa.binary(), b - a, [None, ends.buffers()[1], pa.py_buffer(ids.tobytes())])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(file.doc_ids[a:b], mask=file.absent[a:b]), pa.array(start + bounds[a:b]),
                        pa.array(file.counts[a:b]), content], ["id", "start", "n_tokens", "ids"])

    tasks = max(1, manifest.count())
    return files.repartition(tasks, "name").mapInArrow(read, "id long, start long, n_tokens long, ids binary").withColumnRenamed("id", id)
