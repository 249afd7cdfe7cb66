"""Benchmark decontamination: word windows of benchmark items, broadcast as a hash set, found in whole documents.

Words are runs of digits, lower-cased ASCII letters and characters beyond ASCII. Each window of ``width`` consecutive
words of an item (the whole item if it has fewer) goes into a sorted array of 64-bit hashes. Documents are scanned with
the hash of every window of their words; a hit is verified by its words. Benchmark text is broadcast in blocks of at
most BLOCK_WORDS windows; with more blocks, the scans of one document follow each other in one stage, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.llm.text import prepare, pieces, runs, span_hashes, utf8

WIDTH = 13
MIN_SHARE = 20
BLOCK_WORDS = 500_000
PIECE_WORDS = 10_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STATE = "struct<words: bigint, hit: bigint, runs: array<bigint>, items: array<string>>"
EMPTY = f"cast(named_struct('words', 0L, 'hit', 0L, 'runs', array(), 'items', array()) as {STATE})"
FOUND = "_decontaminate_found"
_STEP = np.uint64(0x9DDFEA08EB382D69)

#: A word's bytes as they count: digits and ASCII letters in lower case, bytes of other characters; 0 is no word.
FOLDED = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    FOLDED[_b] = _b
for _b in range(0x41, 0x5B):
    FOLDED[_b] = _b + 32


class WindowSet(NamedTuple):
    """Windows of one block of items: by window length, sorted hashes with each window's place in the text and its item."""

    text: bytes
    item_ids: list[str | None]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def window_hashes(words: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all windows of the given lengths over a sequence of word hashes."""
    found, count = {}, len(words)
    sums = np.zeros(count, np.uint64)
    for k in range(min(max(lengths, default=0), count)):
        sums = sums[: count - k] * _STEP + words[k:]
        if k + 1 in lengths:
            mixed = (sums ^ (sums >> np.uint64(31))) * _STEP
            found[k + 1] = mixed ^ (mixed >> np.uint64(33))
    return found


def build_windows(items: list[tuple[str | None, str]], width: int = WIDTH) -> WindowSet:
    """The window set of (item id, words joined by single spaces)."""
    items = sorted(set(items), key=lambda x: (x[0] is not None, x))
    texts = [t.encode() for _, t in items]
    text = b" ".join(texts)
    data = np.frombuffer(text, np.uint8)
    bounds = np.append(0, np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))
    starts, ends = runs(data != 32, np.array([0, len(data)]))
    owner = np.searchsorted(bounds, starts, "right") - 1
    lengths = np.minimum(np.bincount(owner, minlength=len(items)), width)
    by_length = {}
    for length, hashes in window_hashes(span_hashes(data, starts, ends), sorted(set(lengths.tolist()) - {0})).items():
        first = np.arange(len(hashes))
        first = first[(owner[first] == owner[first + length - 1]) & (lengths[owner[first]] == length)]
        first = first[np.argsort(hashes[first], kind="stable")]
        by_length[length] = (
            hashes[first], starts[first].astype(np.int32), ends[first + length - 1].astype(np.int32), owner[first].astype(np.int32))
    return WindowSet(text, [i for i, _ in items], by_length)


def item_blocks(benchmark: DataFrame, id: str, text: str, width: int) -> Iterator[list[tuple[str | None, str]]]:
    """Items with words as (id, words joined by spaces), in blocks of bounded size; long items come in overlapping pieces."""
    words = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(WORD), F.lit(0))
    listed = benchmark.where(F.col(text).isNotNull()).select(F.col(id).cast("string").alias("item"), words.alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    cut = (
        listed.where(F.size("words") > 0).withColumn("first", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS))))
        .select("item", F.slice("words", F.col("first") + 1, PIECE_WORDS + width - 1).alias("words"))
        .select("item", F.size("words").alias("n"), F.array_join("words", " ").alias("text")))
    block, held = [], 0
    for row in cut.toLocalIterator():
        if block and held + row["n"] > BLOCK_WORDS:
            yield block
            block, held = [], 0
        block.append((row["item"], row["text"]))
        held += row["n"]
    yield block


class Scanner:
    """Finds a block's windows in texts."""

    def __init__(self, windows: WindowSet):
        self.windows = windows
        self.lengths = sorted(windows.by_length)
        self.marked = {}
        for length, (hashes, *_) in windows.by_length.items():
            bits = max(16, min(24, len(hashes).bit_length() + 6))
            marked = np.zeros(1 << bits, bool)
            marked[hashes >> np.uint64(64 - bits)] = True
            self.marked[length] = (np.uint64(64 - bits), marked)

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, set[str]]]]:
        """Number of words of each text, and the verified hits as (text, first word, length, items)."""
        folded = FOLDED[data]
        starts, ends = runs(folded != 0, offsets)
        border = np.searchsorted(starts, offsets)
        hits = []
        for length, hashes in window_hashes(span_hashes(folded, starts, ends), self.lengths).items():
            shift, marked = self.marked[length]
            known, from_byte, to_byte, owner = self.windows.by_length[length]
            at = np.flatnonzero(marked[hashes >> shift])
            text_of = np.searchsorted(border, at, "right") - 1
            within = at + length <= border[text_of + 1]
            at, text_of = at[within], text_of[within]
            low, high = np.searchsorted(known, hashes[at], "left"), np.searchsorted(known, hashes[at], "right")
            for k in np.flatnonzero(low < high).tolist():
                first = int(at[k])
                found = b" ".join([
                    folded[a:b].tobytes() for a, b in zip(starts[first: first + length].tolist(), ends[first: first + length].tolist())])
                same = [e for e in range(low[k], high[k]) if self.windows.text[from_byte[e]: to_byte[e]] == found]
                if same:
                    items = {self.windows.item_ids[owner[e]] for e in same} - {None}
                    hits.append((int(text_of[k]), first - int(border[text_of[k]]), length, items))
        return np.diff(border), hits


def merge_runs(intervals: list[tuple[int, int]]) -> list[int]:
    """First word and end of each run of hit words, flat and in order."""
    flat: list[int] = []
    for a, b in sorted(intervals):
        if flat and a <= flat[-1]:
            flat[-1] = max(flat[-1], b)
        else:
            flat += [a, b]
    return flat


def _scan_udf(shared):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scanner = Scanner(shared.value)
        for column, state in batches:
            data, offsets = utf8(column)
            counts = np.zeros(len(column), np.int64)
            found: dict[int, tuple[list, set]] = {}
            if any(state.field("hit").to_numpy(zero_copy_only=False)):
                for k, before in enumerate(state.to_pylist()):
                    if before["hit"]:
                        found[k] = (list(zip(before["runs"][::2], before["runs"][1::2])), set(before["items"]))
            for a, b in pieces(offsets):
                counts[a:b], hits = scanner.scan(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                for text, first, length, items in hits:
                    spans, owners = found.setdefault(a + text, ([], set()))
                    spans.append((first, first + length))
                    owners.update(items)
            flat = [merge_runs(found[k][0]) if k in found else [] for k in range(len(column))]
            yield pa.StructArray.from_arrays([
                pa.array(counts), pa.array([sum(r[1::2]) - sum(r[::2]) for r in flat], pa.int64()), pa.array(flat, pa.list_(pa.int64())),
                pa.array([sorted(found[k][1]) if k in found else [] for k in range(len(column))], pa.list_(pa.string())),
            ], ["words", "hit", "runs", "items"])

    return F.arrow_udf(run, STATE).asNondeterministic()


def _cut_udf():
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, hit_runs in batches:
            texts = []
            for text, flat in zip(column.to_pylist(), hit_runs.to_pylist()):
                if text and flat:
                    data = np.frombuffer(text.encode(), np.uint8)
                    starts, ends = runs(FOLDED[data] != 0, np.array([0, len(data)]))
                    kept = np.ones(len(data), bool)
                    for a, b in zip(flat[::2], flat[1::2]):
                        kept[starts[a]: ends[b - 1]] = False
                    text = data[kept].tobytes().decode()
                texts.append(text)
            yield pa.array(texts, pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()


def annotate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (ids sorted as strings), hit_runs and contaminated.

    A word is hit inside any occurrence of a window; ``hit_runs`` holds first word and end of each run of hit words. A
    document is contaminated if it has a hit and at least one word in MIN_SHARE is hit. Null or empty text has no words
    and is not contaminated. Rows are judged one by one, so repeated rows get the same result. Items without words or
    with a null text have no windows; a null item id marks words but is not listed. Items that share an id count once.
    Columns of ``docs`` named like a result are replaced. An empty benchmark hits nothing.
    """
    context = docs.sparkSession.sparkContext
    prepare(docs.sparkSession)
    found = docs.withColumn(FOUND, F.expr(EMPTY))
    for block in item_blocks(benchmark, item_id, item_text, width):
        shared = context.broadcast(build_windows(block, width))
        found = found.withColumn(FOUND, _scan_udf(shared)(F.col(text), F.col(FOUND)))
    hit, words = F.col(f"{FOUND}.hit"), F.col(f"{FOUND}.words")
    return found.withColumns({
        "n_words": words, "n_hit": hit, "n_items": F.size(f"{FOUND}.items").cast("long"), "items": F.col(f"{FOUND}.items"),
        "hit_runs": F.col(f"{FOUND}.runs"), "contaminated": (hit > 0) & (MIN_SHARE * hit >= words)}).drop(FOUND)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, unchanged and with their own columns only."""
    judged = docs.select(F.struct("*").alias("row"), docs[text].alias("text"))
    return annotate(judged, benchmark, **options).where(~F.col("contaminated")).select("row.*")


def cut_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, each without its runs of hit words and the signs between those; other columns are unchanged."""
    judged = annotate(docs.select(F.struct("*").alias("row"), docs[text].alias("text")), benchmark, **options)
    cut = _cut_udf()(F.col("text"), F.col("hit_runs"))
    return judged.select("row", cut.alias("cut")).select(F.col("row").withField(text, F.col("cut")).alias("row")).select("row.*")
