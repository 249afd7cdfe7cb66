"""Periodic run detection in the words of a text: string synchronising sets at dyadic scales, verified by content.

A run is a maximal stretch of words of smallest period q that is at least max(LEAST, 3 * q) words long. Periods up to SMALL
are found by comparing the words with themselves q places on. For every longer period there is one power of two t with
1.5 * t <= q < 3 * t. At that scale a position is chosen if, among the hashes of the t words beginning at it and at the t
positions after it, the smallest is the first or the last. Whether a position is chosen depends on the 2 * t words there
alone, so of a run of period q, in which every such context comes back q words on, at least one chosen position i has
i + q chosen as well, with an equal context (the first 2 * q words of a run cannot all lie in shorter periods). Chosen
positions of equal context at a distance in the scale's range propose that distance as a period; comparing the words
decides, and gives the ends of the run. Stretches of t words of a period up to t / 3 are left out of the choice, which
keeps the set small in repetitive text: they are exactly those inside runs that smaller scales have found before.

Hashes choose positions and propose; no result rests on them. Work is in proportion to the words times the number of
scales, memory to the words.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weekmart.llm.text import column_udf, distinct_spans, pieces, prepare, runs, spread, utf8

LEAST, TIMES = 24, 3
SMALL, FIRST_SCALE = 5, 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _ONE
    values ^= values >> np.uint64(29)
    return values


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of twice the width, from those of ``width`` symbols at every position."""
    return _mixed(hashes[:-width] * _TWO + (hashes[width:] ^ _ONE))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values, by prefixes and suffixes of blocks of that width."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, _NEVER)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    after = np.minimum.accumulate(blocks, axis=1).ravel()
    before = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:count], after[width - 1: width - 1 + count])


def chosen_positions(hashes: np.ndarray, width: int, skipped: np.ndarray | None = None) -> np.ndarray:
    """The synchronising set of ``width``: positions where the least hash of a window stands at its first or last place.

    ``skipped`` marks positions that no window chooses for.
    """
    if len(hashes) <= width:
        return np.zeros(0, np.int64)
    ids = np.minimum(hashes, _NEVER - np.uint64(1))
    if skipped is not None:
        ids[skipped[: len(ids)]] = _NEVER
    least = _least(ids, width + 1)
    return np.flatnonzero(((ids[:-width] == least) | (ids[width:] == least)) & (least != _NEVER))


def _extended(symbols: np.ndarray, at: int, period: int, step: int) -> tuple[int, int]:
    """The first and the end of the positions around ``at`` whose symbol comes back ``period`` places on."""
    end, size, count = at, step, len(symbols) - period
    while end < count:
        differs = symbols[end: min(end + size, count)] != symbols[end + period: min(end + size, count) + period]
        if differs.any():
            end += int(differs.argmax())
            break
        end, size = min(end + size, count), size * 2
    first, size = at, step
    while first > 0:
        low = max(0, first - size)
        differs = (symbols[low:first] != symbols[low + period: first + period])[::-1]
        if differs.any():
            first -= int(differs.argmax())
            break
        first, size = low, size * 2
    return first, end


def _stretches(symbols: np.ndarray, period: int, least: int) -> np.ndarray:
    """Maximal stretches, rows (first, end, period), of at least ``least`` symbols that repeat after ``period``."""
    if len(symbols) <= period:
        return np.zeros((0, 3), np.int64)
    borders = np.concatenate([[-1], np.flatnonzero(symbols[:-period] != symbols[period:]), [len(symbols) - period]])
    long = np.flatnonzero(np.diff(borders) - 1 >= least - period)
    return np.stack([borders[long] + 1, borders[long + 1] + period, np.full(len(long), period)], 1)


def _proposed(positions: np.ndarray, contexts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances (from ``low``, under ``high``) of two positions of equal context."""
    order = np.argsort(contexts, kind="stable")  # positions ascend, so they do inside a context too
    positions, contexts = positions[order], contexts[order]
    found, lag = [], 1
    while lag < len(positions):
        apart = positions[lag:] - positions[:-lag]
        near = (contexts[lag:] == contexts[:-lag]) & (apart < high)
        if not near.any():
            break
        wanted = near & (apart >= low)
        found.append((positions[:-lag][wanted], apart[wanted]))
        lag += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _scale(symbols: np.ndarray, width: int, half: np.ndarray, own: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, list]:
    """Stretches of periods from 1.5 up to 3 times ``width``, and the hashes of twice the width.

    ``half`` and ``own`` are the hashes of width / 2 and width symbols, ``known`` the runs of smaller periods.
    """
    double = _doubled(own, width)
    if width < LEAST:  # runs are longer; these periods are among the small ones
        known = np.concatenate([_stretches(symbols, period, width) for period in range(1, width // TIMES + 1)])
    known = known[(TIMES * known[:, 2] <= width) & (known[:, 1] - known[:, 0] >= width)]
    marks = np.zeros(len(symbols) + 1, np.int32)
    np.add.at(marks, known[:, 0], 1)
    np.add.at(marks, known[:, 1] - width + 1, -1)
    positions = chosen_positions(own, width, np.cumsum(marks[:-1]) > 0)
    at, apart = _proposed(positions, double[positions], -(-3 * width // 2), 3 * width)
    if not len(at):
        return double, []
    # a run repeats 2 * period positions in a row, of which the contexts cover 2 * width: one side goes on by half a width
    step = width // 2
    after, before = np.minimum(at + 2 * width, len(half) - 1 - apart), np.maximum(at - step, 0)
    goes_on = (half[after] == half[np.minimum(after + apart, len(half) - 1)]) | (half[before] == half[before + apart])
    at, apart = at[goes_on], apart[goes_on]
    order = np.lexsort((at, apart))
    at, apart = at[order], apart[order]
    found: list[tuple[int, int, int]] = []
    k = 0
    while k < len(at):  # one step for each stretch
        period = int(apart[k])
        first, end = _extended(symbols, int(at[k]), period, 4 * width)
        if end + period - first >= max(LEAST, TIMES * period):
            found.append((first, end + period, period))
        others = int(np.searchsorted(apart, period, "right"))
        k = max(k + 1, k + int(np.searchsorted(at[k:others], end)))
    return double, found


def find_runs(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All runs in texts of ``counts`` words given as numbers: the text of each, and rows (start, length, period).

    Rows are ordered by text, start and period. The texts are searched side by side with a symbol of its own after each,
    which no run can contain. Texts too short for the periods of a scale leave before it.
    """
    texts = np.arange(len(counts))
    out: list[tuple[int, int, int, int]] = []
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    base = int(words.max(initial=-1)) + 1

    def laid(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the chosen texts with their ends between them, and where each text begins."""
        sizes = counts[chosen]
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        symbols = np.empty(begins[-1], np.int64)
        symbols[spread(begins[:-1], sizes)] = words[spread(starts[chosen], sizes)]
        symbols[begins[1:] - 1] = base + np.arange(len(chosen))
        return symbols, begins[:-1]

    def keep(found: Iterable[Sequence[int]], chosen: np.ndarray, begins: np.ndarray) -> None:
        for first, end, period in found:
            k = int(np.searchsorted(begins, first, "right")) - 1
            out.append((int(chosen[k]), int(first - begins[k]), int(end - first), int(period)))

    texts = texts[counts >= LEAST]
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    symbols, begins = laid(texts)
    for period in range(1, SMALL + 1):
        keep(_stretches(symbols, period, LEAST), texts, begins)
    width, half, own = 1, symbols.astype(np.uint64), _mixed((symbols + 1).astype(np.uint64))
    while width < FIRST_SCALE:
        half, own, width = own, _doubled(own, width), 2 * width
    while True:
        longest = TIMES * -(-3 * width // 2)
        staying = counts[texts] >= longest
        if not staying.any():
            break
        if counts[texts[staying]].sum() * 2 < counts[texts].sum():
            texts = texts[staying]
            symbols, begins = laid(texts)
            size, half, own = 1, symbols.astype(np.uint64), _mixed((symbols + 1).astype(np.uint64))
            while size < width:
                half, own, size = own, _doubled(own, size), 2 * size
        at = {int(t): int(b) for t, b in zip(texts, begins)} if out else {}
        known = [(at[t] + s, at[t] + s + n, p) for t, s, n, p in out if t in at]
        double, found = _scale(symbols, width, half, own, np.array(known, np.int64).reshape(-1, 3))
        keep(found, texts, begins)
        half, own, width = own, double, 2 * width
    least: dict[tuple[int, int, int], int] = {}
    for text, start, length, period in out:  # a stretch found by a multiple of its period as well
        key = (text, start, length)
        least[key] = min(period, least.get(key, period))
    rows = np.array(sorted((t, s, p, n) for (t, s, n), p in least.items()), np.int64).reshape(-1, 4)
    return rows[:, 0], rows[:, [1, 3, 2]]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of the texts, and the number of words of each."""
    starts, ends = runs(~_SPACE[data], offsets)
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def _piece(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs a text, the runs, and the UTF-8 bytes and lengths of the texts without repeated words."""
    starts, ends, counts = _words(data, offsets)
    words = distinct_spans(data, starts, ends)[1] if len(starts) else np.zeros(0, np.int64)
    texts, found = find_runs(words, counts)
    begins = np.cumsum(counts) - counts
    marks = np.zeros(len(starts) + 1, np.int64)
    first = begins[texts] + found[:, 0]
    np.add.at(marks, first + found[:, 2], 1)
    np.add.at(marks, first + found[:, 1], -1)
    kept = np.cumsum(marks[:-1]) == 0
    sizes = (ends - starts)[kept] + 1
    closes = np.cumsum(sizes)
    left = np.append(data, np.uint8(0x20))[spread(starts[kept], sizes)]
    left[closes - 1] = 0x20
    per_text = np.bincount(np.repeat(np.arange(len(counts)), counts)[kept], minlength=len(counts))
    lengths = np.diff(np.concatenate([[0], closes])[np.concatenate([[0], np.cumsum(per_text)])])
    full = np.ones(len(left), bool)
    full[np.cumsum(lengths)[lengths > 0] - 1] = False  # the blank after a text's last word
    return np.bincount(texts, minlength=len(counts)), found, left[full], np.maximum(lengths - 1, 0)


def _found(column: pa.Array) -> pa.Array:
    data, offsets = utf8(column)
    parts = [_piece(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) for a, b in pieces(offsets)]
    if not parts:
        parts = [_piece(data, offsets)]
    numbers, found, left, lengths = (np.concatenate(x) for x in zip(*parts))
    rows = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(numbers)]), pa.int32()), rows)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    texts = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(left))).cast(pa.string())
    return pa.StructArray.from_arrays([listed, texts], ["runs", "collapsed"])


def with_runs(docs: DataFrame, text: str = "text", name: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``name``: ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what stands between blanks and the control signs 9 to 13, numbered from 0. ``collapsed`` holds the words that
    no run contains after its first period, joined by one blank. A null, empty or blank text has no runs and collapses to
    the empty text. Repeated rows get equal results; other columns stay, one called ``name`` is replaced. Nothing is
    shuffled; a very long text is searched alone, with memory in proportion to its words.
    """
    prepare(docs.sparkSession)
    return docs.withColumn(name, column_udf(f"struct<runs: array<{RUN}>, collapsed: string>", lambda: _found)(docs[text]))
