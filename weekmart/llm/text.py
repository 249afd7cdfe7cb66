"""Numpy views of Arrow text columns, for operators that scan text inside Spark's Python tasks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import weekmart

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
PIECE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_shipped: set[str] = set()
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prepare(spark: SparkSession) -> None:
    """Make a session ready for Python tasks of this package.

    Arrow batches are limited by bytes unless the user has set a limit, so long texts cannot fill a task's memory, and
    the package itself is sent to the executors, once an application.
    """
    if spark.conf.get(BATCH_SETTING, "1") == "1":
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(weekmart.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="weekmart-")) / "weekmart.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def column_udf(result: str, opened: Callable[[], Callable[[pa.Array], pa.Array]]):
    """Arrow UDF of one column; ``opened`` runs once a task and returns the function of a batch.

    It is marked nondeterministic so that a filter on the result does not make Spark compute it twice.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        apply = opened()
        for batch in batches:
            yield apply(batch)

    return F.arrow_udf(run, result).asNondeterministic()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole consecutive texts of at most ``limit`` bytes; a longer text stands alone."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string, its code points, and the offsets counted in code points."""
    joined = data.tobytes().decode("utf-8")
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    if len(points) == len(data):
        return joined, points, offsets
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return joined, points, before[offsets]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values that stay within one text."""
    count = len(inside)
    opens, closes = inside.copy(), inside.copy()
    if count:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        borders = offsets[(offsets > 0) & (offsets < count)]
        opens[borders] = inside[borders]
        closes[borders - 1] = inside[borders - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given spans, one span after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + int(starts.max(initial=0)) < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((starts - (ends - lengths)).astype(kind), lengths)


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span: equal for equal spans wherever they stand."""
    count = len(symbols)
    if len(_powers[0]) <= count:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            power = np.full(max(count + 1, PIECE_BYTES + 1), base, np.uint64)
            power[0] = 1
            _powers[k] = np.multiply.accumulate(power)
    up, down = _powers
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:count], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    return hashes ^ (hashes >> np.uint64(32))


def distinct_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An index of each different value, and for every value its position in that list."""
    order = np.argsort(values)
    ordered = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(values), np.int64)
    inverse[order] = np.cumsum(fresh) - 1
    return order[fresh], inverse


def same_spans(one: np.ndarray, one_starts: np.ndarray, two: np.ndarray, two_starts: np.ndarray, lengths: np.ndarray) -> bool:
    """Whether each span of the first symbols equals its counterpart of the same length in the second."""
    tiled = len(lengths) and one_starts[0] == 0 and (one_starts[1:] == (one_starts + lengths)[:-1]).all()
    first = one[: one_starts[-1] + lengths[-1]] if tiled else one[spread(one_starts, lengths)]
    return bool((first == two[spread(two_starts, lengths)]).all())


def distinct_spans(
    symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """An index of one span of each different content, and for every span its position in that list.

    Hashes propose, contents decide: should two different spans share a hash, contents are compared one by one.
    """
    first, inverse = distinct_values(span_hashes(symbols, starts, ends) if hashes is None else hashes)
    like, lengths = first[inverse], ends - starts
    if bool((lengths == lengths[like]).all()) and same_spans(symbols, starts, symbols, starts[like], lengths):
        return first, inverse
    seen: dict[bytes, int] = {}
    index = []
    inverse = np.empty(len(starts), np.int64)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        content = symbols[a:b].tobytes()
        if content not in seen:
            seen[content] = len(index)
            index.append(i)
        inverse[i] = seen[content]
    return np.array(index, np.int64), inverse
