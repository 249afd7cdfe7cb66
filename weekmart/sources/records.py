"""Records of delimited files by a boundary scan: quoted fields may hold line breaks, files may be larger than a split.

Files are read as lines, each with its file, the block it was read in and its place there. A line leads from outside or inside
a quoted field to outside or inside one, as its quotes open, double and close fields; a quote inside an unquoted field is a sign
like others. Such steps can be composed without knowing how they began: one that forgets (both beginnings end alike), one that
keeps, one that turns. So each block is composed for itself, the blocks of a file are composed in their order, and every line
then knows where it begins. A record is a line that begins outside and the lines up to the next such.

A task reads the lines of a block one after another, so it composes them and joins those of a record as they come: lines are
neither shuffled nor sorted, and of each block only the record that began before it and the one that ends after it are.

Only files with a line that opens a field and does not close it are scanned; the lines of all others are records as they are.
A file is UTF-8 if all its lines are, else Windows-1252; one pass over the lines tells both, and the header of every file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekmart.session import staged

FILE = "_file"
# the positions Windows-1252 fills with characters and Latin-1 with control codes
WINDOWS_BYTES = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
LATIN_CONTROLS = "".join(map(chr, WINDOWS_BYTES))
WINDOWS_CHARACTERS = bytes(WINDOWS_BYTES).decode("cp1252")
WINDOWS = ("cp1252", "windows-1252")

INSIDE = '(?:[^"]|"")*+'
FIELDS = f'(?:(?:[^",][^,]*+|"{INSIDE}"[^,]*+)?+,)*+'
OPENS = rf'^{FIELDS}"{INSIDE}\z'  # a line that begins outside a quoted field and ends inside one
STAYS = rf"^{INSIDE}\z"  # a line that begins and stays inside
OPENS_AGAIN = rf'^{INSIDE}"[^,]*+,{FIELDS}"{INSIDE}\z'
BLOCK = (FILE, "_block")


def plain_path(path: Column) -> Column:
    """Path in one spelling, whether listed or taken from a row's metadata."""
    return F.replace(F.regexp_replace(path, r"^file:/+", "/"), F.lit("%20"), F.lit(" "))


def windows_text(value: Column) -> Column:
    """Text of bytes in Windows-1252; Spark knows Latin-1, and the few characters that differ are translated."""
    return F.translate(F.decode(value.cast("binary"), "ISO-8859-1"), LATIN_CONTROLS, WINDOWS_CHARACTERS)


def numbered_lines(spark: SparkSession, path: str | Sequence[str], name_glob: str | None = None) -> DataFrame:
    """FILE (as Spark spells it), _block (where the split begins), _line (ascending in a block), value: all lines below a path, bytes as they are."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), "value")


def _composed(turns: str, forgets: str, ends: str, window) -> tuple[Column, Column]:
    """Whether any step up to here forgets, and the state after them: of a beginning outside if none does.

    ``turns`` is 1 for a step that turns the state, ``forgets`` tells steps of a fixed end, ``ends`` that end (0 or 1).
    The state is the last fixed end, turned as often as steps after it turn.
    """
    total = F.sum(turns).over(window)
    last = F.last(F.when(F.col(forgets), F.col(ends) + F.col(f"{turns}_so_far")), True).over(window)
    return last.isNotNull(), F.pmod(F.coalesce(last, F.lit(0)) + total, F.lit(2))


def _block_steps():
    """For ``mapInArrow``: the step of each block from those of its lines, as the states it ends in.

    Takes ``_part`` (one number a block), and ``_outside`` and ``_inside``, the states in which a line ends that begins there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ends = None, (0, 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_part", "_outside", "_inside"))
            bounds = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            done = []
            for i, j in zip(bounds[:-1], bounds[1:]):
                if part is not None and parts[i] != part:
                    done.append((part, *ends))
                    ends = (0, 1)
                part, fixed = int(parts[i]), np.flatnonzero(a[i:j] == b[i:j])
                if len(fixed):
                    last = i + int(fixed[-1])
                    end = (int(a[last]) + int((a[last + 1: j] > b[last + 1: j]).sum())) % 2
                    ends = (end, end)
                else:
                    turns = int((a[i:j] > b[i:j]).sum())
                    ends = tuple((x + turns) % 2 for x in ends)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.int64(), pa.int32(), pa.int32()))], ["_part", "_outside", "_inside"])
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, *ends), (pa.int64(), pa.int32(), pa.int32()))], ["_part", "_outside", "_inside"])
    return run


WHOLE, HEAD, REST = 0, 1, 2


def _joined_lines():
    """For ``mapInArrow``: records of the lines of each block, one after another.

    Takes ``_part``, ``_line``, ``_outside``, ``_inside``, ``value`` and ``_begins``, the state in which the block begins. A record
    within the block is WHOLE; the lines of one that began in an earlier block are REST, those of one that does not end here HEAD.
    """
    whole, head, rest = WHOLE, HEAD, REST

    def glued(values: pa.Array, offsets) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), "\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state, kind, first, held = None, 0, None, 0, []  # held: the lines so far of a record that has not ended
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, lines, a, b, begins = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_part", "_line", "_outside", "_inside", "_begins"))
            values = batch.column("value")
            out = []

            def put(part, places, kind, texts):
                out.append((np.full(len(places), part, np.int64), places, np.full(len(places), kind, np.int32), texts))

            def put_held(kind):
                every = pa.concat_arrays(held)
                put(part, np.array([first], np.int64), kind, glued(every, [0, len(every)]))
                held.clear()

            bounds = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for i, j in zip(bounds[:-1], bounds[1:]):
                if parts[i] != part:
                    if held:
                        put_held(head if kind == whole else rest)
                    part, state = int(parts[i]), int(begins[i])
                    kind, first = (rest if state else whole), int(lines[i])
                turns = np.cumsum(a[i:j] > b[i:j])
                order = np.arange(j - i)
                last = np.maximum.accumulate(np.where(a[i:j] == b[i:j], order, -1))
                at = np.maximum(last, 0)
                after = np.where(last >= 0, a[i:j][at] + turns - turns[at], state + turns) % 2
                before = np.append(state, after[:-1])
                starts = np.flatnonzero(before == 0)
                if state:
                    upto = int(starts[0]) if len(starts) else j - i
                    held.append(values.slice(i, upto))
                    if after[upto - 1] == 0:
                        put_held(kind)
                state = int(after[-1])
                if len(starts):
                    ended = starts if state == 0 else starts[:-1]
                    if len(ended):
                        offsets = np.append(starts, j - i)[: len(ended) + 1]
                        put(part, lines[i:j][ended], whole, glued(values.slice(i, j - i), offsets))
                    if state:
                        kind, first = whole, int(lines[i + starts[-1]])
                        held.append(values.slice(i + int(starts[-1]), j - i - int(starts[-1])))
            if out:
                yield batch_of(out)
        if held:
            every = pa.concat_arrays(held)
            yield batch_of([(np.array([part], np.int64), np.array([first], np.int64), np.array([head if kind == whole else rest], np.int32), glued(every, [0, len(every)]))])

    def batch_of(out) -> pa.RecordBatch:
        numbers = [pa.array(np.concatenate([o[k] for o in out])) for k in range(3)]
        return pa.RecordBatch.from_arrays([*numbers, pa.concat_arrays([o[3] for o in out])], ["_part", "_line", "_kind", "value"])
    return run


def _scanned(lines: DataFrame, torn: DataFrame) -> DataFrame:
    """_part, _line, value of the records of files with quoted line breaks; the place is that of the first line.

    ``torn`` has the blocks of these files (BLOCK, _part, _plain, _latin). It is broadcast so that lines stay in the order in which
    they are read: it is smaller than the list of the same blocks from which Spark's driver plans their reading.
    """
    def with_steps(blocks: DataFrame) -> DataFrame:
        every = lines.join(F.broadcast(blocks.drop("_plain")), list(BLOCK)).withColumn("value", _text("value"))
        quoted = F.contains("value", F.lit('"'))
        outside = quoted & F.col("value").rlike(OPENS)
        inside = ~quoted | F.col("value").rlike(STAYS) | F.col("value").rlike(OPENS_AGAIN)
        return every.withColumns({"_outside": outside.cast("int"), "_inside": inside.cast("int")})

    steps = with_steps(torn).select("_part", "_outside", "_inside").mapInArrow(_block_steps(), "_part long, _outside int, _inside int")
    blocks = staged(steps, "torn-steps").join(torn, "_part").select(
        "_part", *BLOCK, "_plain", "_latin", (F.col("_outside") == F.col("_inside")).alias("_forgets"), F.col("_outside").alias("_end"))
    blocks = blocks.withColumn("_turn", F.when(F.col("_forgets"), 0).otherwise(F.col("_end")))
    so_far = Window.partitionBy(FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("_turn_so_far", F.sum("_turn").over(so_far))
    blocks = blocks.withColumn("_after", _composed("_turn", "_forgets", "_end", so_far)[1])
    every = Window.partitionBy(FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    open_end = F.raise_error(F.concat(F.lit("a quoted field is not closed in "), F.col("_plain"))).cast("int")
    begins = F.coalesce(F.lag("_after").over(Window.partitionBy(FILE).orderBy("_block")), F.lit(0))
    begins = F.when(F.last("_after").over(every) == 1, open_end).otherwise(begins).cast("int")
    blocks = staged(blocks.select("_part", *BLOCK, "_plain", "_latin", begins.alias("_begins")), "torn-blocks")

    read = with_steps(blocks).select("_part", "_line", "_begins", "_outside", "_inside", "value")
    read = staged(read.mapInArrow(_joined_lines(), "_part long, _line long, _kind int, value string"), "torn-records")
    # a block may begin with the rest of a record of an earlier one
    pieces = read.filter(F.col("_kind") != WHOLE).join(torn.select("_part", *BLOCK), "_part")
    in_file = Window.partitionBy(FILE).orderBy("_block", F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("_of", F.last(F.when(F.col("_kind") == HEAD, F.struct("_part", "_line")), True).over(in_file))
    ordered = F.array_sort(F.collect_list(F.struct("_block", (-F.col("_kind")).alias("_order"), "value")))
    glued = pieces.groupBy(FILE, "_of").agg(ordered.alias("_lines")).select(
        "_of._part", "_of._line", F.array_join(F.transform("_lines", lambda p: p["value"]), "\n").alias("value"))
    return read.filter(F.col("_kind") == WHOLE).select("_part", "_line", "value").unionByName(staged(glued, "torn-ends"))


def _text(value: str) -> Column:
    """A line as text, by its file's encoding."""
    return F.when(F.col("_latin"), windows_text(F.col(value))).otherwise(F.col(value))


def records_with_header(
    spark: SparkSession, path: str | Sequence[str], name_glob: str | None = None, encoding: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records below a path (FILE, value, header) without the header's own, and the header of each file (FILE, header).

    ``encoding`` is ``UTF-8``, ``cp1252`` or, if none is given, found for each file. Line breaks in quoted fields become
    line feeds. Blank lines outside them are no records. A quoted field that is never closed is an error that names the file.
    No file is listed or opened by the driver, and lines meet what is known of their file block by block, so a file of any
    size is dealt over many tasks.
    """
    lines = numbered_lines(spark, path, name_glob)
    opens = F.contains("value", F.lit('"')) & F.col("value").rlike(OPENS)
    place = F.when(F.col("value") != "", F.col("_line"))
    # numbers and flags only, so that the lines are aggregated by hash; a text among them would have all lines sorted
    blocks = staged(lines.groupBy(*BLOCK).agg(
        F.min(place).alias("_first"), F.bool_or(opens).alias("_torn"), F.bool_and(F.is_valid_utf8("value")).alias("_valid")), "blocks")
    latin = F.lit(encoding.lower() in WINDOWS) if encoding else ~F.bool_and("_valid")
    begin = F.min(F.when(F.col("_first").isNotNull(), F.struct("_block", "_first")))
    files = blocks.groupBy(FILE).agg(F.bool_or("_torn").alias("_torn"), latin.alias("_latin"), begin.alias("_begin"))
    begins = files.select(FILE, "_begin._block", F.col("_begin._first").alias("_line")).filter("_line is not null")
    header = lines.join(begins, [*BLOCK, "_line"]).select(FILE, F.col("value").alias("header"))
    known = staged(blocks.select(*BLOCK).join(files.drop("_begin"), FILE).join(header, FILE, "left").withColumns({
        "_part": F.monotonically_increasing_id(), "_plain": plain_path(F.col(FILE)), "header": _text("header")}), "files")

    every = lines.join(known.filter(~F.col("_torn")), list(BLOCK)).withColumn("value", _text("value"))
    records = every.select(F.col("_plain").alias(FILE), "value", "header")
    headers = known.filter(~F.col("_torn")).select(F.col("_plain").alias(FILE), "header").distinct()
    torn = known.filter("_torn").drop("_torn", "header")
    if not torn.isEmpty():
        scanned = _scanned(lines, torn)
        first = scanned.filter("value <> ''").groupBy("_part").agg(F.min("_line").alias("_line")).join(torn, "_part")
        first = first.groupBy("_plain").agg(F.min(F.struct("_block", "_line", "_part")).alias("_at")).select("_plain", "_at._part", "_at._line")
        first = scanned.join(first, ["_part", "_line"]).select("_plain", F.col("value").alias("header"))
        first = staged(torn.select("_part", "_plain").join(first, "_plain").withColumnRenamed("_plain", FILE), "torn-headers")
        records = records.unionByName(scanned.join(first, "_part").select(FILE, "value", "header"))
        headers = headers.unionByName(first.select(FILE, "header").distinct())
    bare = F.ltrim(F.col("header"), F.lit("\ufeff"))
    kept = records.withColumn("header", bare).filter("value <> '' and ltrim('\ufeff', value) <> header")
    return kept.select(FILE, "value", "header"), headers.filter("header is not null").withColumn("header", bare)
