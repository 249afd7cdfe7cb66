"""Incremental loads: new files are picked up as a stream and merged with the batch load modes.

``availableNow`` drains all that has arrived as one batch and stops, so the job can be scheduled
weekly; a batch that is repeated after a failure leaves the same table, because both load modes are
idempotent. Batches are not cut by file count: a week split over two batches would be appended only
in part, or replaced by its second half. Deliveries dated by their headers are loaded by file instead,
so their batches may be cut anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weekmart.sources.readers import read_shared
from weekmart.sources.records import FILE
from weekmart.sources.snapshots import replace_partitions
from weekmart.sources.sinks import append_missing_weeks, write_partitions


def file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def _drain(stream: DataFrame, checkpoint: str, load: Callable[[DataFrame], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: load(batch))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_append_missing(
    stream: DataFrame, table: str, checkpoint: str, week: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Stream into a table, adding only weeks it does not have."""
    _drain(stream, checkpoint, lambda batch: append_missing_weeks(prepare(batch), table, week))


def stream_replace(
    stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Stream into a table, replacing the partitions each batch delivers."""
    _drain(stream, checkpoint, lambda batch: write_partitions(prepare(batch), table, keys))


FILE_ID = "file_id"


def arriving_files(spark: SparkSession, folder: str, name_glob: str | None = None, files_a_batch: int | None = None) -> DataFrame:
    """The paths of new files below a folder as a stream; their content is not read by it."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    options = {"recursiveFileLookup": "true", "pathGlobFilter": name_glob, "maxFilesPerTrigger": files_a_batch}
    return reader.options(**{k: v for k, v in options.items() if v is not None}).load(folder).select("path")


def stream_shared(
    files: DataFrame, table: str, checkpoint: str, schema: StructType, day: str = "week_beginning_date",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Stream deliveries dated by their last header into a snapshot table of the partitions (``day``, file).

    The stream remembers which files it has seen. Each batch reads the headers of its own files, so every file has its own
    layout and week, whatever came in earlier batches, and its rows become one partition, replaced as a whole. A batch that
    is repeated after a failure, or a file that is delivered again, leaves the same table; a week may come in several files
    and batches. The driver sees the names of a batch's files, as the file stream itself does.
    """
    def load(batch: DataFrame) -> None:
        paths = [r[0] for r in batch.collect()]
        if paths:
            rows = read_shared(batch.sparkSession, paths, schema, day, keep=[FILE])
            loaded = prepare(rows).withColumn(FILE_ID, F.xxhash64(FILE)).drop(FILE)
            replace_partitions(loaded, table, [day, FILE_ID])

    _drain(files, checkpoint, load)
