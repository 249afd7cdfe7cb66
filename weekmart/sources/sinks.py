"""Sinks and load modes. Tables are folders of Parquet files partitioned by their replace keys.

Rows are rebalanced by the partition columns before a partitioned write: adaptive execution then
merges small partitions and splits a hot one over several tasks and files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.functions.clean import lower_headers
from weekmart.operators.history import missing_weeks, next_missing_weeks
from weekmart.operators.series import last_weeks
from weekmart.session import staged

RECORD = "_loaded_weeks"  # a name that readers of the table skip


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(k) for k in keys])


def write_csv(df: DataFrame, path: str, compression: str = "gzip", partition: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("header", "true").option("compression", compression)
    (writer.partitionBy(*partition) if partition else writer).csv(path)


def save_version(df: DataFrame, root: str, version: str) -> str:
    """Full history as a new version; an existing version is never overwritten."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` (distributor and week, distributor, country)."""
    (rebalanced(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or an empty frame of the same layout before the first load."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], like.schema)


def loaded_weeks(df: DataFrame, path: str, week: str) -> DataFrame:
    """The weeks whose load was completed, as recorded beside the table's data.

    A table without a record (one that another load mode wrote) is taken as complete, and its weeks are recorded.
    """
    record = f"{path.rstrip('/')}/{RECORD}"
    like = df.select(week)
    try:
        return df.sparkSession.read.schema(like.schema).parquet(record)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    read_or_empty(df.sparkSession, path, df).select(week).distinct().write.mode("append").parquet(record)
    return df.sparkSession.read.schema(like.schema).parquet(record)


def _load_weeks(df: DataFrame, path: str, week: str) -> None:
    """Write whole weeks over whatever a failed load left of them, then record them as complete."""
    weeks = staged(df.select(week).distinct(), "weeks")
    if not weeks.isEmpty():
        write_partitions(df, path, [week])
        weeks.write.mode("append").parquet(f"{path.rstrip('/')}/{RECORD}")


def append_missing_weeks(df: DataFrame, path: str, week: str) -> None:
    """Add only the weeks the table does not have yet; running it again adds nothing.

    Rows without a week are one week of their own. A week that a failed load left in part is written anew.
    """
    _load_weeks(missing_weeks(loaded_weeks(df, path, week), df, week), path, week)


def backfill_weeks(df: DataFrame, path: str, week: str, limit: int = 10) -> None:
    """Add the first ``limit`` missing weeks per run."""
    _load_weeks(next_missing_weeks(loaded_weeks(df, path, week), df, limit, week), path, week)


def replace_latest_weeks(df: DataFrame, path: str, keys: Sequence[str], week: str, n: int) -> None:
    """Send only the ``n`` latest weeks, replacing their partitions."""
    write_partitions(last_weeks(df, n, week), path, keys)


def reload(df: DataFrame, path: str) -> None:
    """Truncate and load. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_report(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Several tables of one report with lower-case headers, one folder each."""
    paths = {}
    for name, table in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name.lower()}"
        lower_headers(table).write.mode("overwrite").parquet(paths[name])
    return paths
