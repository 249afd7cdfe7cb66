"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
TASK_BYTES_SETTING = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITIONS_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TASK_BYTES, TASK_ROWS = "8m", 100_000
FILE_BROADCAST_SETTING = "spark.sql.autoBroadcastJoinThreshold"
MEASURED_BROADCAST_SETTING = "spark.sql.adaptive.autoBroadcastJoinThreshold"
SPLIT_BYTES_SETTING = "spark.sql.files.maxPartitionBytes"
OPEN_COST_SETTING = "spark.sql.files.openCostInBytes"
FILE_BROADCAST, MEASURED_BROADCAST, SPLIT_BYTES, OPEN_COST = "256k", "10m", "32m", "1m"


def local_session(cores: str = "8", app: str = "weekmart", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session (tests, benchmark)
    may fall back to a folder of this machine; anywhere else an unset folder is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    known = context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="weekmart-")
    context.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/weekmart/{label}-{uuid.uuid4().hex[:12]}"


def staged(keys: DataFrame, label: str = "keys") -> DataFrame:
    """A narrow key table or an aggregate, written to the shared folder and read again.

    The planner then knows its size in bytes and broadcasts it only below Spark's own threshold; the
    table it was taken from is not read a second time by the plan that uses the keys, nor after a lost
    executor.
    """
    path = staging_path(keys.sparkSession, label)
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def bound_tasks(spark: SparkSession, rows: int) -> None:
    """Let a larger fact make more tasks instead of larger ones.

    Adaptive execution merges the partitions of a shuffle down to one a core, up to 64 MB compressed, and what a task sorts and
    hashes is many times that. The bytes are lowered unless the user has set them; a shuffle begins with a partition for
    every TASK_ROWS of the fact's rows where that is more than Spark's own number, and is raised only.

    Before a query runs Spark knows a dimension by the size of its files alone. As a hashed relation that every task holds it is
    some forty times that, and again as many times as its rows are exploded. So only very small files are broadcast unseen;
    any other table is shuffled, and adaptive execution broadcasts it if its rows, as measured, are few. Splits of files are
    smaller too: a task that sums or deals out what it reads holds rows of its whole split.
    """
    for setting, value in ((TASK_BYTES_SETTING, TASK_BYTES), (SPLIT_BYTES_SETTING, SPLIT_BYTES), (OPEN_COST_SETTING, OPEN_COST)):
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, value)
    if spark.conf.get(FILE_BROADCAST_SETTING, None) is None:
        spark.conf.set(FILE_BROADCAST_SETTING, FILE_BROADCAST)
        if spark.conf.get(MEASURED_BROADCAST_SETTING, None) is None:
            spark.conf.set(MEASURED_BROADCAST_SETTING, MEASURED_BROADCAST)
    known = max(int(spark.conf.get(PARTITIONS_SETTING, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if rows // TASK_ROWS > known:
        spark.conf.set(PARTITIONS_SETTING, str(rows // TASK_ROWS))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by their keys over as many tasks as a shuffle begins with, not merged by their compressed bytes.

    For rows that the next step multiplies: the bytes do not tell what a task will hold.
    """
    conf = df.sparkSession.conf
    tasks = max(int(conf.get(PARTITIONS_SETTING, None) or 0), int(conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)
