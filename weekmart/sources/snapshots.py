"""Tables whose loads take effect as a whole: immutable data folders, manifests, and one pointer swapped at once.

Below a table's path, ``data/load=<id>`` holds what one load wrote, partitioned by the table's keys; ``manifests/<id>`` is a
table of the partitions that make up one version (keys and folder); ``versions/<number>`` names the manifest, the keys and the
schema. A load writes its data and manifest first and then creates the next version's file, which fails if it is there. Readers
take the highest version and read its folders. A load that dies leaves folders no version names; the table stays as it was.

Of two loads that began at the same version the second finds the file taken. If the first replaced other partitions it goes on
from there, else it ends in a ``ConflictError``: what it would replace is not what it has seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TRIES = 20
FOLDER = "_folder"


class ConflictError(RuntimeError):
    """Another load has replaced the same partitions since this one began."""


class Version(NamedTuple):
    number: int
    manifest: str
    keys: tuple[str, ...]
    schema: StructType


def _at(spark: SparkSession, path: str):
    """The file system of a path, as Spark's own configuration knows it, and the path in its form."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, at = _at(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


def _publish(spark: SparkSession, folder: str, name: str, content: str) -> bool:
    """Create a file with its whole content, unless there is one of that name; false if there is."""
    files, target = _at(spark, f"{folder}/{name}")
    _, draft = _at(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(content.encode()))
    out.close()
    jvm = spark._jvm
    try:
        if files.getUri().getScheme() == "file":  # a rename would replace the file there; a link does not
            both = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*both)
            files.delete(draft, False)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, none)
        return True
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that can be read, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{path.rstrip('/')}/versions") if n.isdigit())


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The latest version, or the one of that number; none before the first load."""
    root = path.rstrip("/")
    if number is None:
        number = max(versions(spark, path), default=None)
        if number is None:
            return None
    files, at = _at(spark, f"{root}/versions/{number:012d}")
    stream = files.open(at)
    try:
        told = json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()
    return Version(number, told["manifest"], tuple(told["keys"]), StructType.fromJson(told["schema"]))


def _manifest(spark: SparkSession, path: str, version: Version | None, like: StructType) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], like)
    return spark.read.schema(like).parquet(f"{path.rstrip('/')}/manifests/{version.manifest}")


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table at its latest version, or at an earlier one; later loads do not change what is read."""
    version = current(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    folders = [r[0] for r in _manifest(spark, path, version, _listing(version)).select(FOLDER).collect()]  # one for each partition
    if not folders:
        return spark.createDataFrame([], version.schema)
    root = path.rstrip("/")
    data = spark.read.schema(version.schema).option("basePath", f"{root}/data").parquet(*[f"{root}/data/{f}" for f in folders])
    return data.select(*version.schema.fieldNames())


def _listing(version: Version) -> StructType:
    return StructType([version.schema[k] for k in version.keys]).add(FOLDER, "string")


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys], F.lit(True))


def _changed(spark: SparkSession, path: str, old: Version | None, new: Version, keys: Sequence[str]) -> DataFrame:
    """Keys of the partitions that two versions hold in different folders."""
    a, b = (_manifest(spark, path, v, _listing(new)) for v in (old, new))
    return a.exceptAll(b).unionByName(b.exceptAll(a)).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()


def _load(df: DataFrame, path: str, keys: Sequence[str], whole: bool, gone: DataFrame | None = None) -> int:
    spark, root, keys = df.sparkSession, path.rstrip("/"), list(keys)
    began = current(spark, path)
    if began is not None and not whole and (began.keys != tuple(keys) or began.schema.fieldNames() != df.columns):
        raise ValueError(f"the table at {path} has keys {began.keys} and columns {began.schema.fieldNames()}")
    load = f"load={uuid.uuid4().hex}"
    writer = (df.hint("rebalance", *[F.col(k) for k in keys]) if keys else df).write
    (writer.partitionBy(*keys) if keys else writer).parquet(f"{root}/data/{load}")
    version = Version(0, "", tuple(keys), StructType([df.schema[c] for c in df.columns]))
    written = spark.read.schema(version.schema).parquet(f"{root}/data/{load}")
    folder = F.concat(F.lit(load), F.element_at(F.split("_metadata.file_path", F.lit(load)), -1))
    # the first row of each file tells its folder
    rows = written.filter("_metadata.row_index = 0").select(*keys, F.regexp_replace(folder, "/[^/]*$", "").alias("_uri")).distinct().collect()  # one for each partition
    listed = [(*r[:-1], unquote(urlsplit(r[-1]).path)) for r in rows]
    mine = spark.createDataFrame(listed, _listing(version))
    touched = mine.select(*keys) if gone is None else mine.select(*keys).unionByName(gone.select(*keys)).distinct()
    if not whole and (not listed and (gone is None or gone.isEmpty())):
        return 0 if began is None else began.number
    for _ in range(TRIES):
        head = current(spark, path)
        if head is not None and (began is None or head.number != began.number):
            if whole or head.keys != tuple(keys) or not touched.join(
                    changed := _changed(spark, path, began, head, keys), _same(touched, changed, keys), "left_semi").isEmpty():
                raise ConflictError(f"version {head.number} of {path} has replaced the same partitions")
        kept = mine
        if head is not None and not whole:
            replaced = touched.select(*[F.col(k).alias(f"_{k}") for k in keys])
            before = _manifest(spark, path, head, _listing(version))
            kept = mine.unionByName(before.join(replaced, _same(before, replaced, keys), "left_anti"))
        manifest = uuid.uuid4().hex
        kept.coalesce(1).write.parquet(f"{root}/manifests/{manifest}")
        number = 1 if head is None else head.number + 1
        content = json.dumps({"manifest": manifest, "keys": keys, "schema": version.schema.jsonValue(), "load": load})
        if _publish(spark, f"{root}/versions", f"{number:012d}", content):
            return number
    raise ConflictError(f"{TRIES} other loads of {path} came first")


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str], gone: DataFrame | None = None) -> int:
    """Replace exactly the partitions present in ``df``, all at once; the number of the version that holds them.

    A null key is a partition like others. Partitions whose keys are listed in ``gone`` go even where ``df`` has no rows
    for them. Without either nothing is replaced. ``df`` may read from the table itself.
    """
    return _load(df, path, keys, False, gone)


def partitions(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The keys of a version's partitions, from its manifest; none before the first load."""
    version = current(spark, path, number)
    return None if version is None else _manifest(spark, path, version, _listing(version)).select(*version.keys)


def replace_table(df: DataFrame, path: str, keys: Sequence[str] = ()) -> int:
    """Truncate and load: the rows of ``df`` are the whole next version. ``df`` may read from the table itself."""
    return _load(df, path, keys, True)


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Delete all but the latest ``keep`` versions and the loads only they name; returns the deleted numbers.

    Folders that no version ever named, such as those of loads under way, stay.
    """
    root, numbers = path.rstrip("/"), versions(spark, path)
    old, left = numbers[:-keep], numbers[-keep:]
    if not old:
        return []
    told = {n: current(spark, path, n) for n in numbers}

    def loads(chosen: Sequence[int]) -> set[str]:
        return {r[0].split("/")[0] for n in chosen for r in _manifest(spark, path, told[n], _listing(told[n])).select(FOLDER).collect()}

    gone = loads(old) - loads(left)
    for name in [f"versions/{n:012d}" for n in old] + [f"manifests/{told[n].manifest}" for n in old] + [f"data/{load}" for load in sorted(gone)]:
        files, at = _at(spark, f"{root}/{name}")
        files.delete(at, True)
    return old
