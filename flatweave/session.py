"""Where a job may put intermediate tables, and small path helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    Only a local session without the setting gets a folder of its own; a cluster, ``local-cluster``
    included, without it is an error, because a machine-local folder would be lost or
    invisible to other executors.  A folder that the cluster names is trusted to be shared: a mounted
    one has a ``file:`` address too.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"flatweave-{application}-")


def new_stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/flatweave/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), spark: SparkSession | None = None
) -> tuple[DataFrame, str]:
    """Write a DataFrame to the shared folder once and read it back.

    The written table cuts the lineage: a lost executor re-reads files instead of
    recomputing the plan, and every reader sees the same rows.  ``spark`` reads it
    back, by default the session of ``df``.
    """
    spark = spark or df.sparkSession
    path = new_stage_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a table written by :func:`stage`; refuses any other path."""
    if not path.startswith(f"{shared_folder(spark)}/flatweave/"):
        raise ValueError(f"not a staged table: {path}")
    delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while the block runs."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def listing_tasks(spark: SparkSession) -> str:
    """Tasks that list directories: a few for each core, where Spark would take one for each directory."""
    return str(4 * spark.sparkContext.defaultParallelism)


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


# A task that writes directories keeps up to so many files open and need not sort its rows by directory, which would spill wide ones;
# what goes beyond is sorted.
OPEN_FILES, OPEN_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters", "32"
# A join takes rows as they are dealt by some of its keys, and does not deal them again by all.
BY_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


class Stages:
    """Owner of staged tables: they are dropped when the block ends, however it ends."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def table(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = new_stage_path(self._spark, name)
        self._paths.append(path)  # first, so that a failed write goes too
        df.write.partitionBy(*partition_by).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        while self._paths:
            drop_stage(self._spark, self._paths.pop())


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_directories(
    spark: SparkSession, path: str, columns: tuple[str, ...], wanted: Callable[[dict], bool] = lambda values: True
) -> list[tuple[dict, str]]:
    """Values and path of each directory of a partitioned table; none if the table is missing.

    Lists one level after the other, and below a directory only if ``wanted`` accepts
    the values known so far.  No file is opened.
    """
    found = [({}, path)]
    for column in columns:
        below = []
        for values, parent in found:
            fs, target = _file_system(spark, parent)
            if not fs.exists(target):
                continue
            for status in fs.listStatus(target):
                name = status.getPath().getName()
                if not status.isDirectory() or not name.startswith(f"{column}="):
                    continue
                text = name[len(column) + 1 :]
                known = {**values, column: None if text == NO_VALUE else unquote(text)}
                if wanted(known):
                    below.append((known, f"{parent}/{name}"))
        found = below
    return found


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is missing."""
    fs, target = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file, whole."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, written new."""
    fs, target = _file_system(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def move_if_absent(spark: SparkSession, path: str, to: str) -> bool:
    """Move a file to a name that must be free, in one step where the store can; False if it is taken."""
    jvm = spark._jvm
    fs, source = _file_system(spark, path)
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(to))
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(source), target, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True
