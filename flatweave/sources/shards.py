"""Nested exports on storage: ``<root>/<source>/dataset=<d>/shard=<YYYYMMDD>/*.parquet``.

Which shards exist is told by their directories, so an export without rows exists.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave.functions.expressions import quoted
from flatweave.schemas import PLACE, PLACE_FIELDS, SOURCE_SCHEMAS
from flatweave.session import (
    LISTING,
    OPEN_AT_ONCE,
    OPEN_FILES,
    listing_tasks,
    partition_directories,
    path_exists,
    setting,
)

Pair = tuple[str, str]
# Up to so many directories are named to a scan one by one; for more, Spark would start a job to list them.
NAMED_DIRECTORIES = 32
# Above this part of the directories that lie side by side, the whole folder is listed and then pruned.
MOST_OF = 0.25


def source_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}"


def among(pairs: Iterable[Pair]) -> Column:
    """Whether a row's shard is one of these; settled by directory where they are the scan's partitions."""
    listed = ", ".join(quoted(f"{dataset}/{shard}") for dataset, shard in sorted(set(pairs)))
    return F.expr(f"concat_ws('/', dataset, shard) IN ({listed})") if listed else F.lit(False)


def _directory(root: str, source: str, pair: Pair) -> str:
    return f"{source_path(root, source)}/dataset={_escaped(pair[0])}/shard={_escaped(pair[1])}"


def _within(shard: str, between: tuple[str, str] | None) -> bool:
    return between is None or between[0] <= shard <= between[1]


def _list(
    spark: SparkSession,
    root: str,
    source: str,
    between: tuple[str, str] | None,
    datasets: Iterable[str] | None,
    pairs: Iterable[Pair] | None,
) -> tuple[dict[Pair, str], int]:
    """The directories of the shards that are wanted and exist, and how many lie beside them."""
    pairs = None if pairs is None else set(pairs)
    if pairs is not None:
        datasets = {dataset for dataset, _ in pairs} & (set(datasets) if datasets is not None else {d for d, _ in pairs})
        if len(pairs) <= NAMED_DIRECTORIES:
            there = {pair: _directory(root, source, pair) for pair in pairs if pair[0] in datasets and _within(pair[1], between)}
            there = {pair: path for pair, path in there.items() if path_exists(spark, path)}
            return there, len(there)
    datasets = None if datasets is None else set(datasets)
    seen = 0

    def wanted(values: dict) -> bool:
        nonlocal seen
        dataset, shard = values["dataset"], values.get("shard")
        if datasets is not None and dataset not in datasets:
            return False
        if shard is None:
            return "shard" not in values
        seen += 1
        return _within(shard, between) and (pairs is None or (dataset, shard) in pairs)

    found = partition_directories(spark, source_path(root, source), PLACE, wanted)
    return {(values["dataset"], values["shard"]): path for values, path in found}, seen


def shard_paths(
    spark: SparkSession,
    root: str,
    source: str,
    between: tuple[str, str] | None = None,
    datasets: Iterable[str] | None = None,
    pairs: Iterable[Pair] | None = None,
) -> dict[Pair, str]:
    """The directory of each existing ``(dataset, shard)``; empty if the source is missing.

    ``between`` is an inclusive range of shards.  Only directories of wanted datasets are listed, once each.
    """
    return _list(spark, root, source, between, datasets, pairs)[0]


def listed_shards(spark: SparkSession, root: str, source: str, pairs: Iterable[Pair]) -> tuple[dict[Pair, str], int]:
    """The directories of those of ``pairs`` that exist, and how many lie beside them; for :func:`read_source`."""
    return _list(spark, root, source, None, None, pairs)


def read_source(
    spark: SparkSession,
    root: str,
    source: str,
    shard: str | None = None,
    between: tuple[str, str] | None = None,
    datasets: Iterable[str] | None = None,
    pairs: Iterable[Pair] | None = None,
    schema: T.StructType | None = None,
    extra: Iterable[T.StructField] = (),
    position: bool = True,
    listed: tuple[dict[Pair, str], int] | None = None,
) -> DataFrame:
    """Scan one source: a single shard, an inclusive range of shards, some pairs, or all.

    Only wanted directories are opened: a few are named to the scan, of many the whole folder is listed and pruned by
    their names.  The declared schema fills columns an
    old shard lacks with NULL.  ``row_position`` (file name and row number in it) identifies
    a source row; leave it out with ``position=False`` where no key is generated.  ``listed`` is a result of
    :func:`listed_shards`, in place of the other choices.
    """
    fields = (schema or SOURCE_SCHEMAS[source]).fields
    declared = T.StructType([*fields, *extra, *PLACE_FIELDS])
    if shard is not None:
        between = (shard, shard)
    folder = source_path(root, source)
    reader = spark.read.schema(declared)
    with setting(spark, LISTING, listing_tasks(spark)):
        if between is None and datasets is None and pairs is None and listed is None:
            rows = reader.parquet(folder) if path_exists(spark, folder) else None
        else:
            found, beside = listed or _list(spark, root, source, between, datasets, pairs)
            if not found:
                rows = None
            elif len(found) > NAMED_DIRECTORIES and len(found) > MOST_OF * beside:
                rows = reader.parquet(folder).where(among(found))
            else:
                rows = reader.option("basePath", folder).parquet(*sorted(found.values()))
    if rows is None:
        rows = spark.createDataFrame([], declared)
        return rows.withColumn("row_position", F.lit(None).cast("string")) if position else rows
    if not position:
        return rows
    row_position = F.concat_ws("#", "_metadata.file_name", "_metadata.row_index")
    return rows.select("*", row_position.alias("row_position"))


def list_shards(
    spark: SparkSession, root: str, source: str, between: tuple[str, str] | None = None
) -> DataFrame:
    """The ``(dataset, shard)`` pairs that exist, with rows or without."""
    return spark.createDataFrame(sorted(shard_paths(spark, root, source, between)), T.StructType(PLACE_FIELDS))


def shard_table(spark: SparkSession, root: str, source: str, datasets: Iterable[str] | None = None) -> DataFrame:
    """A row for each shard with files: dataset, shard, files, bytes, newest (timestamp), and a mark of its files.

    One listing by Spark's tasks; no file is opened.  The mark changes when a file of the shard is
    added, removed, or written again (with other bytes or at another time).
    """
    folder = source_path(root, source)
    paths = [folder] if datasets is None else [f"{folder}/dataset={_escaped(name)}" for name in sorted(set(datasets))]
    paths = [path for path in paths if path_exists(spark, path)]
    if not paths:
        return spark.createDataFrame([], "dataset string, shard string, files long, bytes long, newest timestamp, mark string")
    # A session of its own, for settings of the listing only: Spark would cut it into a task a directory.
    lister = spark.newSession()
    lister.conf.set(LISTING, listing_tasks(spark))
    lister.conf.set("spark.sql.files.maxPartitionNum", listing_tasks(spark))
    files = lister.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    place = r"/dataset=([^/]*)/shard=([^/]*)/([^/]*)$"

    def part(group: int) -> Column:
        return F.regexp_extract("path", place, group)

    def name(group: int) -> Column:
        return F.url_decode(F.replace(part(group), F.lit("+"), F.lit("%2B")))

    files = files.where(F.col("path").rlike(place)).select(
        name(1).alias("dataset"),
        name(2).alias("shard"),
        "length",
        "modificationTime",
        F.xxhash64(part(3), "length", "modificationTime").alias("one"),
    )
    # Two files can hardly share a hash: their names differ.
    mark = F.concat_ws("-", F.count("*"), F.hex(F.bit_xor("one")))
    return files.groupBy(*PLACE).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("newest"),
        mark.alias("mark"),
    )


def _escaped(name: str) -> str:
    """A partition value as its directory is named."""
    return "".join(f"%{ord(sign):02X}" if sign in _ESCAPED or sign < " " else sign for sign in name)


# What directory names of partitions escape.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def cluster(rows: DataFrame) -> DataFrame:
    """Rows of a shard together in few tasks; an oversized shard is split."""
    return rows.hint("rebalance", *PLACE)


def write_source(rows: DataFrame, root: str, source: str, clustered: bool = False) -> str:
    """Write nested rows that carry ``dataset`` and ``shard`` as an export.

    Rows that are ``clustered``, by :func:`cluster` or since a scan of shards gave them, are not shuffled: each task has few shards.
    """
    path = source_path(root, source)
    spark = rows.sparkSession
    with setting(spark, OPEN_FILES, OPEN_AT_ONCE):
        (rows if clustered else cluster(rows)).write.mode("overwrite").partitionBy(*PLACE).parquet(path)
    return path
