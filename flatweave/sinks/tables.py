"""Flat tables on storage, replaced by source shard, all or nothing.

Two layouts, each one table for all datasets and days:

* sharded      ``<root>/sharded/flat_x/rows/version=/dataset=/shard=``
* partitioned  ``<root>/partitioned/flat_x/rows/version=/dataset=/event_date=/shard=``

The partitioned table has a partition per day, as a DATE, and below it one per source shard.  A shard's rows are replaced whole and
touch no other shard's rows, even if some of them carry another day's date, so writing again changes nothing.

A write goes to a version of its own, which nobody reads until it is published.  Publishing moves one small file
``current/<number>.json`` into place, which names the version of every shard: a reader sees all of a write or
nothing of it, and two writers cannot publish the same number.  The version that a shard had before stays for readers under way until the
shard is replaced again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave import schemas
from flatweave.operators.flatten import flatten_table
from flatweave.schemas import PLACE, PLACE_FIELDS, SOURCE_SCHEMAS, TABLES_OF_SOURCE
from flatweave.session import (
    LISTING,
    OPEN_AT_ONCE,
    OPEN_FILES,
    child_names,
    delete_path,
    listing_tasks,
    move_if_absent,
    partition_directories,
    path_exists,
    read_bytes,
    setting,
    write_bytes,
)
from flatweave.sinks.layouts import PARTITIONED, SHARDED
from flatweave.sources.shards import Pair, among

# What is known of each shard that was ever written: the version that holds it now and the one before, the source it came from, a mark
# of the source's files, the run that wrote it, and how many rows it has.
STATE_FIELDS = [
    *PLACE_FIELDS,
    *(T.StructField(name, T.StringType()) for name in ("version", "previous", "source", "mark", "run")),
    T.StructField("rows", T.LongType()),
]
STATE = T.StructType(STATE_FIELDS)
PUBLISH_ATTEMPTS = 20
DELETIONS_AT_ONCE = 16


def table_path(root: str, layout: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layout}/flat_{table}"


def rows_path(root: str, layout: str, table: str) -> str:
    return f"{table_path(root, layout, table)}/rows"


def _version_path(root: str, layout: str, table: str, version: str) -> str:
    return f"{rows_path(root, layout, table)}/version={version}"


def partition_columns(layout: str, table: str) -> list[str]:
    return ["dataset", "shard"] if layout == SHARDED else ["dataset", schemas.date_field(table), "shard"]


@lru_cache(maxsize=None)
def _flat_fields(table: str) -> tuple[T.StructField, ...]:
    spark = SparkSession.active()
    source = next(name for name, tables in TABLES_OF_SOURCE.items() if table in tables)
    keys = [T.StructField("event_id", T.StringType())]
    if not source.startswith("events"):
        keys = [T.StructField("row_id", T.StringType()), T.StructField("date", T.DateType())]
    nested = T.StructType([*SOURCE_SCHEMAS[source].fields, *keys, *PLACE_FIELDS])
    flat = flatten_table(spark.createDataFrame([], nested), table, source)
    return tuple(T.StructField(f.name, f.dataType) for f in flat.schema.fields)


def flat_schema(table: str) -> T.StructType:
    """Columns of a flat table, in order."""
    return T.StructType(list(_flat_fields(table)))


# ---- What is current ---------------------------------------------------------------


def _latest(spark: SparkSession, path: str) -> int:
    """Number of the last publication; 0 if there is none."""
    names = child_names(spark, f"{path}/current")
    return max((int(name.removesuffix(".json")) for name in names if name[0].isdigit()), default=0)


def _publication(path: str, number: int) -> str:
    return f"{path}/current/{number:010d}.json"


def _published(spark: SparkSession, path: str, number: int) -> dict[Pair, Row]:
    """What the driver needs to publish the next one: a row a shard, as few as the directories that a scan lists there."""
    if not number:
        return {}
    lines = read_bytes(spark, _publication(path, number)).decode().splitlines()
    rows = [Row(**dict(zip(STATE.names, json.loads(line)))) for line in lines]
    return {(row.dataset, row.shard): row for row in rows}


def shard_state(spark: SparkSession, root: str, layout: str, table: str) -> DataFrame:
    """A row for each shard that a flat table holds, see :data:`STATE`."""
    path = table_path(root, layout, table)
    return spark.createDataFrame([tuple(row) for row in _published(spark, path, _latest(spark, path)).values()], STATE)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """:func:`shard_state` of all flat tables, with ``flat_table`` and ``layout``."""
    parts = [
        shard_state(spark, root, layout, table).select(F.lit(table).alias("flat_table"), F.lit(layout).alias("layout"), "*")
        for layout in (SHARDED, PARTITIONED)
        for table in schemas.ALL_TABLES
        if path_exists(spark, table_path(root, layout, table))
    ]
    whole = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in ("flat_table", "layout")] + STATE_FIELDS))
    for part in parts:
        whole = whole.unionByName(part)
    return whole


def read_flat(spark: SparkSession, root: str, layout: str, table: str) -> DataFrame:
    """A flat table of either layout; empty if it was never written."""
    schema = flat_schema(table)
    if not _latest(spark, table_path(root, layout, table)):
        return spark.createDataFrame([], schema)
    state = shard_state(spark, root, layout, table)
    stored = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    rows = spark.read.schema(stored).parquet(rows_path(root, layout, table))
    # A row for each shard: less than the scan itself holds, which lists the shards' directories.  All columns are the scan's
    # partitions, so that directories of earlier versions are not opened.
    current = F.broadcast(state.where("version != ''").select(*PLACE, "version"))
    return rows.join(current, [*PLACE, "version"], "left_semi").select(*schema.names)


# ---- Writing -----------------------------------------------------------------------


def write_version(rows: DataFrame, root: str, layout: str, table: str) -> str:
    """Write rows where nobody reads them yet; a failed write leaves nothing behind."""
    version = f"v{uuid.uuid4().hex}"
    path = _version_path(root, layout, table, version)
    try:
        rows.write.partitionBy(*partition_columns(layout, table)).parquet(path)
    except BaseException:
        delete_path(rows.sparkSession, path)
        raise
    return version


def copy_version(
    spark: SparkSession, root: str, table: str, version: str, layout: str, to: str, pairs: Iterable[Pair] | None = None
) -> str:
    """The rows of a version, or of some of its shards, in the other layout."""
    rows = spark.read.schema(flat_schema(table)).parquet(_version_path(root, layout, table, version))
    if pairs is not None:
        rows = rows.where(among(pairs))
    return write_version(rows, root, to, table)


def publish(
    spark: SparkSession, root: str, layout: str, table: str, version: str | dict[Pair, str], entries: list[Row]
) -> None:
    """Make a version, or each shard's own, the current one of the shards in ``entries`` (of :func:`entries_of`), all at once.

    A shard of which the version has no rows ends up empty.  Should another writer publish meanwhile, its
    publication is taken over and tried again.  The driver holds a row for each shard of the table, as it does to plan a scan of it.
    """
    path = table_path(root, layout, table)
    for _ in range(PUBLISH_ATTEMPTS):
        number = _latest(spark, path)
        known = _published(spark, path, number)
        state = dict(known)
        for entry in entries:
            pair = entry["dataset"], entry["shard"]
            before = known[pair].version if pair in known else None
            own = version if isinstance(version, str) else version[pair]
            state[pair] = Row(**{**entry.asDict(), "version": own, "previous": before})
        lines = [json.dumps([row[name] for name in STATE.names]) for _, row in sorted(state.items())]
        draft = f"{path}/current/_{uuid.uuid4().hex}"
        try:
            write_bytes(spark, draft, "\n".join(lines).encode())
            published = move_if_absent(spark, draft, _publication(path, number + 1))
        finally:
            delete_path(spark, draft)
        if published:
            replaced = [known[entry["dataset"], entry["shard"]] for entry in entries if (entry["dataset"], entry["shard"]) in known]
            used = {one for row in state.values() for one in (row.version, row.previous)}
            _clean(spark, root, layout, table, replaced, used, number + 1)
            return
    raise RuntimeError(f"{path}: {PUBLISH_ATTEMPTS} publications by others came between")


def _clean(spark: SparkSession, root: str, layout: str, table: str, replaced: list[Row], used: set[str | None], number: int) -> None:
    """Delete what the replaced shards had before their last version, and publications before the last one."""
    path = table_path(root, layout, table)
    gone: dict[str, set[Pair]] = {}
    for row in replaced:
        if row.previous is not None:
            gone.setdefault(row.previous, set()).add((row.dataset, row.shard))
    doomed = [_version_path(root, layout, table, version) for version in gone.keys() - used]
    for version in gone.keys() & used:
        pairs = gone[version]
        datasets = {dataset for dataset, _ in pairs}

        def wanted(values: dict, pairs=pairs, datasets=datasets) -> bool:
            return values["dataset"] in datasets and ("shard" not in values or (values["dataset"], values["shard"]) in pairs)

        columns = tuple(partition_columns(layout, table))
        found = partition_directories(spark, _version_path(root, layout, table, version), columns, wanted)
        doomed += [directory for _, directory in found]
    doomed += [
        f"{path}/current/{name}"
        for name in child_names(spark, f"{path}/current")
        if name[0].isdigit() and int(name.removesuffix(".json")) < number - 1
    ]
    if doomed:
        with ThreadPoolExecutor(max_workers=DELETIONS_AT_ONCE) as pool:
            list(pool.map(lambda one: delete_path(spark, one), doomed))


@lru_cache(maxsize=4)
def _footer_reader(spark: SparkSession) -> SparkSession:
    """A session of its own: only the newer Parquet source takes an aggregate down to the footers."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader.conf.set(LISTING, listing_tasks(spark))
    reader.conf.set("spark.sql.shuffle.partitions", "8")  # a row a directory
    return reader


def footer_counts(spark: SparkSession, path: str, schema: T.StructType, by: tuple[str, ...]) -> list[Row]:
    """Rows by partition columns, from the footers of the files alone; one a directory."""
    return _footer_reader(spark).read.schema(schema).parquet(path).groupBy(*by).agg(F.count("*").alias("rows")).collect()


def version_counts(spark: SparkSession, root: str, layout: str, table: str, version: str) -> dict[Pair, int]:
    """Rows of each shard in a version, from footers."""
    path = _version_path(root, layout, table, version)
    return {(row.dataset, row.shard): row.rows for row in footer_counts(spark, path, flat_schema(table), PLACE)}


def current_counts(spark: SparkSession, root: str, layout: str, table: str) -> dict[Pair, tuple[int, int]]:
    """Of each shard, the rows that were published and those that the footers of its files have now."""
    state = shard_state(spark, root, layout, table).select(*PLACE, "version", "rows").collect()  # one a shard
    if not state:
        return {}
    stored = T.StructType([*flat_schema(table).fields, T.StructField("version", T.StringType())])
    found = footer_counts(spark, rows_path(root, layout, table), stored, ("version", *PLACE))
    rows = {(row.version, row.dataset, row.shard): row.rows for row in found}
    return {(one.dataset, one.shard): (one.rows, rows.get((one.version, one.dataset, one.shard), 0)) for one in state}


def entries_of(
    pairs: Iterable[Pair],
    counts: dict[Pair, int],
    source: str | None = None,
    marks: dict[Pair, str] | None = None,
    run: str | None = None,
) -> list[Row]:
    """What :func:`publish` says of some shards."""
    return [
        Row(dataset=pair[0], shard=pair[1], source=source, mark=(marks or {}).get(pair), run=run, rows=counts.get(pair, 0))
        for pair in sorted(set(pairs))
    ]


def replace_shards(rows: DataFrame, root: str, layout: str, table: str, shards: Iterable[Pair] | DataFrame) -> None:
    """Replace what the table holds for some source shards by ``rows``.

    ``shards`` lists the ``(dataset, shard)`` pairs replaced; one without rows ends
    up empty.  Readers see the rows of before until all of the new ones are written.
    """
    spark = rows.sparkSession
    if isinstance(shards, DataFrame):
        shards = [tuple(row) for row in shards.select(*PLACE).distinct().collect()]  # a row a directory
    with setting(spark, OPEN_FILES, OPEN_AT_ONCE):
        version = write_version(rows, root, layout, table)
    counts = version_counts(spark, root, layout, table, version)
    publish(spark, root, layout, table, version, entries_of(shards, counts))
