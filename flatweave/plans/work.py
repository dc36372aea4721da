"""What to flatten: arrivals or a backfill range, routed by the control table.

The control table has one row per dataset: ``dataset, tables_to_flatten
array<string>, sharded, partitioned, intraday_views`` (the flags may be NULL) and
optionally ``frequency, units`` of a same-day refresh.  A work list has one row per flat table to write: ``dataset, source, shard,
flat_table, sharded, partitioned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatweave import schemas
from flatweave.functions.expressions import shard_date
from flatweave.schemas import ALL_TABLES, PLACE, TABLES_OF_SOURCE
from flatweave.sinks.layouts import PARTITIONED, SHARDED
from flatweave.sources.inventory import discover_datasets

# Tables a new control table lists: all, or the event tables only.
EVERY_TABLE = ALL_TABLES
EVENTS_ONLY = schemas.EVENT_TABLES


CONFIG_SCHEMA = """
    map<string, struct<
      tables_to_flatten: array<string>,
      output_format: struct<sharded: boolean, partitioned: boolean>,
      intraday_flattening: struct<
        intraday_flat_tables_schedule: struct<frequency: int, units: string>, intraday_flat_views: boolean>>>
    """


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """The control table of a JSON configuration file, one object keyed by dataset."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", CONFIG_SCHEMA)).alias("dataset", "c")).select(
        "dataset",
        "c.tables_to_flatten",
        "c.output_format.sharded",
        "c.output_format.partitioned",
        F.col("c.intraday_flattening.intraday_flat_views").alias("intraday_views"),
        "c.intraday_flattening.intraday_flat_tables_schedule.frequency",
        "c.intraday_flattening.intraday_flat_tables_schedule.units",
    )


def default_control(
    inventory: DataFrame,
    tables: tuple[str, ...] = EVERY_TABLE,
    now: Column | None = None,
    sharded: bool = True,
    partitioned: bool = False,
    intraday_views: bool = True,
) -> DataFrame:
    """A control table for every dataset discovered in an inventory."""
    return discover_datasets(inventory, now).select(
        "dataset",
        F.array(*map(F.lit, tables)).alias("tables_to_flatten"),
        F.lit(sharded).alias("sharded"),
        F.lit(partitioned).alias("partitioned"),
        F.lit(intraday_views).alias("intraday_views"),
    )


def backfill_grid(datasets: DataFrame, sources: tuple[str, ...], start: str, end: str) -> DataFrame:
    """Arrivals for every dataset, source and day from ``start`` to ``end``, newest first."""
    days = F.sequence(shard_date(F.lit(start)), shard_date(F.lit(end)))
    return (
        datasets.select("dataset", F.explode(F.array(*map(F.lit, sources))).alias("source"))
        .select("dataset", "source", F.explode(days).alias("day"))
        .select("dataset", "source", F.date_format("day", "yyyyMMdd").alias("shard"))
        .orderBy(F.desc("shard"), "source", "dataset")
    )


def _applicable_tables() -> Column:
    """Names of the flat tables the row's source feeds."""
    choice = None
    for source, tables in TABLES_OF_SOURCE.items():
        names = F.array(*map(F.lit, tables))
        choice = F.when(F.col("source") == source, names) if choice is None else choice.when(
            F.col("source") == source, names
        )
    return choice


def configured_arrivals(arrivals: DataFrame, control: DataFrame) -> DataFrame:
    """Arrivals whose dataset the control table lists."""
    return arrivals.join(control.select("dataset"), "dataset", "left_semi")


def route(arrivals: DataFrame, control: DataFrame) -> DataFrame:
    """The work list of some arrivals.

    The flat tables are those configured for the dataset that its source also
    feeds; no such table, or no such dataset, means no work.
    """
    tables = F.explode(F.array_intersect("tables_to_flatten", "__applicable"))
    return (
        arrivals.select("dataset", "source", "shard")
        .distinct()
        .withColumn("__applicable", _applicable_tables())
        .join(control, "dataset")
        .select(
            "dataset",
            "source",
            "shard",
            tables.alias("table"),
            F.coalesce("sharded", F.lit(True)).alias("sharded"),
            F.coalesce("partitioned", F.lit(False)).alias("partitioned"),
        )
        .select(
            "dataset",
            "source",
            "shard",
            F.concat(F.lit("flat_"), "table").alias("flat_table"),
            "sharded",
            "partitioned",
        )
    )


Pair = tuple[str, str]
Output = tuple[str, str]  # table and layout


def settle(work: DataFrame) -> dict[str, dict[Pair, set[Output]]]:
    """A work list computed once: for each source, what to write from each of its shards.

    One row a source directory comes to the driver, which names these directories to a scan anyway.
    """
    entry = F.struct("flat_table", "sharded", "partitioned")
    rows = work.groupBy("source", *PLACE).agg(F.collect_set(entry).alias("outputs")).collect()
    settled: dict[str, dict[Pair, set[Output]]] = {}
    for row in rows:
        outputs = {
            (one.flat_table.removeprefix("flat_"), layout)
            for one in row.outputs
            for layout in (SHARDED, PARTITIONED)
            if one[layout]
        }
        if outputs:
            settled.setdefault(row.source, {})[row.dataset, row.shard] = outputs
    return settled


def with_source(work: DataFrame, existing: DataFrame) -> DataFrame:
    """Work whose source shard exists."""
    return work.join(existing, list(PLACE), "left_semi")


def not_superseded(intraday: DataFrame, daily_shards: DataFrame) -> DataFrame:
    """Same-day rows, or work, of shards without a daily export."""
    return intraday.join(daily_shards, list(PLACE), "left_anti")
