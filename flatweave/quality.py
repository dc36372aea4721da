"""Checks on written flat tables: schemas, counts, days and key uniqueness."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave.operators.relational import rows_per_day
from flatweave.schemas import date_field
from flatweave.session import partition_directories
from flatweave.sinks.tables import PARTITIONED, SHARDED, current_counts, flat_schema, rows_path
from flatweave.sources.shards import Pair


def schema_differences(left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()) -> list[str]:
    """Columns that only one side has, or that differ in type."""
    kinds = [{f.name: f.dataType for f in side.schema.fields if f.name not in ignore} for side in (left, right)]
    names = sorted(set(kinds[0]) | set(kinds[1]))
    return [name for name in names if kinds[0].get(name) != kinds[1].get(name)]


def as_written(spark: SparkSession, root: str, layout: str, table: str) -> DataFrame:
    """A written table with the columns and types that its files and directories have, not the declared ones."""
    return spark.read.option("mergeSchema", "true").parquet(rows_path(root, layout, table)).drop("version")


def day_is_date(flat: DataFrame, table: str) -> bool:
    """Whether the day column is a DATE; use it on :func:`as_written`, where nothing is declared."""
    return date_field(table) in flat.columns and flat.schema[date_field(table)].dataType == T.DateType()


def written_differences(spark: SparkSession, root: str, table: str) -> list[str]:
    """Columns that differ between the two layouts of a table as written, or from its declaration.

    Directory columns come back as what their names look like, so a shard number is not compared by type.
    """
    written = [as_written(spark, root, layout, table) for layout in (SHARDED, PARTITIONED)]
    declared = spark.createDataFrame([], flat_schema(table))
    places = ("dataset", "shard")
    names = [sorted(set(one.columns) ^ set(declared.columns)) for one in written]
    return sorted({*names[0], *names[1], *schema_differences(*written, ignore=places),
                   *schema_differences(written[1], declared, ignore=places)})


def days_match_partitions(spark: SparkSession, root: str, table: str) -> bool:
    """Whether every directory of the partitioned layout is a day."""
    found = partition_directories(spark, rows_path(root, PARTITIONED, table), ("version", "dataset", date_field(table)))
    days = [values[date_field(table)] for values, _ in found]
    return bool(days) and all(day is None or re.fullmatch(r"\d{4}-\d\d-\d\d", day) for day in days)


def lost_rows(spark: SparkSession, root: str, layout: str, table: str) -> dict[Pair, tuple[int, int]]:
    """Shards whose files have another number of rows than was published, with both numbers; only footers are read."""
    counts = current_counts(spark, root, layout, table)
    return {pair: both for pair, both in counts.items() if both[0] != both[1]}


def layout_differences(spark: SparkSession, root: str, table: str) -> dict[Pair, tuple[int, int]]:
    """Shards with other numbers of rows in the sharded and the partitioned layout, from footers; a missing one has none."""
    sharded, partitioned = (current_counts(spark, root, layout, table) for layout in (SHARDED, PARTITIONED))
    both = {pair: (sharded.get(pair, (0, 0))[1], partitioned.get(pair, (0, 0))[1]) for pair in sharded.keys() | partitioned.keys()}
    return {pair: counts for pair, counts in both.items() if counts[0] != counts[1]}


def count_difference(left: DataFrame, right: DataFrame) -> int:
    return left.count() - right.count()


def day_count_differences(left: DataFrame, right: DataFrame, day: str = "event_date") -> DataFrame:
    """Days whose row counts differ between two tables, a missing day counting 0."""
    a = rows_per_day(left, day).withColumnRenamed("nrow", "left_rows")
    b = rows_per_day(right, day).withColumnRenamed("nrow", "right_rows")
    both = a.withColumnRenamed(day, "__day").join(b, F.col("__day").eqNullSafe(F.col(day)), "full")
    return both.select(
        F.coalesce("__day", day).alias(day),
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
    ).where("left_rows != right_rows")


def repeated_keys(flat: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys that more than one row of a shard carries; NULL keys are not counted."""
    return _rows_per_key(flat, key).where(F.col(key).isNotNull() & (F.col("nrow") > 1))


def key_summary(flat: DataFrame, key: str = "event_id") -> DataFrame:
    """Per shard: rows, rows without a key, distinct keys and keys that repeat."""
    has_key = F.col(key).isNotNull()
    return _rows_per_key(flat, key).groupBy("dataset", "shard").agg(
        F.sum("nrow").alias("rows"),
        F.coalesce(F.sum(F.when(~has_key, F.col("nrow"))), F.lit(0)).alias("without_key"),
        F.count_if(has_key).alias("keys"),
        F.count_if(has_key & (F.col("nrow") > 1)).alias("repeated_keys"),
    )


def _rows_per_key(flat: DataFrame, key: str) -> DataFrame:
    return flat.groupBy("dataset", "shard", key).agg(F.count("*").alias("nrow"))
