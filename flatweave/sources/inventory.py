"""Discovery of datasets from an inventory of tables.

An inventory has the columns ``project, dataset, table_id, creation_time``; the
last is in milliseconds since the epoch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name patterns and the age limit of discovery.
DATASET_PATTERN = r"^analytics_\d+$"
EVENT_TABLE_PATTERN = r"^events.*\d{8}$"
MAX_AGE_DAYS = 30

MILLIS_PER_DAY = 86_400_000


def union_datasets(parts: list[DataFrame]) -> DataFrame:
    """All rows of several datasets; a column one of them lacks is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def analytics_tables(inventory: DataFrame) -> DataFrame:
    """Tables of datasets that hold an analytics property."""
    return inventory.where(F.col("dataset").rlike(DATASET_PATTERN))


def recent_event_tables(inventory: DataFrame, now: Column | None = None, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Event tables created in the last ``max_age_days`` days before ``now`` (a timestamp)."""
    now_millis = F.unix_millis(F.current_timestamp() if now is None else now)
    age = (now_millis - F.col("creation_time")) / MILLIS_PER_DAY
    return inventory.where(F.col("table_id").rlike(EVENT_TABLE_PATTERN) & (age < max_age_days))


def discover_datasets(inventory: DataFrame, now: Column | None = None, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Datasets worth flattening, in name order."""
    recent = recent_event_tables(analytics_tables(inventory), now, max_age_days)
    return recent.select("dataset").distinct().orderBy("dataset")
