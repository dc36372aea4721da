"""Small hand-made exports."""

from pyspark.sql import types as T

from flatweave.schemas import PLACE_FIELDS, SOURCE_SCHEMAS
from flatweave.sources.shards import write_source

DATASET = "analytics_1"


def event(day="20240101", **fields):
    row = {
        "event_date": day,
        "event_timestamp": 1,
        "event_name": "view",
        "stream_id": "s",
        "user_pseudo_id": "u",
        "dataset": DATASET,
        "shard": day,
    }
    return row | fields


def param(key, **value):
    return {"key": key, "value": value}


def frame(spark, source, rows, position=True):
    fields = [*SOURCE_SCHEMAS[source].fields, *PLACE_FIELDS]
    if position:
        rows = [{"row_position": f"r{i}"} | row for i, row in enumerate(rows)]
        fields.append(T.StructField("row_position", T.StringType()))
    return spark.createDataFrame(rows, T.StructType(fields))


def export(spark, root, source, rows):
    """Write rows as an export, replacing the source."""
    write_source(frame(spark, source, rows, position=False), str(root), source)
    return str(root)
