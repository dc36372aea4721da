"""Flatten shards as messages announce them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flatweave.plans.flatten_job import flatten_work
from flatweave.plans.work import route
from flatweave.sources.messages import decode_messages, parse_arrivals, parse_lifecycle


def read_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages dropped as JSON files, one object with base64 ``data`` per line."""
    reader = spark.readStream.schema("data string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def flatten_on_arrival(
    messages: DataFrame,
    control: DataFrame,
    source_root: str,
    out_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    **job,
) -> StreamingQuery:
    """Start a stream that flattens every shard a message announces.

    ``messages`` is any stream with a base64 ``data`` column.  A shard is always
    recomputed whole and replaced, so a repeated or replayed message is harmless.
    Messages that name no known table are left to :func:`record_rejected`.
    """
    # A stream's own session plans without adaptive execution; the job needs it.
    spark = messages.sparkSession

    def flatten_batch(batch: DataFrame, _batch_id: int) -> None:
        arrivals = parse_arrivals(decode_messages(batch)).where("valid")
        flatten_work(spark, route(arrivals, control), source_root, out_root, **job)

    return (
        messages.writeStream.foreachBatch(flatten_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# How the messages of each kind are read.
PARSERS = {"arrival": parse_arrivals, "lifecycle": parse_lifecycle}


def rejected_messages(messages: DataFrame, kind: str) -> DataFrame:
    """Messages that are no ``arrival``, or no ``lifecycle`` message: kind, data, message (its text, if it has one), reason."""
    parsed = PARSERS[kind](decode_messages(messages)).where("NOT valid")
    return parsed.select(F.lit(kind).alias("kind"), "data", "message", "reason")


def record_rejected(
    messages: DataFrame, kind: str, folder: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start a stream that keeps the messages which the other streams leave out, each once, in Parquet files."""
    return (
        rejected_messages(messages, kind)
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
