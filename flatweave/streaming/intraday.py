"""Same-day data: views that read it live, and flat tables refreshed on a timer."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flatweave import schemas
from flatweave.operators.flatten import (
    flat_event_params,
    flat_items,
    flat_user_properties,
    intraday_events,
)
from flatweave.operators.numbering import HOT_GROUP_ROWS
from flatweave.operators.view_sql import flat_view_sql, identifier, keyed_view_sql
from flatweave.plans.flatten_job import flatten_work
from flatweave.plans.work import route
from flatweave.schemas import PLACE, SOURCE_SCHEMAS
from flatweave.session import child_names, setting
from flatweave.sources.messages import decode_messages, parse_lifecycle
from flatweave.sources.shards import shard_paths

SOURCE = "events_intraday"
# The state of views is one small row a shard.
STATE_PARTITIONS = 8
STATEMENTS_AT_ONCE = 8


# ---- Views -----------------------------------------------------------------------


def intraday_table(keyed: DataFrame, table: str, shard: str | None = None) -> DataFrame:
    """A same-day flat table of rows keyed in the view form."""
    if table == "events":
        return intraday_events(keyed, shard)
    if table == "event_params":
        return flat_event_params(keyed, SOURCE, raw_values=False)
    if table == "user_properties":
        return flat_user_properties(keyed, SOURCE)
    if table == "items":
        return flat_items(keyed, SOURCE)
    raise ValueError(f"no same-day view of {table}")


def keyed_view_name(dataset: str, shard: str) -> str:
    return f"{dataset}_view_events_{shard}_unique_pk"


def view_name(dataset: str, table: str, shard: str) -> str:
    return f"{dataset}_view_flat_{table}_{shard}"


def _qualified(database: str, name: str) -> str:
    return f"{identifier(database)}.{identifier(name)}"


def create_views(
    spark: SparkSession,
    source_root: str,
    dataset: str,
    shard: str,
    tables: list[str],
    database: str = "default",
    position: str | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> list[str]:
    """Create or replace the keyed view of a shard and a flat view per table over it, in a database of the catalog.

    The catalog keeps them as SQL text, so they outlive the session if the catalog does.  They are no copies: a query lists and
    reads the shard's directory.  A shard without any file gets no views.  The catalog allows letters, digits and ``_`` in the
    name of a dataset.
    """
    path = shard_paths(spark, source_root, SOURCE, pairs=[(dataset, shard)]).get((dataset, shard))
    if path is None or not any(name[0] not in "._" for name in child_names(spark, path)):
        return []
    keyed_name = keyed_view_name(dataset, shard)
    keyed = _qualified(database, keyed_name)
    available = spark.read.parquet(path).schema
    text = keyed_view_sql(path, dataset, shard, available, position, hot_rows)
    spark.sql(f"CREATE OR REPLACE VIEW {keyed} AS {text}")
    available = T.StructType([f for f in available.fields if f.name in SOURCE_SCHEMAS[SOURCE].names])
    missing = [f for f in SOURCE_SCHEMAS[SOURCE].fields if f.name not in available.names]
    available = T.StructType([*available.fields, *missing])
    names = [keyed_name]
    for table in tables:
        if table in schemas.EVENT_TABLES:
            name = view_name(dataset, table, shard)
            text = flat_view_sql(keyed, available, table, shard)
            spark.sql(f"CREATE OR REPLACE VIEW {_qualified(database, name)} AS {text}")
            names.append(name)
    return names


def drop_views(spark: SparkSession, dataset: str, shard: str, database: str = "default") -> None:
    """Drop both layers of a shard's views, those that exist."""
    names = [view_name(dataset, table, shard) for table in schemas.EVENT_TABLES]
    for name in [*names, keyed_view_name(dataset, shard)]:
        spark.sql(f"DROP VIEW IF EXISTS {_qualified(database, name)}")


def existing_views(spark: SparkSession, database: str = "default") -> list[str]:
    """Names of the views of a database, in order."""
    rows = spark.sql(f"SHOW VIEWS IN {identifier(database)}").where("NOT isTemporary").select("viewName").collect()
    return sorted(row.viewName for row in rows)


def latest_actions(messages: DataFrame) -> DataFrame:
    """The last creation or deletion of each same-day shard, and its time; of two at one time the deletion counts."""
    events = parse_lifecycle(messages).where("valid")
    last = F.max(F.struct("logged_at", "action"))  # "delete" is greater than "create"
    latest = events.groupBy(*PLACE).agg(last.alias("last"))
    return latest.select(*PLACE, "last.action", "last.logged_at")


def manage_views(
    messages: DataFrame,
    control: DataFrame,
    source_root: str,
    checkpoint: str,
    database: str = "default",
    trigger: dict | None = None,
    state_partitions: int = STATE_PARTITIONS,
    **views,
) -> StreamingQuery:
    """Start a stream that keeps the views of a database in step with creations and deletions.

    The last action of each shard and its time are state of the stream, one key a shard, kept in its checkpoint: an action older than
    the last one is ignored, in whichever batch and after however many restarts it comes.  Datasets outside the control table are
    ignored; ``intraday_views`` decides whether a creation makes views, a deletion always drops them.  The creation of a
    shard that does not exist any more makes none.  A batch that is run again does no harm.  ``state_partitions`` holds from a
    checkpoint's first start on.
    """
    spark = messages.sparkSession

    def apply(batch: DataFrame, _batch_id: int) -> None:
        on = F.coalesce("intraday_views", F.lit(True))
        wanted = batch.join(control, "dataset").select(*PLACE, "action", "tables_to_flatten", on.alias("on"))
        # Views are made by statements of the driver; one row for each shard that messages of this batch name.

        def follow(row: Row) -> None:
            if row.action == "delete":
                drop_views(spark, row.dataset, row.shard, database)
            elif row.on:
                create_views(spark, source_root, row.dataset, row.shard, row.tables_to_flatten, database, **views)

        # Most of a statement's time goes into looking at the shard's files; shards do not depend on each other.
        with ThreadPoolExecutor(max_workers=STATEMENTS_AT_ONCE) as pool:
            list(pool.map(inheritable_thread_target(spark)(follow), wanted.collect()))

    # A stream keeps the settings it is started with.
    with setting(spark, "spark.sql.shuffle.partitions", str(state_partitions)):
        return (
            latest_actions(decode_messages(messages))
            .writeStream.outputMode("update")
            .foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


# ---- Timed refresh ------------------------------------------------------------------


def refresh_interval(frequency: int, units: str) -> str:
    """A trigger interval; minutes go from 1 to 59, hours are whole hours."""
    if units not in ("minutes", "hours"):
        raise ValueError("the units of a refresh are minutes or hours")
    if units == "minutes" and not 1 <= frequency <= 59:
        raise ValueError("a refresh in minutes takes 1 to 59")
    if frequency < 1:
        raise ValueError("a refresh takes a positive number of hours")
    return f"{frequency} {units}"


Control = DataFrame | Callable[[], DataFrame]


def _ticks(spark: SparkSession, at_tick: Callable[[int], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    """A stream that calls ``at_tick`` with the number of the tick, which goes on from the checkpoint after a restart."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    run = ticks.writeStream.foreachBatch(lambda _batch, number: at_tick(number))
    return run.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _refresh(spark: SparkSession, control: DataFrame, source_root: str, out_root: str, job: dict) -> None:
    """Flatten the same-day shards of the control table's datasets whose files have changed since they were flattened."""
    names = [row.dataset for row in control.select("dataset").distinct().collect()]  # the configured datasets
    present = sorted(shard_paths(spark, source_root, SOURCE, datasets=names))
    arrivals = spark.createDataFrame(present, "dataset string, shard string").withColumn("source", F.lit(SOURCE))
    flatten_work(spark, route(arrivals, control), source_root, out_root, changed_only=True, **job)


def refresh_intraday(
    spark: SparkSession,
    control: Control,
    source_root: str,
    out_root: str,
    checkpoint: str,
    frequency: int | None = None,
    units: str = "hours",
    **job,
) -> StreamingQuery:
    """Start a stream that brings the flat tables of same-day shards up to date at each tick.

    At each tick the files of the shards that exist are listed, and those shards are flattened, whole, of which a file was added, removed or
    written again since a flat table was made of them; that is known from the flat tables themselves.  A shard with a daily
    export is left alone.  ``control`` may be a function, which is then asked at each tick.  Without ``frequency`` there is one tick.
    """
    trigger = {"availableNow": True} if frequency is None else {"processingTime": refresh_interval(frequency, units)}

    # The work is done by the session that the stream was started from: a stream's own plans without adaptive execution.
    def at_tick(_number: int) -> None:
        _refresh(spark, control() if callable(control) else control, source_root, out_root, job)

    return _ticks(spark, at_tick, checkpoint, trigger)


def scheduled(control: DataFrame, tick: int) -> tuple[DataFrame, list[str]]:
    """Rows of the control table that are due at a tick (ticks are minutes), and datasets whose schedule is none."""
    frequency, units = F.col("frequency"), F.col("units")
    minutes = F.when((units == "minutes") & frequency.between(1, 59), frequency)
    minutes = minutes.when((units == "hours") & (frequency >= 1), frequency * 60)
    rows = control.where(frequency.isNotNull()).withColumn("__minutes", minutes)
    wrong = [row.dataset for row in rows.where("__minutes IS NULL").select("dataset").collect()]
    return rows.where((F.lit(tick) % F.col("__minutes")) == 0).drop("__minutes"), sorted(wrong)


def refresh_on_schedule(
    spark: SparkSession,
    control: Control,
    source_root: str,
    out_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    **job,
) -> StreamingQuery:
    """Start one stream that refreshes every dataset of the control table by its own schedule.

    It ticks once a minute.  At each tick the control table is read (``control`` may be a function, which reads it anew), and
    the datasets are refreshed whose period divides the number of the tick, so a changed, new or removed schedule needs
    no restart.  A dataset without a schedule is not refreshed.  A schedule that is none is an error at the start, and later
    leaves its dataset out, with a warning.
    """

    def current() -> DataFrame:
        return control() if callable(control) else control

    wrong = scheduled(current(), 0)[1]
    if wrong:
        raise ValueError(f"a refresh takes 1 to 59 minutes or whole hours: {', '.join(wrong)}")

    def at_tick(number: int) -> None:
        due, wrong = scheduled(current(), number)
        if wrong:
            logging.getLogger(__name__).warning("no schedule that can be kept: %s", ", ".join(wrong))
        _refresh(spark, due, source_root, out_root, job)

    return _ticks(spark, at_tick, checkpoint, trigger or {"processingTime": "1 minute"})
