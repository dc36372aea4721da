"""Generated keys: event ids, row ids and session ids."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.functions.expressions import id_text, param_value, shard_date
from flatweave.operators.numbering import number_rows
from flatweave.schemas import PLACE

NO_PSEUDO_ID = "user_pseudo_id_null"
KEY_COLUMNS = (
    "stream_id",
    "user_pseudo_id",
    "event_name",
    "event_timestamp",
    "batch_event_index",
    "batch_page_id",
    "batch_ordering_id",
)

_NUMBER = "__number"
# A broadcast may have so many rows; above that, rows and numbers are shuffled.
MOST_BROADCAST = 500_000
_CUTS, _PART = "__cuts", "__part"


def _optional(df: DataFrame, name: str) -> Column:
    """A column as text with NULL, or absence, as the empty string."""
    if name not in df.columns:
        return F.lit("")
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _daily_parts(df: DataFrame) -> list[Column]:
    return [
        F.col("stream_id"),
        _optional(df, "user_pseudo_id"),
        F.col("event_name"),
        F.col("event_timestamp").cast("string"),
        _optional(df, "batch_event_index"),
        _optional(df, "batch_page_id"),
        _optional(df, "batch_ordering_id"),
    ]


def _joined(parts: list[Column], separator: str) -> Column:
    """Concatenation that is NULL if any part is (``concat_ws`` would skip it)."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(separator), part]
    return F.concat(*pieces)


def _event_key(events: DataFrame, intraday_view: bool) -> tuple[list[Column], list[Column], str]:
    """Parts of the id, keys of the groups whose rows are numbered, and the separator."""
    if not intraday_view:
        parts = _daily_parts(events)
        return parts, [F.concat(*parts)], "_"
    parts = [
        F.col("stream_id"),
        F.coalesce("user_pseudo_id", F.lit(NO_PSEUDO_ID)),
        F.col("event_name"),
        F.col("event_timestamp").cast("string"),
    ]
    return parts, parts, "."


def repeat_numbers(
    events: DataFrame, intraday_view: bool = False, position: str = "row_position", **numbering
) -> DataFrame:
    """``dataset, shard``, position and number of the rows that are not the first of their group.

    Reads and shuffles the key columns only.  Events rarely agree on their whole
    key, so this is usually a small part of the input.
    """
    _, keys, _ = _event_key(events, intraday_view)
    narrow = events.select(*PLACE, position, *[name for name in KEY_COLUMNS if name in events.columns])
    numbered = number_rows(narrow, keys, _NUMBER, position=position, **numbering)
    return numbered.where(F.col(_NUMBER) > 1).select(*PLACE, position, _NUMBER)


def shard_cuts(events: DataFrame, tasks: int) -> DataFrame:
    """Into how many parts the rows of a shard are cut to spread over so many tasks: dataset, shard, ``__cuts``.

    Counts rows without reading a column.  A row for each shard comes to the driver, as few as the directories that a scan lists.
    """
    sizes = events.groupBy(*PLACE).agg(F.count("*").alias("n")).collect()
    part = max(1, sum(row.n for row in sizes) // (2 * tasks))
    schema = f"dataset string, shard string, {_CUTS} long"
    return events.sparkSession.createDataFrame([(row.dataset, row.shard, ceil(row.n / part)) for row in sizes], schema)


def _by_parts(rows: DataFrame, cuts: DataFrame, position: str, tasks: int) -> DataFrame:
    # One column names the part, so that both sides are dealt alike whatever Spark finds out about the others.
    part = F.xxhash64(*PLACE, F.pmod(F.xxhash64(position), F.coalesce(_CUTS, F.lit(1))))
    parts = rows.join(F.broadcast(cuts), list(PLACE), "left").withColumn(_PART, part).drop(_CUTS)
    return parts.repartition(tasks, _PART)


def with_event_id(
    events: DataFrame,
    intraday_view: bool = False,
    position: str = "row_position",
    repeats: DataFrame | None = None,
    parts: tuple[DataFrame, int] | None = None,
    **numbering,
) -> DataFrame:
    """Add ``event_id`` to nested events.

    The daily form joins seven parts with ``_`` and numbers rows that agree on the
    parts put together *without* a separator.  The same-day view form joins four
    parts with ``.`` and numbers rows that agree on each.  Either is NULL where the
    stream, name or timestamp is NULL.

    Only the key columns are shuffled to be numbered.  The numbers, those given as ``repeats`` (a result of
    :func:`repeat_numbers`) or else made when the rows are read, are joined to the rows: by broadcast if
    Spark sees that they are small, else with one shuffle of the rows.

    With ``parts`` (a result of :func:`shard_cuts` and the number of its tasks) there is such a shuffle, by shard and a part of
    it; the rows are looked up in the numbers and are not sorted.  Where :data:`flatweave.session.BY_ALL_KEYS` is off, a task has the
    rows of few shards, and so writes few files.
    """
    pieces, _, separator = _event_key(events, intraday_view)
    if repeats is None:
        repeats = repeat_numbers(events, intraday_view, position, **numbering)
    if parts is None:
        numbered = events.join(repeats, [*PLACE, position], "left")
    else:
        cuts, tasks = parts
        few = _by_parts(repeats, cuts, position, tasks).hint("shuffle_hash")
        numbered = _by_parts(events, cuts, position, tasks).join(few, [_PART, *PLACE, position], "left")
    numbered = numbered.select(*events.columns, F.coalesce(_NUMBER, F.lit(1)).alias(_NUMBER))
    event_id = _joined([*pieces, F.col(_NUMBER).cast("string")], separator)
    return numbered.withColumn("event_id", event_id).drop(_NUMBER)


def session_id(param: str, separator: str = "_", strict: bool = False) -> Column:
    """User and session parameter joined; NULL if either is missing."""
    value = param_value("event_params", param, strict=strict).cast("string")
    return F.concat(F.col("user_pseudo_id"), F.lit(separator), value)


def session_ids(separator: str = "_", strict: bool = False) -> dict[str, Column]:
    return {
        "session_id": session_id("ga_session_id", separator, strict),
        "session_id_1": session_id("ga_session_number", separator, strict),
    }


def with_row_id(users: DataFrame, source: str, position: str = "row_position", random: bool = False) -> DataFrame:
    """Add ``row_id`` and the shard's ``date`` to a user export.

    The id is derived from the row's place in the source, so children computed in
    separate jobs agree with their parent.  ``random`` draws a new id per row;
    stage the result before reading it more than once.
    """
    row_id = F.uuid() if random else id_text(F.lit(source), "dataset", "shard", F.col(position).cast("string"))
    return users.withColumns({"row_id": row_id, "date": shard_date("shard")})
