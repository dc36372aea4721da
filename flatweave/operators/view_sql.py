"""SQL text of the same-day views.

A view that outlives the session that made it is kept by the catalog as text.  These views name the shard's directory, so each
read lists it anew and sees the files that are there then.
"""

from __future__ import annotations

from pyspark.sql import types as T

from flatweave import schemas
from flatweave.functions.expressions import SPREAD_BITS, param_text, quoted, spread_text
from flatweave.operators.flatten import EVENT_ARRAYS, element_columns, intraday_event_columns
from flatweave.operators.keys import NO_PSEUDO_ID
from flatweave.operators.numbering import HOT_GROUP_ROWS, SAMPLE_ROWS
from flatweave.schemas import PLACE, has_path

SOURCE = "events_intraday"
ROW_POSITION = "concat_ws('#', _metadata.file_name, _metadata.row_index)"
_KEYS = ("__key0", "__key1", "__key2", "__key3")
_PARTS = ("stream_id", f"coalesce(user_pseudo_id, '{NO_PSEUDO_ID}')", "event_name", "CAST(event_timestamp AS STRING)")


def identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _columns(available: T.StructType) -> list[str]:
    """The export's columns; one that the shard's files lack is NULL."""
    kinds = {field.name: field.dataType.simpleString() for field in schemas.SOURCE_SCHEMAS[SOURCE].fields}
    return [name if name in available.names else f"CAST(NULL AS {kind}) AS {name}" for name, kind in kinds.items()]


def keyed_view_sql(
    path: str,
    dataset: str,
    shard: str,
    available: T.StructType,
    position: str | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> str:
    """Rows of a shard's directory with ``event_id`` in the same-day form.

    The numbers are those of :func:`flatweave.operators.keys.with_event_id`: groups that an even sample shows to be too large for a task
    are numbered in ranges, and the sizes of earlier ranges added.  ``available`` is the schema of the shard's files,
    ``position`` a column that identifies a row, if not its place in its file.
    """
    keys = ", ".join(_KEYS)
    share = min(1.0, SAMPLE_ROWS / hot_rows)
    many = hot_rows if share == 1.0 else 0.75 * hot_rows
    same = " AND ".join("{0}.%s = {1}.%s" % (key, key) for key in _KEYS)
    parts = ", ".join(f"{part} AS {key}" for part, key in zip(_PARTS, _KEYS))
    place = f"{quoted(dataset)} AS dataset, {quoted(shard)} AS shard"
    joined = ", '.', ".join(f"cut.{key}" for key in _KEYS)
    return f"""
WITH placed AS (
  SELECT *, {parts}, {spread_text('__position')} AS __spread, xxhash64(__position) AS __tie
  FROM (SELECT {', '.join(_columns(available))}, {place}, {position or ROW_POSITION} AS __position FROM parquet.{identifier(path)})),
hot AS (
  SELECT {keys}, CAST(greatest(ceil(log2(count(*) / {share}D / {hot_rows}D)), 1) AS INT) AS __bits
  FROM placed WHERE __spread < {int(share * (1 << SPREAD_BITS))}L GROUP BY {keys} HAVING count(*) / {share}D > {many}D),
cut AS (
  SELECT /*+ BROADCAST(hot) */ placed.*, __bits,
    CASE WHEN {' OR '.join(f'placed.{key} IS NULL' for key in _KEYS)} THEN __spread WHEN __bits IS NULL THEN 0L
      ELSE shiftright(__spread, {SPREAD_BITS} - __bits) END AS __cut
  FROM placed LEFT JOIN hot ON {same.format('placed', 'hot')}),
earlier AS (
  SELECT {keys}, __cut,
    sum(__rows) OVER (PARTITION BY {keys} ORDER BY __cut ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS __before
  FROM (SELECT {keys}, __cut, count(*) AS __rows FROM cut WHERE __bits IS NOT NULL GROUP BY {keys}, __cut))
SELECT {', '.join(f'cut.{name}' for name in (*schemas.SOURCE_SCHEMAS[SOURCE].names, *PLACE))},
  concat({joined}, '.', CAST(
    row_number() OVER (PARTITION BY {', '.join(f'cut.{key}' for key in _KEYS)}, cut.__cut ORDER BY __spread, __tie)
    + coalesce(__before, 0L) AS STRING)) AS event_id
FROM cut LEFT JOIN earlier ON {same.format('cut', 'earlier')} AND cut.__cut = earlier.__cut"""


def flat_view_sql(keyed_view: str, available: T.StructType, table: str, shard: str) -> str:
    """A same-day flat table of a keyed view (its name as SQL) with the given schema."""
    if table == "events":
        known = has_path(available["event_params"].dataType.elementType, "value.int_value")
        sessions = ", ".join(
            f"concat(user_pseudo_id, '.', CAST({param_text('event_params', param) if known else 'NULL'} AS STRING)) AS {name}"
            for name, param in (("session_id", "ga_session_id"), ("session_id_1", "ga_session_number"))
        )
        columns = intraday_event_columns(available, shard, SOURCE)
        return f"SELECT {', '.join(columns)} FROM (SELECT *, {sessions} FROM {keyed_view})"
    if table not in EVENT_ARRAYS:
        raise ValueError(f"no same-day view of {table}")
    array, element = EVENT_ARRAYS[table]
    columns = element_columns(table, SOURCE, available[array].dataType.elementType, raw_values=False)
    rows = f"SELECT {', '.join(PLACE)}, event_date, event_id, explode({array}) AS {element} FROM {keyed_view}"
    return f"SELECT {', '.join(columns)} FROM ({rows})"
