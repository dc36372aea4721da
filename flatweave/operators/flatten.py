"""The flat tables: struct fields become columns, array elements become rows.

Every function takes rows that already carry their key and returns the flat
table's columns, preceded by ``dataset`` and ``shard``.  ``explode`` gives no row
for a NULL or empty array.  Select lists are SQL text: the wide tables have some
150 columns, and text crosses to the JVM in one call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave import schemas
from flatweave.functions.expressions import field_or_null, text_value
from flatweave.operators.keys import KEY_COLUMNS, session_ids
from flatweave.schemas import PLACE

EVENT_HEAD = [*PLACE, "to_date(event_date, 'yyyyMMdd') AS event_date", "event_id"]


def _leaves(df: DataFrame, schema, skip: tuple[str, ...] = ()) -> list[str]:
    available = df.schema
    return [
        f"{field_or_null(available, path, dtype)} AS {path.replace('.', '_')}"
        for path, dtype in schemas.leaf_paths(schema)
        if path not in skip
    ]


def _tag(source: str) -> str:
    return f"'{'intraday' if schemas.is_intraday(source) else 'daily'}' AS source_table_type"


# ---- Events ----------------------------------------------------------------------


def flat_events(keyed: DataFrame, source: str = "events", strict: bool = False) -> DataFrame:
    if "session_id" not in keyed.columns:
        keyed = keyed.withColumns(session_ids(strict=strict))
    leaves = _leaves(keyed, schemas.EVENTS, skip=("event_date",))
    return keyed.selectExpr(*EVENT_HEAD, "session_id", "session_id_1", *leaves, _tag(source))


def intraday_event_columns(available: T.StructType, shard: str | None = None, source: str = "events_intraday") -> list[str]:
    """Select list of the same-day event table; see :func:`intraday_events`."""
    columns = []
    for path, dtype in schemas.leaf_paths(schemas.EVENTS):
        top, _, leaf = path.partition(".")
        since = None
        if top == "collected_traffic_source":
            if leaf not in schemas.INTRADAY_COLLECTED_TRAFFIC:
                continue
            since = schemas.COLLECTED_TRAFFIC_SINCE
        elif top == "is_active_user":
            since = schemas.ACTIVE_USER_SINCE
        elif top in schemas.DAILY_ONLY or path == "event_date":
            continue
        value = field_or_null(available, path, dtype)
        if since is not None:
            if shard is not None and shard < since:
                continue
            if shard is None:
                value = f"CASE WHEN shard >= '{since}' THEN {value} END"
        columns.append(f"{value} AS {path.replace('.', '_')}")
    return [*EVENT_HEAD, "session_id", "session_id_1", *columns, _tag(source)]


def intraday_events(keyed: DataFrame, shard: str | None = None, source: str = "events_intraday") -> DataFrame:
    """Same-day event table.

    With ``shard`` the columns are those that shard's export has.  Without it, rows
    of all shards get all columns, NULL where the row's shard predates a column.
    """
    schema = keyed.schema
    if "session_id" not in keyed.columns:
        keyed = keyed.withColumns(session_ids(separator="."))
    return keyed.selectExpr(*intraday_event_columns(schema, shard, source))


# ---- Event arrays: a row for each element ------------------------------------------

# Array and name of the element of each table.
EVENT_ARRAYS = {"event_params": ("event_params", "p"), "user_properties": ("user_properties", "p"), "items": ("items", "items")}


def element_columns(table: str, source: str, element: T.DataType, raw_values: bool = True) -> list[str]:
    """Select list of a table over exploded elements of the given type; fields that it lacks are NULL."""
    name = EVENT_ARRAYS[table][1]
    available = T.StructType([T.StructField(name, element)])

    def field(path: str, kind: T.DataType) -> str:
        return field_or_null(available, f"{name}.{path}", kind)

    if table == "event_params":
        columns = [f"{field('key', T.StringType())} AS event_params_key", f"{text_value('p.value', available)} AS event_params_value"]
        if raw_values:
            columns += [
                f"{field('value.string_value', T.StringType())} AS event_params_string_value",
                f"{field('value.int_value', T.LongType())} AS event_params_int_value",
            ]
    elif table == "user_properties":
        columns = [
            f"{field('key', T.StringType())} AS user_properties_key",
            f"{text_value('p.value', available)} AS user_properties_value",
            f"{field('value.set_timestamp_micros', T.LongType())} AS user_properties_value_set_timestamp_micros",
        ]
    else:
        leaves = schemas.leaf_paths(schemas.EVENTS["items"].dataType.elementType)
        columns = [f"{field(leaf, dtype)} AS items_{leaf}" for leaf, dtype in leaves]
    return [*EVENT_HEAD, *columns, _tag(source)]


def _one_per(keyed: DataFrame, array: str, element: str, *keep: str) -> DataFrame:
    return keyed.select(*keep, F.explode(array).alias(element))


def _elements(keyed: DataFrame, table: str, source: str, raw_values: bool = True) -> DataFrame:
    array, element = EVENT_ARRAYS[table]
    rows = _one_per(keyed, array, element, *PLACE, "event_date", "event_id")
    return rows.selectExpr(*element_columns(table, source, rows.schema[element].dataType, raw_values))


def flat_event_params(keyed: DataFrame, source: str = "events", raw_values: bool = True) -> DataFrame:
    return _elements(keyed, "event_params", source, raw_values)


def flat_user_properties(keyed: DataFrame, source: str = "events") -> DataFrame:
    return _elements(keyed, "user_properties", source)


def flat_items(keyed: DataFrame, source: str = "events") -> DataFrame:
    return _elements(keyed, "items", source)


# ---- Users and pseudonymous users --------------------------------------------------


def _user_table(keyed: DataFrame, schema) -> DataFrame:
    return keyed.selectExpr(*PLACE, "row_id", "date", *_leaves(keyed, schema))


def _user_properties(keyed: DataFrame, user: str) -> DataFrame:
    rows = _one_per(keyed, "user_properties", "p", *PLACE, "row_id", "date", user)
    return rows.selectExpr(
        *PLACE,
        "row_id",
        "date",
        user,
        "p.key AS user_property_key",
        "p.value.string_value AS user_property_value",
        "p.value.set_timestamp_micros AS user_property_set_timestamp_micros",
        "p.value.user_property_name AS user_property_name",
    )


def _user_audiences(keyed: DataFrame, user: str) -> DataFrame:
    rows = _one_per(keyed, "audiences", "a", *PLACE, "row_id", "date", user)
    fields = schemas.USERS["audiences"].dataType.elementType.names
    return rows.selectExpr(*PLACE, "row_id", "date", user, *[f"a.{name} AS audience_{name}" for name in fields])


def flat_pseudo_users(keyed: DataFrame) -> DataFrame:
    return _user_table(keyed, schemas.PSEUDO_USERS)


def flat_pseudo_user_properties(keyed: DataFrame) -> DataFrame:
    return _user_properties(keyed, "pseudo_user_id")


def flat_pseudo_user_audiences(keyed: DataFrame) -> DataFrame:
    return _user_audiences(keyed, "pseudo_user_id")


def flat_users(keyed: DataFrame) -> DataFrame:
    return _user_table(keyed, schemas.USERS)


def flat_users_user_properties(keyed: DataFrame) -> DataFrame:
    return _user_properties(keyed, "user_id")


def flat_users_user_audiences(keyed: DataFrame) -> DataFrame:
    return _user_audiences(keyed, "user_id")


# ---- Lookup --------------------------------------------------------------------------

_EVENT_FLATTENERS: dict[str, Callable[..., DataFrame]] = {
    "events": flat_events,
    "event_params": flat_event_params,
    "user_properties": flat_user_properties,
    "items": flat_items,
}

_USER_FLATTENERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "pseudo_users": flat_pseudo_users,
    "pseudo_user_properties": flat_pseudo_user_properties,
    "pseudo_user_audiences": flat_pseudo_user_audiences,
    "users": flat_users,
    "users_user_properties": flat_users_user_properties,
    "users_user_audiences": flat_users_user_audiences,
}


def flatten_table(keyed: DataFrame, table: str, source: str) -> DataFrame:
    """The flat table ``flat_<table>`` of keyed source rows."""
    if table not in schemas.TABLES_OF_SOURCE[source]:
        raise ValueError(f"{source} does not feed flat_{table}")
    if table in _EVENT_FLATTENERS:
        return _EVENT_FLATTENERS[table](keyed, source)
    return _USER_FLATTENERS[table](keyed)


def columns_needed(tables: list[str], source: str) -> list[str]:
    """Source columns the given flat tables read, keys included.

    Narrows the rows *before* the key shuffle and the staged copy.
    """
    schema = schemas.SOURCE_SCHEMAS[source]
    arrays = [field.name for field in schema.fields if field.dataType.typeName() == "array"]
    scalars = [field.name for field in schema.fields if field.name not in arrays]
    parents = {"events", "pseudo_users", "users"}
    if source.startswith("events"):
        needed = {"event_date", *KEY_COLUMNS}
        owner = {"event_params": "event_params", "user_properties": "user_properties", "items": "items"}
    else:
        needed = {"user_id"} if source == "users" else {"pseudo_user_id"}
        owner = {table: "audiences" if table.endswith("audiences") else "user_properties" for table in tables}
    for table in tables:
        if table in parents:
            needed.update(scalars)
            if table == "events":
                needed.add("event_params")
        else:
            needed.add(owner[table])
    return [name for name in schema.names if name in needed]
