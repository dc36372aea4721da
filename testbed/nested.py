"""Nested exports derived from the driver's tables.

The scalar expressions are plain SQL that Spark and DuckDB read alike: Spark puts
their values into structs and arrays here, the oracles put them straight into flat
columns.  An event is one row, except that a purchase with line items becomes one
row per line item, so that no array grows with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave import schemas
from flatweave.schemas import PLACE
from flatweave.session import setting, shared_folder
from flatweave.sources.shards import cluster, read_source, write_source

SOURCE_ROW = T.StructField("source_row", T.StringType())
USER_SHARD = "20240131"

# ---- Scalar values, shared text ------------------------------------------------------

DATASET = "'analytics_' || CAST(100000001 + user_id % 3 AS STRING)"
SHARD = "replace(substr(CAST(ts AS STRING), 1, 10), '-', '')"
EVENT_ROW = (
    "CAST(event_id AS STRING) || '.' || coalesce(CAST(l_partkey AS STRING) || '.' || CAST(l_suppkey AS STRING)"
    " || '.' || CAST(l_linenumber AS STRING), '')"
)

EVENT_VALUES = {
    "event_date": SHARD,
    "event_timestamp": "day_micros",
    "event_name": "event_type",
    "event_previous_timestamp": "CASE WHEN event_id % 7 = 0 THEN ts_micros - 1000000 END",
    "event_value_in_usd": "value",
    "event_bundle_sequence_id": "event_id",
    "user_id": "CASE WHEN event_id % 5 = 0 THEN CAST(user_id AS STRING) END",
    "user_pseudo_id": "CASE WHEN event_id % 13 <> 0 THEN 'u' || CAST(user_id AS STRING) END",
    "stream_id": "CASE WHEN event_id % 101 <> 0 THEN 'stream' || CAST(user_id % 3 AS STRING) END",
    "geo.country": "n_name",
    "geo.continent": "r_name",
    "ecommerce.total_item_quantity": "CAST(l_quantity AS BIGINT)",
    "ecommerce.purchase_revenue": "o_totalprice",
    "ecommerce.unique_items": "CASE WHEN l_partkey IS NOT NULL THEN CAST(1 AS BIGINT) END",
    "ecommerce.transaction_id": "CAST(o_orderkey AS STRING)",
    "batch_event_index": "CASE WHEN event_id % 4 = 0 THEN user_id % 5 END",
    "batch_page_id": "CAST(NULL AS BIGINT)",
    "batch_ordering_id": "CASE WHEN event_id % 10 = 0 THEN CAST(1 AS BIGINT) END",
}

ITEM_VALUES = {
    "item_id": "'p' || CAST(l_partkey AS STRING)",
    "item_name": "p_name",
    "item_brand": "p_brand",
    "item_category": "p_type",
    "price": "l_extendedprice / l_quantity",
    "quantity": "CAST(l_quantity AS BIGINT)",
    "item_revenue": "l_extendedprice * (1 - l_discount)",
    "item_refund": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice END",
}
REFUND_VALUES = {
    "item_id": "'r' || CAST(l_partkey AS STRING)",
    "quantity": "0 - CAST(l_quantity AS BIGINT)",
    "item_refund": "l_extendedprice",
}

# Parameters: name, value field, value, condition under which the entry exists.
PARAMS = (
    ("ga_session_id", "int_value", "day_micros / 86400000000", "event_id % 9 <> 0"),
    ("ga_session_number", "int_value", "user_id % 7 + 1", "event_id % 10 <> 3"),
    ("value", "double_value", "value", "event_id % 2 = 0"),
    ("value", "float_value", "value + 1", "event_id % 2 = 1"),
    ("props", "string_value", "props", "1 = 1"),
    ("props", "int_value", "event_id", "event_id % 17 = 0"),
    ("empty", None, None, "event_id % 19 = 0"),
)
HAS_PARAMS = "event_id % 11 <> 0"

PROPERTIES = (
    ("segment", "string_value", "c_mktsegment", "c_custkey IS NOT NULL"),
    ("nation", "int_value", "CAST(c_nationkey AS BIGINT)", "c_custkey IS NOT NULL"),
    ("balance", "double_value", "c_acctbal", "c_custkey IS NOT NULL"),
)
HAS_PROPERTIES = "event_id % 6 <> 0"

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

USER_VALUES = {
    "user_id": "CAST(c_custkey AS STRING)",
    "user_info.last_active_timestamp_micros": "last_micros",
    "user_info.user_first_touch_timestamp_micros": "first_micros",
    "geo.country": "n_name",
    "geo.continent": "r_name",
    "user_ltv.revenue_in_usd": "revenue",
    "user_ltv.purchases": "purchases",
    "occurrence_date": "'20240131'",
    "last_updated_date": "CASE WHEN c_custkey % 2 = 0 THEN '20240131' ELSE '20240130' END",
}
PSEUDO_VALUES = {
    "pseudo_user_id": "'u' || CAST(user_id AS STRING)",
    "stream_id": "'stream' || CAST(user_id % 3 AS STRING)",
    "user_info.last_active_timestamp_micros": "last_micros",
    "user_info.user_first_touch_timestamp_micros": "first_micros",
    "user_ltv.revenue_in_usd": "revenue",
    "user_ltv.purchases": "n_purchase",
    "user_ltv.sessions": "sessions",
    "occurrence_date": "last_day",
    "last_updated_date": "last_day",
}


def filler(path: str, index: int, dtype: T.DataType, row: str, label: str) -> str:
    """A value for a leaf that has no better one, different for every leaf."""
    kind = dtype.typeName()
    if kind == "boolean":
        return f"{row} % 2 = 0"
    value = {
        "string": f"{label} || '{index}'",
        "long": f"{row} * 1000 + {index}",
        "double": f"{row} + {index}.5",
    }[kind]
    return f"CASE WHEN ({row} + {index}) % 3 = 0 THEN {value} END"


def leaf_values(schema: T.StructType, given: dict[str, str], row: str, label: str) -> dict[str, str]:
    """SQL text for every scalar leaf of a schema, by path."""
    return {
        path: given[path] if path in given else filler(path, index, dtype, row, label)
        for index, (path, dtype) in enumerate(schemas.leaf_paths(schema))
    }


ITEM_SCHEMA = schemas.EVENTS["items"].dataType.elementType
EVENT_LEAVES = leaf_values(schemas.EVENTS, EVENT_VALUES, "event_id", "event_type")
ITEM_LEAVES = leaf_values(ITEM_SCHEMA, ITEM_VALUES, "l_partkey", "l_linestatus")
REFUND_LEAVES = {name: REFUND_VALUES.get(name, "NULL") for name in ITEM_SCHEMA.names}
USER_LEAVES = leaf_values(schemas.USERS, USER_VALUES, "c_custkey", "c_mktsegment")
PSEUDO_LEAVES = leaf_values(schemas.PSEUDO_USERS, PSEUDO_VALUES, "user_id", "'u'")

# ---- Nested columns -------------------------------------------------------------------


def _struct(schema: T.StructType, values: dict[str, str], prefix: str = "") -> list[tuple[str, str]]:
    """Name and SQL text of a schema's scalar and struct fields, filled from leaf values."""
    columns = []
    for field in schema.fields:
        path = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            inner = _struct(field.dataType, values, path + ".")
            columns.append((field.name, _named(inner)))
        elif not isinstance(field.dataType, T.ArrayType):
            columns.append((field.name, f"CAST({values[path]} AS {field.dataType.simpleString()})"))
    return columns


def _named(fields: list[tuple[str, str]]) -> str:
    return f"named_struct({', '.join(f'{chr(39)}{name}{chr(39)}, {text}' for name, text in fields)})"


def _columns(fields: list[tuple[str, str]]) -> list[str]:
    return [f"{text} AS {name}" for name, text in fields]


def _entries(entries: list[tuple[str, str]]) -> str:
    """SQL text of an array of the structs whose condition holds, from ``(condition, struct)``."""
    built = ", ".join(f"CASE WHEN {condition} THEN {struct} END" for condition, struct in entries)
    return f"filter(array({built}), entry -> entry IS NOT NULL)"


def _key_values(array: T.ArrayType, entries, micros: str | None = None) -> str:
    value = array.elementType["value"].dataType
    built = []
    for key, field, text, condition in entries:
        given = {name: "NULL" for name in value.names} | {"set_timestamp_micros": micros, field: text}
        built.append((condition, _named([("key", f"'{key}'"), ("value", _named(_struct(value, given)))])))
    return _entries(built)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


# Lines and orders that no event has are left out before a shuffle, whatever their tables' size, by a Bloom filter of 8 MB.  It lets through about
# 2 in 100 of them at 7 million purchases, and more and more above that; the join itself is exact.
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
THINNED = {
    f"{_BLOOM}.applicationSideScanSizeThreshold": "0",
    f"{_BLOOM}.creationSideThreshold": "1t",
    f"{_BLOOM}.expectedNumItems": "4000000",
    f"{_BLOOM}.numBits": "67108864",
}


@contextmanager
def thinned(spark: SparkSession) -> Iterator[None]:
    """The settings of :data:`THINNED` while the block runs."""
    with ExitStack() as stack:
        for name, value in THINNED.items():
            stack.enter_context(setting(spark, name, value))
        yield


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, or per line item of a purchase, with the columns around it."""
    events = _table(spark, sf_dir, "events").withColumns(
        {"ts_micros": _micros(F.col("ts")), "day_micros": _micros(F.date_trunc("day", "ts"))}
    )
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = _table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    bought = events.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("bought"))
    orders = _table(spark, sf_dir, "orders").join(bought, F.col("o_orderkey") == F.col("bought"), "left_semi")
    # Only lines that an event has go through the other joins.
    lines = (
        _table(spark, sf_dir, "lineitem")
        .join(bought, F.col("l_orderkey") == F.col("bought"), "left_semi")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    bought = (F.col("event_id") == F.col("l_orderkey")) & (F.col("event_type") == "purchase")
    return events.join(customers, F.col("user_id") == F.col("c_custkey"), "left").join(lines, bought, "left")


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {field.name: field.dataType for field in schemas.EVENTS.fields}
    params = _key_values(types["event_params"], PARAMS)
    properties = _key_values(types["user_properties"], PROPERTIES, micros="ts_micros")
    sold, refunded = (_named(_struct(ITEM_SCHEMA, leaves)) for leaves in (ITEM_LEAVES, REFUND_LEAVES))
    items = _entries([("1 = 1", sold), ("l_returnflag = 'R'", refunded)])
    # Clustered before the nested columns are made, which are several times as wide.
    base = cluster(event_base(spark, sf_dir).selectExpr("*", f"{DATASET} AS dataset", f"{SHARD} AS shard"))
    return base.selectExpr(
        *_columns(_struct(schemas.EVENTS, EVENT_LEAVES)),
        f"CASE WHEN {HAS_PARAMS} THEN {params} END AS event_params",
        f"CASE WHEN {HAS_PROPERTIES} THEN {properties} END AS user_properties",
        f"CASE WHEN l_partkey IS NOT NULL THEN {items} END AS items",
        f"{EVENT_ROW} AS source_row",
        *PLACE,
    )


def _audiences(entries: list[tuple[str, str, str, str]]) -> str:
    """Audience entries from ``(name, start, end, condition)``."""
    element = schemas.USERS["audiences"].dataType.elementType
    built = []
    for index, (name, start, end, condition) in enumerate(entries):
        values = dict(zip(element.names, (f"'{index}'", name, start, end, "'false'")))
        built.append((condition, _named(_struct(element, values))))
    return _entries(built)


def _user_properties(entries: list[tuple[str, str, str]]) -> str:
    value = schemas.USERS["user_properties"].dataType.elementType["value"].dataType
    built = []
    for key, text, condition in entries:
        values = dict(zip(value.names, (text, "last_micros", f"'{key}_name'")))
        built.append((condition, _named([("key", f"'{key}'"), ("value", _named(_struct(value, values)))])))
    return _entries(built)


USER_PROPERTIES = [
    ("segment", "c_mktsegment", "1 = 1"),
    ("nation", "n_name", "c_custkey % 4 <> 0"),
    ("balance", "NULL", "c_custkey % 3 = 0"),
]
USER_AUDIENCES = [("c_mktsegment", "first_micros", "NULL", "1 = 1")] + [
    (f"'{p}'", f"first_{i}", f"last_{i}", f"first_{i} IS NOT NULL") for i, p in enumerate(PRIORITIES)
]
PSEUDO_PROPERTIES = [
    ("first_type", "first_type", "1 = 1"),
    ("errors", "CASE WHEN n_error > 0 THEN 'yes' END", "user_id % 2 = 0"),
]
PSEUDO_AUDIENCES = [(f"'{t}'", f"first_{t}", f"last_{t}", f"n_{t} > 0") for t in EVENT_TYPES]


def nested_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: a full export under one shard."""
    orders = _table(spark, sf_dir, "orders").withColumn("o_micros", _micros(F.col("o_orderdate")))
    of_priority = [F.when(F.col("o_orderpriority") == p, F.col("o_micros")) for p in PRIORITIES]
    history = orders.groupBy("o_custkey").agg(
        F.min("o_micros").alias("first_micros"),
        F.max("o_micros").alias("last_micros"),
        F.count("*").alias("purchases"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
        *[F.min(value).alias(f"first_{i}") for i, value in enumerate(of_priority)],
        *[F.max(value).alias(f"last_{i}") for i, value in enumerate(of_priority)],
    )
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    base = (
        _table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumn("revenue", F.col("cents") / 100)
    )
    return base.selectExpr(
        *_columns(_struct(schemas.USERS, USER_LEAVES)),
        f"CASE WHEN c_custkey % 6 <> 0 THEN {_user_properties(USER_PROPERTIES)} END AS user_properties",
        f"CASE WHEN c_custkey % 8 <> 0 THEN {_audiences(USER_AUDIENCES)} END AS audiences",
        "CAST(c_custkey AS STRING) AS source_row",
        f"{DATASET.replace('user_id', 'c_custkey')} AS dataset",
        f"'{USER_SHARD}' AS shard",
    )


def nested_pseudo_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event user, under the day of the user's last event."""
    events = _table(spark, sf_dir, "events").withColumns({"micros": _micros(F.col("ts")), "day": F.expr(SHARD)})
    of_type = {t: F.col("event_type") == t for t in EVENT_TYPES}
    base = events.groupBy("user_id").agg(
        F.min("micros").alias("first_micros"),
        F.max("micros").alias("last_micros"),
        F.max("day").alias("last_day"),
        F.countDistinct("day").alias("sessions"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
        F.min("event_type").alias("first_type"),
        *[F.count_if(match).alias(f"n_{t}") for t, match in of_type.items()],
        *[F.min(F.when(match, F.col("micros"))).alias(f"first_{t}") for t, match in of_type.items()],
        *[F.max(F.when(match, F.col("micros"))).alias(f"last_{t}") for t, match in of_type.items()],
    ).withColumn("revenue", F.col("cents") / 100)
    return base.selectExpr(
        *_columns(_struct(schemas.PSEUDO_USERS, PSEUDO_LEAVES)),
        f"{_user_properties(PSEUDO_PROPERTIES)} AS user_properties",
        f"{_audiences(PSEUDO_AUDIENCES)} AS audiences",
        "CAST(user_id AS STRING) AS source_row",
        f"{DATASET} AS dataset",
        "last_day AS shard",
    )


def nested_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events again as same-day tables, each a day ahead of its daily table."""
    ahead = F.date_format(F.date_add(F.to_date("shard", "yyyyMMdd"), 1), "yyyyMMdd")
    rows = read_nested(spark, sf_dir, "events")
    return rows.withColumns({"event_date": ahead, "shard": ahead})


# Sources whose builders give rows that lie together by shard: the same-day tables are read by shard.
CLUSTERED = ("events", "events_intraday")
BUILDERS = {
    "events": nested_events,
    "events_intraday": nested_intraday,
    "pseudonymous_users": nested_pseudo_users,
    "users": nested_users,
}


def _root(spark: SparkSession, sf_dir: str) -> str:
    digest = hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/flatweave/{spark.sparkContext.applicationId}/nested-{digest}"


@lru_cache(maxsize=None)
def _built(root: str, sf_dir: str, source: str) -> None:
    spark = SparkSession.active()
    with thinned(spark):
        write_source(BUILDERS[source](spark, sf_dir), root, source, clustered=source in CLUSTERED)


def nested_root(spark: SparkSession, sf_dir: str, *sources: str) -> str:
    """Folder of the nested exports of a data folder, written once per application."""
    root = _root(spark, sf_dir)
    for source in sources:
        _built(root, sf_dir, source)
    return root


def read_nested(spark: SparkSession, sf_dir: str, source: str, **scan) -> DataFrame:
    root = nested_root(spark, sf_dir, source)
    return read_source(spark, root, source, extra=[SOURCE_ROW], position=False, **scan)
