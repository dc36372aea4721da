"""DuckDB SQL for the registered queries.

The flat answers come straight from the driver's tables: no struct, array or
unnest takes part, so an error in the nesting or flattening shows.
"""

from __future__ import annotations

from flatweave import schemas
from testbed import nested as n
from testbed.queries import (
    BACKFILL,
    CONTROL,
    DATASETS,
    DISCOVERY_NOW,
    EMPTIED,
    GATE_DAYS,
    ONE_SHARD,
    SHARD_RANGE,
)

_SQL_TYPE = {"string": "VARCHAR", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _cast(text: str, kind: str) -> str:
    return f"CAST({text} AS {_SQL_TYPE[kind]})"


def _day(shard: str) -> str:
    return f"CAST(strptime({shard}, '%Y%m%d') AS DATE)"


def _spread(position: str) -> str:
    return f"CAST('0x' || substr(md5({position}), 1, 15) AS BIGINT)"


# ---- Events --------------------------------------------------------------------------------

_V = n.EVENT_VALUES
_PSEUDO = f"({_V['user_pseudo_id']})"
_STREAM = f"({_V['stream_id']})"
_DAILY_PARTS = [
    _STREAM,
    f"coalesce({_PSEUDO}, '')",
    "event_type",
    "CAST(day_micros AS VARCHAR)",
    f"coalesce(CAST({_V['batch_event_index']} AS VARCHAR), '')",
    f"coalesce(CAST({_V['batch_page_id']} AS VARCHAR), '')",
    f"coalesce(CAST({_V['batch_ordering_id']} AS VARCHAR), '')",
]
_INTRADAY_PARTS = [
    _STREAM,
    f"coalesce({_PSEUDO}, 'user_pseudo_id_null')",
    "event_type",
    "CAST(day_micros AS VARCHAR)",
]


def _gate_shift() -> str:
    """Days by which the same-day shards of each dataset are moved, one more than the adapter's."""
    cases = " ".join(f"WHEN {DATASETS.index(dataset)} THEN {days + 1}" for dataset, days in GATE_DAYS.items())
    return f"CASE user_id % 3 {cases} ELSE 1 END"


def _events(shift: int | str = 0, intraday_view: bool = False) -> str:
    """CTEs ending in ``ev``: a row per nested event with its key."""
    shard = n.SHARD if not shift else f"strftime(ts + to_days(CAST({shift} AS INTEGER)), '%Y%m%d')"
    parts = _INTRADAY_PARTS if intraday_view else _DAILY_PARTS
    group = ", ".join(parts) if intraday_view else " || ".join(parts)
    separator = "'.'" if intraday_view else "'_'"
    event_id = f" || {separator} || ".join([*parts, "CAST(num AS VARCHAR)"])
    return f"""
    WITH base AS (
      SELECT e.*, c.*, nn.*, r.*, l.*, p.*, o.*,
             epoch_us(ts) AS ts_micros, epoch_us(date_trunc('day', ts)) AS day_micros
      FROM events e
      LEFT JOIN customer c ON user_id = c_custkey
      LEFT JOIN nation nn ON c_nationkey = n_nationkey
      LEFT JOIN region r ON n_regionkey = r_regionkey
      LEFT JOIN lineitem l ON event_id = l_orderkey AND event_type = 'purchase'
      LEFT JOIN part p ON l_partkey = p_partkey
      LEFT JOIN orders o ON l_orderkey = o_orderkey
    ),
    placed AS (
      SELECT *, event_id AS src_id, {n.DATASET} AS dataset, {shard} AS shard, {n.EVENT_ROW} AS source_row FROM base
    ),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY dataset, shard, {group} ORDER BY {_spread("source_row")}) AS num
      FROM placed
    ),
    ev AS (SELECT * EXCLUDE (event_id), {event_id} AS key_id, src_id AS event_id FROM numbered)
    """


def _head(tag: str) -> tuple[str, str]:
    return f"dataset, shard, {_day('shard')} AS event_date, key_id AS event_id", f"'{tag}' AS source_table_type"


def _sessions(separator: str) -> str:
    number = {name: (value, condition) for name, _, value, condition in n.PARAMS}
    columns = []
    for output, param in (("session_id", "ga_session_id"), ("session_id_1", "ga_session_number")):
        value, condition = number[param]
        columns.append(
            f"CASE WHEN {n.HAS_PARAMS} AND {condition} THEN {_PSEUDO} || '{separator}' ||"
            f" CAST(CAST({value} AS BIGINT) AS VARCHAR) END AS {output}"
        )
    return ", ".join(columns)


def _event_leaves(keep=lambda path: True, since=lambda path: None) -> str:
    def value(path: str, dtype) -> str:
        plain = _cast(n.EVENT_LEAVES[path], dtype.typeName())
        return f"CASE WHEN shard >= '{since(path)}' THEN {plain} END" if since(path) else plain

    return ", ".join(
        f"{value(path, dtype)} AS {path.replace('.', '_')}"
        for path, dtype in schemas.leaf_paths(schemas.EVENTS)
        if path != "event_date" and keep(path)
    )


def _flat_events() -> str:
    head, tag = _head("daily")
    return f"{_events()} SELECT {head}, {_sessions('_')}, {_event_leaves()}, {tag} FROM ev"


_GATED = _events(_gate_shift(), intraday_view=True)


def _intraday_events() -> str:
    dropped = ("batch_", "session_traffic_source_last_click.", "publisher.")
    collected = "collected_traffic_source."

    def keep(path: str) -> bool:
        if path.startswith(collected):
            return path.removeprefix(collected) in schemas.INTRADAY_COLLECTED_TRAFFIC
        return not path.startswith(dropped)

    def since(path: str) -> str | None:
        return "20230503" if path.startswith(collected) else "20230717" if path == "is_active_user" else None

    head, tag = _head("intraday")
    return f"{_GATED} SELECT {head}, {_sessions('.')}, {_event_leaves(keep, since)}, {tag} FROM ev"


_TEXT = {
    "string_value": "CAST({0} AS VARCHAR)",
    "int_value": "CAST(CAST({0} AS BIGINT) AS VARCHAR)",
    "float_value": "CAST(CAST({0} AS DOUBLE) AS VARCHAR)",
    "double_value": "CAST(CAST({0} AS DOUBLE) AS VARCHAR)",
    None: "CAST(NULL AS VARCHAR)",
}


def _params(tag: str, raw: bool, cte: str, shifted: bool = False) -> str:
    head, tag_column = _head(tag)
    selects = []
    for key, field, value, condition in n.PARAMS:
        columns = [head, f"'{key}' AS event_params_key", f"{_TEXT[field].format(value)} AS event_params_value"]
        if raw:
            text = value if field == "string_value" else "CAST(NULL AS VARCHAR)"
            number = f"CAST({value} AS BIGINT)" if field == "int_value" else "CAST(NULL AS BIGINT)"
            columns += [f"{text} AS event_params_string_value", f"{number} AS event_params_int_value"]
        selects.append(f"SELECT {', '.join(columns)}, {tag_column} FROM ev WHERE {n.HAS_PARAMS} AND {condition}")
    return f"{cte} {' UNION ALL '.join(selects)}"


def _properties(tag: str, cte: str, where: str = "1 = 1") -> str:
    head, tag_column = _head(tag)
    selects = [
        f"SELECT {head}, '{key}' AS user_properties_key, {_TEXT[field].format(value)} AS user_properties_value,"
        f" ts_micros AS user_properties_value_set_timestamp_micros, {tag_column}"
        f" FROM ev WHERE {n.HAS_PROPERTIES} AND {condition} AND {where}"
        for key, field, value, condition in n.PROPERTIES
    ]
    return f"{cte} {' UNION ALL '.join(selects)}"


def _items(tag: str, cte: str) -> str:
    head, tag_column = _head(tag)
    selects = []
    for leaves, condition in ((n.ITEM_LEAVES, "1 = 1"), (n.REFUND_LEAVES, "l_returnflag = 'R'")):
        columns = ", ".join(
            f"{_cast(leaves[f.name], f.dataType.typeName())} AS items_{f.name}" for f in n.ITEM_SCHEMA.fields
        )
        selects.append(f"SELECT {head}, {columns}, {tag_column} FROM ev WHERE l_partkey IS NOT NULL AND {condition}")
    return f"{cte} {' UNION ALL '.join(selects)}"


def _lookup() -> str:
    found = {}
    for key, field, value, condition in n.PARAMS:
        found.setdefault((key, field), (value, condition))

    def first(key: str, field: str, kind: str, name: str) -> str:
        value, condition = found[(key, field)]
        return f"CASE WHEN {n.HAS_PARAMS} AND {condition} THEN {_cast(value, kind)} END AS {name}"

    return (
        f"{_events()} SELECT dataset, shard, source_row, {first('ga_session_id', 'int_value', 'long', 'ga_session_id')},"
        f" {first('props', 'string_value', 'string', 'props')}, {first('value', 'double_value', 'double', 'value')},"
        " CAST(NULL AS BIGINT) AS absent FROM ev"
    )


# ---- Users ------------------------------------------------------------------------------------


def _row_id(source: str, row: str) -> str:
    digest = f"md5('{source}' || '|' || dataset || '|' || shard || '|' || CAST({row} AS VARCHAR))"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {start}, {length})" for start, length in cuts)


def _users() -> str:
    priorities = ", ".join(
        f"min(CASE WHEN o_orderpriority = '{p}' THEN epoch_us(o_orderdate) END) AS first_{i},"
        f" max(CASE WHEN o_orderpriority = '{p}' THEN epoch_us(o_orderdate) END) AS last_{i}"
        for i, p in enumerate(n.PRIORITIES)
    )
    return f"""
    WITH history AS (
      SELECT o_custkey, min(epoch_us(o_orderdate)) AS first_micros, max(epoch_us(o_orderdate)) AS last_micros,
             count(*) AS purchases,
             CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue, {priorities}
      FROM orders GROUP BY o_custkey
    ),
    base AS (
      SELECT *, {n.DATASET.replace("user_id", "c_custkey")} AS dataset, '{n.USER_SHARD}' AS shard
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN history ON c_custkey = o_custkey
    ),
    us AS (SELECT *, {_row_id("users", "c_custkey")} AS row_id, {_day("shard")} AS day FROM base)
    """


def _pseudo_users() -> str:
    kinds = ", ".join(
        f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t},"
        f" min(epoch_us(ts)) FILTER (WHERE event_type = '{t}') AS first_{t},"
        f" max(epoch_us(ts)) FILTER (WHERE event_type = '{t}') AS last_{t}"
        for t in n.EVENT_TYPES
    )
    return f"""
    WITH base AS (
      SELECT user_id, min(epoch_us(ts)) AS first_micros, max(epoch_us(ts)) AS last_micros,
             max({n.SHARD}) AS last_day, count(DISTINCT {n.SHARD}) AS sessions,
             CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue,
             min(event_type) AS first_type, {kinds}
      FROM events GROUP BY user_id
    ),
    placed AS (SELECT *, {n.DATASET} AS dataset, last_day AS shard FROM base),
    us AS (SELECT *, {_row_id("pseudonymous_users", "user_id")} AS row_id, {_day("shard")} AS day FROM placed)
    """


def _user_table(cte: str, schema, leaves: dict[str, str]) -> str:
    columns = ", ".join(
        f"{_cast(leaves[path], dtype.typeName())} AS {path.replace('.', '_')}"
        for path, dtype in schemas.leaf_paths(schema)
    )
    # Nested so that output names cannot hide input columns.
    return f"{cte} SELECT dataset, shard, row_id, day AS date, {columns} FROM us"


def _user_properties(cte: str, user: str, name: str, entries, has: str) -> str:
    selects = [
        f"SELECT dataset, shard, row_id, day AS date, {user} AS {name}, '{key}' AS user_property_key,"
        f" CAST({value} AS VARCHAR) AS user_property_value, last_micros AS user_property_set_timestamp_micros,"
        f" '{key}_name' AS user_property_name FROM us WHERE {has} AND {condition}"
        for key, value, condition in entries
    ]
    return f"{cte} {' UNION ALL '.join(selects)}"


def _user_audiences(cte: str, user: str, name: str, entries, has: str) -> str:
    selects = [
        f"SELECT dataset, shard, row_id, day AS date, {user} AS {name}, '{i}' AS audience_id, {label} AS audience_name,"
        f" CAST({start} AS BIGINT) AS audience_membership_start_timestamp_micros,"
        f" CAST({end} AS BIGINT) AS audience_membership_expiry_timestamp_micros, 'false' AS audience_npa"
        f" FROM us WHERE {has} AND {condition}"
        for i, (label, start, end, condition) in enumerate(entries)
    ]
    return f"{cte} {' UNION ALL '.join(selects)}"


_USER, _PSEUDO_USER = "CAST(c_custkey AS VARCHAR)", "'u' || CAST(user_id AS VARCHAR)"
_USERS, _PSEUDO_USERS = _users(), _pseudo_users()

# ---- Listings, planning, messages --------------------------------------------------------------

_EVENT_SHARDS = f"SELECT DISTINCT {n.DATASET} AS dataset, {n.SHARD} AS shard FROM events"
_PSEUDO_SHARDS = f"""
    SELECT DISTINCT dataset, shard
    FROM (SELECT user_id, {n.DATASET} AS dataset, max({n.SHARD}) AS shard FROM events GROUP BY user_id)"""
_USER_SHARDS = (
    f"SELECT DISTINCT {n.DATASET.replace('user_id', 'c_custkey')} AS dataset, '{n.USER_SHARD}' AS shard FROM customer"
)
_ARRIVALS = f"""
    SELECT dataset, shard, 'events' AS source FROM ({_EVENT_SHARDS})
    UNION ALL SELECT dataset, shard, 'pseudonymous_users' FROM ({_PSEUDO_SHARDS})
    UNION ALL SELECT dataset, shard, 'users' FROM ({_USER_SHARDS})"""
_INVENTORY = f"""
    WITH days AS (
      SELECT user_id, {n.SHARD} AS shard, epoch_ms(max(date_trunc('day', ts))) AS creation_time
      FROM events GROUP BY ALL
    ),
    inventory AS (
      SELECT 'project-' || CAST(user_id % 4 AS VARCHAR) AS project,
             'analytics_' || CAST(user_id + 1000 AS VARCHAR) AS dataset, kind || shard AS table_id, creation_time
      FROM days, (VALUES ('events_'), ('pseudonymous_users_')) AS k(kind)
      UNION ALL
      SELECT 'project-0', 'crm_' || CAST(c_custkey AS VARCHAR), 'events_20240130', 1706572800000 FROM customer
    )"""
_RECENT = f"""{_INVENTORY},
    recent AS (
      SELECT * FROM inventory
      WHERE regexp_matches(dataset, '^analytics_\\d+$') AND regexp_matches(table_id, '^events.*\\d{{8}}$')
        AND (epoch_ms(TIMESTAMP '{DISCOVERY_NOW}') - creation_time) / 86400000.0 < 30
    )"""


def _control() -> str:
    rows = []
    for dataset, tables, sharded, partitioned, _ in CONTROL:
        flags = f"{str(sharded is not False).lower()}, {str(bool(partitioned)).lower()}"
        rows += [f"('{dataset}', '{table}', {flags})" for table in tables]
    feeds = [
        f"('{source}', '{table}')" for source, tables in schemas.TABLES_OF_SOURCE.items() for table in tables
    ]
    return (
        f"control(dataset, tab, sharded, partitioned) AS (VALUES {', '.join(rows)}),"
        f" feeds(source, tab) AS (VALUES {', '.join(feeds)})"
    )


_TABLE_PATH = """
    SELECT DISTINCT user_id, {dataset} AS ds, {shard} AS day FROM events"""
_ARRIVAL_PARSE = f"""
    WITH t AS ({_TABLE_PATH.format(dataset=n.DATASET, shard=n.SHARD)}),
    named AS (
      SELECT *, CASE user_id % 7 WHEN 2 THEN 'events_intraday' WHEN 3 THEN 'users' WHEN 4 THEN 'pseudonymous_users'
                ELSE 'events' END AS src,
             user_id % 7 NOT IN (0, 1) AS valid
      FROM t
    )
    SELECT user_id, day, CASE WHEN valid THEN 'p' || CAST(user_id % 2 AS VARCHAR) END AS project,
           CASE WHEN valid THEN ds END AS dataset, CASE WHEN valid THEN src END AS source,
           CASE WHEN valid THEN day END AS shard, valid
    FROM named"""
_LIFECYCLE = f"""
    WITH t AS (
      SELECT event_id, ts, CASE WHEN event_id % 2 = 0 THEN 'create' ELSE 'delete' END AS action,
             'analytics_' || CAST(user_id + 1000 AS VARCHAR) AS ds, {n.SHARD} AS day,
             event_id % 2 = 0 OR event_id % 11 <> 0 AS valid
      FROM events
    )"""
_DAY_COUNTS = f"SELECT event_date, count(*) AS nrow FROM ({_params('daily', True, _events())}) GROUP BY event_date"

_REJOIN_KEY = "ev2.dataset = p.dataset AND ev2.shard = p.shard AND ev2.event_id = p.event_id"

ORACLES: dict[str, str] = {
    "event_key_daily": f"{_events()} SELECT dataset, shard, source_row, key_id AS event_id FROM ev",
    "event_key_intraday": (
        f"{_events(1, intraday_view=True)} SELECT dataset, shard, source_row, key_id AS event_id FROM ev"
    ),
    "row_key_users": f"{_USERS} SELECT dataset, shard, {_USER} AS user_id, row_id, day AS date FROM us",
    "session_ids": f"{_events()} SELECT dataset, shard, source_row, {_sessions('_')} FROM ev",
    "param_lookup": _lookup(),
    "event_key_summary": (
        f"{_events()}, k AS (SELECT dataset, shard, key_id, count(*) AS nrow FROM ev GROUP BY ALL)"
        " SELECT dataset, shard, CAST(sum(nrow) AS BIGINT) AS rows,"
        " CAST(coalesce(sum(nrow) FILTER (WHERE key_id IS NULL), 0) AS BIGINT) AS without_key,"
        " count(key_id) AS keys, count(key_id) FILTER (WHERE nrow > 1) AS repeated_keys FROM k GROUP BY ALL"
    ),
    "flat_events": _flat_events(),
    "flat_event_params": _params("daily", True, _events()),
    "flat_user_properties": _properties("daily", _events()),
    "flat_items": _items("daily", _events()),
    "flat_pseudo_users": _user_table(_PSEUDO_USERS, schemas.PSEUDO_USERS, n.PSEUDO_LEAVES),
    "flat_pseudo_user_properties": _user_properties(
        _PSEUDO_USERS, _PSEUDO_USER, "pseudo_user_id", n.PSEUDO_PROPERTIES, "1 = 1"
    ),
    "flat_pseudo_user_audiences": _user_audiences(
        _PSEUDO_USERS, _PSEUDO_USER, "pseudo_user_id", n.PSEUDO_AUDIENCES, "1 = 1"
    ),
    "flat_users": _user_table(_USERS, schemas.USERS, n.USER_LEAVES),
    "flat_users_user_properties": _user_properties(_USERS, _USER, "user_id", n.USER_PROPERTIES, "c_custkey % 6 <> 0"),
    "flat_users_user_audiences": _user_audiences(_USERS, _USER, "user_id", n.USER_AUDIENCES, "c_custkey % 8 <> 0"),
    "intraday_flat_events": _intraday_events(),
    "intraday_flat_event_params": _params("intraday", False, _GATED),
    "intraday_flat_user_properties": _properties("intraday", _GATED),
    "intraday_flat_items": _items("intraday", _GATED),
    "params_rejoin_events": (
        f"SELECT p.dataset, p.shard, p.event_id, ev2.event_name, ev2.event_bundle_sequence_id, p.event_params_key,"
        f" p.event_params_value FROM ({_params('daily', True, _events())}) p"
        f" JOIN ({_flat_events()}) ev2 ON {_REJOIN_KEY}"
    ),
    "user_properties_by_country": (
        "SELECT u.geo_country, p.user_property_key, count(p.user_property_value) AS n_values, count(*) AS n_rows"
        f" FROM ({_user_table(_USERS, schemas.USERS, n.USER_LEAVES)}) u"
        f" JOIN ({_user_properties(_USERS, _USER, 'user_id', n.USER_PROPERTIES, 'c_custkey % 6 <> 0')}) p"
        " USING (row_id) GROUP BY ALL"
    ),
    "shard_scan": (
        f"{_events()} SELECT dataset, shard, source_row, event_type AS event_name, n_name AS geo_country"
        f" FROM ev WHERE shard = '{ONE_SHARD}'"
    ),
    "shard_range_scan": (
        f"{_events()} SELECT dataset, shard, count(*) AS nrow FROM ev"
        f" WHERE shard BETWEEN '{SHARD_RANGE[0]}' AND '{SHARD_RANGE[1]}' GROUP BY ALL"
    ),
    "source_shards": (
        f"SELECT dataset, source, shard FROM ({_ARRIVALS}) UNION ALL"
        f" SELECT DISTINCT {n.DATASET}, 'events_intraday', strftime(ts + INTERVAL 1 DAY, '%Y%m%d') FROM events"
    ),
    "union_all_datasets": f"""{_events()}
        SELECT 'events' AS source, dataset, shard, count(*) AS nrow FROM ev GROUP BY ALL
        UNION ALL
        SELECT 'pseudonymous_users', dataset, shard, count(*)
        FROM (SELECT user_id, {n.DATASET} AS dataset, max({n.SHARD}) AS shard FROM events GROUP BY user_id) GROUP BY ALL
        UNION ALL
        SELECT 'users', {n.DATASET.replace("user_id", "c_custkey")}, '{n.USER_SHARD}', count(*) FROM customer
        GROUP BY ALL""",
    "daily_supersedes_intraday": (
        f"SELECT * FROM ({_params('intraday', True, _events(shift=1))}) x"
        f" WHERE NOT EXISTS (SELECT 1 FROM ({_EVENT_SHARDS}) d WHERE d.dataset = x.dataset AND d.shard = x.shard)"
    ),
    "dataset_discovery": f"{_RECENT} SELECT DISTINCT dataset FROM recent ORDER BY dataset",
    "recent_tables": f"{_RECENT} SELECT project, dataset, table_id, creation_time FROM recent",
    "default_config": (
        f"{_RECENT} SELECT dataset, flat_table, true AS sharded, false AS partitioned, true AS intraday_views"
        " FROM (SELECT DISTINCT dataset FROM recent),"
        f" (VALUES {', '.join(f'({chr(39)}{t}{chr(39)})' for t in schemas.ALL_TABLES)}) AS k(flat_table)"
    ),
    "last_schema_window": f"""{_INVENTORY},
        d AS (SELECT DISTINCT project, dataset FROM inventory WHERE regexp_matches(dataset, '^analytics_\\d+$')),
        w AS (
          SELECT *, last_value(dataset) OVER (PARTITION BY project ORDER BY dataset
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_dataset FROM d
        )
        SELECT *, CASE WHEN dataset <> last_dataset THEN 'inner' ELSE 'last' END AS position FROM w""",
    "last_customer_per_nation": (
        "SELECT c_custkey, c_name, c_nationkey, last_value(c_name) OVER (PARTITION BY c_nationkey ORDER BY c_name"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_name FROM customer"
    ),
    "last_customer_per_segment": (
        "SELECT c_custkey, segment, c_acctbal, last_value(c_acctbal) OVER (PARTITION BY segment ORDER BY c_acctbal"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_balance"
        " FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer)"
    ),
    "ordered_numbers": (
        "SELECT l_suppkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts"
        " FROM lineitem GROUP BY l_suppkey"
    ),
    "ordered_string_agg": (
        "SELECT dataset, shard, string_agg(event_type, ',' ORDER BY event_type) AS event_names"
        f" FROM (SELECT DISTINCT {n.DATASET} AS dataset, {n.SHARD} AS shard, event_type FROM events) GROUP BY ALL"
    ),
    "constant_columns": (
        f"{_INVENTORY} SELECT 'nested' AS kind, 1 AS version,"
        " 'projects/' || project || '/datasets/' || dataset || '/tables/' || table_id AS path FROM inventory"
    ),
    "configured_datasets": (
        f"SELECT dataset, shard, source FROM ({_ARRIVALS}) WHERE dataset IN ('{DATASETS[0]}', '{DATASETS[1]}')"
    ),
    "work_routing": (
        f"WITH {_control()} SELECT a.dataset, a.source, a.shard, 'flat_' || tab AS flat_table, sharded, partitioned"
        f" FROM ({_ARRIVALS}) a JOIN control USING (dataset) JOIN feeds USING (source, tab)"
    ),
    "backfill_grid": (
        "SELECT dataset, source, strftime(day, '%Y%m%d') AS shard"
        f" FROM (SELECT DISTINCT {n.DATASET} AS dataset FROM events), (VALUES ('events'), ('users')) AS k(source),"
        f" generate_series({_day(repr(BACKFILL[0]))}, {_day(repr(BACKFILL[1]))}, INTERVAL 1 DAY) AS g(day)"
        " ORDER BY shard DESC, source, dataset"
    ),
    "arrival_parse": _ARRIVAL_PARSE,
    "lifecycle_parse": (
        f"{_LIFECYCLE} SELECT event_id, action, CASE WHEN valid THEN 'p' END AS project,"
        " CASE WHEN valid THEN ds END AS dataset, CASE WHEN valid THEN 'events_intraday' END AS source,"
        " CASE WHEN valid THEN day END AS shard, valid FROM t"
    ),
    "lifecycle_latest": (
        f"{_LIFECYCLE} SELECT ds AS dataset, day AS shard, arg_max(action, ts) AS action FROM t WHERE valid GROUP BY ALL"
    ),
    "written_sharded": _items("daily", _events()),
    "written_partitioned": _params("daily", True, _events()),
    "written_users": _user_audiences(_USERS, _USER, "user_id", n.USER_AUDIENCES, "c_custkey % 8 <> 0"),
    "day_counts": f"{_DAY_COUNTS} ORDER BY event_date",
    "day_counts_parity": f"SELECT event_date, nrow AS sharded, nrow AS partitioned FROM ({_DAY_COUNTS})",
    "replace_day_idempotent": _items("daily", _events()),
    "stream_flatten": _properties("daily", _events()),
    "stream_intraday_refresh": (
        f"SELECT * FROM ({_params('intraday', True, _events(shift=1))}) x"
        f" WHERE NOT EXISTS (SELECT 1 FROM ({_EVENT_SHARDS}) d WHERE d.dataset = x.dataset AND d.shard = x.shard)"
    ),
    "stream_views": _properties(
        "intraday", _events(shift=1, intraday_view=True), "CAST(substr(shard, 7, 2) AS INTEGER) % 4 <> 0"
    ),
    "view_lifecycle_restart": (
        f"SELECT dataset || part AS view FROM (SELECT dataset, unnest(['_view_events_' || shard || '_unique_pk',"
        f" '_view_flat_user_properties_' || shard]) AS part FROM (SELECT DISTINCT {n.DATASET} AS dataset,"
        f" strftime({_day(n.SHARD)} + INTERVAL 1 DAY, '%Y%m%d') AS shard FROM events)"
        " WHERE CAST(substr(shard, 7, 2) AS INTEGER) % 4 <> 0)"
    ),
}


_LAYOUTS = "(VALUES ('sharded'), ('partitioned')) AS k(layout)"
ORACLES |= {
    f"written_{table}_table": f"SELECT * FROM ({ORACLES[f'flat_{table}']}), {_LAYOUTS}" for table in schemas.ALL_TABLES
}
ORACLES["written_checks"] = " UNION ALL ".join(
    f"SELECT '{table}' AS flat_table, count(*) AS sharded, count(*) AS partitioned, 0 AS differences, true AS day_is_date"
    f" FROM ({ORACLES[f'flat_{table}']})"
    for table in schemas.ALL_TABLES
)
ORACLES["failed_replace"] = f"SELECT * FROM ({ORACLES['flat_items']}), {_LAYOUTS}"
ORACLES["resumed_backfill"] = (
    "SELECT 'items' AS flat_table, layout, dataset, shard, 'events' AS source, 'first' AS run, shard >= '20240122' AS kept"
    f" FROM ({_EVENT_SHARDS}), {_LAYOUTS}"
)
ORACLES["refresh_changed_shards"] = (
    f"SELECT dataset, shard, CAST(CASE WHEN shard = '{ONE_SHARD}' THEN 2 ELSE 1 END AS BIGINT) AS writes FROM (SELECT DISTINCT"
    f" {n.DATASET} AS dataset, strftime({_day(n.SHARD)} + INTERVAL 1 DAY, '%Y%m%d') AS shard FROM events)"
)
ORACLES["rejected_arrivals"] = f"""
    WITH d AS (SELECT DISTINCT user_id, {n.DATASET} AS ds, {n.SHARD} AS day FROM events),
    m AS (
      SELECT '{{"protoPayload":{{"resourceName":"projects/p' || CAST(user_id % 2 AS VARCHAR) || '/datasets/' || ds || '/tables/'
             || CASE user_id % 7 WHEN 0 THEN 'events' ELSE 'users_x_' || day END || '"}}}}' AS message,
             'names no table of an export' AS reason
      FROM d WHERE user_id % 7 IN (0, 1)
      UNION ALL
      SELECT CASE event_id % 5 WHEN 1 THEN '{{"id": ' || CAST(event_id AS VARCHAR) WHEN 2 THEN '{{"id": ' || CAST(event_id AS VARCHAR) || '}}' END,
             CASE event_id % 5 WHEN 0 THEN 'not base64 text' WHEN 1 THEN 'not a JSON object' ELSE 'no resource name' END
      FROM events WHERE event_id % 5 < 3
    )
    SELECT 'arrival' AS kind, message, reason, count(*) AS n FROM m GROUP BY ALL"""
ORACLES["random_row_ids"] = f"""
    WITH u AS (SELECT dataset, count(*) AS users FROM ({ORACLES["flat_users"]}) GROUP BY dataset),
    c AS (
      SELECT dataset, count(*) AS children
      FROM (SELECT dataset FROM ({ORACLES["flat_users_user_properties"]})
            UNION ALL SELECT dataset FROM ({ORACLES["flat_users_user_audiences"]}))
      GROUP BY dataset
    )
    SELECT dataset, users, users AS ids, users AS uuids, children, CAST(0 AS BIGINT) AS orphans FROM u JOIN c USING (dataset)"""
ORACLES["empty_shard_replaced"] = (
    f"SELECT * FROM ({ORACLES['flat_pseudo_users']}), {_LAYOUTS} WHERE shard <> '{EMPTIED}'"
)
