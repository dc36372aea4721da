"""The registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatweave import quality, schemas
from flatweave.functions.expressions import param_value
from flatweave.operators.flatten import flatten_table
from flatweave.operators.keys import session_ids, with_event_id, with_row_id
from flatweave.operators.relational import (
    last_value_per_group,
    ordered_text,
    rejoin,
    rows_per_day,
    with_constants,
)
from flatweave.plans.flatten_job import backfill, flatten_work, key_events, keyed_source
from flatweave.plans.work import (
    backfill_grid,
    configured_arrivals,
    default_control,
    not_superseded,
    route,
    with_source,
)
from flatweave.schemas import PLACE
from flatweave.session import Stages, delete_path, new_stage_path
from flatweave.sinks.tables import PARTITIONED, SHARDED, current_counts, ledger, read_flat, replace_shards, shard_state
from flatweave.sources.inventory import analytics_tables, discover_datasets, recent_event_tables, union_datasets
from flatweave.sources.messages import decode_messages, parse_arrivals, parse_lifecycle
from flatweave.sources.shards import list_shards, shard_paths, write_source
from flatweave.streaming.arrivals import flatten_on_arrival, read_messages, record_rejected
from flatweave.streaming.intraday import (
    existing_views,
    intraday_table,
    latest_actions,
    manage_views,
    refresh_intraday,
)
from testbed.nested import DATASET, SHARD, SOURCE_ROW, nested_root, read_nested

Query = Callable[[SparkSession, str], DataFrame]

POSITION = "source_row"
ONE_SHARD = "20240115"
SHARD_RANGE = ("20240105", "20240120")
BACKFILL = ("20240101", "20240131")
DISCOVERY_NOW = "2024-02-20 00:00:00"
DATASETS = tuple(f"analytics_{100000001 + i}" for i in range(3))
CONTROL = (
    # dataset, tables, sharded, partitioned, intraday views
    (DATASETS[0], list(schemas.ALL_TABLES), True, True, True),
    (DATASETS[1], ["event_params", "items", "pseudo_users", "users_user_audiences"], None, None, None),
)
CONTROL_SCHEMA = (
    "dataset string, tables_to_flatten array<string>, sharded boolean, partitioned boolean, intraday_views boolean"
)
JOB = {"position": POSITION, "extra": [SOURCE_ROW]}


def _stages(spark: SparkSession) -> Stages:
    """Of a result that is read later: its staged tables stay until the application's folder goes."""
    return Stages(spark)


def control_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CONTROL), CONTROL_SCHEMA)


# ---- Keys -----------------------------------------------------------------------------


def event_key_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = key_events(read_nested(spark, sf_dir, "events"), POSITION, _stages(spark))
    return keyed.select(*PLACE, POSITION, "event_id")


def event_key_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the form of the live view, which numbers the rows when it is read."""
    keyed = with_event_id(read_nested(spark, sf_dir, "events_intraday"), intraday_view=True, position=POSITION)
    return keyed.select(*PLACE, POSITION, "event_id")


def row_key_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_row_id(read_nested(spark, sf_dir, "users"), "users", POSITION)
    return keyed.select(*PLACE, "user_id", "row_id", "date")


def session_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_nested(spark, sf_dir, "events")
    return rows.select(*PLACE, POSITION, *[value.alias(name) for name, value in session_ids().items()])


def param_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_nested(spark, sf_dir, "events")
    return rows.select(
        *PLACE,
        POSITION,
        param_value("event_params", "ga_session_id").alias("ga_session_id"),
        param_value("event_params", "props", "string_value").alias("props"),
        param_value("event_params", "value", "double_value").alias("value"),
        param_value("event_params", "absent").alias("absent"),
    )


def event_key_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_summary(event_key_daily(spark, sf_dir))


# ---- Flat tables ------------------------------------------------------------------------


def _flat(table: str) -> Query:
    source = next(name for name, tables in schemas.TABLES_OF_SOURCE.items() if table in tables)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = nested_root(spark, sf_dir, source)
        return flatten_table(keyed_source(spark, root, source, [table], stages=_stages(spark), **JOB), table, source)

    return query


# Days by which same-day shards are moved, so that some lie on each side of the days on which columns were added.
GATE_DAYS = {DATASETS[1]: -255, DATASETS[2]: -180}


def gated_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_nested(spark, sf_dir, "events_intraday")
    days = F.lit(0)
    for dataset, shift in GATE_DAYS.items():
        days = F.when(F.col("dataset") == dataset, shift).otherwise(days)
    moved = F.date_format(F.date_add(F.to_date("shard", "yyyyMMdd"), days), "yyyyMMdd")
    return rows.withColumns({"shard": moved, "event_date": moved})


def _intraday(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = gated_intraday(spark, sf_dir)
        if table == "events":
            # The parameters are read before rows are shuffled, and stay behind.
            rows = rows.withColumns(session_ids(separator=".")).drop("event_params")
        keyed = key_events(rows, POSITION, _stages(spark), intraday_view=True)
        return intraday_table(keyed, table)

    return query


def params_rejoin_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = nested_root(spark, sf_dir, "events")
    tables = ["events", "event_params"]
    keyed = keyed_source(spark, root, "events", tables, stages=_stages(spark), **JOB)
    events, params = (flatten_table(keyed, table, "events") for table in tables)
    return rejoin(events, params).select(
        *PLACE, "event_id", "event_name", "event_bundle_sequence_id", "event_params_key", "event_params_value"
    )


def user_properties_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = nested_root(spark, sf_dir, "users")
    tables = ["users", "users_user_properties"]
    keyed = keyed_source(spark, root, "users", tables, **JOB)
    users, properties = (flatten_table(keyed, table, "users") for table in tables)
    joined = rejoin(users, properties, "row_id")
    return joined.groupBy("geo_country", "user_property_key").agg(
        F.count("user_property_value").alias("n_values"), F.count("*").alias("n_rows")
    )


# ---- Scans ---------------------------------------------------------------------------------


def shard_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_nested(spark, sf_dir, "events", shard=ONE_SHARD)
    return rows.select(*PLACE, POSITION, "event_name", F.col("geo.country").alias("geo_country"))


def shard_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_nested(spark, sf_dir, "events", between=SHARD_RANGE)
    return rows.groupBy(*PLACE).agg(F.count("*").alias("nrow"))


def source_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested work whose source exists; not every day of the grid does."""
    root = nested_root(spark, sf_dir, *schemas.SOURCE_SCHEMAS)
    datasets = list_shards(spark, root, "users").select("dataset").distinct()
    wanted = backfill_grid(datasets, tuple(schemas.SOURCE_SCHEMAS), *BACKFILL)
    found = [
        with_source(wanted.where(F.col("source") == source), list_shards(spark, root, source))
        for source in schemas.SOURCE_SCHEMAS
    ]
    return union_datasets(found)


def union_all_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts per shard of all three sources, one under the other."""
    parts = [
        read_nested(spark, sf_dir, source).select(*PLACE, F.lit(source).alias("source"))
        for source in ("events", "pseudonymous_users", "users")
    ]
    return union_datasets(parts).groupBy("source", *PLACE).agg(F.count("*").alias("nrow"))


def daily_supersedes_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = nested_root(spark, sf_dir, "events", "events_intraday")
    # Directories are chosen, so that superseded rows are not read.
    left = not_superseded(list_shards(spark, root, "events_intraday"), list_shards(spark, root, "events")).collect()
    rows = read_nested(spark, sf_dir, "events_intraday", pairs=[tuple(row) for row in left])
    return flatten_table(key_events(rows, POSITION, _stages(spark)), "event_params", "events_intraday")


# ---- Discovery and planning --------------------------------------------------------------------


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of a warehouse: event and user tables per event user, other tables per customer."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("day", F.date_trunc("day", "ts"))
    created = F.unix_millis(F.max("day").cast("timestamp")).alias("creation_time")
    days = events.groupBy("user_id", F.expr(SHARD).alias("shard")).agg(created)
    analytics = days.select(
        F.expr("'project-' || CAST(user_id % 4 AS STRING)").alias("project"),
        F.expr("'analytics_' || CAST(user_id + 1000 AS STRING)").alias("dataset"),
        F.explode(
            F.array(
                F.concat(F.lit("events_"), "shard"),
                F.concat(F.lit("pseudonymous_users_"), "shard"),
            )
        ).alias("table_id"),
        "creation_time",
    )
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    others = customers.select(
        F.lit("project-0").alias("project"),
        F.expr("'crm_' || CAST(c_custkey AS STRING)").alias("dataset"),
        F.lit("events_20240130").alias("table_id"),
        F.lit(1706572800000).alias("creation_time"),
    )
    return union_datasets([analytics, others])


def _now():
    return F.lit(DISCOVERY_NOW).cast("timestamp")


def dataset_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover_datasets(inventory(spark, sf_dir), _now())


def recent_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_event_tables(analytics_tables(inventory(spark, sf_dir)), _now())


def default_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = default_control(inventory(spark, sf_dir), now=_now())
    tables = F.explode("tables_to_flatten").alias("flat_table")
    return control.select("dataset", tables, "sharded", "partitioned", "intraday_views")


def last_dataset_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset with the last dataset of its project, and whether it is that one."""
    datasets = analytics_tables(inventory(spark, sf_dir)).select("project", "dataset").distinct()
    marked = last_value_per_group(datasets, ["project"], "dataset", "last_dataset")
    return marked.withColumn(
        "position", F.when(F.col("dataset") != F.col("last_dataset"), "inner").otherwise("last")
    )


def last_customer_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey")
    return last_value_per_group(customers, ["c_nationkey"], "c_name", "last_name")


def last_customer_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment have none: they form a group of their own."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = customers.selectExpr("c_custkey", "nullif(c_mktsegment, 'BUILDING') AS segment", "c_acctbal")
    return last_value_per_group(rows, ["segment"], "c_acctbal", "last_balance")


def ordered_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts that each supplier delivers, by number, repeats included."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_partkey")
    return ordered_text(items, ["l_suppkey"], "l_partkey", "parts", ",")


def ordered_string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types of each dataset and day, in name order, as one text."""
    rows = read_nested(spark, sf_dir, "events").select(*PLACE, "event_name").distinct()
    return ordered_text(rows, list(PLACE), "event_name", "event_names", ",")


def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table paths from a constant pattern next to every discovered table."""
    tables = with_constants(inventory(spark, sf_dir), kind="nested", version=1)
    path = F.format_string("projects/%s/datasets/%s/tables/%s", "project", "dataset", "table_id")
    return tables.select("kind", "version", path.alias("path"))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        read_nested(spark, sf_dir, source).select(*PLACE, F.lit(source).alias("source")).distinct()
        for source in ("events", "pseudonymous_users", "users")
    ]
    return union_datasets(parts)


def configured_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configured_arrivals(_arrivals(spark, sf_dir), control_table(spark))


def work_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_arrivals(spark, sf_dir), control_table(spark))


def backfill_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    datasets = events.select(F.expr(DATASET).alias("dataset")).distinct()
    return backfill_grid(datasets, ("events", "users"), *BACKFILL)


# ---- Messages ---------------------------------------------------------------------------------


def _encoded(payload: Column) -> Column:
    return F.base64(F.to_json(payload).cast("binary"))


def arrival_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An arrival per user and day; every seventh user's path has no shard, one has a bad type."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tables = events.select("user_id", F.expr(DATASET).alias("dataset"), F.expr(SHARD).alias("shard")).distinct()
    path = F.expr(
        "'projects/p' || CAST(user_id % 2 AS STRING) || '/datasets/' || dataset || '/tables/' ||"
        " CASE WHEN user_id % 7 = 0 THEN 'events' WHEN user_id % 7 = 1 THEN 'users_x_' || shard"
        " WHEN user_id % 7 = 2 THEN 'events_intraday_' || shard WHEN user_id % 7 = 3 THEN 'users_' || shard"
        " WHEN user_id % 7 = 4 THEN 'pseudonymous_users_' || shard ELSE 'events_' || shard END"
    )
    body = F.struct(F.struct(path.alias("resourceName")).alias("protoPayload"))
    return tables.select("user_id", F.col("shard").alias("day"), _encoded(body).alias("data"))


def arrival_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_arrivals(decode_messages(arrival_messages(spark, sf_dir)))
    return parsed.select("user_id", "day", "project", "dataset", "source", "shard", "valid")


def lifecycle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: odd ones delete the same-day table of the user and day, even ones create it.

    Every eleventh deletion lists two resources, which makes it invalid.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(
        "event_id",
        "ts",
        F.expr("'analytics_' || CAST(user_id + 1000 AS STRING)").alias("dataset"),
        F.concat(F.lit("events_intraday_"), F.expr(SHARD)).alias("table"),
    )
    created = F.expr("event_id % 2 = 0")
    resource = F.struct(F.concat(F.lit("projects/p/datasets/"), "dataset", F.lit("/tables/"), "table").alias("resource"))
    entries = F.when(F.expr("event_id % 11 = 0"), F.array(resource, resource)).otherwise(F.array(resource))
    name = F.struct(F.lit("p").alias("projectId"), F.col("dataset").alias("datasetId"), F.col("table").alias("tableId"))
    response = F.struct(F.struct(F.struct(name.alias("tableName")).alias("resource")).alias("tableInsertResponse"))
    payload = F.struct(
        F.when(created, "tableservice.insert").otherwise("tableservice.delete").alias("methodName"),
        entries.alias("authorizationInfo"),
        F.when(created, response).alias("serviceData"),
    )
    logged = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")
    return rows.select("event_id", _encoded(F.struct(logged, payload.alias("protoPayload"))).alias("data"))


def lifecycle_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lifecycle(decode_messages(lifecycle_messages(spark, sf_dir)))
    return parsed.select("event_id", "action", "project", "dataset", "source", "shard", "valid")


def lifecycle_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_actions(decode_messages(lifecycle_messages(spark, sf_dir))).drop("logged_at")


# ---- Written tables -------------------------------------------------------------------------------


def _flatten_all(spark: SparkSession, sf_dir: str, source: str, tables: tuple[str, ...], runs: int = 1) -> str:
    """Flatten every shard of a source into both layouts; returns the output folder."""
    root = nested_root(spark, sf_dir, source)
    out = new_stage_path(spark, "flat")
    control = list_shards(spark, root, source).select(
        "dataset",
        F.array(*map(F.lit, tables)).alias("tables_to_flatten"),
        F.lit(True).alias("sharded"),
        F.lit(True).alias("partitioned"),
    ).distinct()
    arrivals = list_shards(spark, root, source).withColumn("source", F.lit(source))
    for _ in range(runs):
        flatten_work(spark, route(arrivals, control), root, out, **JOB)
    return out


@lru_cache(maxsize=None)
def _flattened_once(application: str, sf_dir: str, source: str) -> str:
    """All flat tables of a source in both layouts, written once per application."""
    tables = schemas.TABLES_OF_SOURCE[source]
    return _flatten_all(SparkSession.active(), sf_dir, source, tuple(tables))


def _written_root(spark: SparkSession, sf_dir: str, table: str) -> str:
    source = next(name for name, tables in schemas.TABLES_OF_SOURCE.items() if table in tables)
    return _flattened_once(spark.sparkContext.applicationId, sf_dir, source)


def _written(table: str) -> Query:
    """A flat table as written, from both layouts."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = _written_root(spark, sf_dir, table)
        both = [read_flat(spark, out, one, table).withColumn("layout", F.lit(one)) for one in (SHARDED, PARTITIONED)]
        return union_datasets(both)

    return query


def written_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_flat(spark, _written_root(spark, sf_dir, "items"), SHARDED, "items")


def written_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_flat(spark, _written_root(spark, sf_dir, "event_params"), PARTITIONED, "event_params")


def written_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_flat(spark, _written_root(spark, sf_dir, "users"), PARTITIONED, "users_user_audiences")


def written_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each flat table in each layout by the files' footers, and whether files and directories have the declared form.

    Shards whose rows differ between the layouts, or from what was published, are differences as well.
    """
    rows = []
    for table in schemas.ALL_TABLES:
        out = _written_root(spark, sf_dir, table)
        found = [current_counts(spark, out, layout, table) for layout in (SHARDED, PARTITIONED)]
        counts = [sum(now for _, now in one.values()) for one in found]
        wrong = sum(published != now for one in found for published, now in one.values())
        wrong += sum(found[0].get(pair) != found[1].get(pair) for pair in found[0].keys() | found[1].keys())
        wrong += len(quality.written_differences(spark, out, table))
        partitioned = quality.as_written(spark, out, PARTITIONED, table)
        dates = quality.day_is_date(partitioned, table) and quality.days_match_partitions(spark, out, table)
        rows.append((table, *counts, wrong, dates))
    schema = "flat_table string, sharded long, partitioned long, differences int, day_is_date boolean"
    return spark.createDataFrame(rows, schema)


def random_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids drawn at random: as many as users, and every child has its parent's."""
    root, out = nested_root(spark, sf_dir, "users"), new_stage_path(spark, "flat")
    tables = ["users", "users_user_properties", "users_user_audiences"]
    work = list_shards(spark, root, "users").withColumn("source", F.lit("users"))
    control = spark.createDataFrame([(dataset, tables, True, False, False) for dataset in DATASETS], CONTROL_SCHEMA)
    flatten_work(spark, route(work, control), root, out, random_row_ids=True, **JOB)
    users, properties, audiences = (read_flat(spark, out, SHARDED, table) for table in tables)
    children = properties.select("dataset", "row_id").unionByName(audiences.select("dataset", "row_id"))
    own = users.select("dataset", "row_id", F.col("row_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("ok"))
    found = children.join(own.drop("dataset"), "row_id", "left").groupBy("dataset").agg(
        F.count("*").alias("children"), F.count_if(F.col("ok").isNull()).alias("orphans")
    )
    return (
        own.groupBy("dataset")
        .agg(F.count("*").alias("users"), F.count_distinct("row_id").alias("ids"), F.count_if("ok").alias("uuids"))
        .join(found, "dataset")
    )


EMPTIED = "20240130"


def empty_shard_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of all days flattened, then one day's shards rewritten without rows and all flattened again."""
    source, table = "pseudonymous_users", "pseudo_users"
    root, out = new_stage_path(spark, "emptied"), new_stage_path(spark, "flat")
    rows = read_nested(spark, sf_dir, source)
    write_source(rows, root, source)
    work = list_shards(spark, root, source).withColumn("source", F.lit(source))
    control = spark.createDataFrame([(dataset, [table], True, True, False) for dataset in DATASETS], CONTROL_SCHEMA)
    flatten_work(spark, route(work, control), root, out, **JOB)
    nothing = rows.drop(*PLACE).where("1 = 0")
    for path in shard_paths(spark, root, source, between=(EMPTIED, EMPTIED)).values():
        nothing.write.mode("overwrite").parquet(path)
    flatten_work(spark, route(work, control), root, out, **JOB)
    both = [read_flat(spark, out, one, table).withColumn("layout", F.lit(one)) for one in (SHARDED, PARTITIONED)]
    return union_datasets(both)


def failed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat table in both layouts after a replacement of all its shards that failed half-way."""
    table, root = "items", nested_root(spark, sf_dir, "events")
    out = _flatten_all(spark, sf_dir, "events", (table,))
    pairs = list(shard_paths(spark, root, "events"))
    rows = read_flat(spark, out, SHARDED, table)
    late = F.when(F.col("shard") == ONE_SHARD, F.raise_error(F.lit("stopped half-way"))).otherwise(F.col("items_item_id"))
    for layout in (SHARDED, PARTITIONED):
        try:
            replace_shards(rows.withColumn("items_item_id", late.cast("string")), out, layout, table, pairs)
        except Exception as error:  # noqa: BLE001
            if "stopped half-way" not in str(error):
                raise
    both = [read_flat(spark, out, one, table).withColumn("layout", F.lit(one)) for one in (SHARDED, PARTITIONED)]
    return union_datasets(both)


RESUMED_STEP, BROKEN = 30, "20240115"


def resumed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of a backfill that a broken file stopped, and that went on under its name when the file was gone.

    ``kept`` says whether the shard still has what the first attempt wrote.
    """
    root, out = new_stage_path(spark, "broken"), new_stage_path(spark, "flat")
    write_source(read_nested(spark, sf_dir, "events"), root, "events", clustered=True)
    control = spark.createDataFrame([(dataset, ["items"], True, True, False) for dataset in DATASETS], CONTROL_SCHEMA)
    broken = shard_paths(spark, root, "events", between=(BROKEN, BROKEN))
    junk = [f"{path}/junk.parquet" for path in broken.values()]

    def run() -> None:
        backfill(spark, control, root, out, *BACKFILL, sources=("events",), run="first", shards_at_once=RESUMED_STEP, **JOB)

    for path in junk:
        spark.range(1).selectExpr("'no such file format' AS value").coalesce(1).write.text(path)
    try:
        run()
    except Exception as error:  # noqa: BLE001
        if "junk.parquet" not in str(error):
            raise
    first = ledger(spark, out).select("flat_table", "layout", *PLACE, "version").collect()
    for path in junk:
        delete_path(spark, path)
    run()
    schema = "flat_table string, layout string, dataset string, shard string, version string"
    kept = spark.createDataFrame(first, schema).withColumn("kept", F.lit(True))
    found = ledger(spark, out).join(kept, ["flat_table", "layout", *PLACE, "version"], "left")
    return found.select("flat_table", "layout", *PLACE, "source", "run", F.coalesce("kept", F.lit(False)).alias("kept"))


def day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_day(_flat("event_params")(spark, sf_dir)).orderBy("event_date")


def day_counts_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of both layouts, after the second of two runs."""
    out = _flatten_all(spark, sf_dir, "events", ("event_params",), runs=2)
    sharded, partitioned = (read_flat(spark, out, layout, "event_params") for layout in (SHARDED, PARTITIONED))
    both = rows_per_day(sharded).join(rows_per_day(partitioned).withColumnRenamed("nrow", "partitioned"), "event_date", "full")
    return both.select("event_date", F.col("nrow").alias("sharded"), "partitioned")


def replace_day_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day replaced by no rows, then by its rows again, in a table of all days."""
    table = "items"
    root = nested_root(spark, sf_dir, "events")
    out = _flatten_all(spark, sf_dir, "events", (table,))
    day = list(shard_paths(spark, root, "events", between=(ONE_SHARD, ONE_SHARD)))
    with Stages(spark) as stages:
        keyed = keyed_source(spark, root, "events", [table], pairs=day, stages=stages, **JOB)
        rows = flatten_table(keyed, table, "events")
        replace_shards(rows.where("1 = 0"), out, PARTITIONED, table, day)
        replace_shards(rows, out, PARTITIONED, table, day)
    return read_flat(spark, out, PARTITIONED, table)


# ---- Streams -----------------------------------------------------------------------------------


def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals of all event shards, some twice, drained by a stream that flattens them."""
    root = nested_root(spark, sf_dir, "events")
    inbox, out, checkpoint = (new_stage_path(spark, name) for name in ("inbox", "flat", "checkpoint"))
    path = F.format_string("projects/p/datasets/%s/tables/events_%s", "dataset", "shard")
    body = F.struct(F.struct(path.alias("resourceName")).alias("protoPayload"))
    messages = list_shards(spark, root, "events").select(_encoded(body).alias("data"))
    messages.coalesce(1).write.json(inbox)
    messages.where(F.col("shard") == ONE_SHARD).coalesce(1).write.mode("append").json(inbox)
    control = spark.createDataFrame(
        [(dataset, ["user_properties"], True, False, False) for dataset in DATASETS], CONTROL_SCHEMA
    )
    flatten_on_arrival(read_messages(spark, inbox, 1), control, root, out, checkpoint, **JOB).awaitTermination()
    return read_flat(spark, out, SHARDED, "user_properties")


def stream_intraday_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same-day files drained by the refresh stream; shards with a daily table are left out."""
    root = nested_root(spark, sf_dir, "events", "events_intraday")
    out, checkpoint = (new_stage_path(spark, name) for name in ("flat", "checkpoint"))
    control = spark.createDataFrame(
        [(dataset, ["event_params"], True, False, False) for dataset in DATASETS], CONTROL_SCHEMA
    )
    refresh_intraday(spark, control, root, out, checkpoint, **JOB).awaitTermination()
    return read_flat(spark, out, SHARDED, "event_params")


def refresh_changed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each same-day shard was written in three ticks: nothing has changed at the second, one day at the third."""
    root, out, checkpoint = (new_stage_path(spark, name) for name in ("same-day", "flat", "checkpoint"))
    rows = read_nested(spark, sf_dir, "events_intraday")
    write_source(rows, root, "events_intraday", clustered=True)
    control = spark.createDataFrame([(dataset, ["items"], True, False, False) for dataset in DATASETS], CONTROL_SCHEMA)
    seen = []
    for tick in range(3):
        if tick == 2:
            more = rows.where(F.col("shard") == ONE_SHARD)
            more.write.mode("append").partitionBy(*PLACE).parquet(f"{root}/events_intraday")
        refresh_intraday(spark, control, root, out, checkpoint, **JOB).awaitTermination()
        seen += shard_state(spark, out, SHARDED, "items").select(*PLACE, "version").collect()
    versions = spark.createDataFrame(seen, "dataset string, shard string, version string")
    return versions.groupBy(*PLACE).agg(F.count_distinct("version").alias("writes"))


def rejected_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that no stream acts on, with the reason, kept by a stream of their own that is started twice."""
    inbox, folder, checkpoint = (new_stage_path(spark, name) for name in ("inbox", "rejected", "checkpoint"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    junk = events.select(
        F.expr(
            "CASE event_id % 5 WHEN 0 THEN '*' || event_id WHEN 1 THEN base64('{\"id\": ' || event_id)"
            " WHEN 2 THEN base64('{\"id\": ' || event_id || '}') ELSE NULL END"
        ).alias("data")
    ).where("data IS NOT NULL")
    for part in (arrival_messages(spark, sf_dir).select("data"), junk):
        part.write.mode("append").json(inbox)
        record_rejected(read_messages(spark, inbox), "arrival", folder, checkpoint).awaitTermination()
    return spark.read.parquet(folder).groupBy("kind", "message", "reason").agg(F.count("*").alias("n"))


def view_messages(shards: DataFrame) -> DataFrame:
    """Creations of all shards, then deletions of those of every fourth day, then late and odd messages.

    The third batch brings creations that are older than the deletion, deletions without a time, and the creation of a shard that
    does not exist.
    """
    day = F.col("shard").substr(7, 2).cast("int")
    name = F.struct(
        F.lit("p").alias("projectId"),
        F.col("dataset").alias("datasetId"),
        F.concat(F.lit("events_intraday_"), "shard").alias("tableId"),
    )
    response = F.struct(F.struct(F.struct(name.alias("tableName")).alias("resource")).alias("tableInsertResponse"))
    path = F.concat(F.lit("projects/p/datasets/"), "dataset", F.lit("/tables/events_intraday_"), "shard")
    entries = F.array(F.struct(path.alias("resource")))

    def message(rows: DataFrame, batch: int, method: str, time: str | None) -> DataFrame:
        created = method == "tableservice.insert"
        payload = F.struct(
            F.lit(method).alias("methodName"),
            F.when(F.lit(not created), entries).alias("authorizationInfo"),
            F.when(F.lit(created), response).alias("serviceData"),
        )
        body = F.struct(F.lit(time).alias("timestamp"), payload.alias("protoPayload"))
        return rows.select(F.lit(batch).alias("batch"), _encoded(body).alias("data"))

    insert, delete = "tableservice.insert", "tableservice.delete"
    dropped = shards.where(day % 4 == 0)
    absent = shards.select("dataset", F.lit("20991231").alias("shard")).distinct()
    return union_datasets(
        [
            message(shards, 1, insert, "2024-03-01T00:00:00Z"),
            message(dropped.where(day % 8 == 0), 2, delete, "2024-03-01T00:00:00Z"),
            message(dropped.where(day % 8 == 4), 2, delete, "2024-03-05T00:00:00Z"),
            message(shards.where(day % 5 == 0), 3, delete, None),
            message(dropped, 3, insert, "2024-02-28T00:00:00Z"),
            message(absent, 3, insert, "2024-03-09T00:00:00Z"),
        ]
    )


VIEW_BATCHES = (1, 2, 3)


def _managed_views(spark: SparkSession, sf_dir: str, restarts: bool) -> str:
    """The database whose views followed the messages, a file a batch, in one run of the stream or with a new one for each batch."""
    root = nested_root(spark, sf_dir, "events_intraday")
    inbox, checkpoint, folder = (new_stage_path(spark, name) for name in ("inbox", "checkpoint", "views"))
    database = "views_" + folder.rpartition("-")[2]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    messages = view_messages(list_shards(spark, root, "events_intraday"))
    control = spark.createDataFrame(
        [(dataset, ["user_properties"], None, None, True) for dataset in DATASETS], CONTROL_SCHEMA
    )

    def drain() -> None:
        stream = manage_views(read_messages(spark, inbox, 1), control, root, checkpoint, database, position=POSITION)
        stream.awaitTermination()

    for batch in VIEW_BATCHES:
        messages.where(F.col("batch") == batch).select("data").coalesce(1).write.mode("append").json(inbox)
        if restarts:
            drain()
    if not restarts:
        drain()
    return database


def stream_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of all same-day shards after their creations and deletions, those left read back together."""
    database = _managed_views(spark, sf_dir, restarts=False)
    flat = [name for name in existing_views(spark, database) if "_view_flat_" in name]
    return spark.sql(" UNION ALL ".join(f"SELECT * FROM {database}.{name}" for name in flat))


def view_lifecycle_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views that are left when the stream ends and starts again from its checkpoint before each batch."""
    database = _managed_views(spark, sf_dir, restarts=True)
    return spark.createDataFrame([(name,) for name in existing_views(spark, database)], "view string")


QUERIES: dict[str, Query] = {
    "event_key_daily": event_key_daily,
    "event_key_intraday": event_key_intraday,
    "row_key_users": row_key_users,
    "session_ids": session_keys,
    "param_lookup": param_lookup,
    "event_key_summary": event_key_summary,
    **{f"flat_{table}": _flat(table) for table in schemas.ALL_TABLES},
    **{f"intraday_flat_{table}": _intraday(table) for table in schemas.EVENT_TABLES},
    "params_rejoin_events": params_rejoin_events,
    "user_properties_by_country": user_properties_by_country,
    "shard_scan": shard_scan,
    "shard_range_scan": shard_range_scan,
    "source_shards": source_shards,
    "union_all_datasets": union_all_datasets,
    "daily_supersedes_intraday": daily_supersedes_intraday,
    "dataset_discovery": dataset_discovery,
    "recent_tables": recent_tables,
    "default_config": default_config,
    "last_schema_window": last_dataset_window,
    "last_customer_per_nation": last_customer_per_nation,
    "last_customer_per_segment": last_customer_per_segment,
    "ordered_numbers": ordered_numbers,
    "ordered_string_agg": ordered_string_agg,
    "constant_columns": constant_columns,
    "configured_datasets": configured_datasets,
    "work_routing": work_routing,
    "backfill_grid": backfill_days,
    "arrival_parse": arrival_parse,
    "lifecycle_parse": lifecycle_parse,
    "lifecycle_latest": lifecycle_latest,
    "written_sharded": written_sharded,
    "written_partitioned": written_partitioned,
    "written_users": written_users,
    **{f"written_{table}_table": _written(table) for table in schemas.ALL_TABLES},
    "written_checks": written_checks,
    "random_row_ids": random_row_ids,
    "empty_shard_replaced": empty_shard_replaced,
    "day_counts": day_counts,
    "day_counts_parity": day_counts_parity,
    "replace_day_idempotent": replace_day_idempotent,
    "failed_replace": failed_replace,
    "resumed_backfill": resumed_backfill,
    "refresh_changed_shards": refresh_changed_shards,
    "rejected_arrivals": rejected_arrivals,
    "stream_flatten": stream_flatten,
    "stream_intraday_refresh": stream_intraday_refresh,
    "stream_views": stream_views,
    "view_lifecycle_restart": view_lifecycle_restart,
}
