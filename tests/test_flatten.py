import pytest
from nested_rows import event, export, frame, param
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave import schemas
from flatweave.operators.flatten import columns_needed, flatten_table, intraday_events
from flatweave.operators.keys import session_ids, with_event_id, with_row_id
from flatweave.sinks.tables import flat_schema
from flatweave.sources.shards import read_source
from flatweave.streaming.intraday import intraday_table


def flat(spark, table, rows, source="events"):
    return flatten_table(with_event_id(frame(spark, source, rows)), table, source)


def test_column_counts():
    # The places, the export's columns and, for events, the tag.
    assert len(flat_schema_names("events")) == 2 + 152 + 1
    assert len(flat_schema_names("items")) == 2 + 29
    assert len(flat_schema_names("pseudo_users")) == 2 + 30
    assert len(flat_schema_names("users")) == 2 + 29
    assert len(flat_schema_names("event_params")) == 2 + 7
    assert len(flat_schema_names("user_properties")) == 2 + 6
    for table in ("pseudo_user_properties", "users_user_properties"):
        assert len(flat_schema_names(table)) == 2 + 7
    for table in ("pseudo_user_audiences", "users_user_audiences"):
        assert len(flat_schema_names(table)) == 2 + 8


@pytest.fixture(autouse=True)
def _session(spark):
    pass


def flat_schema_names(table):
    return flat_schema(table).names


def test_arrays_without_elements_give_no_rows(spark):
    rows = [event(event_params=None), event(event_params=[]), event(event_params=[param("a", int_value=1)])]
    assert flat(spark, "event_params", rows).count() == 1
    assert flat(spark, "items", rows).count() == 0


def test_null_element_gives_a_row_of_nulls(spark):
    row = flat(spark, "event_params", [event(event_params=[None])]).first()
    assert row.event_params_key is None and row.event_params_value is None and row.event_id


def test_parameter_values_as_text(spark):
    values = [
        param("string", string_value="x", int_value=9),
        param("int", int_value=9, double_value=1.5),
        param("float", float_value=2.5, double_value=1.5),
        param("double", double_value=1.5),
        param("none"),
        param("string", string_value="again"),
    ]
    rows = flat(spark, "event_params", [event(event_params=values)]).collect()
    got = sorted((r.event_params_key, r.event_params_value or "") for r in rows)
    assert got == [("double", "1.5"), ("float", "2.5"), ("int", "9"), ("none", ""), ("string", "again"), ("string", "x")]
    raw = {r.event_params_key: (r.event_params_string_value, r.event_params_int_value) for r in rows}
    assert raw["int"] == (None, 9) and raw["double"] == (None, None)


def test_user_tables_take_text_only(spark):
    user = {
        "user_id": "a",
        "dataset": "d",
        "shard": "20240107",
        "user_properties": [{"key": "k", "value": {"string_value": "v", "set_timestamp_micros": 3, "user_property_name": "n"}}],
        "audiences": [{"id": "1", "name": "x", "npa": "true"}, {"id": "2"}],
    }
    keyed = with_row_id(frame(spark, "users", [user]), "users")
    prop = flatten_table(keyed, "users_user_properties", "users").first()
    assert (prop.user_property_key, prop.user_property_value, prop.user_property_name) == ("k", "v", "n")
    audiences = flatten_table(keyed, "users_user_audiences", "users").collect()
    parent = flatten_table(keyed, "users", "users").first()
    assert [a.audience_id for a in audiences] == ["1", "2"]
    assert {a.row_id for a in audiences} == {parent.row_id}


def test_bad_event_date_is_an_error(spark):
    with pytest.raises(PySparkException):
        flat(spark, "events", [event(event_date="2024-13-99")]).collect()


def test_tag_follows_source(spark):
    assert flat(spark, "events", [event()]).first().source_table_type == "daily"
    assert flat(spark, "events", [event()], "events_intraday").first().source_table_type == "intraday"


def test_source_only_feeds_its_tables(spark):
    with pytest.raises(ValueError):
        flat(spark, "users", [event()])


def test_old_export_without_newer_columns(spark, tmp_path):
    names = [f.name for f in schemas.EVENTS.fields if f.name not in ("is_active_user", "publisher", "batch_page_id")]
    old = frame(spark, "events", [event()], position=False).select(*names, "dataset", "shard")
    old.write.partitionBy("dataset", "shard").parquet(f"{tmp_path}/events")
    row = flatten_table(with_event_id(read_source(spark, str(tmp_path), "events")), "events", "events").first()
    assert row.event_id == "s_u_view_1____1" and row.publisher_ad_format is None and row.is_active_user is None
    bare = with_event_id(old.withColumn("row_position", F.lit("0")))
    assert flatten_table(bare, "events", "events").first().publisher_ad_format is None


@pytest.mark.parametrize(
    "shard, collected, active",
    [("20230502", False, False), ("20230503", True, False), ("20230716", True, False), ("20230717", True, True)],
)
def test_same_day_columns_by_shard(spark, shard, collected, active):
    rows = [event(shard, is_active_user=True, collected_traffic_source={"gclid": "g"})]
    keyed = with_event_id(frame(spark, "events", rows), intraday_view=True)
    one = intraday_events(keyed, shard)
    assert ("collected_traffic_source_gclid" in one.columns) == collected
    assert ("is_active_user" in one.columns) == active
    assert "collected_traffic_source_manual_marketing_tactic" not in one.columns
    row = intraday_events(keyed).first()
    assert row.collected_traffic_source_gclid == ("g" if collected else None)
    assert row.is_active_user == (True if active else None)


def test_same_day_events_take_session_ids_that_were_read_before(spark):
    """So a shuffle of keyed rows need not carry the parameters."""
    rows = frame(spark, "events_intraday", [event(event_params=[param("ga_session_id", int_value=5)]), event(event_params=None)])
    keyed = with_event_id(rows, intraday_view=True)
    narrow = with_event_id(rows.withColumns(session_ids(separator=".")).drop("event_params"), intraday_view=True)
    assert sorted(intraday_events(narrow).collect(), key=str) == sorted(intraday_events(keyed).collect(), key=str)
    assert {row.session_id for row in intraday_events(narrow).collect()} == {"u.5", None}


def test_same_day_parameters_have_no_raw_values(spark):
    keyed = with_event_id(frame(spark, "events", [event(event_params=[param("k", int_value=1)])]), intraday_view=True)
    names = intraday_table(keyed, "event_params").columns
    assert "event_params_value" in names and "event_params_int_value" not in names


def test_columns_needed_cover_every_table(spark):
    for source, tables in schemas.TABLES_OF_SOURCE.items():
        for table in tables:
            names = columns_needed([table], source)
            rows = frame(spark, source, []).select(*names, *schemas.PLACE, "row_position")
            keyed = with_event_id(rows) if source.startswith("events") else with_row_id(rows, source)
            assert flatten_table(keyed, table, source).columns == flat_schema_names(table)
    assert "items" not in columns_needed(["event_params"], "events")
    assert "device" not in columns_needed(["event_params"], "events")


def test_scan_reads_only_what_a_table_needs(spark, tmp_path):
    root = export(spark, tmp_path, "events", [event(event_params=[param("ga_session_id", int_value=1)])])
    rows = read_source(spark, root, "events", shard="20240101", position=False)
    from flatweave.operators.keys import session_ids

    df = rows.select(*[v.alias(k) for k, v in session_ids().items()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [path.split("/")[-2] for path in df.inputFiles()] == ["shard=20240101"]
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert schema.endswith("event_params:array<struct<key:string,value:struct<int_value:bigint>>>>")


def test_flat_days_are_dates():
    for table in schemas.ALL_TABLES:
        assert flat_schema(table)[schemas.date_field(table)].dataType == T.DateType()
