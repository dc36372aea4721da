import base64
import json
import os
import time

import pytest
from nested_rows import DATASET, event, export, frame, param
from test_messages import arrival, lifecycle

from flatweave.operators.keys import with_event_id
from flatweave.plans.flatten_job import flatten_work
from flatweave.plans.work import route
from flatweave.sinks.tables import SHARDED, read_flat, shard_state
from flatweave.sources.shards import read_source
from flatweave.streaming.arrivals import flatten_on_arrival, read_messages, record_rejected, rejected_messages
from flatweave.streaming.intraday import (
    create_views,
    drop_views,
    existing_views,
    intraday_table,
    keyed_view_name,
    manage_views,
    refresh_intraday,
    refresh_interval,
    refresh_on_schedule,
    scheduled,
    view_name,
)

CONTROL = (
    "dataset string, tables_to_flatten array<string>, sharded boolean, partitioned boolean, intraday_views boolean,"
    " frequency int, units string"
)


def control(spark, tables, views=True, frequency=None, units=None, dataset=DATASET):
    return spark.createDataFrame([(dataset, tables, True, False, views, frequency, units)], CONTROL)


def send(inbox, name, *bodies):
    inbox.mkdir(exist_ok=True)
    lines = [json.dumps({"data": base64.b64encode(json.dumps(body).encode()).decode()}) for body in bodies]
    (inbox / f"{name}.json").write_text("\n".join(lines))


def shards(spark, out, table="events"):
    rows = read_flat(spark, out, SHARDED, table).groupBy("shard").count().collect()
    return {r.shard: r["count"] for r in rows}


def announce(source, shard, dataset=DATASET):
    return arrival(f"projects/p/datasets/{dataset}/tables/{source}_{shard}")


def test_arrivals_are_flattened_once_each(spark, tmp_path):
    root, out, inbox = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "inbox"
    export(spark, root, "events", [event("20240101"), event("20240102"), event("20240103")])

    def drain():
        flatten_on_arrival(
            read_messages(spark, str(inbox)), control(spark, ["events"]), root, out, str(tmp_path / "checkpoint")
        ).awaitTermination()

    send(inbox, "1", announce("events", "20240101"), announce("events", "20240101"), {"junk": 1},
         announce("events", "20240102", "analytics_404"), announce("users", "20240101"))
    drain()
    assert shards(spark, out) == {"20240101": 1}
    # A late, larger version of a shard replaces it; a message is handled once.
    export(spark, root, "events", [event("20240101"), event("20240101", event_name="late"), event("20240103")])
    send(inbox, "2", announce("events", "20240101"), announce("events", "20240103"))
    drain()
    drain()
    assert shards(spark, out) == {"20240101": 2, "20240103": 1}


def test_refresh_recomputes_present_shards(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")

    def drain():
        refresh_intraday(
            spark, control(spark, ["events"]), root, out, str(tmp_path / "checkpoint")
        ).awaitTermination()

    export(spark, root, "events_intraday", [event("20240102")])
    drain()
    assert shards(spark, out) == {"20240102": 1}
    more = frame(spark, "events_intraday", [event("20240102"), event("20240103")], position=False)
    more.write.mode("append").partitionBy("dataset", "shard").parquet(f"{root}/events_intraday")
    drain()
    assert shards(spark, out) == {"20240102": 2, "20240103": 1}
    ids = [r.event_id for r in read_flat(spark, out, SHARDED, "events").where("shard = '20240102'").collect()]
    assert sorted(ids) == ["s_u_view_1____1", "s_u_view_1____2"]
    # A file rewritten under its old name is seen too.
    folder = next((tmp_path / "in" / "events_intraday").glob("dataset=*/shard=20240103"))
    names = {path.name: path for path in folder.iterdir() if path.name.startswith("part-")}
    other = frame(spark, "events_intraday", [event("20240103"), event("20240103")], position=False)
    other.drop("dataset", "shard").coalesce(1).write.parquet(str(tmp_path / "other"))
    new = next((tmp_path / "other").glob("part-*"))
    for path in names.values():
        path.write_bytes(new.read_bytes())
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    drain()
    assert shards(spark, out) == {"20240102": 2, "20240103": 2 * len(names)}


def test_views_follow_messages(spark, tmp_path):
    root, inbox = str(tmp_path / "in"), tmp_path / "inbox"
    dataset = "analytics_31"
    rows = [event("20240102", dataset=dataset, event_params=[param("a", int_value=1)])]
    export(spark, root, "events_intraday", rows)

    def drain(table_control):
        manage_views(
            read_messages(spark, str(inbox)), table_control, root, str(tmp_path / "checkpoint")
        ).awaitTermination()

    on = control(spark, ["events", "event_params", "users"], dataset=dataset)
    send(inbox, "1", lifecycle("insert", "20240102", dataset, "2024-01-02T00:00:00Z"))
    drain(on)
    params, events, keyed = (
        view_name(dataset, "event_params", "20240102"), view_name(dataset, "events", "20240102"), keyed_view_name(dataset, "20240102")
    )
    assert spark.table(params).first().event_id == "s.u.view.1.1"
    assert spark.table(events).first().source_table_type == "intraday"
    assert not spark.catalog.tableExists(view_name(dataset, "items", "20240102"))
    send(inbox, "2", lifecycle("delete", "20240102", dataset, "2024-01-03T00:00:00Z"))
    drain(on)
    assert not any(spark.catalog.tableExists(name) for name in (params, events, keyed))
    send(inbox, "3", lifecycle("insert", "20240102", dataset, "2024-01-04T00:00:00Z"))
    drain(control(spark, ["events"], views=False, dataset=dataset))
    assert not spark.catalog.tableExists(events)


def test_late_and_timeless_messages_do_not_revive_views(spark, tmp_path):
    root, inbox, dataset = str(tmp_path / "in"), tmp_path / "inbox", "analytics_32"
    export(spark, root, "events_intraday", [event(f"2024010{day}", dataset=dataset) for day in range(1, 5)])
    insert, delete = (lambda shard, at, kind=kind: lifecycle(kind, shard, dataset, at) for kind in ("insert", "delete"))
    # Files are read one after the other, a batch each.
    send(inbox, "1", insert("20240101", "2024-01-02T00:00:00Z"), insert("20240102", "2024-01-02T00:00:00Z"))
    send(inbox, "2", delete("20240101", "2024-01-05T00:00:00Z"), delete("20240103", None),
         insert("20240104", "2024-01-02T00:00:00Z"), delete("20240104", "2024-01-02T00:00:00Z"))
    send(inbox, "3", insert("20240101", "2024-01-04T00:00:00Z"), insert("20240109", "2024-01-04T00:00:00Z"))
    for at, name in enumerate(sorted(inbox.iterdir())):
        os.utime(name, (1_700_000_000 + at, 1_700_000_000 + at))
    manage_views(
        read_messages(spark, str(inbox), 1), control(spark, ["events"], dataset=dataset), root, str(tmp_path / "checkpoint")
    ).awaitTermination()
    there = [day for day in (1, 2, 3, 4, 9) if spark.catalog.tableExists(view_name(dataset, "events", f"2024010{day}"))]
    assert there == [2]


def test_refresh_intervals():
    assert refresh_interval(30, "minutes") == "30 minutes"
    assert refresh_interval(1, "hours") == "1 hours"
    for frequency, units in ((60, "minutes"), (0, "minutes"), (1, "hour"), (0, "hours")):
        with pytest.raises(ValueError):
            refresh_interval(frequency, units)


def written_at(spark, out, table="events"):
    return {(r.dataset, r.shard): r.version for r in shard_state(spark, out, SHARDED, table).collect()}


def test_refresh_leaves_unchanged_shards_alone(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events_intraday", [event("20240102"), event("20240103")])

    def drain():
        refresh_intraday(spark, control(spark, ["events"]), root, out, str(tmp_path / "checkpoint")).awaitTermination()
        return written_at(spark, out)

    first = drain()
    assert len(first) == 2 and drain() == first
    more = frame(spark, "events_intraday", [event("20240103")], position=False)
    more.write.mode("append").partitionBy("dataset", "shard").parquet(f"{root}/events_intraday")
    third = drain()
    assert {pair[1] for pair in first if third[pair] != first[pair]} == {"20240103"}
    assert shards(spark, out) == {"20240102": 1, "20240103": 2}
    # A removed file is a change as well, and a daily export takes the shard over.
    folder = next((tmp_path / "in" / "events_intraday").glob("dataset=*/shard=20240103"))
    next(path for path in folder.iterdir() if path.name.startswith("part-")).unlink()
    drain()
    assert shards(spark, out)["20240103"] in (1, 0)
    export(spark, root, "events", [event("20240102")])
    flatten_work(spark, route(spark.createDataFrame([(DATASET, "events", "20240102")], "dataset string, source string, shard string"),
                              control(spark, ["events"])), root, out)
    daily = written_at(spark, out)
    drain()
    assert written_at(spark, out) == daily


def test_due_schedules(spark):
    both = control(spark, ["events"], frequency=30, units="minutes").unionByName(
        control(spark, ["events"], frequency=2, units="hours", dataset="analytics_2")
    ).unionByName(control(spark, ["events"], dataset="analytics_3")).unionByName(
        control(spark, ["events"], frequency=60, units="minutes", dataset="analytics_4")
    )
    due = {tick: {r.dataset for r in scheduled(both, tick)[0].collect()} for tick in (0, 1, 30, 60, 120)}
    assert due == {0: {DATASET, "analytics_2"}, 1: set(), 30: {DATASET}, 60: {DATASET}, 120: {DATASET, "analytics_2"}}
    assert scheduled(both, 0)[1] == ["analytics_4"]


def test_schedules_are_read_at_each_tick(spark, tmp_path):
    """A dataset whose schedule comes while the stream runs is refreshed without a restart."""
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events_intraday", [event("20240102"), event("20240102", dataset="analytics_2")])
    tables = [control(spark, ["events"], frequency=1, units="minutes").unionByName(control(spark, ["events"], dataset="analytics_2"))]
    stream = refresh_on_schedule(
        spark, lambda: tables[-1], root, out, str(tmp_path / "checkpoint"), trigger={"processingTime": "1 second"}
    )

    def wait_for(count):
        deadline = time.monotonic() + 90
        while len(written_at(spark, out)) < count and time.monotonic() < deadline and stream.isActive:
            time.sleep(0.3)
        return {dataset for dataset, _ in written_at(spark, out)}

    try:
        assert wait_for(1) == {DATASET}
        tables.append(control(spark, ["events"], frequency=1, units="minutes", dataset="analytics_2"))
        assert wait_for(2) == {DATASET, "analytics_2"}
    finally:
        stream.stop()
    bad = control(spark, ["events"], frequency=60, units="minutes")
    with pytest.raises(ValueError):
        refresh_on_schedule(spark, bad, root, out, str(tmp_path / "other"))


def test_rejected_messages_are_kept_with_a_reason(spark, tmp_path):
    inbox = tmp_path / "inbox"
    send(inbox, "1", announce("events", "20240101"), announce("events", "2024"), {"protoPayload": {}}, [1], "x")
    (inbox / "2.json").write_text(
        "\n".join(json.dumps({"data": data}) for data in ("%%%", base64.b64encode(b'{"a": ').decode(), None, base64.b64encode(b"").decode()))
    )

    def drain():
        record_rejected(read_messages(spark, str(inbox)), "arrival", str(tmp_path / "bad"), str(tmp_path / "c")).awaitTermination()
        return sorted((r.reason, r.message) for r in spark.read.parquet(str(tmp_path / "bad")).collect() if r.message)

    found = drain()
    assert [reason for reason, _ in found].count("names no table of an export") == 1
    assert ("no resource name", '{"protoPayload": {}}') in found
    reasons = [r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()]
    assert None not in reasons and len(reasons) == 8 and reasons.count("not base64 text") == 2
    assert drain() == found


def test_rejected_lifecycle_messages(spark, tmp_path):
    inbox = tmp_path / "inbox"
    good = lifecycle("insert", "20240102", DATASET, "2024-01-02T00:00:00Z")
    two = lifecycle("delete", "20240102", DATASET, "2024-01-02T00:00:00Z")
    two["protoPayload"]["authorizationInfo"] *= 2
    send(inbox, "1", good, two, lifecycle("delete", "20240102", DATASET, None), lifecycle("insert", "2024", DATASET, "2024-01-02T00:00:00Z"),
         {"protoPayload": {"methodName": "other"}})
    rows = rejected_messages(spark.read.schema("data string").json(str(inbox)), "lifecycle").collect()
    assert sorted(r.reason for r in rows) == [
        "names no same-day table", "neither a creation nor a deletion", "no readable time", "not one resource",
    ]


def test_views_outlive_the_stream_and_the_session(spark, tmp_path):
    """Every batch by a stream of its own, which knows only what the checkpoint holds."""
    root, inbox, dataset = str(tmp_path / "in"), tmp_path / "inbox", "analytics_33"
    export(spark, root, "events_intraday", [event(f"2024010{day}", dataset=dataset) for day in (1, 2)])

    def drain(name, *bodies):
        send(inbox, name, *bodies)
        manage_views(
            read_messages(spark, str(inbox)), control(spark, ["events"], dataset=dataset), root, str(tmp_path / "checkpoint")
        ).awaitTermination()

    drain("1", *(lifecycle("insert", f"2024010{day}", dataset, "2024-01-02T00:00:00Z") for day in (1, 2)))
    drain("2", lifecycle("delete", "20240101", dataset, "2024-01-05T00:00:00Z"))
    drain("3", lifecycle("insert", "20240101", dataset, "2024-01-04T00:00:00Z"))
    other = spark.newSession()
    there = [day for day in (1, 2) if other.catalog.tableExists(f"default.{view_name(dataset, 'events', f'2024010{day}')}")]
    assert there == [2]
    drain("4", lifecycle("insert", "20240101", dataset, "2024-01-06T00:00:00Z"))
    assert other.table(view_name(dataset, "events", "20240101")).count() == 1


def test_views_read_live(spark, tmp_path):
    root, dataset = str(tmp_path / "in"), "analytics_34"
    export(spark, root, "events_intraday", [event("20240101", dataset=dataset)])
    assert len(create_views(spark, root, dataset, "20240101", ["event_params", "events", "users"])) == 3
    events = view_name(dataset, "events", "20240101")
    assert spark.table(events).count() == 1
    more = frame(spark, "events_intraday", [event("20240101", dataset=dataset)] * 2, position=False)
    more.write.mode("append").partitionBy("dataset", "shard").parquet(f"{root}/events_intraday")
    assert {r.event_id for r in spark.table(events).collect()} == {f"s.u.view.1.{n}" for n in (1, 2, 3)}


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_view_numbers_are_those_of_the_job(spark, tmp_path, hot_rows):
    """Groups that are cut or not, and null keys: the text of a view says what the operators do."""
    root, dataset, shard = str(tmp_path / "in"), "odd_set", "20240101"
    rows = [event(shard, dataset=dataset, event_name="it's"[: 2 + i % 3], event_params=[param("ga_session_id", int_value=i)]) for i in range(90)]
    rows += [event(shard, dataset=dataset, user_pseudo_id=None), event(shard, dataset=dataset, event_name=None)]
    export(spark, root, "events_intraday", rows)
    tables = ["events", "event_params", "user_properties", "items"]
    create_views(spark, root, dataset, shard, tables, hot_rows=hot_rows)
    keyed = with_event_id(read_source(spark, root, "events_intraday"), intraday_view=True, hot_rows=hot_rows)
    for table in tables:
        expected = intraday_table(keyed, table, shard)
        found = spark.table(f"`{view_name(dataset, table, shard)}`")
        assert found.columns == expected.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_views_of_an_old_or_empty_shard(spark, tmp_path):
    """Columns that the files lack are null, a directory without files has no views."""
    root, dataset = tmp_path / "in", "analytics_35"
    old = spark.sql(
        "SELECT '20240101' AS event_date, 1L AS event_timestamp, 'view' AS event_name, 's' AS stream_id, 'u' AS user_pseudo_id,"
        " array(struct('a' AS key, struct('x' AS string_value) AS value)) AS event_params"
    )
    old.write.parquet(str(root / f"events_intraday/dataset={dataset}/shard=20240101"))
    (root / f"events_intraday/dataset={dataset}/shard=20240102").mkdir()
    tables = ["events", "event_params", "user_properties", "items"]
    assert create_views(spark, str(root), dataset, "20240102", tables) == []
    assert create_views(spark, str(root), dataset, "20240103", tables) == []
    assert len(create_views(spark, str(root), dataset, "20240101", tables)) == 5
    row = spark.table(view_name(dataset, "event_params", "20240101")).first()
    assert (row.event_id, row.event_params_key, row.event_params_value) == ("s.u.view.1.1", "a", "x")
    row = spark.table(view_name(dataset, "events", "20240101")).first()
    assert row.geo_country is None and row.session_id is None
    assert spark.table(view_name(dataset, "items", "20240101")).count() == 0
    drop_views(spark, dataset, "20240101")
    assert not [name for name in existing_views(spark) if name.startswith(dataset)]
