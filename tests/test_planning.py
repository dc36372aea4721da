import json
import re

from pyspark.sql import functions as F

from flatweave.operators.relational import last_value_per_group, ordered_text, with_constants
from flatweave.plans.work import EVENTS_ONLY, backfill_grid, default_control, not_superseded, read_control, route, with_source
from flatweave.session import setting
from flatweave.sources.inventory import discover_datasets, union_datasets
from flatweave.sources.shards import read_source, write_source
from testbed.nested import SOURCE_ROW, event_base, nested_events, thinned

CONTROL = "dataset string, tables_to_flatten array<string>, sharded boolean, partitioned boolean, intraday_views boolean"
DAY = 86_400_000


def arrivals(spark, rows):
    return spark.createDataFrame(rows, "dataset string, source string, shard string")


def test_route_takes_configured_and_applicable_tables(spark):
    control = spark.createDataFrame(
        [
            ("a", ["events", "items", "users", "no_such_table"], None, None, None),
            ("b", ["users"], False, True, None),
            ("c", [], None, None, None),
        ],
        CONTROL,
    )
    rows = arrivals(
        spark,
        [
            ("a", "events", "1"), ("a", "events", "1"), ("a", "users", "1"), ("a", "events_intraday", "2"),
            ("b", "events", "1"), ("b", "users", "1"), ("c", "events", "1"), ("unknown", "events", "1"),
        ],
    )
    assert sorted(tuple(r) for r in route(rows, control).collect()) == [
        ("a", "events", "1", "flat_events", True, False),
        ("a", "events", "1", "flat_items", True, False),
        ("a", "events_intraday", "2", "flat_events", True, False),
        ("a", "events_intraday", "2", "flat_items", True, False),
        ("a", "users", "1", "flat_users", True, False),
        ("b", "users", "1", "flat_users", False, True),
    ]


def test_backfill_grid_is_inclusive_and_newest_first(spark):
    datasets = spark.createDataFrame([("a",), ("b",)], "dataset string")
    rows = backfill_grid(datasets, ("events", "users"), "20240228", "20240301").collect()
    assert len(rows) == 12
    assert [r.shard for r in rows] == sorted((r.shard for r in rows), reverse=True)
    assert {r.shard for r in rows} == {"20240228", "20240229", "20240301"}


def test_existing_and_superseded(spark):
    work = arrivals(spark, [("a", "events_intraday", "1"), ("a", "events_intraday", "2"), ("b", "events_intraday", "1")])
    daily = spark.createDataFrame([("a", "1")], "dataset string, shard string")
    assert [r.shard for r in with_source(work, daily).collect()] == ["1"]
    assert sorted((r.dataset, r.shard) for r in not_superseded(work, daily).collect()) == [("a", "2"), ("b", "1")]


def inventory(spark):
    now = 100 * DAY
    return spark.createDataFrame(
        [
            ("p", "analytics_2", "events_20240101", now - 29 * DAY),
            ("p", "analytics_1", "events_intraday_20240101", now - DAY),
            ("p", "analytics_1", "events_20240101", now - DAY),
            ("p", "analytics_3", "events_20240101", now - 30 * DAY),
            ("p", "analytics_4", "users_20240101", now),
            ("p", "analytics_5", "events_2024", now),
            ("p", "analytics_x", "events_20240101", now),
            ("p", "my_analytics_6", "events_20240101", now),
        ],
        "project string, dataset string, table_id string, creation_time long",
    )


def test_discovery(spark):
    now = F.timestamp_millis(F.lit(100 * DAY))
    assert [r.dataset for r in discover_datasets(inventory(spark), now).collect()] == ["analytics_1", "analytics_2"]
    control = default_control(inventory(spark), now=now).collect()
    assert [len(r.tables_to_flatten) for r in control] == [10, 10]
    assert (control[0].sharded, control[0].partitioned, control[0].intraday_views) == (True, False, True)
    short = default_control(inventory(spark), EVENTS_ONLY, now).first()
    assert short.tables_to_flatten == ["events", "event_params", "user_properties", "items"]


def test_control_file(spark, tmp_path):
    config = {
        "analytics_1": {
            "tables_to_flatten": ["events"],
            "output_format": {"sharded": True, "partitioned": True},
            "intraday_flattening": {
                "intraday_flat_tables_schedule": {"frequency": 15, "units": "minutes"},
                "intraday_flat_views": False,
            },
        },
        "analytics_2": {"tables_to_flatten": ["users", "items"]},
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config, indent=2))
    rows = {r.dataset: r for r in read_control(spark, str(path)).collect()}
    assert (rows["analytics_1"].partitioned, rows["analytics_1"].intraday_views) == (True, False)
    assert (rows["analytics_1"].frequency, rows["analytics_1"].units) == (15, "minutes")
    assert rows["analytics_2"].sharded is None and rows["analytics_2"].frequency is None
    work = route(arrivals(spark, [("analytics_2", "events", "1")]), read_control(spark, str(path))).collect()
    assert [(r.flat_table, r.sharded, r.partitioned) for r in work] == [("flat_items", True, False)]


def test_relational_helpers(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("y", None)], "k string, v string")
    last = last_value_per_group(df, ["k"], "v", "last")
    assert sorted((r.k, r.v or "", r.last or "") for r in last.collect()) == [
        ("x", "a", "b"), ("x", "b", "b"), ("x", "b", "b"), ("y", "", "")
    ]
    assert [tuple(r) for r in ordered_text(df, ["k"], "v", "t", "-").collect()] == [("x", "a-b-b")]
    assert with_constants(df, one=1).select("one").distinct().collect()[0].one == 1
    other = spark.createDataFrame([("z", 1)], "k string, n int")
    assert union_datasets([df, other, df]).count() == 9


def test_null_keys_form_a_group(spark):
    rows = [(None, "a"), (None, "b"), ("x", "c"), ("x", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    found = last_value_per_group(df, ["k"], "v", "last").collect()
    assert {tuple(row) for row in found} == {(*row, {None: "b", "x": "c"}[row[0]]) for row in rows}


def test_numbers_are_joined_in_their_own_order(spark):
    df = spark.createDataFrame([("a", n) for n in (100, 9, 10, 9, None, -1)], "k string, v long")
    assert ordered_text(df, ["k"], "v", "t", ",").first().t == "-1,9,9,10,100"


def test_wide_rows_are_neither_shuffled_nor_sorted_to_write_an_export(spark, tmp_path):
    rows = nested_events(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions", 1)
    assert "named_struct" in above and "named_struct" not in below
    write_source(rows, str(tmp_path / "one"), "events", clustered=True)
    again = read_source(spark, str(tmp_path / "one"), "events", extra=[SOURCE_ROW], position=False)
    write_source(again, str(tmp_path / "two"), "events", clustered=True)
    copied = read_source(spark, str(tmp_path / "two"), "events", extra=[SOURCE_ROW], position=False)
    assert copied.exceptAll(rows.select(*copied.columns)).isEmpty() and copied.count() == rows.count()


def test_lines_and_orders_without_an_event_are_left_out_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame([("n", 1, 1)], "n_name string, n_nationkey long, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([("r", 1)], "r_name string, r_regionkey long").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(1, 1)], "c_custkey long, c_nationkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "p")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    # Two rows of one event, an event that is no purchase, and lines and orders with and without an event, or a key.
    events = [(1, "purchase", 1), (1, "purchase", 2), (2, "view", 1), (None, "purchase", 1), (7, "purchase", 1)]
    kinds = "event_id long, event_type string, user_id long"
    moment = F.timestamp_seconds(F.lit(0))
    spark.createDataFrame(events, kinds).withColumn("ts", moment).write.parquet(f"{tmp_path}/events.parquet")
    lines = [(1, 1), (1, 9), (2, 1), (None, 1), (7, None)] + [(key, 1) for key in range(100, 1100)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 1.0), (1, 2.0), (2, 3.0), (None, 4.0)] + [(key, 5.0) for key in range(100, 1100)]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")

    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    with setting(spark, broadcast, "-1"), setting(spark, "spark.sql.adaptive.enabled", "false"), thinned(spark):
        base = event_base(spark, str(tmp_path)).select("event_id", "event_type", "user_id", "l_partkey", "o_totalprice", "p_name")
        plan = base._jdf.queryExecution().optimizedPlan().toString()
        found = sorted(map(tuple, base.collect()), key=str)
    for column in ("l_orderkey", "o_orderkey"):
        assert re.search(rf"might_contain\(.*{column}", plan)
    bought = [(1, part, price, name) for part, name in ((1, "p"), (9, None)) for price in (1.0, 2.0)]
    expected = [(1, "purchase", user, part, price, name) for user in (1, 2) for _, part, price, name in bought]
    expected += [(2, "view", 1, None, None, None), (None, "purchase", 1, None, None, None), (7, "purchase", 1, None, None, None)]
    assert found == sorted(expected, key=str)
