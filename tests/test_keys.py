import pytest
from nested_rows import event, export, frame, param
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from flatweave.functions.expressions import param_value
from flatweave.operators.keys import repeat_numbers, session_ids, with_event_id, with_row_id
from flatweave.operators.numbering import number_rows
from flatweave.plans.flatten_job import key_events
from flatweave.session import Stages
from flatweave.sources.shards import read_source


def ids(df):
    return sorted(str(row.event_id) for row in df.select("event_id").collect())


def test_daily_id_parts_and_nulls(spark):
    rows = [
        event(batch_event_index=3, batch_ordering_id=5),
        event(user_pseudo_id=None),
        event(stream_id=None),
        event(event_name=None),
        event(event_timestamp=None),
    ]
    assert ids(with_event_id(frame(spark, "events", rows))) == ["None", "None", "None", "s__view_1____1", "s_u_view_1_3__5_1"]


def test_intraday_id_parts_and_nulls(spark):
    rows = [event(), event(), event(user_pseudo_id=None), event(stream_id=None), event(batch_event_index=1)]
    keyed = with_event_id(frame(spark, "events", rows), intraday_view=True)
    assert ids(keyed) == ["None", "s.u.view.1.1", "s.u.view.1.2", "s.u.view.1.3", "s.user_pseudo_id_null.view.1.1"]


def test_groups_are_joined_without_separator(spark):
    rows = [event(stream_id="1", user_pseudo_id="23"), event(stream_id="12", user_pseudo_id="3")]
    numbers = [key.rsplit("_", 1)[1] for key in ids(with_event_id(frame(spark, "events", rows)))]
    assert sorted(numbers) == ["1", "2"]
    apart = with_event_id(frame(spark, "events", rows), intraday_view=True)
    assert [key.rsplit(".", 1)[1] for key in ids(apart)] == ["1", "1"]


def test_shards_and_datasets_are_numbered_apart(spark):
    rows = [event(), event("20240102"), event(dataset="analytics_2"), event()]
    assert [key[-1] for key in ids(with_event_id(frame(spark, "events", rows)))] == ["1", "1", "1", "2"]


def skewed(spark, rows=3000):
    """A third of all rows in one group, a third without a key, the rest in small groups."""
    base = spark.range(rows).select(
        F.lit("analytics_1").alias("dataset"),
        F.lit("20240101").alias("shard"),
        F.when(F.col("id") % 3 != 1, F.lit("s")).alias("stream_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 400)).alias("user_pseudo_id"),
        F.lit("view").alias("event_name"),
        F.lit(1).cast("long").alias("event_timestamp"),
        F.col("id").cast("string").alias("row_position"),
    )
    return base


def test_cutting_large_groups_changes_no_number(spark):
    events = skewed(spark)
    whole = with_event_id(events)
    cut = with_event_id(events, hot_rows=20, rows_per_task=100)
    both = whole.select("row_position", F.col("event_id").alias("a")).join(
        cut.select("row_position", F.col("event_id").alias("b")), "row_position"
    )
    assert both.count() == 3000
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    hot = {row.event_id for row in cut.where("user_pseudo_id = 'hot' AND stream_id IS NOT NULL").collect()}
    assert hot == {f"s_hot_view_1____{n}" for n in range(1, 1001)}


def test_ranges_of_a_large_group_are_small(spark):
    keys = [F.concat("stream_id", "user_pseudo_id")]
    numbered = number_rows(skewed(spark), keys, "n", hot_rows=20, rows_per_task=100)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in plan
    # 1000 rows cut by ceil(log2(1000 / 20)) = 6 bits: 64 ranges of about 16 rows.
    sizes = (
        skewed(spark)
        .where("user_pseudo_id = 'hot' AND stream_id IS NOT NULL")
        .select(F.shiftright(F.conv(F.substring(F.md5("row_position"), 1, 15), 16, 10).cast("long"), 54).alias("cut"))
        .groupBy("cut")
        .count()
    )
    assert sizes.agg(F.max("count")).first()[0] < 40


def test_copies_of_one_row_get_different_numbers(spark):
    rows = [event() for _ in range(50)]
    keyed = with_event_id(frame(spark, "events", rows), hot_rows=5)
    assert keyed.select("event_id").distinct().count() == 50


def test_staged_and_lazy_keys_agree(spark):
    events = skewed(spark)
    expected = {(r.row_position, r.event_id) for r in with_event_id(events).collect()}
    with Stages(spark) as stages:
        keyed = key_events(events, stages=stages, hot_rows=20, rows_per_task=100)
        assert {(r.row_position, r.event_id) for r in keyed.collect()} == expected


def test_many_numbers_are_joined_by_parts_of_shards_without_sorting_the_rows(spark):
    events = skewed(spark)
    expected = {(r.row_position, r.event_id) for r in with_event_id(events).collect()}
    with Stages(spark) as stages:
        keyed = key_events(events, stages=stages, most_broadcast=0)
        assert {(r.row_position, r.event_id) for r in keyed.collect()} == expected
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_are_shuffled_for_their_keys_only(spark):
    """Wide rows move once at most, however many repeat a key."""
    wide = skewed(spark).withColumn("payload", F.repeat(F.lit("x"), 100))
    with Stages(spark) as stages:
        keyed = key_events(wide, stages=stages)
        plan = keyed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("payload") <= 4 and "Window" not in plan
        assert "Repartition" not in plan


def test_repeat_numbers_leaves_first_rows_out(spark):
    rows = [event(), event(), event(event_name="click")]
    assert [r[3] for r in repeat_numbers(frame(spark, "events", rows)).collect()] == [2]


def test_numbers_match_a_plain_window(spark):
    events = skewed(spark).where("stream_id IS NOT NULL")
    window = Window.partitionBy("user_pseudo_id").orderBy(F.conv(F.substring(F.md5("row_position"), 1, 15), 16, 10).cast("long"))
    plain = events.select("row_position", F.row_number().over(window).alias("n")).collect()
    ours = number_rows(events, [F.col("user_pseudo_id")], "n", hot_rows=30).select("row_position", "n").collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, ours))


def test_scan_position_makes_ids_repeatable(spark, tmp_path):
    root = export(spark, tmp_path, "events", [event(), event(), event("20240102"), event(event_name="click")])
    rows = read_source(spark, root, "events")
    assert rows.select("dataset", "shard", "row_position").distinct().count() == 4
    one, two = (sorted(map(tuple, with_event_id(rows).select("row_position", "event_id").collect())) for _ in range(2))
    assert one == two


def test_session_ids(spark):
    rows = [
        event(event_params=[param("ga_session_id", int_value=7), param("ga_session_number", int_value=2)]),
        event(event_params=[param("x", int_value=7)]),
        event(event_params=[]),
        event(event_params=None),
        event(user_pseudo_id=None, event_params=[param("ga_session_id", int_value=7)]),
        event(event_params=[param("ga_session_id", string_value="7")]),
        event(event_params=[param("ga_session_id", int_value=1), param("ga_session_id", int_value=2)]),
    ]
    df = frame(spark, "events", rows).orderBy("row_position").select(*[v.alias(k) for k, v in session_ids().items()])
    assert [tuple(r) for r in df.collect()] == [
        ("u_7", "u_2"), (None, None), (None, None), (None, None), (None, None), (None, None), ("u_1", None)
    ]
    dotted = frame(spark, "events", rows[:1]).select(session_ids(".")["session_id"].alias("s")).first().s
    assert dotted == "u.7"


def test_strict_lookup_rejects_repeated_parameter(spark):
    rows = [event(event_params=[param("k", int_value=1), param("k", int_value=2)])]
    df = frame(spark, "events", rows)
    assert df.select(param_value("event_params", "k").alias("v")).first().v == 1
    with pytest.raises(PySparkException, match="more than one value"):
        df.select(param_value("event_params", "k", strict=True)).collect()


def test_row_ids(spark):
    users = frame(spark, "users", [{"user_id": u, "dataset": "d", "shard": "20240107"} for u in ("a", "b", "a")])
    keyed = with_row_id(users, "users")
    rows = keyed.select("row_id", "date").collect()
    assert len({r.row_id for r in rows}) == 3
    assert {str(r.date) for r in rows} == {"2024-01-07"}
    assert rows == with_row_id(users, "users").select("row_id", "date").collect()
    assert all(len(r.row_id) == 36 and r.row_id.count("-") == 4 for r in rows)
    drawn = with_row_id(users, "users", random=True).select("row_id").collect()
    assert {r.row_id for r in rows}.isdisjoint(r.row_id for r in drawn)
