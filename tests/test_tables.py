import os
import pathlib
import time

import pytest
from nested_rows import DATASET, event, export, param
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave import quality
from flatweave.operators.relational import rejoin
from flatweave.plans.flatten_job import backfill, flatten_work, keyed_source, number_steps
from flatweave.plans.work import route
from flatweave.session import Stages, drop_stage, setting, shared_folder
from flatweave.sinks.tables import (
    PARTITIONED,
    SHARDED,
    current_counts,
    footer_counts,
    ledger,
    read_flat,
    replace_shards,
    rows_path,
    shard_state,
)
from flatweave.sources.shards import among, read_source, shard_table

CONTROL = "dataset string, tables_to_flatten array<string>, sharded boolean, partitioned boolean, intraday_views boolean"


def work(spark, shards, tables=("events", "event_params"), source="events", sharded=True, partitioned=True):
    control = spark.createDataFrame([(DATASET, list(tables), sharded, partitioned, True)], CONTROL)
    arrivals = spark.createDataFrame([(DATASET, source, s) for s in shards], "dataset string, source string, shard string")
    return route(arrivals, control)


def two_days():
    return [
        event("20240101", event_params=[param("a", int_value=1), param("b", int_value=2)]),
        event("20240101", event_params=[param("a", int_value=1)]),
        event("20240102", event_params=[param("a", int_value=1)]),
    ]


def counts(spark, out, table="event_params", layout=PARTITIONED):
    flat = read_flat(spark, out, layout, table)
    return {(r.shard, str(r.event_date)): r["count"] for r in flat.groupBy("shard", "event_date").count().collect()}


def staged_folders(spark):
    return partition_free(f"{shared_folder(spark)}/flatweave/{spark.sparkContext.applicationId}")


def partition_free(folder):
    path = pathlib.Path(folder.removeprefix("file:"))
    return {p.name for p in path.iterdir() if not p.name.startswith("nested-")} if path.exists() else set()


def test_a_shard_has_few_files_though_many_rows_repeat_a_key(spark, tmp_path):
    days = [f"202401{day:02}" for day in range(1, 13)]
    rows = [event(day, event_params=[param("a", int_value=at)]) for day in days for at in range(40)]
    root, out = export(spark, tmp_path / "in", "events", rows), str(tmp_path / "out")
    with setting(spark, "spark.sql.shuffle.partitions", "16"):
        flatten_work(spark, work(spark, days, partitioned=False), root, out, most_broadcast=0)
    for table in ("events", "event_params"):
        files = list(pathlib.Path(rows_path(out, SHARDED, table)).rglob("*.parquet"))
        # 32 parts of 12 shards; it was one file for each task and shard, about 190.
        assert len(files) <= 48
        flat = read_flat(spark, out, SHARDED, table)
        assert flat.count() == flat.select("shard", "event_id").distinct().count() == 480


def test_many_numbers_are_joined_by_steps_of_shards_without_shuffling_rows(spark, tmp_path):
    days = [f"202401{day:02}" for day in range(1, 5)]
    # 39 rows of a day repeat a key, and 199 of the last one: above what may be broadcast here.
    rows = [event(day, event_params=[param("a", int_value=at)]) for day in days for at in range(200 if day == days[-1] else 40)]
    root, out = export(spark, tmp_path / "in", "events", rows), str(tmp_path / "out")
    pairs = [(DATASET, day) for day in days]
    with Stages(spark) as stages:
        scan = read_source(spark, root, "events")
        steps = number_steps(scan, pairs, stages, most_broadcast=100)
        assert sorted(pair for step, _ in steps for pair in step) == pairs
        assert [len(step) for step, _ in steps] == [2, 1, 1]
        for step, numbers in steps:
            keyed = keyed_source(spark, root, "events", ["events"], numbers=numbers, rows=scan.where(among(step)))
            assert keyed.select("event_id", "shard").distinct().count() == sum(200 if day == days[-1] else 40 for _, day in step)
            plan = keyed._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan and "hashpartitioning" not in plan) == (step != pairs[-1:])
    whole = str(tmp_path / "whole")
    flatten_work(spark, work(spark, days, ("event_params",)), root, whole)
    for _ in range(3):
        flatten_work(spark, work(spark, days, ("event_params",)), root, out, most_broadcast=100)
    for layout in (SHARDED, PARTITIONED):
        flat, expected = (read_flat(spark, one, layout, "event_params") for one in (out, whole))
        assert flat.count() == expected.count() == 320
        assert flat.exceptAll(expected).count() == 0
        assert all(published == now for published, now in current_counts(spark, out, layout, "event_params").values())
    # Of each shard, its last version and the one before.
    versions = shard_state(spark, out, SHARDED, "event_params")
    assert versions.select("version").distinct().count() == 3
    assert len(list(pathlib.Path(rows_path(out, SHARDED, "event_params")).iterdir())) == 6


def test_layouts_agree_and_runs_are_idempotent(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    before = staged_folders(spark)
    for _ in range(2):
        flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
        for table in ("events", "event_params"):
            sharded, partitioned = (read_flat(spark, out, layout, table) for layout in (SHARDED, PARTITIONED))
            assert quality.written_differences(spark, out, table) == []
            assert quality.day_is_date(quality.as_written(spark, out, PARTITIONED, table), table)
            assert quality.days_match_partitions(spark, out, table)
            assert quality.count_difference(sharded, partitioned) == 0
            assert quality.day_count_differences(sharded, partitioned).count() == 0
        assert counts(spark, out) == {("20240101", "2024-01-01"): 3, ("20240102", "2024-01-02"): 1}
        events = read_flat(spark, out, SHARDED, "events")
        assert quality.repeated_keys(events).count() == 0
        assert rejoin(events, read_flat(spark, out, SHARDED, "event_params")).count() == 4
    assert staged_folders(spark) == before


def test_checks_see_wrong_tables(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101"], ("items", "event_params")), root, out)
    path = rows_path(out, PARTITIONED, "event_params")
    rows = quality.as_written(spark, out, PARTITIONED, "event_params")
    wrong = rows.withColumn("event_params_int_value", F.col("event_params_int_value").cast("string")).drop("event_id")
    wrong.withColumns({"event_date": F.lit("20240101x"), "version": F.lit("v")}).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("version", "dataset", "event_date", "shard").parquet(f"{path}-new")
    pathlib.Path(path).rename(f"{path}-old")
    pathlib.Path(f"{path}-new").rename(path)
    assert quality.written_differences(spark, out, "event_params")[:1] == ["event_date"] or set(
        quality.written_differences(spark, out, "event_params")
    ) >= {"event_id", "event_params_int_value"}
    assert not quality.day_is_date(quality.as_written(spark, out, PARTITIONED, "event_params"), "event_params")
    assert not quality.days_match_partitions(spark, out, "event_params")


def test_one_day_is_replaced_alone(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    export(spark, tmp_path / "in", "events", [event("20240102", event_params=[param("z", int_value=i) for i in range(5)])])
    flatten_work(spark, work(spark, ["20240102"]), root, out)
    assert counts(spark, out) == {("20240101", "2024-01-01"): 3, ("20240102", "2024-01-02"): 5}


def test_empty_result_clears_the_day(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    export(spark, tmp_path / "in", "events", [event("20240102", event_params=None)])
    flatten_work(spark, work(spark, ["20240102"]), root, out)
    for layout in (SHARDED, PARTITIONED):
        assert counts(spark, out, layout=layout) == {("20240101", "2024-01-01"): 3}
    # The day can be filled again.
    export(spark, tmp_path / "in", "events", two_days())
    flatten_work(spark, work(spark, ["20240102"]), root, out)
    assert counts(spark, out)[("20240102", "2024-01-02")] == 1


def test_stray_dates_stay_with_their_shard(spark, tmp_path):
    stray = event("20240102", event_date="20240101", event_params=[param("s", int_value=1)])
    root, out = export(spark, tmp_path / "in", "events", [*two_days(), stray]), str(tmp_path / "out")
    expected = {("20240101", "2024-01-01"): 3, ("20240102", "2024-01-02"): 1, ("20240102", "2024-01-01"): 1}
    for shards in (["20240101", "20240102"], ["20240102"], ["20240101"]):
        flatten_work(spark, work(spark, shards), root, out)
        assert counts(spark, out) == expected
    # Once the stray is corrected, its old copy goes.
    export(spark, tmp_path / "in", "events", two_days())
    flatten_work(spark, work(spark, ["20240102"]), root, out)
    assert counts(spark, out) == {("20240101", "2024-01-01"): 3, ("20240102", "2024-01-02"): 1}


def test_missing_source_writes_nothing(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20230101"]), root, out)
    flatten_work(spark, work(spark, ["20240101"], ("users",), "users"), root, out)
    assert not (tmp_path / "out").exists()


def test_daily_replaces_same_day_and_is_kept(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events", [event("20240101")])
    export(spark, root, "events_intraday", [event("20240102"), event("20240102", event_name="click")])
    same_day = work(spark, ["20240101", "20240102"], ("events",), "events_intraday")
    flatten_work(spark, same_day, root, out)

    def tags():
        rows = read_flat(spark, out, SHARDED, "events").groupBy("shard", "source_table_type").count().collect()
        return {(r.shard, r.source_table_type): r["count"] for r in rows}

    assert tags() == {("20240102", "intraday"): 2}
    export(spark, root, "events", [event("20240102")])
    flatten_work(spark, work(spark, ["20240102"], ("events",)), root, out)
    flatten_work(spark, same_day, root, out)
    assert tags() == {("20240102", "daily"): 1}


def test_backfill_writes_configured_tables(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events", two_days())
    audiences = [{"id": "1"}, {"id": "2"}]
    export(spark, root, "users", [{"user_id": "a", "dataset": DATASET, "shard": "20240102", "audiences": audiences}])
    export(spark, root, "pseudonymous_users", [{"pseudo_user_id": "p", "dataset": DATASET, "shard": "20240103"}])
    tables = ["event_params", "users", "users_user_audiences", "pseudo_users"]
    control = spark.createDataFrame([(DATASET, tables, None, None, None)], CONTROL)
    backfill(spark, control, root, out, "20240102", "20240131", random_row_ids=True)
    assert counts(spark, out, layout=SHARDED) == {("20240102", "2024-01-02"): 1}
    assert read_flat(spark, out, SHARDED, "pseudo_users").count() == 1
    users = read_flat(spark, out, SHARDED, "users")
    assert rejoin(users, read_flat(spark, out, SHARDED, "users_user_audiences"), "row_id").count() == 2
    assert not (tmp_path / "out" / "partitioned").exists()


def directories(spark, root, pairs):
    """A source ``users`` with one file of one row in each of many directories."""
    spark.createDataFrame([("u",)], "user_id string").coalesce(1).write.parquet(f"{root}/one")
    file = next((root / "one").glob("part-*.parquet"))
    for dataset, shard in pairs:
        folder = root / "in" / "users" / f"dataset={dataset}" / f"shard={shard}"
        folder.mkdir(parents=True)
        os.link(file, folder / "part-0.parquet")


def test_only_requested_directories_are_scanned(spark, tmp_path):
    many = [(f"d{i % 20}", f"2024{i // 20:04d}") for i in range(2_000)]
    directories(spark, tmp_path, many)
    pairs = many[:1_100]
    rows = read_source(spark, f"{tmp_path}/in", "users", pairs=[*pairs, ("d0", "20990101"), ("no", "20240000")])
    # Most of the folder: it is listed whole, and pruned by the names of its directories.
    assert "PartitionFilters: [concat_ws(/, dataset" in rows._jdf.queryExecution().toString()
    files = rows.select("_metadata.file_path").distinct().collect()
    assert len(files) == 1_100
    assert {tuple(part.partition("=")[2] for part in row.file_path.split("/")[-3:-1]) for row in files} == set(pairs)
    assert rows.count() == 1_100
    # A few: only these are listed.
    few = read_source(spark, f"{tmp_path}/in", "users", pairs=[*pairs[:5], ("d0", "20990101")])
    assert len(few.inputFiles()) == 5
    some = read_source(spark, f"{tmp_path}/in", "users", between=("20240000", "20240001"))
    assert len(some.inputFiles()) == 40


def test_emptied_shard_clears_its_rows(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    empty = read_source(spark, root, "events", shard="20240102", position=False).drop("dataset", "shard").where("1 = 0")
    empty.write.mode("overwrite").parquet(f"{root}/events/dataset={DATASET}/shard=20240102")
    assert read_source(spark, root, "events", shard="20240102").count() == 0
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    for layout in (SHARDED, PARTITIONED):
        assert counts(spark, out, layout=layout) == {("20240101", "2024-01-01"): 3}


def test_empty_daily_export_wins_over_same_day(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events", [event("20240102")])
    export(spark, root, "events_intraday", [event("20240102")])
    empty = read_source(spark, root, "events", position=False).drop("dataset", "shard").where("1 = 0")
    empty.write.mode("overwrite").parquet(f"{root}/events/dataset={DATASET}/shard=20240102")
    flatten_work(spark, work(spark, ["20240102"], ("events",), "events_intraday"), root, out)
    assert not (tmp_path / "out").exists()


def test_daily_export_that_arrives_during_a_refresh_stays(spark, tmp_path, monkeypatch):
    from flatweave.plans import flatten_job

    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events_intraday", [event("20240102"), event("20240102", event_name="click")])
    real = flatten_job.publish

    def arrives(*args):
        if not (tmp_path / "in" / "events").exists():
            export(spark, root, "events", [event("20240102")])
        real(*args)

    monkeypatch.setattr(flatten_job, "publish", arrives)
    flatten_work(spark, work(spark, ["20240102"], ("events",), "events_intraday", partitioned=False), root, out)
    assert [r.source_table_type for r in read_flat(spark, out, SHARDED, "events").collect()] == ["daily"]


def test_names_that_need_escaping_are_replaced(spark, tmp_path):
    name = "a b=c:d%"
    rows = [event("20240101", dataset=name, event_params=[param("a", int_value=1)]), event("20240102", dataset=name)]
    root, out = export(spark, tmp_path / "in", "events", rows), str(tmp_path / "out")
    control = spark.createDataFrame([(name, ["event_params"], True, True, True)], CONTROL)
    arrivals = spark.createDataFrame([(name, "events", "20240101")], "dataset string, source string, shard string")
    flatten_work(spark, route(arrivals, control), root, out)
    assert [read_flat(spark, out, layout, "event_params").count() for layout in (SHARDED, PARTITIONED)] == [1, 1]
    export(spark, tmp_path / "in", "events", [event("20240101", dataset=name, event_params=None)])
    flatten_work(spark, route(arrivals, control), root, out)
    assert [read_flat(spark, out, layout, "event_params").count() for layout in (SHARDED, PARTITIONED)] == [0, 0]


def test_replace_lists_the_shards_it_replaces(spark, tmp_path):
    from flatweave.operators.flatten import flatten_table

    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    keyed = keyed_source(spark, root, "events", ["event_params"])
    shards = keyed.select("dataset", "shard").distinct()
    replace_shards(flatten_table(keyed, "event_params", "events"), out, SHARDED, "event_params", shards)
    replace_shards(
        flatten_table(keyed.where("1 = 0"), "event_params", "events"),
        out,
        SHARDED,
        "event_params",
        shards.where("shard = '20240101'"),
    )
    assert counts(spark, out, layout=SHARDED) == {("20240102", "2024-01-02"): 1}


def test_only_staged_tables_are_dropped(spark, tmp_path):
    with pytest.raises(ValueError):
        drop_stage(spark, str(tmp_path))


def test_shared_folder_is_the_configured_one(spark):
    class Session:
        sparkContext = spark.sparkContext

        class conf:
            get = staticmethod(lambda name, default: default)

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert shared_folder(Session) == shared_folder(Session)

    for address in ("spark://somewhere", "local-cluster[2,1,1024]"):

        class Cluster(Session):
            class sparkContext:
                master = address

        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Cluster)


def test_stages_are_dropped_when_a_job_fails(spark, tmp_path):
    before = staged_folders(spark)
    with pytest.raises(Exception, match="stop here"), Stages(spark) as stages:
        assert stages.table(spark.range(3), "kept").count() == 3
        stages.table(spark.range(3).select(F.raise_error(F.lit("stop here"))), "broken")
    assert staged_folders(spark) == before


def replace_with(spark, out, rows, shards, layout=SHARDED):
    replace_shards(rows, out, layout, "event_params", [(DATASET, shard) for shard in shards])


@pytest.mark.parametrize("layout", [SHARDED, PARTITIONED])
def test_a_write_that_fails_changes_nothing(spark, tmp_path, layout):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    rows = read_flat(spark, out, layout, "event_params")
    under_way = rows.select("event_id")  # planned before, read afterwards
    before, files = counts(spark, out, layout=layout), len([path for path in (tmp_path / "out").rglob("*") if path.is_file()])
    late = F.when(F.col("shard") == "20240102", F.raise_error(F.lit("half-way"))).otherwise(F.col("event_id"))
    with pytest.raises(Exception, match="half-way"):
        replace_with(spark, out, rows.withColumn("event_id", late.cast("string")), ["20240101", "20240102"], layout)
    assert counts(spark, out, layout=layout) == before
    assert len([path for path in (tmp_path / "out").rglob("*") if path.is_file()]) == files  # nothing is left behind
    replace_with(spark, out, rows.where("shard = '20240101'").limit(1), ["20240101"], layout)
    assert under_way.count() == 4  # the version of before is still there
    assert counts(spark, out, layout=layout) == {("20240101", "2024-01-01"): 1, ("20240102", "2024-01-02"): 1}


def test_versions_go_when_nobody_needs_them(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    for _ in range(4):
        flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    for layout in (SHARDED, PARTITIONED):
        folder = pathlib.Path(rows_path(out, layout, "event_params"))
        assert len([path for path in folder.iterdir() if path.is_dir()]) == 2
        assert len(list((folder.parent / "current").glob("[0-9]*.json"))) == 2
    # Of a version that another shard still needs, the directories of the replaced shard go.
    for _ in range(3):
        rows = read_flat(spark, out, SHARDED, "event_params").where("shard = '20240101'")
        replace_with(spark, out, rows, ["20240101"])
    folder = pathlib.Path(rows_path(out, SHARDED, "event_params"))
    assert len(list(folder.glob("version=*/dataset=*/shard=20240101"))) == 2
    assert len(list(folder.glob("version=*/dataset=*/shard=20240102"))) == 2
    assert counts(spark, out, layout=SHARDED) == {("20240101", "2024-01-01"): 3, ("20240102", "2024-01-02"): 1}


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Another publication comes between a writer's look at the current one and its own."""
    from flatweave.sinks import tables

    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    rows = read_flat(spark, out, SHARDED, "event_params")
    day = {shard: rows.where(F.col("shard") == shard).limit(1) for shard in ("20240101", "20240102")}
    real, between = tables.move_if_absent, []

    def late(spark, path, to):
        if not between:
            between.append(True)
            replace_with(spark, out, day["20240102"].unionByName(day["20240102"]), ["20240102"])
        return real(spark, path, to)

    monkeypatch.setattr(tables, "move_if_absent", late)
    replace_with(spark, out, day["20240101"], ["20240101"])
    assert counts(spark, out, layout=SHARDED) == {("20240101", "2024-01-01"): 1, ("20240102", "2024-01-02"): 2}
    assert len(set(r.version for r in tables.shard_state(spark, out, SHARDED, "event_params").collect())) == 2


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    from flatweave.plans import flatten_job

    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    export(spark, root, "events", [event(f"2024010{day}") for day in range(1, 6)])
    real, steps = flatten_job._flatten, []

    def stops(*args):
        steps.append(sorted(shard for _, shard in args[3]))
        if len(steps) == 2:
            raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(flatten_job, "_flatten", stops)
    todo = work(spark, [f"2024010{day}" for day in range(1, 6)], ("events",), partitioned=False)
    with pytest.raises(RuntimeError):
        flatten_work(spark, todo, root, out, run="a", shards_at_once=2)
    flatten_work(spark, todo, root, out, run="a", shards_at_once=2)
    assert steps == [["20240104", "20240105"], ["20240102", "20240103"], ["20240102", "20240103"], ["20240101"]]
    assert {(r.flat_table, r.layout, r.shard, r.run) for r in ledger(spark, out).collect()} == {
        ("events", SHARDED, f"2024010{day}", "a") for day in range(1, 6)
    }
    flatten_work(spark, todo, root, out, run="a", shards_at_once=2)
    assert len(steps) == 4
    flatten_work(spark, todo, root, out, run="b")
    assert len(steps) == 5


def test_layouts_of_different_datasets(spark, tmp_path):
    """One dataset in both layouts, one in each: none appears where it is not asked for."""
    names = ["a", "b", "c"]
    rows = [event("20240101", dataset=name, event_params=[param("x", int_value=1)]) for name in names]
    root, out = export(spark, tmp_path / "in", "events", rows), str(tmp_path / "out")
    control = spark.createDataFrame(
        [("a", ["event_params"], True, True, True), ("b", ["event_params"], True, False, True), ("c", ["event_params"], False, True, True)],
        CONTROL,
    )
    arrivals = spark.createDataFrame([(name, "events", "20240101") for name in names], "dataset string, source string, shard string")
    flatten_work(spark, route(arrivals, control), root, out)
    there = {layout: {r.dataset for r in read_flat(spark, out, layout, "event_params").collect()} for layout in (SHARDED, PARTITIONED)}
    assert there == {SHARDED: {"a", "b"}, PARTITIONED: {"a", "c"}}


def test_shard_table(spark, tmp_path):
    rows = [event("20240101", dataset="a b=c+d%"), event("20240102", dataset="a b=c+d%"), event("20240101", dataset="x")]
    root = export(spark, tmp_path / "in", "events", rows)
    found = {(r.dataset, r.shard): r for r in shard_table(spark, root, "events").collect()}
    assert set(found) == {("a b=c+d%", "20240101"), ("a b=c+d%", "20240102"), ("x", "20240101")}
    assert all(r.files == 1 and r.bytes > 0 and r.mark for r in found.values())
    some = shard_table(spark, root, "events", ["a b=c+d%", "missing"]).collect()
    assert {(r.dataset, r.shard): r.mark for r in some} == {p: r.mark for p, r in found.items() if p[0] != "x"}
    assert shard_table(spark, root, "users").collect() == []


def test_many_directories_are_listed_and_planned_quickly(spark, tmp_path):
    directories(spark, tmp_path, [(f"d{i % 20}", f"{20000000 + i // 20}") for i in range(20_000)])
    start = time.monotonic()
    assert shard_table(spark, f"{tmp_path}/in", "users").count() == 20_000
    listed = time.monotonic()
    rows = read_source(spark, f"{tmp_path}/in", "users", position=False)
    planned = time.monotonic()
    assert rows.where("shard = '20000007'").count() == 20
    assert listed - start < 15 and planned - listed < 15  # a few seconds each on an idle machine


def test_counts_come_from_footers(spark, tmp_path):
    root, out = export(spark, tmp_path / "in", "events", two_days()), str(tmp_path / "out")
    flatten_work(spark, work(spark, ["20240101", "20240102"]), root, out)
    for layout in (SHARDED, PARTITIONED):
        assert current_counts(spark, out, layout, "event_params") == {(DATASET, "20240101"): (3, 3), (DATASET, "20240102"): (1, 1)}
        assert quality.lost_rows(spark, out, layout, "event_params") == {}
    assert quality.layout_differences(spark, out, "event_params") == {}
    # A file that is lost shows.
    path = pathlib.Path(rows_path(out, SHARDED, "event_params"))
    for file in path.glob("version=*/dataset=*/shard=20240101/*.parquet"):
        file.unlink()
    assert quality.lost_rows(spark, out, SHARDED, "event_params") == {(DATASET, "20240101"): (3, 0)}
    assert quality.layout_differences(spark, out, "event_params") == {(DATASET, "20240101"): (0, 3)}
    assert current_counts(spark, str(tmp_path / "none"), SHARDED, "items") == {}


def test_footer_counts_push_the_aggregate_down(spark, tmp_path, capsys):
    spark.range(10).selectExpr("id", "CAST(id % 2 AS STRING) AS part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader.read.schema("id long, part string").parquet(str(tmp_path / "t")).groupBy("part").count().explain("formatted")
    assert "PushedAggregation: [COUNT(*)]" in capsys.readouterr().out
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("part", T.StringType())])
    assert {r.part: r.rows for r in footer_counts(spark, str(tmp_path / "t"), schema, ("part",))} == {"0": 5, "1": 5}
