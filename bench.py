"""Time the headline queries; prints one JSON line.

The nested exports are built from the driver's tables first and are not timed.
Each query runs in full (every row and column is computed) a few times; the median
of the runs after the first counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flatweave import schemas
from flatweave.operators.flatten import flatten_table
from flatweave.plans.flatten_job import flatten_work, keyed_source
from flatweave.plans.work import route
from flatweave.session import Stages, new_stage_path
from flatweave.sinks.tables import PARTITIONED, replace_shards
from flatweave.sources.shards import list_shards, shard_paths
from testbed.nested import nested_root
from testbed.queries import JOB, ONE_SHARD, QUERIES, stream_flatten

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("flatweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_query(name: str):
    def run(spark: SparkSession) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    return run


def write_four_event_tables(spark: SparkSession) -> None:
    root = nested_root(spark, SF_DIR, "events")
    shards = list_shards(spark, root, "events")
    control = shards.select(
        "dataset",
        F.array(*map(F.lit, schemas.EVENT_TABLES)).alias("tables_to_flatten"),
        F.lit(True).alias("sharded"),
        F.lit(False).alias("partitioned"),
    ).distinct()
    work = route(shards.withColumn("source", F.lit("events")), control)
    flatten_work(spark, work, root, new_stage_path(spark, "bench"), **JOB)


def replace_one_day(spark: SparkSession, state={}) -> None:
    root = nested_root(spark, SF_DIR, "events")
    out = state.setdefault("out", new_stage_path(spark, "bench-day"))
    day = list(shard_paths(spark, root, "events", between=(ONE_SHARD, ONE_SHARD)))
    with Stages(spark) as stages:
        keyed = keyed_source(spark, root, "events", ["event_params"], pairs=day, stages=stages, **JOB)
        replace_shards(flatten_table(keyed, "event_params", "events"), out, PARTITIONED, "event_params", day)


def stream_catch_up(spark: SparkSession) -> None:
    stream_flatten(spark, SF_DIR)


def main() -> None:
    spark = session()
    nested_root(spark, SF_DIR, "events", "users", "pseudonymous_users")
    names = [
        "event_key_daily",
        *[f"flat_{table}" for table in schemas.ALL_TABLES],
        "session_ids",
        "intraday_flat_events",
        "params_rejoin_events",
        "daily_supersedes_intraday",
        "lifecycle_latest",
    ]
    jobs = {name: run_query(name) for name in names}
    jobs |= {
        "write_four_event_tables": write_four_event_tables,
        "replace_one_day": replace_one_day,
        "stream_catch_up": stream_catch_up,
    }
    times = {}
    for name, job in jobs.items():
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job(spark)
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:] or seconds), 3)
    result = {
        "metric": "flatten_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
