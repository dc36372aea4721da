"""Flatten the shards of a work list and write their flat tables."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatweave import schemas
from flatweave.operators.flatten import columns_needed, flatten_table
from flatweave.operators.keys import (
    KEY_COLUMNS,
    MOST_BROADCAST,
    repeat_numbers,
    session_ids,
    shard_cuts,
    with_event_id,
    with_row_id,
)
from flatweave.operators.numbering import ROWS_PER_TASK
from flatweave.plans.work import Output, Pair, backfill_grid, route, settle
from flatweave.schemas import PLACE
from flatweave.session import BY_ALL_KEYS, OPEN_AT_ONCE, OPEN_FILES, Stages, setting
from flatweave.sinks.tables import copy_version, entries_of, publish, shard_state, version_counts, write_version
from flatweave.sources.shards import among, cluster, listed_shards, read_source, shard_paths, shard_table

# Shards in one step of a named run.
SHARDS_AT_ONCE = 1_000
# Rows of a source, with all columns, that a task takes when they are shuffled.
WIDE_ROWS_PER_TASK = 500_000
# Writes of a job that run beside each other, if it is cut into steps; each holds the broadcast numbers of its step.
WRITES_AT_ONCE = 8


Numbers = tuple[DataFrame, tuple[DataFrame, int] | None]


def key_numbers(
    rows: DataFrame,
    stages: Stages,
    position: str = "row_position",
    most_broadcast: int = MOST_BROADCAST,
    rows_per_task: int = ROWS_PER_TASK,
    **numbering,
) -> Numbers:
    """Numbers of the rows that repeat a key, made once and staged, and the parts of shards to join them by if they are many."""
    numbered = repeat_numbers(rows, position=position, keep=stages.table, rows_per_task=rows_per_task, **numbering)
    repeats = stages.table(numbered, "repeats")
    if repeats.count() <= most_broadcast:
        return repeats, None
    return repeats, _parts(rows)


def _parts(rows: DataFrame) -> tuple[DataFrame, int]:
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // WIDE_ROWS_PER_TASK))
    return shard_cuts(rows, tasks), tasks


def number_steps(
    rows: DataFrame,
    pairs: Iterable[Pair],
    stages: Stages,
    position: str = "row_position",
    most_broadcast: int = MOST_BROADCAST,
    rows_per_task: int = ROWS_PER_TASK,
    **numbering,
) -> list[tuple[list[Pair], Numbers]]:
    """The numbers of :func:`key_numbers` for a job that writes, by steps of shards whose numbers may be broadcast.

    So the wide rows stay where they are read, however many numbers all shards have.  Only shards that alone have too many are left to
    a step that shuffles.  A row for each shard comes to the driver.
    """
    pairs = list(pairs)
    numbered = repeat_numbers(rows, position=position, keep=stages.table, rows_per_task=rows_per_task, **numbering)
    repeats = stages.table(numbered, "repeats")
    found = repeats.groupBy(*PLACE).agg(F.count("*").alias("n")).collect()
    counts = {(row.dataset, row.shard): row.n for row in found}
    if sum(counts.values()) <= most_broadcast:
        return [(pairs, (repeats, None))]
    repeats = stages.table(cluster(repeats), "repeats-by-shard", PLACE)  # a step reads its own
    steps: list[list[Pair]] = []
    room = -1
    for pair in sorted(pair for pair in pairs if counts.get(pair, 0) <= most_broadcast):
        if counts.get(pair, 0) > room:
            steps.append([])
            room = most_broadcast
        steps[-1].append(pair)
        room -= counts.get(pair, 0)
    made = [(step, (F.broadcast(repeats.where(among(step))), None)) for step in steps]
    large = [pair for pair in pairs if counts.get(pair, 0) > most_broadcast]
    if large:
        made.append((large, (repeats.where(among(large)), _parts(rows.where(among(large))))))
    return made


def key_events(
    rows: DataFrame, position: str = "row_position", stages: Stages | None = None, intraday_view: bool = False, **numbering
) -> DataFrame:
    """Events with their id.

    The key columns alone are numbered; only rows that repeat a key get an entry in the table of numbers.  With ``stages``
    that table is written now, and its owner drops it.  Without, nothing is run before the result is read.
    """
    if stages is None:
        return with_event_id(rows, intraday_view, position, **numbering)
    repeats, parts = key_numbers(rows, stages, position, intraday_view=intraday_view, **numbering)
    return with_event_id(rows, intraday_view, position, repeats, parts)


def keyed_source(
    spark: SparkSession,
    root: str,
    source: str,
    tables: Iterable[str],
    between: tuple[str, str] | None = None,
    pairs: Iterable[Pair] | None = None,
    position: str = "row_position",
    extra=(),
    strict: bool = False,
    random_row_ids: bool = False,
    stages: Stages | None = None,
    numbers: Numbers | None = None,
    rows: DataFrame | None = None,
    **numbering,
) -> DataFrame:
    """Rows of a source with their key and only the columns the tables read.

    ``between`` (first and last shard) and ``pairs`` choose the shards, ``position`` is a column that identifies a
    source row, if not the scan's own, and ``extra`` its field; ``strict`` makes a session parameter given twice an
    error.  ``numbers`` are those of :func:`key_numbers` for at least these shards; otherwise see :func:`key_events`.
    ``rows`` is a scan that was made before, in place of a new one.
    """
    tables = list(tables)
    if rows is None:
        by_scan = position == "row_position"
        rows = read_source(spark, root, source, between=between, pairs=pairs, extra=extra, position=by_scan)
    rows = rows.select(*columns_needed(tables, source), *PLACE, position)
    if "events" in tables:
        rows = rows.withColumns(session_ids(strict=strict))
        if "event_params" not in tables:
            rows = rows.drop("event_params")
    if not source.startswith("events"):
        return with_row_id(rows, source, position, random_row_ids)
    if numbers is not None:
        repeats, parts = numbers
        return with_event_id(rows, position=position, repeats=repeats, parts=parts)
    return key_events(rows, position, stages, **numbering)


def flatten_work(
    spark: SparkSession,
    work: DataFrame,
    source_root: str,
    out_root: str,
    run: str | None = None,
    shards_at_once: int = SHARDS_AT_ONCE,
    changed_only: bool = False,
    **options,
) -> None:
    """Write every flat table of a work list.

    The keys of a source are made once and shared by its flat tables.  Shards that
    do not exist, and same-day shards with a daily export, are skipped.

    A named ``run`` goes through the shards from the newest on, ``shards_at_once`` at a time, and publishes each of these steps
    when it is written; started again under its name, it does only what it has not yet published.  With ``changed_only``
    shards are left out whose files are those that the flat table was made of.  ``options`` go to :func:`keyed_source`.
    """
    for source, todo in sorted(settle(work).items()):
        newest_first = sorted(todo, key=lambda pair: (pair[1], pair[0]), reverse=True)
        step = shards_at_once if run is not None else len(newest_first)
        for first in range(0, len(newest_first), step):
            some = {pair: todo[pair] for pair in newest_first[first : first + step]}
            flatten_shards(spark, source, some, source_root, out_root, run, changed_only, **options)


def flatten_shards(
    spark: SparkSession,
    source: str,
    todo: dict[Pair, set[Output]],
    source_root: str,
    out_root: str,
    run: str | None = None,
    changed_only: bool = False,
    **options,
) -> None:
    """Write what is to be written from each shard of one source; all of it is published when all is written."""
    # Marks are taken before any file is read: what changes meanwhile differs from them next time.
    marks = source_marks(spark, source_root, source, todo) if changed_only else {}
    if run is not None or changed_only:
        todo = _left_to_do(spark, source, todo, out_root, run, marks if changed_only else None)

    def daily_of(pairs: Iterable[Pair]) -> set[Pair]:
        return set(shard_paths(spark, source_root, "events", pairs=pairs))

    listed, beside = listed_shards(spark, source_root, source, todo)
    daily = daily_of(listed) if schemas.is_intraday(source) else set()
    own = {pair: outputs for pair, outputs in todo.items() if pair in listed and pair not in daily}
    if not own:
        return
    with Stages(spark) as stages:
        listed = {pair: listed[pair] for pair in own}
        written = _flatten(spark, stages, source, own, (listed, beside), source_root, out_root, options)
        _publish(spark, source, written, out_root, marks, run)
    if schemas.is_intraday(source):
        # A daily export that came meanwhile may just have been overwritten: it is written again.
        late = daily_of(own)
        again = {pair: outputs for pair, outputs in own.items() if pair in late}
        if again:
            flatten_shards(spark, "events", again, source_root, out_root, **options)


def source_marks(spark: SparkSession, source_root: str, source: str, pairs: Iterable[Pair]) -> dict[Pair, str]:
    """The mark of each shard's files; one a directory."""
    pairs = set(pairs)
    marks = shard_table(spark, source_root, source, {dataset for dataset, _ in pairs}).where(among(pairs))
    return {(row.dataset, row.shard): row.mark for row in marks.select(*PLACE, "mark").collect()}


def _left_to_do(
    spark: SparkSession,
    source: str,
    todo: dict[Pair, set[Output]],
    out_root: str,
    run: str | None,
    marks: dict[Pair, str] | None,
) -> dict[Pair, set[Output]]:
    """Without what this run has published, or what was made of the files that are there now."""
    left = {pair: set(outputs) for pair, outputs in todo.items()}
    for output in sorted({output for outputs in todo.values() for output in outputs}):
        table, layout = output
        state = shard_state(spark, out_root, layout, table).where(among(todo))
        for row in state.select(*PLACE, "source", "mark", "run").collect():  # one a shard of this step
            pair = row.dataset, row.shard
            same = marks is not None and row.source == source and row.mark is not None and row.mark == marks.get(pair)
            if same or (run is not None and row.run == run and row.source == source):
                left[pair].discard(output)
    return {pair: outputs for pair, outputs in left.items() if outputs}


Made = tuple[str, list[Pair], dict[Pair, int]]  # a version, shards and their rows
Written = dict[Output, list[Made]]


def _flatten(spark, stages, source, todo, listed, source_root, out_root, options) -> Written:
    pairs_of: dict[str, dict[str, list[Pair]]] = {}
    for pair, outputs in todo.items():
        for table, layout in outputs:
            pairs_of.setdefault(table, {}).setdefault(layout, []).append(pair)
    position, extra = options.get("position", "row_position"), options.get("extra", ())
    random_ids = options.get("random_row_ids", False)
    numbering = {name: value for name, value in options.items() if name in ("hot_rows", "rows_per_task", "most_broadcast")}
    options = {name: value for name, value in options.items() if name not in numbering}

    # One scan, listed once; each table reads its own columns of it.
    scan = read_source(spark, source_root, source, extra=extra, position=position == "row_position", listed=listed)
    keyed = None
    steps: list[tuple[list[Pair], Numbers | None]] = [(list(todo), None)]
    if source.startswith("events"):
        steps = number_steps(scan.select(*KEY_COLUMNS, *PLACE, position), todo, stages, position, **numbering)
    elif random_ids and sum(map(len, pairs_of.values())) > 1:
        # Ids that are drawn at random are made once for all tables.
        keyed = keyed_source(spark, source_root, source, sorted(pairs_of), rows=scan, **options)
        keyed = stages.table(keyed, f"keyed-{source}", PLACE)

    def write(table: str, layouts: dict[str, list[Pair]], step: list[Pair], numbers: Numbers | None) -> dict[Output, Made]:
        rows = keyed
        if rows is None:
            part = scan if len(step) == len(todo) else scan.where(among(step))
            rows = keyed_source(spark, source_root, source, [table], numbers=numbers, rows=part, **options)
        written: dict[Output, Made] = {}
        # The layout with more shards is made of the source, and the other one of its files if they hold all it wants.
        for layout, pairs in sorted(layouts.items(), key=lambda one: (-len(one[1]), one[0])):
            made = next(((known, version) for known, (version, has, _) in written.items() if set(pairs) <= set(has)), None)
            if made is not None:
                (_, other), version = made
                some = pairs if len(pairs) < len(written[table, other][1]) else None
                version = copy_version(spark, out_root, table, version, other, layout, some)
            else:
                chosen = rows if len(pairs) == len(step) else rows.where(among(pairs))
                version = write_version(flatten_table(chosen, table, source), out_root, layout, table)
            written[table, layout] = version, pairs, version_counts(spark, out_root, layout, table, version)
        return written

    writes = []
    for step, numbers in steps:
        inside = set(step)
        for table, layouts in pairs_of.items():
            some = {layout: [pair for pair in pairs if pair in inside] for layout, pairs in layouts.items()}
            some = {layout: pairs for layout, pairs in some.items() if pairs}
            if some:
                writes.append((table, some, step, numbers))
    # The writes go to different versions and share no state: let the cluster fill
    # the tail of one with the tasks of another.
    written: Written = {}
    with setting(spark, OPEN_FILES, OPEN_AT_ONCE), setting(spark, BY_ALL_KEYS, "false"):
        for one in _at_once(spark, write, writes, len(pairs_of) if len(steps) == 1 else WRITES_AT_ONCE):
            for output, made in one.items():
                written.setdefault(output, []).append(made)
    return written


def _at_once(spark: SparkSession, function, arguments, most: int) -> list:
    with ThreadPoolExecutor(max_workers=most) as pool:
        return [one.result() for one in [pool.submit(inheritable_thread_target(spark)(function), *args) for args in arguments]]


def _publish(spark, source: str, written: Written, out_root: str, marks: dict[Pair, str], run: str | None) -> None:
    def publish_one(output: Output, made: list[Made]) -> None:
        table, layout = output
        versions = {pair: version for version, pairs, _ in made for pair in pairs}
        counts = {pair: rows for _, _, found in made for pair, rows in found.items()}
        publish(spark, out_root, layout, table, versions, entries_of(versions, counts, source, marks, run))

    _at_once(spark, publish_one, written.items(), len(written))


def backfill(
    spark: SparkSession,
    control: DataFrame,
    source_root: str,
    out_root: str,
    start: str,
    end: str,
    sources: tuple[str, ...] = ("events", "pseudonymous_users", "users"),
    **options,
) -> None:
    """Flatten every configured dataset's shards from ``start`` to ``end``, both included.

    Give it a ``run`` name to be able to go on where it stopped, see :func:`flatten_work`.
    """
    grid = backfill_grid(control, sources, start, end)
    flatten_work(spark, route(grid, control), source_root, out_root, **options)
