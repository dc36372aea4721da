"""Row numbers within groups that may be of any size.

A plain ``row_number`` sends each group to one task.  Here a group's order is
defined by an evenly spread 60-bit value of the row's source position, so a group
too large for one task can be cut into equal ranges of that value: rows are
numbered inside each range, and the sizes of the earlier ranges are added.  The
numbers do not depend on where, or whether, a group is cut, so large groups are found in a
sample.

Give the columns that are needed only: all rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatweave.functions.expressions import SPREAD_BITS, spread
from flatweave.schemas import PLACE

HOT_GROUP_ROWS = 1_000_000
ROWS_PER_TASK = 2_000_000
# A hot group has about so many rows in the sample that finds it.
SAMPLE_ROWS = 1_000

_HASH, _SPREAD, _TIE, _BITS, _CUT, _GROUP, _ROWS, _BEFORE = (
    "__hash",
    "__spread",
    "__tie",
    "__bits",
    "__cut",
    "__group",
    "__rows",
    "__before",
)


def _group_hash(group: list[Column]) -> Column:
    """Hash of a row's group; NULL if a key is NULL (such rows get no number)."""
    complete = F.lit(True)
    for key in group:
        complete = complete & key.isNotNull()
    return F.when(complete, F.xxhash64(*group))


def group_sizes(df: DataFrame, group: list[Column], position: str, hot_rows: int) -> DataFrame:
    """Rows of each group in an even sample, told by a hash, and in one more entry those of all rows outside it.

    One pass that shuffles hashes of about one row in ``hot_rows / SAMPLE_ROWS``, and gives the number of all rows as well.
    """
    sampled = spread(position) < int(min(1.0, SAMPLE_ROWS / hot_rows) * (1 << SPREAD_BITS))
    return df.groupBy(F.when(sampled, _group_hash(group)).alias(_HASH)).agg(F.count("*").alias(_ROWS))


def hot_groups(sizes: DataFrame, hot_rows: int) -> DataFrame:
    """Hashes of groups too large for one task, with the leading bits to cut them by.

    A group a quarter below ``hot_rows`` may be
    cut as well, and one a little above it may not; both are still numbered right.  About one group per ``hot_rows`` rows can be hot:
    100,000 of 16 bytes in 10^11 rows, so the result may be broadcast.  Two groups with one hash are cut alike, no more.
    """
    share = min(1.0, SAMPLE_ROWS / hot_rows)
    sizes = sizes.where(F.col(_HASH).isNotNull()).withColumn(_ROWS, F.col(_ROWS) / share)
    sizes = sizes.where(F.col(_ROWS) > (hot_rows if share == 1.0 else 0.75 * hot_rows))
    bits = F.greatest(F.ceil(F.log2(F.col(_ROWS) / hot_rows)), F.lit(1))
    return sizes.select(_HASH, bits.cast("int").alias(_BITS))


def _cut() -> Column:
    """The range a row falls into: everything in one, unless its group is hot.

    Rows without a complete key need no number and are spread freely.
    """
    return F.expr(
        f"CASE WHEN {_HASH} IS NULL THEN {_SPREAD} WHEN {_BITS} IS NULL THEN 0 "
        f"ELSE shiftright({_SPREAD}, {SPREAD_BITS} - {_BITS}) END"
    )


def number_rows(
    df: DataFrame,
    keys: list[Column],
    output: str,
    position: str = "row_position",
    scope: tuple[str, ...] = PLACE,
    hot_rows: int = HOT_GROUP_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Number the rows of each group from 1, per source shard.

    ``position`` names a column that identifies a source row; it makes the order,
    hence the numbers, repeatable.  A row with a NULL key gets a NULL number.

    ``keep`` writes a table and gives it back, under a name.  With it the large groups are found once, in a pass that also
    counts the rows to shuffle them into as many tasks as they need; without it nothing is run before the
    result is, and the session's number of shuffle partitions holds.
    """
    scope = list(scope)
    group = [*map(F.col, scope), *keys]
    sizes = group_sizes(df, group, position, hot_rows)
    if keep is not None:
        sizes = keep(sizes, "group-sizes")
    hot = hot_groups(sizes, hot_rows)

    placed = (
        df.withColumns({_HASH: _group_hash(group), _SPREAD: spread(position), _TIE: F.xxhash64(position)})
        .join(F.broadcast(hot), _HASH, "left")
        .withColumn(_CUT, _cut())
        .drop(_BITS)
        .withColumn(_GROUP, F.struct(*group))
    )
    if keep is not None:
        default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        needed = -(-(sizes.agg(F.sum(_ROWS)).first()[0] or 0) // rows_per_task)
        if needed > default:
            placed = placed.repartition(needed, _HASH, _CUT)
    # The group hash and range come first: comparing two longs settles most rows.
    window = Window.partitionBy(_HASH, _CUT, _GROUP).orderBy(_SPREAD, _TIE)
    numbered = placed.withColumn(output, F.row_number().over(window))

    # Sizes of the ranges of hot groups: at most 3 ranges per hot_rows rows.
    ranges = (
        df.select(_group_hash(group).alias(_HASH), spread(position).alias(_SPREAD), F.struct(*group).alias(_GROUP))
        .join(F.broadcast(hot), _HASH)
        .groupBy(_HASH, _GROUP, _cut().alias(_CUT))
        .agg(F.count("*").alias(_ROWS))
    )
    earlier = Window.partitionBy(_HASH, _GROUP).orderBy(_CUT).rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select(_HASH, _GROUP, _CUT, F.sum(_ROWS).over(earlier).alias(_BEFORE))

    number = F.when(F.col(_HASH).isNotNull(), F.col(output) + F.coalesce(F.col(_BEFORE), F.lit(0)))
    return (
        numbered.join(F.broadcast(before), [_HASH, _GROUP, _CUT], "left")
        .withColumn(output, number)
        .select(*df.columns, output)
    )
