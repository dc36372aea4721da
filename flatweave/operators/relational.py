"""Aggregates, windows and joins over flat tables and inventories."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_value_per_group(df: DataFrame, group: list[str], value: str, output: str) -> DataFrame:
    """Add the last ``value`` of each row's group, in value order, to every row.

    The same as ``last_value`` over the whole partition, but as a partial aggregate
    joined back: no task has to hold a group, and a skewed join side can be split.  As in a
    window, rows with a NULL key form a group.
    """
    names = {name: f"__{name}" for name in group}
    last = df.groupBy(*[F.col(name).alias(other) for name, other in names.items()]).agg(F.max(value).alias(output))
    same = [df[name].eqNullSafe(last[other]) for name, other in names.items()]
    return df.join(last, reduce(and_, same), "left").select(*[df[name] for name in df.columns], output)


def ordered_text(df: DataFrame, group: list[str], value: str, output: str, separator: str = "") -> DataFrame:
    """The values of each group put together in their own order, repeats included.

    Values are sorted before they become text, numbers hence by size.  Repeats are counted before
    they are collected, so only distinct values of a group come together; the text itself is of course one value.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("__n"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(value).alias("value"), "__n")))
    # More repeats than an array can hold would not fit into a text either.
    times = lambda n: F.when(n < 2**31, n.cast("int")).otherwise(F.raise_error(F.lit("too many values for one text")))
    texts = F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["value"].cast("string"), times(p["__n"]))))
    return counted.groupBy(*group).agg(F.array_join(texts, separator).alias(output))


def with_constants(df: DataFrame, **constants: str | int | float | bool) -> DataFrame:
    """Every row next to one row of constants."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def rows_per_day(flat: DataFrame, day: str = "event_date") -> DataFrame:
    return flat.groupBy(day).agg(F.count("*").alias("nrow"))


def rejoin(parent: DataFrame, child: DataFrame, key: str = "event_id") -> DataFrame:
    """Child rows next to their parent's columns, by the generated key.

    Columns of both that are not the key come from the parent.  ``dataset`` and
    ``shard`` take part in the join where both sides have them.
    """
    places = [name for name in ("dataset", "shard") if name in parent.columns and name in child.columns]
    on = [*places, key]
    shared = [name for name in child.columns if name in parent.columns and name not in on]
    return parent.join(child.drop(*shared), on)
