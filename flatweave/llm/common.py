"""Shared pieces: word splitting, staged tables, row ids and batches."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatweave.session import new_stage_path, stage

WORD = r"[^\x20\x09-\x0D]+"
words_of: Callable[[str], list[str]] = re.compile(WORD).findall
# Every column that an operator adds for itself starts with this.
ROW = "__llm_row"
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Texts are handed to Python in small batches from now on; long ones would not fit in memory else."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return frame.select(*columns) if columns else frame


_recorded: list[str] | None = None


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Written to the shared folder and read back, so that a lost executor costs a file read only."""
    if compression is None:
        made, path = stage(df, f"llm-{name}")
    else:
        path = new_stage_path(df.sparkSession, f"llm-{name}")
        df.write.option("compression", compression).parquet(path)
        made = df.sparkSession.read.schema(df.schema).parquet(path)
    if _recorded is not None:
        _recorded.append(path)
    return made


@contextmanager
def recording() -> Iterator[list[str]]:
    """The paths of the tables staged in the block, for an owner that can tell when they are done with."""
    global _recorded
    before, _recorded = _recorded, []
    try:
        yield _recorded
    finally:
        _recorded = before


def with_row_ids(df: DataFrame, name: str) -> DataFrame:
    """Written with a number for each row, which fixes the numbers; repeated rows differ in it."""
    return staged(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def uniform(*columns: Column | str) -> Column:
    """An even value in [0, 1) that depends on the given values only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(2.0**-53)


def slices_by_size(sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Positions, from the largest on, in runs of at most ``most`` in total (one large item may pass it)."""
    order = np.argsort(-sizes, kind="stable")
    first, total = 0, 0
    for at, item in enumerate(sizes[order]):
        if at > first and total + item > most:
            yield order[first:at]
            first, total = at, 0
        total += item
    if first < len(order):
        yield order[first:]


def hash_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hashes of ``key``.

    Rows are counted first, so that all tasks together send the driver little more than the sample.
    """
    count = df.count()
    # Six standard deviations above what is wanted: fewer are found about once in 10^9 times.
    share = (most + 6 * most**0.5 + 10) / count if count else 1.0
    return df.where(uniform(key) < share).orderBy(F.xxhash64(key), key).limit(most)


# What a Python worker may keep of words, and the longest one worth keeping: text without spaces has "words" of any length.
STORE_BYTES = 104 << 20
LONGEST_KEPT = 64
# An entry of a dictionary, besides its key and value.
ENTRY_BYTES = 104

_kept: dict[str, Any] = {}


def give_back() -> None:
    """Memory that Python no longer uses goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def kept_in_worker(name: str, make: Callable[[], Any] = dict) -> Any:
    """What this Python worker keeps under ``name``, made when it is first asked for.

    Spark gives the workers of one stage to the next, so whatever an earlier operator kept here goes now.
    """
    if name not in _kept:
        if _kept:
            _kept.clear()
            give_back()
        _kept[name] = make()
    return _kept[name]


class Vocabulary:
    """Rows of features of words, kept by a Python worker across its tasks, in ``most`` bytes.

    ``features`` makes a row of numbers for each of a list of new words.  When full, the words met first, which are the
    frequent ones, stay; should most others keep missing, all are forgotten.  Long words are never kept.
    """

    def __init__(self, features: Callable[[list[str]], np.ndarray], most: int = STORE_BYTES):
        self._features, self._most = features, most
        self._forget()

    def _forget(self) -> None:
        self._numbers: dict[str, int] = {}
        self._rows: np.ndarray | None = None
        self._missed = self.bytes = 0

    def _keep(self, words: list[str], rows: np.ndarray) -> None:
        start, end = len(self._numbers), len(self._numbers) + len(words)
        self._numbers.update(zip(words, range(start, end)))
        if self._rows is None or end > len(self._rows):
            grown = np.empty((max(1024, end + end // 2), *rows.shape[1:]), rows.dtype)
            if self._rows is not None:
                grown[:start] = self._rows[:start]
            self._rows = grown
        self._rows[start:end] = rows

    def rows(self, words: list[str]) -> np.ndarray:
        """A feature row for each word, in order."""
        found = list(map(self._numbers.get, words))
        if None not in found:
            if not found:
                return self._features([])
            return self._rows[np.fromiter(found, np.int64, len(found))]
        new = list(dict.fromkeys(word for word, number in zip(words, found) if number is None))
        made = self._features(new)
        short = [at for at, word in enumerate(new) if len(word) <= LONGEST_KEPT]
        # Rows are kept in an array with half as much room again, and held twice while it grows.
        cost = sum(sys.getsizeof(new[at]) for at in short) + len(short) * (ENTRY_BYTES + 3 * made[:1].nbytes)
        if self.bytes + cost <= self._most:
            self.bytes += cost
            self._keep([new[at] for at in short], made[short] if len(short) < len(new) else made)
        else:
            self._missed += cost
        if len(new) == len(short) and new[0] in self._numbers:
            found = list(map(self._numbers.__getitem__, words))
            return self._rows[np.fromiter(found, np.int64, len(found))]
        start = len(self._numbers)
        other = dict(zip(new, range(start, start + len(new))))
        places = np.fromiter((other[w] if n is None else n for w, n in zip(words, found)), np.int64, len(found))
        rows = np.empty((len(words), *made.shape[1:]), made.dtype)
        known = places < start
        if known.any():
            rows[known] = self._rows[places[known]]
        rows[~known] = made[places[~known] - start]
        if self._missed > 8 * self._most:
            self._forget()
        return rows


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``function`` for each Arrow batch; a batch without rows is left out."""
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)
