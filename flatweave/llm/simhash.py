"""SimHash fingerprints and exact linking within a few bits by vantage-point shards.

Plain vantage-point trees over 64 random bits prune little at a radius of 4: distances to any
vantage point lie within 32 +- 4, so a query visits both sides of 7 splits in 10.  So the
first split uses partial distances.  The 64 bits are cut into ``radius + 2`` blocks; a pair
within the radius agrees on at least two blocks entirely, that is, on those bits both have
distance zero from a vantage point that any of them does.  Each pair of blocks hence makes a forest of
shards that never overlap.  A shard too large for a task is split further by the
distance of its members to a vantage point of the whole 64 bits, and members within the
radius of a boundary are also sent across it.  Inside a task members are ordered
by the distance to another vantage point, and each is compared only with those whose distance differs
by at most the radius (triangle inequality).  No step drops a pair, so links are exact.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import ROW, kept_in_worker, small_batches, staged, with_row_ids, words_of
from flatweave.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SHARD_ROWS = 20_000
SMALL_RUN = 48
_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WINDOWS = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in more than half of the shingles' hashes; 0 without words."""
    words = words_of((text or "").translate(_TO_LOWER))
    if not words:
        return 0
    whole = " ".join(words).encode()
    ends = np.cumsum([len(word.encode()) for word in words] if not whole.isascii() else [*map(len, words)])
    ends = ends + np.arange(len(words))
    width = min(shingle_words, len(words))
    lasts = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for first in range(0, len(starts), _WINDOWS):
        hashes = np.fromiter(
            (digest(whole[a:b], SEED) for a, b in zip(starts[first : first + _WINDOWS], lasts[first : first + _WINDOWS])),
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(2 * votes > len(starts), bitorder="little")
    return int(on.view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text: str = "text", output: str = "__llm_fp") -> DataFrame:
    """Adds the fingerprint as a signed long."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        kept_in_worker("simhash")
        found = np.fromiter((fingerprint(text) for text in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return df.withColumn(output, prints(F.col(text)))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 blocks that cover the 64 bits."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _in_order(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, first member reached) links that connect all points within the radius."""
    distance = np.bitwise_count(points ^ points[0]).astype(np.int64)
    order = np.argsort(distance, kind="stable")
    points, distance = points[order], distance[order]
    starts = np.searchsorted(distance, np.arange(-radius, 66 + radius))
    free = np.ones(len(points), bool)
    members, firsts = [], []
    for seed in range(len(points)):
        if not free[seed]:
            continue
        free[seed] = False
        todo = [seed]
        while todo:
            one = todo.pop()
            low, high = starts[distance[one]], starts[distance[one] + 2 * radius + 1]
            near = np.bitwise_count(points[low:high] ^ points[one]) <= radius
            near = low + np.flatnonzero(near & free[low:high])
            if len(near):
                free[near] = False
                todo.extend(near.tolist())
                members.append(points[near])
                firsts.append(np.full(len(near), points[seed]))
    if not members:
        return points[:0], points[:0]
    return np.concatenate(members), np.concatenate(firsts)


def shard_links(shard: np.ndarray, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the points of each shard; ``shard`` numbers it for each point."""
    order = np.lexsort((points, shard))
    shard, points = shard[order], points[order]
    new = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    sizes = np.diff(np.r_[new, len(shard)])
    left, right = [], []
    small = np.repeat(sizes <= SMALL_RUN, sizes)
    most = int(sizes[sizes <= SMALL_RUN].max(initial=0))
    for step in range(1, most):
        same = small[step:] & (shard[step:] == shard[:-step])
        same = np.flatnonzero(same)
        near = same[np.bitwise_count(points[same] ^ points[same + step]) <= radius]
        left.append(points[near + step])
        right.append(points[near])
    for start, size in zip(new[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN]):
        a, b = _in_order(np.unique(points[start : start + size]), radius)
        left.append(a)
        right.append(b)
    if not left:
        return points[:0], points[:0]
    return np.concatenate(left), np.concatenate(right)


def fingerprint_links(prints: DataFrame, radius: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints ``fp`` exactly as all pairs within the radius would."""
    blocks = _blocks(radius)
    keys = []
    for number, ((s, n), (t, m)) in enumerate(combinations(blocks, 2)):
        one = f"shiftrightunsigned(fp, {s}) & {(1 << n) - 1}L"
        two = f"shiftrightunsigned(fp, {t}) & {(1 << m) - 1}L"
        keys.append(f"({number}L << 40) + (({one}) << {m}) + ({two})")
    keyed = prints.select("fp", F.explode(F.array(*map(F.expr, keys))).alias("key"))
    hot = staged(
        keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("vantage")).where(F.col("n") > shard_rows),
        "hot-shards",
    )
    # A member of a hot shard belongs to the shell of its distance and also visits the shells just below.
    distance = F.expr("bit_count(fp ^ vantage)")
    shells = F.when(F.col("vantage").isNull(), F.array(F.lit(-1))).otherwise(
        F.sequence(F.greatest(distance - radius, F.lit(0)), distance)
    )
    dealt = keyed.join(hot.select("key", "vantage"), "key", "left").select(
        "fp", "key", F.explode(shells).alias("shell")
    )
    dealt = dealt.withColumn("shard", F.xxhash64("key", "shell"))
    buckets = max(1, -(-prints.count() * len(keys) // shard_rows))
    dealt = dealt.select("fp", "shard", F.pmod("shard", F.lit(buckets)).alias("bucket"))

    def linked(group: pa.Table) -> pa.Table:
        points = group.column("fp").to_numpy().view(np.uint64)
        a, b = shard_links(group.column("shard").to_numpy(), points, radius)
        pairs = pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()
        return pa.Table.from_pandas(pairs, preserve_index=False)

    return dealt.groupBy("bucket").applyInArrow(linked, "a long, b long")


def _unsigned_hex(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = MAX_BITS) -> DataFrame:
    """Each row's fingerprint and component.

    Returns (``ROW``, id, fingerprint, component_id): component_id is the smallest id among the rows whose
    fingerprints can be reached by links.  Null and empty texts have fingerprint zero and
    link like any other; a null id takes part but is never the smallest, unless all of a component are
    null, whose component_id is then null.  Repeated rows share a component.
    """
    rows = with_row_ids(with_fingerprints(df.select(id_column, text), text).drop(text), "prints")
    classes = components_of(rows, id_column, radius)
    return rows.join(classes, "__llm_fp", "left").select(
        ROW, id_column, _unsigned_hex("__llm_fp").alias("fingerprint"), "component_id"
    )


def components_of(rows: DataFrame, id_column: str, radius: int = MAX_BITS) -> DataFrame:
    """(__llm_fp, component, component_id) for rows that have a fingerprint."""
    prints = staged(rows.groupBy(F.col("__llm_fp").alias("fp")).agg(F.min(id_column).alias("least")), "distinct-prints")
    links = staged(fingerprint_links(prints.select("fp"), radius), "print-links")
    found = connected_components(links)
    grouped = prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    # Written first, so that the join of a hot component can be split.
    grouped = staged(grouped, "print-components")
    least = staged(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    return staged(
        grouped.join(least, "component").select(F.col("fp").alias("__llm_fp"), "component", "component_id"), "classes"
    )


def keep_one(df: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns it came with: the smallest id, null ids last.

    Of rows that share that id one stays.
    """
    rows = with_row_ids(with_fingerprints(df, text), "docs-prints")
    classes = components_of(rows.select(ROW, id_column, "__llm_fp"), id_column, radius)
    order = F.struct(F.col(id_column).isNull().alias("n"), F.col(id_column).alias("i"), F.col(ROW).alias("r"))
    placed = staged(rows.select(ROW, id_column, "__llm_fp").join(classes, "__llm_fp").select(ROW, id_column, "component"), "placed")
    best = staged(placed.groupBy("component").agg(F.min(order).alias("best")), "chosen")
    # The rows that go are fewer than those that stay.
    gone = placed.join(best, "component").where(F.col(ROW) != F.col("best.r")).select(ROW)
    return rows.join(staged(gone, "gone"), ROW, "left_anti").select(*df.columns)
