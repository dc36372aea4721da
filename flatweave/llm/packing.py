"""Packing documents into as few fixed-length sequences as possible, with certified bin counts.

Pieces are dealt evenly into partitions, and each is packed by best-fit decreasing.  A
partition whose number of bins equals a lower bound from dual-feasible functions is proven
optimal.  Partitions with a gap give the documents of their unfilled bins back, certified ones those of
their loosest bins; the returned documents are dealt anew, so that partitions exchange them, and
best-fit decreasing runs again, until no more bins are saved.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.llm import tokens
from flatweave.llm.common import map_batches, staged

SEQUENCE_TOKENS = 2048
PARTITION_PIECES = 4_000
ROUNDS = 6
PIECE = "__llm_piece"


def cut(total: int, most: int) -> list[int]:
    """Lengths of a document's pieces: all but the first are full."""
    full, rest = divmod(total, most)
    return [rest] * (rest > 0) + [most] * full


def token_pieces(
    docs: DataFrame, tokenizer: str | None = None, most: int = SEQUENCE_TOKENS, with_ids: bool = True
) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of at most ``most``.

    (doc_id, piece, start, length, ids_crc32[, ids]); null text is empty and makes one piece of the end id.  Repeated rows
    make pieces of their own.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = tokens.encoder(tokenizer or tokens.public_tokenizer())
        end = tokens.END.to_bytes(tokens.ID_BYTES, "little")
        columns: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1))):
            ids, start = ids + end, 0
            for number, length in enumerate(cut(len(ids) // tokens.ID_BYTES, most)):
                own = ids[start * tokens.ID_BYTES : (start + length) * tokens.ID_BYTES]
                row = (doc_id, number, start, length, zlib.crc32(own), own)
                for column, value in zip(columns.values(), row):
                    column.append(value)
                start += length
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = {name: pa.array(values, kind) for (name, values), kind in zip(columns.items(), kinds)}
        if not with_ids:
            del arrays["ids"]
        return pa.RecordBatch.from_pydict(arrays)

    return map_batches(docs.select("doc_id", "text"), pieces, schema)


@lru_cache(maxsize=8)
def _dual_feasible(capacity: int) -> np.ndarray:
    """Values of dual-feasible functions at each length, a row a function (Fekete and Schepers)."""
    length = np.arange(capacity + 1)
    x = length / capacity
    rows = [x]
    for least in range(1, capacity // 2 + 1, max(1, capacity // 256)):
        rows.append(np.where(length > capacity - least, 1.0, np.where(length >= least, x, 0.0)))
    for k in range(1, 32):
        rows.append(np.where(length * (k + 1) % capacity == 0, x, length * (k + 1) // capacity / k))
    return np.array(rows)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of these lengths has fewer bins."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    return int(np.ceil((_dual_feasible(capacity) @ counts).max(initial=0) - 1e-6))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece: the fullest that has room, else a new one; longest pieces first."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r tokens of room
    made = 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            one = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, one = capacity, made
            made += 1
        bins[at] = one
        room -= length
        if room:
            by_room[room].append(one)
            rooms |= 1 << room
    return bins


def _packed(group: pa.Table, number: int, capacity: int, last: bool) -> pa.Table:
    """Bins and places of one partition; ``again`` marks pieces that are given back."""
    ids, lengths = group.column(PIECE).to_numpy(), group.column("length").to_numpy()
    order = np.lexsort((ids, -lengths))
    ids, lengths = ids[order], lengths[order]
    bins = best_fit_decreasing(lengths, capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    gap = len(fill) > lower_bound(lengths, capacity)
    loose = fill < (capacity if gap else capacity - capacity // 8)
    order = np.argsort(bins, kind="stable")
    ids, lengths, bins = ids[order], lengths[order], bins[order]
    ends = np.cumsum(lengths)
    first = np.r_[True, bins[1:] != bins[:-1]]
    offsets = ends - lengths
    offsets = offsets - np.repeat(offsets[first], np.diff(np.r_[np.flatnonzero(first), len(bins)]))
    part = group.column("part")[0].as_py()
    return pa.table(
        {
            PIECE: ids,
            "length": lengths,
            "sequence_id": (number << 56) + (part << 20) + bins,
            "offset": offsets,
            "again": loose[bins] & (not last),
        }
    )


def _round(pieces: DataFrame, number: int, capacity: int, partition_pieces: int, last: bool) -> DataFrame:
    parts = max(1, -(-pieces.count() // partition_pieces))
    # Another deal each round, so that documents meet others.
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64(PIECE, F.lit(number)), F.lit(parts)))

    def pack(group: pa.Table) -> pa.Table:
        return _packed(group, number, capacity, last)

    schema = f"{PIECE} long, length long, sequence_id long, offset long, again boolean"
    return staged(dealt.groupBy("part").applyInArrow(pack, schema), "packed")


def pack_pieces(
    pieces: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    partition_pieces: int = PARTITION_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(PIECE, sequence_id, offset) for pieces (PIECE, length) of 1 to ``capacity`` tokens.

    Sequences are gapless from offset 0.  An exchange is kept only where it saves bins; what remains after the last round
    keeps its places.
    """
    taken = _round(pieces, 0, capacity, partition_pieces, rounds <= 1)
    done = [taken.where(~F.col("again"))]
    for number in range(1, rounds):
        loose = taken.where("again")
        before = loose.select(F.count_distinct("sequence_id")).first()[0]
        if not before:
            break
        taken = _round(loose.select(PIECE, "length"), number, capacity, partition_pieces, number == rounds - 1)
        after = taken.select(F.count_distinct("sequence_id")).first()[0]
        if after >= before:
            taken = loose if after > before else taken
            done.append(taken)
            break
        done.append(taken.where(~F.col("again")))
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return placed.select(PIECE, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = SEQUENCE_TOKENS, with_ids: bool = True
) -> DataFrame:
    """The pieces of all documents with their sequence and place, and their ids if asked for."""
    pieces = token_pieces(docs, tokenizer, capacity, with_ids)
    pieces = staged(pieces.withColumn(PIECE, F.monotonically_increasing_id()), "token-pieces")
    placed = pack_pieces(pieces.select(PIECE, "length"), capacity)
    return pieces.join(placed, PIECE).drop(PIECE)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_docs) of pieces packed with ids: at most one sequence's worth of pieces meets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda so_far, part: F.concat(so_far, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.count_distinct("doc_id").alias("n_docs"))
