"""How far the sources of a language are from each other, from run-length coded columns of term counts.

Each (language, source) group is a column of counts over the language's vocabulary.  The vocabulary is put in an order in which
terms with equal counts lie together (by total, then by a hash of all groups' counts), and cut into blocks of equal size.  In a block each
group's column becomes runs of equal counts; for a pair of groups the boundaries of both are merged, and between two of them the divergence of
one term is multiplied by the number of terms.  Any order gives the same sums; a good one gives few runs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flatweave.llm.common import small_batches, staged

LEAST_DOCS = 10
BEST_TERMS = 10
UNIT, ADDED = 1_000_000_000, 2
BLOCK_TERMS = 1 << 14
TILE_SOURCES = 64
# A task hands on its partial counts when it holds so many, or terms of so many bytes.
HELD_TERMS, HELD_BYTES = 400_000, 96 << 20

# Letters of ASCII in lower case and all bytes of other characters stay; the rest separates terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
_COUNTS = "lang string, source string, term string, count long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters, lower-cased, and of any characters beyond ASCII."""
    return text.translate(_TERM_BYTES).split()


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and numbers of documents by language, source and term, for as many rows as memory allows."""
    counts: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            terms = pa.array(found.keys(), pa.binary()).cast(pa.string())
            seen = docs[lang, source]
            columns = [
                pa.array([lang] * len(found), pa.string()),
                pa.array([source] * len(found), pa.string()),
                terms,
                pa.array(found.values(), pa.int64()),
                pa.array([seen[term] for term in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        texts = batch.column(2)
        texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts.to_pylist()):
            terms = terms_of(text)
            if not terms:
                continue
            group = lang, source
            if group not in counts:
                counts[group], docs[group] = Counter(), Counter()
            distinct = set(terms)
            counts[group].update(terms)
            docs[group].update(distinct)
            held += sum(map(len, distinct))
            if held > HELD_BYTES:
                held = 0
                yield from hand_on()
        if sum(map(len, counts.values())) > HELD_TERMS:
            held = 0
            yield from hand_on()
    yield from hand_on()


def scaled_share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 2) / (total + 2 * terms)), exact for any longs."""
    wide = "decimal(19,0)"
    return (
        F.call_function(
            "div",
            F.lit(UNIT).cast("decimal(10,0)") * (count.cast(wide) + F.lit(ADDED)),
            total.cast(wide) + F.lit(2) * terms.cast(wide),
        )
        + 1
    )


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """:func:`scaled_share` of many counts of one group."""
    if int(counts.max(initial=0)) + ADDED < 2**63 // UNIT:
        return 1 + UNIT * (counts + ADDED) // (total + 2 * terms)
    return np.array([1 + UNIT * (int(c) + ADDED) // (total + 2 * terms) for c in counts], np.int64)


def runs(places: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of the runs of a column of ``size`` counts, which are 0 but at ``places``."""
    column = np.zeros(size, np.int64)
    column[places] = counts
    starts = np.flatnonzero(np.diff(column, prepend=-1))
    return starts, column[starts]


def divergence(a: tuple, b: tuple, size: int) -> int:
    """The sum of floor((p - q)^2 / (p + q)) over ``size`` terms, of two columns of (starts, shares)."""
    starts = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * np.diff(starts, append=size)).sum())


def _block_pairs(key: tuple, table: pa.Table) -> pa.Table:
    """The part of each pair's value that a block of terms has, for the sources of two tiles."""
    first, second = key[2].as_py(), key[3].as_py()
    table = table.sort_by("place")  # the groups' own rows, which know the block, come first
    size, least, terms = (table.column(name)[0].as_py() for name in ("size", "least", "terms"))
    coded = pc.dictionary_encode(table.column("source").combine_chunks())
    names, codes = coded.dictionary, coded.indices.to_numpy()
    columns = {name: table.column(name).to_numpy() for name in ("place", "count", "total", "tile")}
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(names) + 1))
    made: dict[int, list[tuple]] = {first: [], second: []}
    for code in range(len(names)):
        own = order[bounds[code] : bounds[code + 1]]
        own, head = own[columns["place"][own] >= 0], own[0]
        shares = (np.zeros(0, np.int64),) * 2
        if size:
            starts, counts = runs(columns["place"][own] - least, columns["count"][own], size)
            shares = starts, _shares(counts, int(columns["total"][head]), terms)
        made[int(columns["tile"][head])].append((code, shares))
    pairs = combinations(made[first], 2) if first == second else product(made[first], made[second])
    found = [(a, b, divergence(of_a, of_b, size) if size else 0) for (a, of_a), (b, of_b) in pairs]
    a, b, value = zip(*found) if found else ((), (), ())
    columns = [pa.array([key[0].as_py()] * len(found), pa.string())]
    columns += [names.take(pa.array(side, pa.int32())).cast(pa.string()) for side in (a, b)]
    return pa.Table.from_arrays([*columns, pa.array(value, pa.int64())], ["lang", "a", "b", "value"])


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.withColumn("rank", F.row_number().over(order))


def source_divergence(
    df: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = LEAST_DOCS,
    best_terms: int = BEST_TERMS,
) -> DataFrame:
    """Columns lang, source, part, item string, value long, rank int: see :mod:`flatweave.llm.divergence`.

    Part ``pair`` has a row for each other source of the language, part ``term`` for up to ``best_terms`` terms that
    the source uses more than its language does.  Null languages, sources and texts count as empty; a source
    without terms is still a group, and a language without any term in ``least_docs`` documents gives pairs of value 0.  Repeated rows
    count each.  An empty table gives no rows; a source alone in its language has no pairs, and no terms beyond its language's.
    Ranks go by falling value, then by the item's UTF-8 bytes.  Other columns are ignored, whatever their names.
    ``df`` is read twice.
    """
    spark = df.sparkSession
    small_batches(spark)
    plain = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    parts = plain.mapInArrow(_partial_counts, _COUNTS)
    counted = staged(parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "term-counts")

    vocabulary = counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("count").alias("all"),
        F.bit_xor(F.xxhash64("source", "count")).alias("mark"),
    )
    order = ["lang", "all", "mark", "term"]
    kept = vocabulary.where(F.col("docs") >= least_docs).select(*order).repartitionByRange(*order)
    kept = staged(kept.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "vocabulary")
    kept = kept.withColumn("block", F.shiftright("at", BLOCK_TERMS.bit_length() - 1))
    kept = kept.withColumn("place", F.col("at").bitwiseAND(F.lit(BLOCK_TERMS - 1)))

    entries = staged(
        counted.select("lang", "source", "term", "count").join(kept.drop("mark", "at"), ["lang", "term"]), "entries"
    )
    sums = entries.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    found = plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["total"])
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total"))
    sizes = found.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = found.join(sizes, "lang").join(terms, "lang", "left").fillna(0, ["terms", "lang_total"])
    tiles = F.ceil(F.col("sources") / TILE_SOURCES)
    groups = staged(groups.withColumn("tile", F.pmod(F.xxhash64("source"), tiles)).withColumn("tiles", tiles), "groups")
    of_group = groups.select("lang", "source", "total", "terms", "lang_total", "tile", "tiles")

    # Every group is in every block, with a place of -1, or else its zeros there would be missed; a language without terms has one
    # block of no terms.
    blocks = kept.groupBy("lang", "block").agg(F.count("*").cast("int").alias("size"), F.min("place").alias("least"))
    bare = groups.where("terms = 0").select("lang").distinct()
    blocks = blocks.union(bare.select("lang", F.lit(-1).cast("long"), F.lit(0), F.lit(0).cast("long")))
    columns = ["lang", "block", "size", "least", "source", "place", "count", "total", "terms", "tile", "tiles"]
    zeros = of_group.join(blocks, "lang").withColumns({"place": F.lit(-1).cast("long"), "count": F.lit(0).cast("long")})
    filled = entries.join(of_group, ["lang", "source"])
    filled = filled.withColumns({"size": F.lit(None).cast("int"), "least": F.lit(None).cast("long")})
    dealt = zeros.select(*columns).unionByName(filled.select(*columns))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    pairs = dealt.drop("other", "tiles").groupBy("lang", "block", "low", "high").applyInArrow(
        _block_pairs, "lang string, a string, b string, value long"
    )
    pairs = pairs.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", "value", F.explode(sides).alias("s")).select("lang", "s.source", "s.item", "value")

    used = entries.join(of_group, ["lang", "source"])
    p = scaled_share(F.col("count"), F.col("total"), F.col("terms"))
    q = scaled_share(F.col("all"), F.col("lang_total"), F.col("terms"))
    used = used.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    used = used.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)")).drop("p", "q")

    both = _ranked(pairs).withColumn("part", F.lit("pair")).unionByName(
        _ranked(used).where(F.col("rank") <= best_terms).withColumn("part", F.lit("term"))
    )
    return both.select("lang", "source", "part", "item", "value", "rank")
