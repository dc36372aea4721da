"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one node.  Nodes are dealt to overlapping shards, those of their nearest centroids; shards that are too
large are dealt on to centroids of their own, unless they are one dense group.  Each shard
builds a graph whose lists are thinned by robust pruning (Subramanya et al., DiskANN), and the
lists that a node got in its shards are united.  Every node is then searched for in each of
its shards: greedily from itself, the shard's medoid and each connected part of its graph, and from within the range on
through all links, until no vector in range is left unexpanded.  A pair that shares several shards counts once,
wherever it was found: where the shards of a node disagree, it is compared with all vectors of its shards.  All links
are verified by their cosine in double precision; recall is audited against brute force, and the overlap of shards and the
search are widened until the audit is met.  If the widest does not meet it, all nodes are compared with all others of their
shards, and what misses the target even so is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import ROW, hash_sample, map_batches, staged, uniform, with_row_ids
from flatweave.llm.components import connected_components

THRESHOLD = 0.95
SHARD_NODES = 1_000
MOST_SHARD_NODES = 6_000
OVERLAP = 4
SAMPLE = 20_000
LEAST_PER_CENTROID = 4
# Centroids nearer than this are one, so that a dense group stays together.
# Rows of a sample that are compared with all centroids at once: 8 MB for each 1,000 centroids.
CENTROID_BLOCK = 1_000
SAME_CENTROID = 0.85
# A shard of more nodes is dealt on, by centroids of a sample of its own.
RESPLIT_NODES = 16_000
SHARD_SAMPLE = 4_000
RESPLIT_OVERLAP = 2
# With fewer centroids than this the overlap would leave shards about as large as they were.
LEAST_RESPLIT = 8
MOST_LEVELS = 3
DEGREE = 24
POOL = 64
ALPHA = 1.2
BEAM = 24
WIDEST_BEAM = 192
MEDOIDS = 4
AUDIT_QUERIES = 256
AUDIT_CANDIDATES = 2_048
TARGET_RECALL = 0.98
_QUERIES_AT_ONCE = 256
_EXPANDED_AT_ONCE = 4
_MET = ("node", "shard", "pairs", "shared", "links", "sign", "first")


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector has a direction: no null, NaN or infinite component, not zero, not empty."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0))


def unit(rows: list) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so that no square overflows."""
    matrix = np.array(rows, np.float64).reshape(len(rows), -1)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means on a bounded sample; a block of products is held at a time."""
    random = np.random.default_rng(seed)
    centroids = sample[random.choice(len(sample), min(count, len(sample)), replace=False)]
    blocks = range(0, len(sample), CENTROID_BLOCK)
    for _ in range(rounds):
        nearest = np.concatenate([(sample[at : at + CENTROID_BLOCK] @ centroids.T).argmax(axis=1) for at in blocks])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    kept = np.ones(len(centroids), bool)
    for at in range(len(centroids)):
        if kept[at]:
            kept[at + 1 :] &= centroids[at + 1 :] @ centroids[at] < SAME_CENTROID
    return centroids[kept]


def nearest_centroids(points: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    return np.argsort(-(points @ centroids.T), axis=1, kind="stable")[:, :count]


def shard_graph(points: np.ndarray, block: int = 512) -> np.ndarray:
    """Neighbour lists (-1: none) of a shard's nodes: pruned candidates with links back."""
    count = len(points)
    size = min(POOL, count - 1)
    if size <= 0:
        return np.full((count, 2 * DEGREE), -1, np.int64)
    out = np.empty((count, DEGREE), np.int64)
    for at in range(0, count, block):
        near = points[at : at + block] @ points.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
        pool = np.argpartition(-near, size - 1, axis=1)[:, :size]
        order = np.argsort(-np.take_along_axis(near, pool, axis=1), axis=1, kind="stable")
        pool = np.take_along_axis(pool, order, axis=1)
        # A block's own rows come first, so that pruning can address them by number.
        local = np.vstack([points[at : at + block], points])
        out[at : at + block] = robust_prune(local, pool + len(near), len(near))
    source = np.repeat(np.arange(count), DEGREE)
    target = out.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    # Links back, at most as many again for each node, those from near nodes first.
    order = np.lexsort((-np.einsum("nd,nd->n", points[source], points[target]), target))
    source, target = source[order], target[order]
    starts = np.searchsorted(target, np.arange(count))
    rank = np.arange(len(target)) - starts[target]
    fits = rank < DEGREE
    back = np.full((count, DEGREE), -1, np.int64)
    back[target[fits], rank[fits]] = source[fits]
    return np.hstack([out, back])


def robust_prune(local: np.ndarray, pool: np.ndarray, rows: int) -> np.ndarray:
    """Thins the candidates (``pool``, nearest first) of the first ``rows`` points to at most ``DEGREE`` neighbours.

    The nearest one left is kept, and those that are ``ALPHA`` times nearer to it than to the node go.
    """
    kept = np.full((rows, DEGREE), -1, np.int64)
    alive = np.ones(pool.shape, bool)
    numbers = np.arange(rows)
    candidates = local[pool]
    to_node = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,npd->np", local[:rows], candidates), 0))
    for place in range(DEGREE):
        first = alive.argmax(axis=1)
        has = alive[numbers, first]
        if not has.any():
            break
        chosen = pool[numbers, first]
        kept[has, place] = chosen[has] - rows
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,npd->np", local[chosen], candidates), 0))
        alive &= ~((ALPHA * between <= to_node) & has[:, None])
        alive[numbers, first] = False
    return kept


def range_search(
    points: np.ndarray, lists: np.ndarray, queries: np.ndarray, places: np.ndarray, starts: np.ndarray, threshold: float, beam: int
) -> np.ndarray:
    """Which points (columns) each query found in range; ``places`` are the queries' own ones (-1: none).

    All queries walk in step, and each expands the best few of its ``beam`` best points until all are expanded.  Then
    each expands every point in range that it has met, until none is left.
    """
    count, asked = len(points), len(queries)
    similar = np.full((asked, count), -2.0)
    expanded = np.zeros((asked, count), bool)
    first_of = np.zeros(asked * count, np.int32)

    def visit(query: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Similarities of points (rows: queries, -1: none) not met before, once each; -3 for the others."""
        rows, places = np.nonzero(near >= 0)
        point = near[rows, places]
        code = query[rows] * count + point
        fresh = similar.reshape(-1)[code] == -2.0
        rows, places, point, code = rows[fresh], places[fresh], point[fresh], code[fresh]
        first_of[code] = np.arange(len(code))
        once = first_of[code] == np.arange(len(code))
        rows, places, point, code = rows[once], places[once], point[once], code[once]
        found = np.full(near.shape, -3.0)
        for at in range(0, len(code), 1 << 16):
            part = slice(at, at + (1 << 16))
            found[rows[part], places[part]] = np.einsum("nd,nd->n", queries[query[rows[part]]], points[point[part]])
        similar.reshape(-1)[code] = found[rows, places]
        return found

    active = np.arange(asked)
    ids = np.hstack([places[:, None], np.broadcast_to(starts, (asked, len(starts)))])
    worth = visit(active, ids)
    open_ = np.ones(ids.shape, bool)
    while len(active):
        best = np.argsort(-np.where(open_, worth, -4.0), axis=1, kind="stable")[:, :_EXPANDED_AT_ONCE]
        chosen = np.take_along_axis(ids, best, axis=1)
        real = np.take_along_axis(open_ & (worth > -2.5), best, axis=1)
        going = real.any(axis=1)
        if not going.all():
            active, ids, worth, open_ = active[going], ids[going], worth[going], open_[going]
            best, chosen, real = best[going], chosen[going], real[going]
            if not len(active):
                break
        np.put_along_axis(open_, best, False, axis=1)
        row = np.broadcast_to(active[:, None], chosen.shape)
        expanded[row[real], chosen[real]] = True
        near = np.where(real[:, :, None], lists[chosen], -1).reshape(len(active), -1)
        found = visit(active, near)
        ids = np.hstack([ids, near])
        worth = np.hstack([worth, found])
        open_ = np.hstack([open_, found > -2.5])
        if ids.shape[1] > beam:
            top = np.argpartition(-worth, beam - 1, axis=1)[:, :beam]
            ids, worth, open_ = (np.take_along_axis(one, top, axis=1) for one in (ids, worth, open_))

    mark = np.zeros(count + 1, bool)  # the last place takes the -1
    for query in np.flatnonzero(((similar >= threshold) & ~expanded).any(axis=1)):
        frontier = np.flatnonzero((similar[query] >= threshold) & ~expanded[query])
        while len(frontier):
            mark[:] = False
            mark[lists[frontier].reshape(-1)] = True
            new = np.flatnonzero(mark[:count] & (similar[query] == -2.0))
            similar[query, new] = points[new] @ queries[query]
            frontier = new[similar[query, new] >= threshold]
    return similar >= threshold


def _lists_of(group: pa.Table, ids: np.ndarray) -> np.ndarray:
    """United lists as places in the shard; neighbours that are elsewhere are left out."""
    column = group.column("near").combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    place = np.searchsorted(ids, flat)
    place = np.where(ids[np.minimum(place, len(ids) - 1)] == flat, place, -1)
    lists = np.full((len(sizes), max(1, int(sizes.max(initial=0)))), -1, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    lists[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = place
    return lists


def _shard_lists(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of different lengths as rows, ended by -1."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    made = np.full((len(sizes), int(sizes.max(initial=1))), -1, np.int64)
    made[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return made


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _parts(lists: np.ndarray) -> np.ndarray:
    """The least place of each connected part of a graph."""
    parent = np.arange(len(lists))
    row, column = np.nonzero(lists >= 0)
    _join(parent, row, lists[row, column])
    return np.flatnonzero(parent == np.arange(len(lists)))


def _counts(met: DataFrame) -> DataFrame:
    """(node, links, unsure) of what the searches met: each node's links, once each.

    Pairs of a node are told apart by the shards that they share.  All of these should have found the same ones, by
    their combined hash; a node is unsure if some have not.
    """
    met = met.where("shared > 0").groupBy("node", "pairs", "shared", "shard")
    met = met.agg(F.sum("links").alias("links"), F.bit_xor("sign").alias("sign")).groupBy("node", "pairs", "shared")
    unsure = (F.count("*") < F.col("shared")) | (F.min("sign") != F.max("sign"))
    met = met.agg(F.max("links").alias("links"), unsure.alias("unsure"))
    return met.groupBy("node").agg(F.sum("links").alias("links"), F.max("unsure").alias("unsure"))


def node_links(nodes: DataFrame, threshold: float = THRESHOLD, beam: int | None = BEAM) -> DataFrame:
    """(node, links, first) of nodes (node, unit, weight, shards): the weight of other nodes in range, in one of a node's rows,
    and a node that it hangs together with.  Without a beam each node is compared with all others of its shards.

    A shard above ``MOST_SHARD_NODES`` is cut into slices by hash.  Each slice has its own graph, and the nodes of each slice
    are searched for in every other, a task for each two.
    """
    in_shard = nodes.withColumn("shard", F.explode("shards"))
    slices = staged(
        in_shard.groupBy("shard").agg(F.ceil(F.count("*") / MOST_SHARD_NODES).alias("slices")), "vector-shards"
    )
    placed = in_shard.join(slices, "shard").withColumn("own", F.pmod(F.xxhash64("node"), F.col("slices")))

    def build(group: pa.Table) -> pa.Table:
        ids = group.column("node").to_numpy()
        order = np.argsort(ids)
        lists = shard_graph(_matrix(group.column("unit"))[order])
        ids = ids[order]
        near = [ids[one[one >= 0]] for one in lists]
        return pa.table({"node": ids, "near": pa.array(near, pa.list_(pa.int64()))})

    parts = placed.groupBy("shard", "own").applyInArrow(build, "node long, near array<long>")
    united = parts.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    placed = placed.join(staged(united, "vector-graph"), "node")
    met = staged(_searched(placed, threshold, beam), "vector-met")
    counts = staged(_counts(met), "vector-sure")
    # Shards that disagree have missed links: those nodes are compared with all others of their shards.
    unsure = staged(counts.where("unsure").select("node"), "vector-unsure")
    if not unsure.isEmpty():
        again = staged(_searched(placed, threshold, None, unsure), "vector-met")
        counts = counts.where("NOT unsure").unionByName(_counts(again))
        met = met.unionByName(again)
    ends = met.select("node", F.lit(0).cast("long").alias("links"), "first").distinct()
    return counts.select("node", "links", F.col("node").alias("first")).unionByName(ends)


def _searched(placed: DataFrame, threshold: float, beam: int | None, only: DataFrame | None = None) -> DataFrame:
    """What each node, or each of ``only``, meets in its shards; without a beam it is compared with all.

    A row for each shard, slice and set of shards that the pairs share: (node, shard, pairs, shared, links, sign, first).
    """
    wanted = F.lit(True)
    if only is not None:
        placed = placed.join(only.withColumn("wanted", F.lit(True)), "node", "left")
        wanted = F.coalesce("wanted", F.lit(False))
    placed = placed.withColumn("wanted", wanted)
    # Every node is a query in all slices of its shards, and a point of its own slice for the queries of all.
    every = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    asked = placed.withColumn("slice", F.explode(every)).withColumn("block", F.col("own"))
    asked = asked.withColumns({"is_query": F.col("wanted"), "is_point": F.col("slice") == F.col("own")})
    met = placed.withColumn("block", F.explode(every)).where("block != own").withColumn("slice", F.col("own"))
    met = met.withColumns({"is_query": F.lit(False), "is_point": F.lit(True)})
    asked = asked.unionByName(met)

    def search(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        is_point = group.column("is_point").to_numpy(zero_copy_only=False)
        group = group.take(np.lexsort((group.column("node").to_numpy(), ~is_point)))
        many = int(is_point.sum())
        queries = np.flatnonzero(group.column("is_query").to_numpy(zero_copy_only=False))
        ids, units = group.column("node").to_numpy(), _matrix(group.column("unit"))
        weights, shards = group.column("weight").to_numpy(), _shard_lists(group.column("shards"))
        points = units[:many]
        if not many or not len(queries):
            return pa.table(dict.fromkeys(_MET, ids[:0]))
        parent, rows = np.arange(len(ids)), []

        def count(found: np.ndarray, own: np.ndarray) -> None:
            rows.extend(_count(found, own, shards, weights, _mixed(ids), parent))

        whole = beam is not None and len(queries) == many == len(ids)
        found_all = np.zeros((many, many), bool) if whole else None
        if beam is not None:
            lists = _lists_of(group.slice(0, many), ids[:many])
            # The medoid, some more points, and one of each part in case the graph falls apart.
            starts = np.argsort(-(points @ points.mean(axis=0)), kind="stable")[:1]
            spread = np.linspace(0, many - 1, min(MEDOIDS, many)).astype(np.int64)
            starts = np.unique(np.r_[starts, spread, _parts(lists)])
        for at in range(0, len(queries), _QUERIES_AT_ONCE):
            own = queries[at : at + _QUERIES_AT_ONCE]
            if beam is None:
                found = units[own] @ points.T >= threshold
            else:
                found = range_search(points, lists, units[own], np.where(own < many, own, -1), starts, threshold, beam)
            same = np.flatnonzero(own < many)
            found[same, own[same]] = False
            if whole:
                found_all[own] = found
            else:
                count(found, own)
        if whole:
            # A link found from either end holds for both.
            found_all |= found_all.T
            for at in range(0, len(ids), _QUERIES_AT_ONCE):
                own = np.arange(at, min(len(ids), at + _QUERIES_AT_ONCE))
                count(found_all[own], own)
        _join(parent, parent[:0], parent[:0])
        moved = np.flatnonzero(parent != np.arange(len(ids)))
        rows.append((moved, *[np.zeros(len(moved), np.int64)] * 4))
        place, pairs, shared, links, sign = (np.concatenate(column) for column in zip(*rows))
        columns = [ids[place], np.full(len(place), shard), pairs, shared, links, sign, ids[parent[place]]]
        return pa.table(dict(zip(_MET, columns)))

    return asked.groupBy("shard", "slice", "block").applyInArrow(search, ", ".join(f"{name} long" for name in _MET))


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A hash of each number."""
    mixed = numbers.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed + np.uint64(0x9E3779B97F4A7C15) ^ mixed >> np.uint64(shift)) * np.uint64(factor)
    return (mixed ^ mixed >> np.uint64(31)).view(np.int64)


def _count(found, own, shards, weights, signs, parent):
    """Joins what a block of found links connects, and sums them: (query, pairs, shared, links, sign) by
    query and the shards that its pairs share."""
    query, point = np.nonzero(found)
    mixed = _mixed(shards)
    for at in range(0, len(query), 1 << 18):
        q, p = own[query[at : at + (1 << 18)]], point[at : at + (1 << 18)]
        pairs, shared = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        for a in range(shards.shape[1]):
            both = (shards[p] == shards[q, a][:, None]).any(axis=1) & (shards[q, a] >= 0)
            pairs ^= np.where(both, mixed[q, a], 0)
            shared += both
        _join(parent, q, p)
        order = np.lexsort((pairs, q))
        q, p, pairs, shared = q[order], p[order], pairs[order], shared[order]
        first = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (pairs[1:] != pairs[:-1])])
        links, sign = np.add.reduceat(weights[p], first), np.bitwise_xor.reduceat(signs[p], first)
        yield q[first], pairs[first], shared[first], links, sign


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of all pairs: the smaller root of each pair wins, until no pair has two."""
    while True:
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def audit_recall(nodes: DataFrame, counted: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT_QUERIES) -> float:
    """The mean share of its true links that was found of a node that has any; nodes are compared with all by brute force.

    Two bounded samples by hash are taken, ``AUDIT_CANDIDATES`` of all nodes and ``queries`` of those with a link found, since links
    may be too rare for the first; the lesser mean counts.
    """
    linked = hash_sample(counted.where("links > 0").select("node"), "node", queries)
    drawn = hash_sample(nodes.select("node"), "node", AUDIT_CANDIDATES).withColumn("drawn", F.lit(True))
    sample = staged(linked.withColumn("linked", F.lit(True)).join(drawn, "node", "full"), "vector-audit")
    asked = nodes.select("node", "unit").join(sample, "node").collect()
    if not asked:
        return 1.0
    ids = np.array([row["node"] for row in asked])
    shared = nodes.sparkSession.sparkContext.broadcast((ids, np.array([row["unit"] for row in asked])))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, units = shared.value
        others = batch.column(0).to_numpy(zero_copy_only=False)
        points = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(others), -1)
        near = (units @ points.T >= threshold) & (own[:, None] != others[None, :])
        some = near.any(axis=1)
        return pa.RecordBatch.from_pydict({"node": own[some], "links": near[some] @ batch.column(2).to_numpy(zero_copy_only=False)})

    truth = map_batches(nodes.select("node", "unit", "weight"), compare, "node long, links long")
    truth = truth.groupBy("node").agg(F.sum("links").alias("true_links"))
    share = F.least(F.coalesce("links", F.lit(0)), "true_links") / F.col("true_links")
    row = truth.join(counted.select("node", "links"), "node", "left").join(sample, "node").agg(
        F.avg(F.when(F.col("drawn"), share)).alias("drawn"), F.avg(F.when(F.col("linked"), share)).alias("linked")
    ).first()
    return min((one for one in row if one is not None), default=1.0)


def _nodes(rows: DataFrame, id_column: str, column: str) -> DataFrame:
    """Distinct vectors: (node, vector, weight, least id)."""
    return rows.groupBy(F.col(column).alias("vector")).agg(
        F.min(ROW).alias("node"), F.count("*").alias("weight"), F.min(id_column).alias("least")
    )


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, not even equal ones.
    Vectors of different lengths never link.  ``component_id`` is the smallest id reachable; a null id is never the
    smallest, and a component of null ids only has a null one.  ``kept`` is false for a null id.
    """
    rows = with_row_ids(vectors.select(id_column, column), "vectors")
    good = _usable(rows, column)
    classes = staged(_nodes(good, id_column, column), "vector-classes")

    def units(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [unit([one])[0] for one in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(made, pa.list_(pa.float64())), batch.column(2)], ["node", "unit", "weight"]
        )

    nodes = staged(
        map_batches(classes.select("node", "vector", "weight"), units, "node long, unit array<double>, weight long"),
        "vector-units",
    )
    found = None
    for row in nodes.groupBy(F.size("unit").alias("size")).count().collect():  # one row a dimension
        same = nodes.where(F.size("unit") == row["size"])
        links = _links_of(same, row["count"], threshold)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = rows.where("false").select(F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("links"), F.lit(0).cast("long").alias("first"))
    counts = staged(found.groupBy("node").agg(F.sum("links").alias("links")), "vector-counts")
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("first").alias("b")))
    joined = classes.join(counts, "node", "left").join(parts, "node", "left")
    joined = staged(joined.withColumn("component", F.coalesce("component", "node")), "vector-joined")
    least = staged(joined.groupBy("component").agg(F.min("least").alias("component_id")), "vector-least")
    result = staged(
        joined.join(least, "component").select(
            "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
        ),
        "vector-result",
    )
    usable = good.join(result, F.col(column) == F.col("vector"))
    usable = usable.select(id_column, "n_links", "component_id")
    lone = rows.join(good.select(ROW), ROW, "left_anti").select(
        id_column, F.lit(0).cast("long").alias("n_links"), F.col(id_column).alias("component_id")
    )
    kept = F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False))
    return usable.unionByName(lone).withColumn("kept", kept)


def _resplit(sharded: DataFrame, dimension: int, overlap: int = RESPLIT_OVERLAP) -> DataFrame:
    """Deals the nodes of too large shards on, level by level, to the nearest of centroids of a sample of the shard.

    A shard whose centroids are nearly all alike is a dense group and stays whole.
    """
    settled = None
    for _ in range(MOST_LEVELS):
        members = sharded.select("node", "unit", F.explode("shards").alias("shard"))
        large = members.groupBy("shard").agg(F.count("*").alias("size")).where(F.col("size") > RESPLIT_NODES)
        if settled is not None:
            large = large.join(settled, "shard", "left_anti")
        large = staged(large, "vector-large")
        if large.isEmpty():
            return sharded
        # Cut into blocks, so that no task gets a shard whole.
        large = large.withColumn("blocks", F.ceil(F.col("size") / RESPLIT_NODES))
        members = members.join(large, "shard").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))

        def fit(group: pa.Table) -> pa.Table:
            sample = _matrix(group.column("unit"))
            wanted = min(-(-group.column("size")[0].as_py() // SHARD_NODES), len(sample) // LEAST_PER_CENTROID, 256)
            made = fit_centroids(sample, max(1, wanted)).reshape(-1)
            return pa.table({"shard": group.column("shard")[:1], "centroids": pa.array([made], pa.list_(pa.float64()))})

        def deal(members: pa.Table, fitted: pa.Table) -> pa.Table:
            points = _matrix(members.column("unit"))
            centroids = _matrix(fitted.column("centroids")).reshape(-1, points.shape[1])
            shard = members.column("shard")[0].as_py()
            # Numbers of the new shards; two with one number would only be searched together.
            numbers = [xxhash.xxh64_intdigest(f"{shard}/{one}") >> 1 for one in range(len(centroids))]
            new = np.array(numbers, np.int64)[nearest_centroids(points, centroids, overlap)]
            return pa.table(
                {"node": members.column("node"), "shard": members.column("shard"), "new": pa.array(list(new), pa.list_(pa.int64()))}
            )

        sample = members.where(uniform("node", "shard") < F.lit(SHARD_SAMPLE) / F.col("size")).select("shard", "size", "unit")
        fitted = staged(sample.groupBy("shard").applyInArrow(fit, "shard long, centroids array<double>"), "vector-centroids")
        alone = F.size("centroids") < LEAST_RESPLIT * dimension
        whole = staged(fitted.where(alone).select("shard"), "vector-whole")
        settled = whole if settled is None else settled.union(whole)
        apart = fitted.where(~alone).join(large, "shard")
        apart = apart.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        own = members.join(whole, "shard", "left_anti").select("shard", "block", "node", "unit").groupBy("shard", "block")
        moved = own.cogroup(apart.select("shard", "block", "centroids").groupBy("shard", "block"))
        moved = moved.applyInArrow(deal, "node long, shard long, new array<long>")
        moved = moved.groupBy("node").agg(F.collect_list("shard").alias("old"), F.flatten(F.collect_list("new")).alias("new"))
        empty = F.array().cast("array<bigint>")
        lists = F.array_union(
            F.array_except("shards", F.coalesce("old", empty)), F.coalesce("new", empty)
        )
        joined = sharded.join(moved, "node", "left")
        sharded = staged(
            joined.select("node", "unit", "weight", F.array_sort(lists).alias("shards")), "vector-assigned"
        )
    return sharded


def _links_of(nodes: DataFrame, count: int, threshold: float) -> DataFrame:
    """Shards, graph and search of nodes of one dimension, widened until the audit is met."""
    rows = hash_sample(nodes.select("node", "unit"), "node", SAMPLE).collect()
    sample = np.array([row["unit"] for row in rows])
    wanted = max(1, min(-(-count // SHARD_NODES), len(sample) // LEAST_PER_CENTROID))
    shared = nodes.sparkSession.sparkContext.broadcast(fit_centroids(sample, wanted))

    def shards_of(overlap: int) -> DataFrame:
        def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
            centroids = shared.value
            points = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            near = nearest_centroids(points, centroids, overlap)
            shards = pa.array(list(np.sort(near, axis=1)), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([*batch.columns, shards], ["node", "unit", "weight", "shards"])

        schema = "node long, unit array<double>, weight long, shards array<long>"
        sharded = staged(map_batches(nodes, assign, schema), "vector-assigned")
        return _resplit(sharded, sample.shape[1], RESPLIT_OVERLAP * overlap // OVERLAP)

    def audited(found: DataFrame) -> float:
        return audit_recall(nodes, found.groupBy("node").agg(F.sum("links").alias("links")), threshold)

    beam, overlap = BEAM, OVERLAP
    while True:
        sharded = shards_of(overlap)
        found = staged(node_links(sharded, threshold, beam), "vector-links")
        if audited(found) >= TARGET_RECALL:
            return found
        if beam >= WIDEST_BEAM:
            break
        beam, overlap = 2 * beam, 2 * overlap
    found = staged(node_links(sharded, threshold, None), "vector-links")
    recall = audited(found)
    if recall < TARGET_RECALL:
        raise ValueError(f"{recall:.4f} of the links of a node were found on average, less than {TARGET_RECALL}")
    return found
