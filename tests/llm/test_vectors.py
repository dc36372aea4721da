import numpy as np
import pytest

from flatweave.llm import vectors


def brute(rows, threshold=0.95):
    """(id, links, component) by comparing all with all."""
    units = []
    for _, vector in rows:
        bad = vector is None or not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector)
        units.append(None if bad else vectors.unit([vector])[0])
    links = [
        [j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= threshold]
        for i, a in enumerate(units)
    ]
    result = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        result.append((own, len(links[i]), least, own is not None and own == least))
    return result


def key(row):
    return tuple((value is None, value) for value in row)


def test_given_vectors(table):
    df = table("embeddings")
    rows = [(row.vec_id, list(row.embedding)) for row in df.collect()]
    assert sorted(map(tuple, vectors.near_vectors(df).collect()), key=key) == sorted(brute(rows), key=key)


def clouds(seed, sizes, dimension=24, spread=0.02):
    random = np.random.default_rng(seed)
    made = []
    for size in sizes:
        centre = random.normal(size=dimension)
        made += [(centre + spread * np.linalg.norm(centre) * random.normal(size=dimension) / dimension**0.5 * 4).tolist() for _ in range(size)]
    return [(i, vector) for i, vector in enumerate(made)]


@pytest.mark.parametrize("most", [40, 6_000])
def test_clouds_over_several_shards_and_slices(spark, monkeypatch, most):
    monkeypatch.setattr(vectors, "SHARD_NODES", 60)
    monkeypatch.setattr(vectors, "MOST_SHARD_NODES", most)
    rows = clouds(1, [120, 30, 5, 2, 1] + [1] * 150)
    expected = brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, vectors.near_vectors(df).collect()))
    true, got = sum(row[1] for row in expected), sum(row[1] for row in found)
    assert 0.98 * true <= got <= true
    assert sum(a[2] == b[2] for a, b in zip(found, sorted(expected))) >= 0.98 * len(rows)


def test_large_shards_are_dealt_on_and_dense_groups_stay(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SAMPLE", 24)  # few centroids at first
    monkeypatch.setattr(vectors, "SHARD_NODES", 10)
    monkeypatch.setattr(vectors, "RESPLIT_NODES", 150)
    monkeypatch.setattr(vectors, "MOST_SHARD_NODES", 90)
    rows = clouds(2, [130, 40, 6] + [1] * 300)
    expected = brute(rows)
    found = sorted(map(tuple, vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    true, got = sum(row[1] for row in expected), sum(row[1] for row in found)
    assert 0.97 * true <= got <= true
    assert sum(a[2] == b[2] for a, b in zip(found, sorted(expected))) >= 0.98 * len(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0]), (None, [1.0, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [0.0, 0.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1e300, 2e300]), (12, [-1.0, -2.0]),
        (13, [1.0, 2.0, 0.0]), (14, [1.0, 2.1]), (14, [1.0, 2.1]), (None, [5.0, -1.0]), (15, [-0.0, 1.0]), (16, [0.0, 1.0]),
    ]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], f"{schema}, links string, component string")
    found = vectors.near_vectors(df)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows), key=key)
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    lone = spark.createDataFrame([(3, [1.0])], schema)
    assert [tuple(row) for row in vectors.near_vectors(lone).collect()] == [(3, 0, 3, True)]


def test_pruned_lists_keep_the_nearest_and_respect_the_degree():
    random = np.random.default_rng(4)
    points = vectors.unit(random.normal(size=(300, 16)).tolist())
    lists = vectors.shard_graph(points)
    near = points @ points.T - 2 * np.eye(300)
    assert lists.shape == (300, 2 * vectors.DEGREE)
    for at in range(300):
        own = lists[at][lists[at] >= 0]
        assert near[at].argmax() in own and at not in own


@pytest.mark.parametrize("most", [400, 6_000])
def test_many_groups_without_single_vectors(spark, monkeypatch, most):
    monkeypatch.setattr(vectors, "MOST_SHARD_NODES", most)
    rows = clouds(5, [100] * 10, spread=0.01)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, vectors.near_vectors(df).collect())) == sorted(brute(rows))


def test_a_link_missed_in_one_shard_counts_where_it_was_found(spark, monkeypatch):
    rows = clouds(6, [30, 1, 2], spread=0.01)
    searched = vectors.range_search

    def blind(points, lists, queries, *rest):
        found = searched(points, lists, queries, *rest)
        return found & (len(points) != 32)  # nothing is found in the shard of 32

    monkeypatch.setattr(vectors, "range_search", blind)
    nodes = [(i, vectors.unit([v])[0].tolist(), 1, [0, 1] if i < 32 else [1]) for i, v in rows]
    links = vectors.node_links(spark.createDataFrame(nodes, "node long, unit array<double>, weight long, shards array<long>"))
    found = {row.node: row.n for row in links.groupBy("node").agg({"links": "sum"}).toDF("node", "n").collect()}
    assert [found.get(i, 0) for i, _ in rows] == [row[1] for row in brute(rows)]


def test_audit_weighs_every_linked_node_alike(spark):
    random = np.random.default_rng(7)
    units = vectors.unit(random.normal(size=(60, 16)).tolist())
    units[:40] = units[0]  # one hot group, found, beside ten lost pairs
    units[50:] = units[40:50]
    nodes = [(i, unit.tolist(), 1) for i, unit in enumerate(units)]
    counted = [(i, 39) for i in range(40)]
    df = spark.createDataFrame(nodes, "node long, unit array<double>, weight long")
    recall = vectors.audit_recall(df, spark.createDataFrame(counted, "node long, links long"))
    assert abs(recall - 40 / 60) < 1e-9


def test_overlap_is_widened_and_a_missed_target_is_an_error(spark, monkeypatch):
    audited = iter([0.5, 0.97, 1.0])
    monkeypatch.setattr(vectors, "audit_recall", lambda *_: next(audited))
    rows = clouds(8, [3, 2], spread=0.01)
    nodes = spark.createDataFrame([(i, vectors.unit([v])[0].tolist(), 1) for i, v in rows], "node long, unit array<double>, weight long")
    seen = []
    monkeypatch.setattr(vectors, "_resplit", lambda sharded, dimension, overlap: seen.append(overlap) or sharded)
    vectors._links_of(nodes, len(rows), 0.95)
    assert seen == [2, 4, 8]
    monkeypatch.setattr(vectors, "audit_recall", lambda *_: 0.5)
    with pytest.raises(ValueError, match="0.5000"):
        vectors._links_of(nodes, len(rows), 0.95)
