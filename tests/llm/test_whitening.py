import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp

from flatweave.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, component string, n string, whitened string"


def plain_numbers(vectors):
    return [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]


def plain_scatter(numbers):
    """n times the products less the product of the sums, one entry after the other."""
    n, width = len(numbers), len(numbers[0])
    sums = [sum(x[i] for x in numbers) for i in range(width)]
    return sums, [
        [n * sum(x[i] * x[j] for x in numbers) - sums[i] * sums[j] for j in range(width)] for i in range(width)
    ]


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "c", "n", "w") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


@settings(max_examples=60, deadline=None)
@given(
    hnp.arrays(
        np.int64,
        st.tuples(st.integers(1, 150), st.integers(1, 5)),
        elements=st.one_of(st.integers(-40, 40), st.integers(-(2**40), 2**40), st.integers(-(2**61), 2**61)),
    )
)
def test_cross_products(numbers):
    sums, products = whitening.shifted_cross_products(numbers)
    exact = numbers.astype(object)
    assert sums.tolist() == exact.sum(axis=0).tolist()
    assert products.tolist() == np.triu(exact.T.dot(exact)).tolist()


def test_planes_are_words_of_rows():
    numbers = np.array([[5, 0, 1]] * 64 + [[2, 0, 0]], np.uint64)
    planes, dimensions, bits = whitening.bit_planes(numbers)
    assert planes.shape == (4, 2)
    assert list(zip(dimensions.tolist(), bits.tolist())) == [(0, 0), (0, 1), (0, 2), (2, 0)]
    assert np.bitwise_count(planes).sum(axis=1).tolist() == [64, 1, 64, 64]


def check(rows, vectors, components=32):
    ids = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    numbers = plain_numbers([vectors[i] for i in ids])
    sums, scatter = plain_scatter(numbers)
    n, width = len(numbers), len(sums)
    covariance = np.array([[v / (n * n) for v in row] for row in scatter])
    values = np.linalg.eigvalsh(covariance)[::-1][:components]
    found = {(r.vec_id, r.component): r for r in rows}
    assert set(found) == {(i, k + 1) for i in ids for k in range(min(components, width))} and len(found) == len(rows)
    for i, x in zip(ids, numbers):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert {int(found[i, k + 1].deviation) for k in range(len(values))} == {deviation}
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    trace = sum(scatter[i][i] for i in range(width)) / (n * n)
    real = [k for k, v in enumerate(values) if v > 1e-12 * trace]
    whitened = np.array([[found[i, k + 1].whitened for k in real] for i in ids])
    for k in real:
        assert found[ids[0], k + 1].explained == pytest.approx(values[k] / trace, rel=1e-9)
    error = np.abs(whitened.T @ whitened / n - np.eye(len(real))).max(initial=0)
    assert error < 1e-6 and rows[0].identity_error < 1e-6
    # The whitened rows are a projection on unit eigenvectors: whitened * sqrt(e) brings back the covariance with x.
    centred = np.array(numbers, float) - np.array([s / n for s in sums])
    for k, place in enumerate(real):
        vector = centred.T @ whitened[:, k] / n / np.sqrt(values[place])
        assert np.linalg.norm(vector) == pytest.approx(1, rel=1e-8)
        assert covariance @ vector == pytest.approx(values[place] * vector, abs=1e-8 * trace)


def test_given_table(spark, table):
    df = table("embeddings")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    ids = sorted(vectors)
    rows = whitening.whiten(df).collect()
    number = {one: at for at, one in enumerate(ids)}
    rows = [r.__class__(**{**r.asDict(), "vec_id": number[r.vec_id]}) for r in rows]
    check(rows, [vectors[i] for i in ids])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    vectors = [list(v) for v in rng.normal(size=(70, 5))]
    vectors += [None, [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0, 0, 0, 0], [0.0] * 5, vectors[0], vectors[0]]
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors)
    check(whitening.whiten(frame(spark, vectors).repartition(9), components=3).collect(), vectors, 3)


def test_huge_entries(spark):
    vectors = [[1e15, 3.0], [-1e15, 2.0], [7e14, -1.0]]
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors)
    assert whitening.whiten(frame(spark, [[1e300, 1.0], [-1e300, 2.0]])).count() == 4


def test_no_spread(spark):
    rows = whitening.whiten(frame(spark, [[0.5, 0.25]] * 3)).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in rows] == [(0.0, 0.0, 0, 0.0)] * 6
    assert whitening.whiten(frame(spark, [[0.5, 0.25]])).count() == 2


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[None]]])
def test_nothing_to_fit(spark, vectors):
    found = whitening.whiten(frame(spark, vectors))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_shorter_vectors_are_followed_by_zeros(spark):
    short = whitening.whiten(frame(spark, [[1.0], [0.5, 2.0], [], [0.25, -1.0]])).collect()
    check(short, [[1.0, 0.0], [0.5, 2.0], [0.0, 0.0], [0.25, -1.0]])


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (None, [0.0, 1.0]), (3, [0.5, 0.25]), (3, [0.5, 0.25])], "vec_id long, embedding array<float>")
    found = whitening.whiten(df)
    assert found.where("vec_id IS NULL").count() == 4 and found.where("vec_id = 3").count() == 4
