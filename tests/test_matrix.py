"""COO matrix layer against numpy on the small matrices of the reference's own tests."""

import numpy as np
from pyspark.sql import functions as F

from coact.operators import matrix as mx
from conftest import from_dense, to_dense

# The reference's small test matrices.
TEST_ARRAY = np.array([[1, 2, 3], [4, 0, 6], [0, 0, 8]], dtype=float)
TEST_ARRAY2 = np.array([[1, 2, 3, 0], [4, 0, 6, 1], [0, 0, 8, 2]], dtype=float)


def test_multiply_square(spark):
    a = from_dense(spark, TEST_ARRAY)
    assert np.array_equal(to_dense(mx.multiply(a, a), (3, 3)), TEST_ARRAY @ TEST_ARRAY)


def test_multiply_rectangular(spark):
    a = from_dense(spark, TEST_ARRAY2)
    at = from_dense(spark, TEST_ARRAY2.T)
    assert np.array_equal(to_dense(mx.multiply(a, at), (3, 3)), TEST_ARRAY2 @ TEST_ARRAY2.T)


def test_multiply_threshold_drops_small(spark):
    a = from_dense(spark, TEST_ARRAY)
    prod = mx.multiply(a, a, zero_threshold=20.0).collect()
    full = TEST_ARRAY @ TEST_ARRAY
    assert {(r.i, r.j) for r in prod} == {(i, j) for i, j in zip(*np.nonzero(np.abs(full) >= 20))}


def test_add_with_scalar(spark):
    rng = np.random.default_rng(1)
    a3 = rng.random((3, 4))
    got = to_dense(mx.add(from_dense(spark, a3), from_dense(spark, TEST_ARRAY2), -2), (3, 4))
    assert np.allclose(got, a3 - 2 * TEST_ARRAY2)


def test_diagonal(spark):
    d = mx.diagonal(from_dense(spark, [[1, 0], [0, 0.5]])).collect()
    assert {r.i: r.value for r in d} == {0: 1.0, 1: 0.5}


def test_transpose(spark):
    arr = np.array([[1, 1], [0, 1]], dtype=float)
    assert np.array_equal(to_dense(mx.transpose(from_dense(spark, arr)), (2, 2)), arr.T)


def test_identity(spark):
    arr = np.array([[1, 1], [0, 1]], dtype=float)
    assert np.array_equal(to_dense(mx.identity(from_dense(spark, arr)), (2, 2)), np.eye(2))


def test_divide_by_row_vector(spark):
    vec = mx.vector_from_dense(spark.createDataFrame([([1.0, 2.0, 3.0],)], "a array<double>"), "a")
    got = to_dense(mx.row_divide(from_dense(spark, TEST_ARRAY), vec), (3, 3))
    assert np.allclose(got, TEST_ARRAY / np.array([1, 2, 3])[:, None])


def test_row_scale_and_rows_without_vector_drop(spark):
    vec = mx.from_rows(spark, [(0, 0, 2.0), (2, 0, 3.0)]).select("i", "value")
    got = to_dense(mx.row_scale(from_dense(spark, TEST_ARRAY), vec), (3, 3))
    expect = TEST_ARRAY * np.array([2, 0, 3])[:, None]
    assert np.array_equal(got, expect)


def test_hadamard(spark):
    a, b = TEST_ARRAY, TEST_ARRAY.T
    got = to_dense(mx.hadamard(from_dense(spark, a), from_dense(spark, b)), (3, 3))
    assert np.array_equal(got, a * b)


def test_vector_sqrt_elementwise(spark):
    v = mx.vector_from_dense(spark.createDataFrame([([1.0, 2.0, 3.0],)], "a array<double>"), "a")
    got = sorted((r.i, r.value) for r in mx.vector_map_values(v, F.sqrt).collect())
    assert np.allclose([x for _, x in got], np.sqrt([1, 2, 3]))


def test_map_values_udf_matches_column_version(spark):
    import pandas as pd
    a = from_dense(spark, TEST_ARRAY)
    col = to_dense(mx.map_values(a, lambda v: F.sqrt(v)), (3, 3))
    udf = to_dense(mx.map_values_udf(a, lambda s: pd.Series(np.sqrt(s.to_numpy()))), (3, 3))
    assert np.allclose(col, udf)


def test_add_constant_only_on_stored(spark):
    got = to_dense(mx.add_constant(from_dense(spark, TEST_ARRAY), 1.0), (3, 3))
    assert np.array_equal(got, np.where(TEST_ARRAY != 0, TEST_ARRAY + 1, 0))


def test_densify_and_shape(spark):
    a = from_dense(spark, TEST_ARRAY2)
    d = mx.densify(a).collect()
    assert len(d) == 12
    assert np.array_equal(to_dense(mx.densify(a), (3, 4)), TEST_ARRAY2)
    s = mx.shape(a).first()
    assert (s.n_rows, s.n_cols, s.nnz) == (3, 4, int(np.count_nonzero(TEST_ARRAY2)))


def test_drop_first(spark):
    got = to_dense(mx.drop_first(from_dense(spark, TEST_ARRAY2)), (2, 3))
    assert np.array_equal(got, TEST_ARRAY2[1:, 1:])


def test_row_and_row_sums(spark):
    a = from_dense(spark, TEST_ARRAY2)
    assert np.array_equal(to_dense(mx.row(a, 1), (1, 4))[0], TEST_ARRAY2[1])
    sums = {r.i: r.value for r in mx.row_sum(a).collect()}
    assert sums == {i: float(TEST_ARRAY2[i].sum()) for i in range(3)}


def test_column_std_counts_implicit_zeros(spark):
    got = {r.i: r.value for r in mx.column_std(from_dense(spark, TEST_ARRAY2)).collect()}
    expect = np.std(TEST_ARRAY2, axis=0)
    for j, v in got.items():
        assert np.isclose(v, expect[j])


def test_unit_distance_and_rows_by_distance(spark):
    rng = np.random.default_rng(7)
    m = np.round(rng.random((5, 6)) * 3) * (rng.random((5, 6)) > 0.3)
    m[m.sum(axis=1) == 0, 0] = 1.0
    a = from_dense(spark, m)
    v0 = mx.row(a, 0).select(F.col("j").alias("i"), "value")
    v1 = mx.row(a, 1).select(F.col("j").alias("i"), "value")
    d = mx.unit_distance(v0, v1).first().distance
    u0, u1 = m[0] / np.linalg.norm(m[0]), m[1] / np.linalg.norm(m[1])
    assert np.isclose(d, np.linalg.norm(u0 - u1))
    rows = mx.rows_by_distance(a, v0).orderBy("distance", "i").collect()
    expect = [np.sum((m[i] - m[0]) ** 2) / (np.linalg.norm(m[i]) * np.linalg.norm(m[0])) for i in range(5)]
    assert np.allclose([r.distance for r in sorted(rows, key=lambda r: r.i)], expect)
    assert [r.i for r in rows][0] == 0


def test_from_dense_rows_drops_zeros(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0, 2.0]), (1, [0.0, 0.0, 3.0])], "r long, a array<double>")
    got = sorted(tuple(x) for x in mx.from_dense_rows(df, "r", "a").collect())
    assert got == [(0, 0, 1.0), (0, 2, 2.0), (1, 2, 3.0)]


def test_rows_packed(spark):
    p = {r.i: (list(r.indices), list(r.values)) for r in mx.rows_packed(from_dense(spark, TEST_ARRAY2)).collect()}
    assert p[1] == ([0, 2, 3], [4.0, 6.0, 1.0])


def test_nan_count(spark):
    a = mx.from_rows(spark, [(0, 0, float("nan")), (0, 1, 1.0)])
    assert mx.nan_count(a).first().nan_count == 1


def test_expand_range_chunks_cover_exactly(spark):
    df = spark.createDataFrame([(0, 10), (1, 0), (2, 1), (3, 7)], "i long, n long")
    got = mx.expand_range(df, F.col("n"), "j", chunk=3, keep=["i"]).collect()
    assert sorted((r.i, r.j) for r in got) == sorted(
        (i, j) for i, n in [(0, 10), (1, 0), (2, 1), (3, 7)] for j in range(n))
