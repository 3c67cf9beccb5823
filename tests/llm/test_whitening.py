import math
from fractions import Fraction

import numpy as np
import pytest

from subjectlog.llm import whitening

VECTOR = "vec_id bigint, embedding array<float>, label int, vector string, n string, k string"


def table_of(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "mine", "n", "k") for i, v in zip(ids, vectors)], VECTOR)


def drawn(n, dims, seed, scale=0.3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dims)) @ draw.normal(size=(dims, dims)) * scale
    return x.astype(np.float32).tolist()


def whole(vectors):
    return [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for v in vectors]


def check(rows, vectors, ids, components):
    """Against plain exact sums and the eigenvectors of numpy."""
    x = whole(vectors)
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    off = [[n * v - t for v, t in zip(r, s)] for r in x]
    centred = np.array([[v / n for v in r] for r in off])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    rows = sorted(rows, key=lambda r: ids.index(r["vec_id"]))
    w = np.array([r["whitened"] for r in rows])
    assert w.shape == (n, components)
    assert [int(r["deviation"]) for r in rows] == [sum(y * y for y in r) for r in off]
    assert {r["n"] for r in rows} == {n}
    want = centred @ v / np.sqrt(e)
    assert np.allclose(np.abs(w), np.abs(want), atol=1e-6)
    assert np.allclose(w * np.sign((w * want).sum(0)), want, atol=1e-6)
    assert np.allclose([r["explained"] for r in rows], [e / np.trace(cov)] * n, rtol=1e-9)
    got = np.cov(w.T, bias=True) if components > 1 else np.array([[w.var()]])
    (error,) = {r["identity_error"] for r in rows}
    assert error < 1e-10 and abs(np.abs(got - np.eye(components)).max() - error) < 1e-10


def test_like_numpy(spark):
    vectors = drawn(700, 12, 1)
    odd = [None, [None] * 12, [float("nan")] * 12, [float("inf")] + [1.0] * 11, [1e30] * 12]
    got = whitening.whiten(table_of(spark, vectors + odd), components=9).collect()
    check(got, vectors, list(range(700)), 9)


def test_lengths_apart_and_empty_ones(spark):
    a, b = drawn(90, 5, 2), drawn(70, 3, 3, scale=5e4)  # the second beyond what doubles multiply exactly
    got = whitening.whiten(table_of(spark, a + b + [[], []])).collect()
    check([r for r in got if r["vec_id"] < 90], a, list(range(90)), 5)
    check([r for r in got if 90 <= r["vec_id"] < 160], b, list(range(90, 160)), 3)
    assert len(got) == 160


def test_without_variance(spark):
    assert whitening.whiten(table_of(spark, [])).collect() == []
    one = whitening.whiten(table_of(spark, [[1.0, 2.0]])).collect()
    same = whitening.whiten(table_of(spark, [[1.0, 2.0]] * 3, [7, 7, None])).collect()
    for rows, n in ((one, 1), (same, 3)):
        assert [(r["n"], int(r["deviation"]), r["whitened"], r["explained"]) for r in rows] == [(n, 0, [], [])] * n


def test_dependent_and_constant_dimensions(spark):
    vectors = [[v[0], v[1], v[0], 2.0] for v in drawn(200, 2, 4)]
    got = whitening.whiten(table_of(spark, vectors)).collect()
    check(got, vectors, list(range(200)), 2)


def test_equal_roots(spark):
    """Any orthonormal basis will do where a root is there more than once."""
    vectors = [[a, b, c / 2] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    got = whitening.whiten(table_of(spark, vectors)).collect()
    w = np.array([r["whitened"] for r in got])
    assert np.allclose(w.T @ w / 8, np.eye(3), atol=1e-12)
    assert np.allclose(got[0]["explained"], [4 / 9, 4 / 9, 1 / 9])


@pytest.mark.parametrize("seed", range(6))
def test_polynomial_and_roots(seed):
    draw = np.random.default_rng(seed)
    d = int(draw.integers(2, 9))
    g = draw.integers(-9, 10, (d, max(1, d - seed % 3)))  # some are singular
    matrix = [[int(v) for v in row] for row in g @ g.T]
    p = whitening.primes_above(1 << 31)[0]
    poly = whitening.charpoly_modulo(matrix, p).tolist()
    # Faddeev and Le Verrier, in fractions
    m, want = np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = np.array(matrix, object) @ m + want[-1] * np.eye(d, dtype=int).astype(object)
        want.append(Fraction(-sum((np.array(matrix, object) @ m)[i][i] for i in range(d)), k))
    assert all(v.denominator == 1 for v in want[1:])
    assert poly == [int(v) % p for v in want]
    whole = [int(v) for v in want]
    roots = [r / 2**whitening.REFINE for r, times in whitening.largest_roots(whole, d) for _ in range(times)]
    e = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    assert np.allclose(roots, e[: len(roots)], rtol=1e-9, atol=1e-9) and np.allclose(e[len(roots) :], 0, atol=1e-6)


def test_query(spark, sf_dir):
    got = whitening.op11_whitening(spark, sf_dir)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    rows = got.collect()
    assert len(rows) == 32 * n and {r["component"] for r in rows} == set(range(1, 33))
    assert max(r["identity_error"] for r in rows) < 1e-9
