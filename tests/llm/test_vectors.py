from collections import Counter

import brute
import numpy as np
import pytest

from subjectlog.llm import ann, hnsw

VECTOR = "vec_id bigint, vector array<float>, label int"
ODD = [
    (9900, None, 1), (9901, [], 1), (9902, [0.0] * 8, 1), (9903, [float("nan")] * 8, 1), (9904, [float("inf")] + [1.0] * 7, 1),
    (9905, [None] * 8, 1), (9906, [1.0, 2.0], 1), (9907, [1.0] * 8, None), (None, [1.0] * 8, 1),
]


def rows(n, seed, dims=8, clusters=20):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, dims))
    x = centres[draw.integers(0, clusters, n)] + draw.normal(size=(n, dims)) * draw.choice([0.01, 0.08, 1.0], (n, 1))
    return [(i, [float(v) for v in row], int(i % 3)) for i, row in enumerate(x)]


def unit(vectors):
    x = np.array(vectors, np.float32).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_search_finds_the_nearest(spark):
    from pyspark.sql import functions as F

    some = rows(3000, 1, dims=16)
    vectors = spark.createDataFrame(some + [(3000, some[50][1], 0)], VECTOR).select("vec_id", "vector")
    got = ann.search(vectors, F.col("vec_id") % 50 == 0).collect()
    x = unit([r[1] for r in some] + [some[50][1]])
    hits = 0
    for q in range(0, 3001, 50):
        s = x @ x[q]
        s[q] = -9
        want = np.lexsort((np.arange(len(s)), -s))[:5]
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in found] == [1, 2, 3, 4, 5]
        assert all(score == pytest.approx(s[i], abs=1e-12) for _, i, score in found)
        hits += len({i for _, i, _ in found} & set(want))
    assert hits >= 0.97 * 5 * 61


def test_search_edges(spark):
    from pyspark.sql import functions as F

    few = [(0, [1.0] * 8, 0), (1, [1.0] * 8, 0), (2, [2.0] * 8, 0), (2, [2.0] * 8, 0), (50, [-1.0] + [1.0] * 7, 0)]
    vectors = spark.createDataFrame(few + ODD, VECTOR)
    got = ann.search(vectors, F.col("vec_id") % 50 == 0).collect()
    ranks = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50)}
    assert ranks == {0: [1, 2, 2, 9907, 50], 50: [0, 1, 2, 2, 9907]}
    assert all(np.isfinite(r["score"]) for r in got)
    for none in (vectors.limit(0), vectors.where("vec_id between 9900 and 9905")):
        assert ann.search(none, F.col("vec_id") % 50 == 0).collect() == []


def test_search_in_blocks_and_slices(spark, monkeypatch):
    """However the codes are cut, the same neighbours are found, and all but the query itself are asked."""
    from pyspark.sql import functions as F

    vectors = spark.createDataFrame(rows(700, 4, dims=16), VECTOR).select("vec_id", "vector")
    asked = lambda k: Counter(map(tuple, ann.search(vectors, F.col("vec_id") % 50 == 0, k).collect()))
    whole = asked(5)
    monkeypatch.setattr(ann, "VECTORS", 150)
    monkeypatch.setattr(ann, "QUERIES", 4)
    monkeypatch.setattr(ann, "SLICE", 32)
    assert {x[:3] for x in asked(5)} == {x[:3] for x in whole} and len(whole) == 5 * 14
    assert len(asked(800)) == 14 * 699


def near(docs, **how):
    return {r["vec_id"]: r for r in hnsw.near_duplicates(docs, **how).collect()}


@pytest.mark.parametrize("shard", [8192, 150])
def test_near_vectors(spark, shard):
    some = rows(1200, 4) + [(5000 + i, [1.0 + i * 1e-4] * 4 + [1.0] * 4, 2) for i in range(300)]
    got = near(spark.createDataFrame(some + ODD, VECTOR), shard=shard)
    x, labels, ids = unit([r[1] for r in some]), np.array([r[2] for r in some]), [r[0] for r in some]
    pairs = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(pairs, False)
    want = brute.components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(pairs)))])
    assert len(got) == len(some) + len(ODD) - 1
    for k, i in enumerate(ids):
        assert got[i]["n_links"] == pairs[k].sum() and got[i]["component_id"] == want[i]
        assert got[i]["kept"] == (i == want[i])
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(9900, 9908))


def test_near_vectors_edges(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2)], VECTOR)
    got = near(few)
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
    assert near(few.limit(0)) == {}
    nothing = near(spark.createDataFrame(ODD, VECTOR).where("vec_id <> 9907 and vec_id <> 9906"))
    assert len(nothing) == 6 and all(r["kept"] for r in nothing.values())


def test_graph_search_recall():
    x = np.random.default_rng(2).normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes, _ = hnsw.Graph(x).search(x[:300].astype(np.float32), 64)
    want = np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(nodes, want)]) > 0.9


def test_lengths_and_labels_apart(spark):
    """Vectors meet those of their own length; a row without label hides no labelled one of its id."""
    from pyspark.sql import functions as F

    few = [(0, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0, 0.0], None), (1, [2.0, 0.0, 0.0], 1), (2, [3.0, 0.0, 0.0], 1), (2, None, 1)]
    few += [(100, [1.0, 1.0], 1), (150, [2.0, 2.0], 1), (200, [1.0, 1.0], 2), (200, [1.0, 1.0], None)]
    vectors = spark.createDataFrame(few, VECTOR)
    got = near(vectors)
    want = {0: (2, 0), 1: (2, 0), 2: (2, 0), 100: (1, 100), 150: (1, 100), 200: (0, 200)}
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    found = ann.search(vectors, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found if r["query_id"] in (100, 150)) == [
        (100, 1, 150), (100, 2, 200), (100, 3, 200), (150, 1, 100), (150, 2, 200), (150, 3, 200)
    ]


def test_audits_look_at_queries_with_links():
    """One query among many has a link that was missed; the others have none."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(4000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1] = x[0]
    hits = np.ones(4000, int)
    assert not hnsw._audit(x, x[:1], hits[:1], np.ones(1, bool), 0.98)
    hits[7] = 3  # those with most hits are looked at first
    x[[7, 8, 9, 10]] = x[7]
    assert not hnsw._audit(x, x, hits, np.ones(4000, bool), 0.98)
    assert hnsw._audit(x, x, hits, np.zeros(4000, bool), 0.98)
