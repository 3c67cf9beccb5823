"""What workers keep, the number of buckets, and the splits of the forest."""

import numpy as np

from subjectlog.llm import blocks, secrets, words
from subjectlog.llm.common import tidied


def test_no_leaf_of_the_forest_is_nan():
    """Neighbouring numbers whose midpoint is the upper one leave no side empty."""
    low = np.float64(0.1)
    values = [low, np.nextafter(low, 1)]
    x = np.array([[values[k % 2]] * 4 for k in range(200)])
    forest = secrets.Forest().fit(x, np.arange(200) % 2)
    assert all(np.isfinite(t).all() for t in forest.trees)
    with np.errstate(all="raise"):
        assert np.isfinite(forest.predict(x)).all()


def test_buckets_are_bounded(spark, monkeypatch):
    """More blocks than buckets: they share, and every row is there once."""
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 8)
    monkeypatch.setattr(blocks, "MOST_BUCKETS", 3)
    docs = spark.range(200).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    got, _ = blocks.blocked(docs, "doc_id", "text")
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(200))
    assert got.select("block").distinct().count() > 3


def test_pieces_of_any_size_hash_alike(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(20_000)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    hashes, counts = words.word_hashes(data, offsets)
    runs, _ = words.run_hashes(hashes, counts, 5)
    monkeypatch.setattr(words, "PIECE", 1 << 10)
    again, _ = words.word_hashes(data, offsets)
    assert (again == hashes).all() and (words.run_hashes(again, counts, 5)[0] == runs).all()


def test_batches_come_through():
    assert list(tidied(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
