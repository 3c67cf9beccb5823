import random
from collections import Counter

import brute
import numpy as np
from fixtures import prose
from pyspark.sql import functions as F

from subjectlog.llm import blocks, ngram_join, substring
from subjectlog.llm.components import components


def check_repeats(docs, window):
    rows = docs.select("doc_id", "text").collect()
    want = brute.without_repeats([r["text"] for r in rows], window)
    got = substring.remove_repeats(docs, window).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == Counter(
        (r["doc_id"], *w) for r, w in zip(rows, want)
    )
    return got


def test_repeats(spark, edge, clashing, empty):
    got = check_repeats(edge, 35)
    assert any(0 < r["n_removed"] < r["n_words"] for r in got)
    check_repeats(edge, 3)
    check_repeats(clashing, 35)
    assert substring.remove_repeats(empty).collect() == []


def test_shared_passages(spark):
    passage, rows = prose(7, 80), []
    for i in range(60):
        own = prose(100 + i, 50 + i, 5000)
        rows.append((i, f"{own}\n{passage if i % 3 else ''} {prose(300 + i, 20, 5000)}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = check_repeats(docs, 35)
    assert sum(r["n_removed"] == 80 for r in got) == 40


def test_blocks_are_bounded_by_bytes(spark):
    """Many long texts among short ones: no block holds more than it may, but for a text that is longer by itself."""
    short = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 900).cast("int")).alias("text"))
    long = spark.range(60).select((F.col("id") + 6000).alias("doc_id"), F.repeat(F.lit("text "), (F.col("id") * 8_000).cast("int")).alias("text"))
    huge = spark.range(2).select((F.col("id") + 7000).alias("doc_id"), F.repeat(F.lit("x"), (1 << 24) + 5).alias("text"))
    none = spark.createDataFrame([(8000, None)], "doc_id bigint, text string")
    docs = short.union(long).union(huge).union(none).coalesce(2)
    rows, size = blocks.blocked(docs, "doc_id", "text")
    each = rows.groupBy("block").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"))
    each = each.collect()
    assert sum(r["n"] for r in each) == rows.select("row").distinct().count() == 6063
    assert sum(r["size"] for r in each) == size
    assert all(r["n"] <= blocks.ROWS_PER_BLOCK for r in each)
    assert all(r["size"] <= blocks.BYTES_PER_BLOCK or r["n"] == 1 for r in each)


def test_long_texts_in_small_blocks(spark, edge, monkeypatch):
    """Texts of one partition in blocks of all classes of size, copies in blocks of their own."""
    monkeypatch.setattr(blocks, "BYTES_PER_BLOCK", 1 << 13)
    check_repeats(edge.coalesce(1), 35)
    check_near(edge.coalesce(1))
    long = prose(21, 3000, 50_000)
    texts = [long, *(prose(30 + k, 40 + 90 * k, 50_000) for k in range(20)), f"{prose(60, 12)} {long}", long.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    assert sum(r["n_removed"] == 3000 for r in check_repeats(docs, 35)) == 2
    check_near(docs)


def test_two_hashes_of_words_differ():
    """The second hash of a word is not made of the first one."""
    from subjectlog.llm.words import run_hashes, word_hashes

    data = np.frombuffer(b"a bc def a bc xyz", np.uint8)
    first, counts = word_hashes(data, np.array([0, 8, 17]))
    second, again = word_hashes(data, np.array([0, 8, 17]), salt=1)
    assert counts.tolist() == again.tolist() == [3, 3] and not set(first) & set(second)
    for words, salt in ((first, 0), (second, 1)):
        assert words[:2].tolist() == words[3:5].tolist() and len(set(words)) == 4
        runs, places = run_hashes(words, counts, 2, salt)
        assert places.tolist() == [0, 1, 3, 4] and runs[0] == runs[2] and runs[1] != runs[3]


def check_near(docs):
    rows = docs.select("doc_id", "text").collect()
    found = brute.near_documents([r["text"] for r in rows])
    least = {}
    for i, (_, root) in found.items():
        if rows[i]["doc_id"] is not None:
            least[root] = min(least.get(root, 1 << 60), rows[i]["doc_id"])
    want = Counter((rows[i]["doc_id"], n, least.get(root)) for i, (n, root) in found.items())
    _, members = ngram_join.near_duplicates(docs)
    members = members.collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members) == want
    assert sum(r["kept"] for r in members) == len({root for _, root in found.values()})


def test_near_documents(spark, edge, clashing, empty):
    check_near(edge)
    check_near(clashing)
    assert ngram_join.near_duplicates(empty)[1].collect() == []
    one = ngram_join.one_of_each(clashing)
    groups = {root for _, root in brute.near_documents([r["text"] for r in clashing.collect()]).values()}
    assert one.columns == clashing.columns and one.count() == len(groups) == 13
    assert ngram_join.one_of_each(empty).collect() == []


def test_graded_similarity(spark, monkeypatch):
    """Around the threshold, over sizes on both sides of a band's end, with a hot passage; squares are needed."""
    monkeypatch.setattr(ngram_join, "SQUARE", 8)
    draw, rows = random.Random(5), []
    hot = prose(9, 40).split()
    for size in (6, 20, 60, 120, 250, 700):
        for family in range(3):
            base = prose((size, family).__hash__(), size, 3000).split()
            for k in range(12):
                words = list(base)
                for _ in range(draw.randint(0, max(1, size // 25))):
                    words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
                cut = draw.randint(0, max(1, size // 4))
                words = words[cut:] if k % 2 else words[: len(words) - cut]
                rows.append(words + hot if family == 2 else words)
    for k in range(40):  # mostly the hot passage: alike in part, not linked
        rows.append(hot + prose(1000 + k, 16, 9000).split())
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id bigint, text string")
    check_near(docs.repartition(4))


def test_chunks_and_bits_bound_the_difference():
    draw = np.random.default_rng(3)
    for n in (5, 90, 300, 600, 1500, 5000):
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: -max(1, n // 9)], draw.integers(0, 1 << 63, n // 15, dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        for layout in set(ngram_join.layouts(len(a))) & set(ngram_join.layouts(len(b))):
            x, y = ngram_join.chunk_keys(a, layout), ngram_join.chunk_keys(b, layout)
            assert len(x) - len(np.intersect1d(x, y)) <= apart and len(x) >= ngram_join.picked(len(a))
            p, q = (int.from_bytes(ngram_join.parity_bits(s, layout), "big") for s in (a, b))
            assert (p ^ q).bit_count() <= apart


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    want = brute.components(set(range(41)) | {100, 90, 95}, [e for e in chain if e[0] != e[1]])
    assert {r["id"]: r["component"] for r in got} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
