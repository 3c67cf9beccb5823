from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from subjectlog.llm import mixing


def mixed(docs, **how):
    return [r.asDict() for r in mixing.mix(mixing.sized(docs), **how).collect()]


def test_targets_and_shares(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 5}" if i % 11 else None) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixed(docs)
    sizes = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
    want, taken = brute.targets(sizes), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 7
    assert sorted(map(str, got)) == sorted(map(str, mixed(docs)))  # reruns agree


def test_smaller_mix_is_part_of_larger(spark):
    rows = [(i, "a b c", f"s{i % 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    less, more = ({r["doc_id"]: r["copies"] for r in mixed(docs, share=s)} for s in (0.4, 0.8))
    assert all(less[i] <= more[i] for i in less) and sum(less.values()) < sum(more.values())


def test_edges(edge, clashing, empty):
    got = mixed(edge)
    assert len(got) == 20 and all(r["size"] == len(brute.WORD.findall(r["text"] or "")) for r in got)
    twice = [r["taken"] for r in got if r["doc_id"] == 12]
    assert len(set(twice)) == 1  # repeated rows have one key
    assert len(mixed(clashing.drop("size", "key"))) == 20
    assert mixed(empty) == [] and mixing.mixed_documents(empty).count() == 0
    out = mixing.mixed_documents(clashing)
    assert out.columns == clashing.columns
    copies = {(r["doc_id"], r["text"]): r["copies"] for r in got}
    counted = out.groupBy("doc_id", "text").count().collect()
    repeated = {(12, next(r["text"] for r in got if r["doc_id"] == 12)): 2}
    assert {(r["doc_id"], r["text"]): r["count"] for r in counted} == {
        k: c * repeated.get(k, 1) for k, c in copies.items() if c
    }


def test_all_in_one_source_and_no_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string").withColumn("source", F.lit("x"))
    assert sum(r["taken"] for r in mixed(docs)) in (2, 4)
    nothing = spark.createDataFrame([(1, None, None), (2, "", "y")], "doc_id bigint, text string, source string")
    assert [r["taken"] for r in mixed(nothing)] == [0, 0]
