"""Each stage beside a brute-force version on its own input; the whole as its stages."""

import hashlib
from collections import Counter, defaultdict

import brute
import pytest
import sentencepiece
from public_tokenizers import path

import corpus_pipeline
from subjectlog.llm.common import table, written
from subjectlog.llm.mixing import hash_key
from subjectlog.llm.quality import quality_network
from subjectlog.llm.secrets import findings_in, trained_scanner


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(name, input, output) of each stage."""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_order_and_columns(stages, spark, sf_dir):
    assert list(stages) == ["quality", "ngram_join", "secrets", "mixing", "sentencepiece"]
    names = table(spark, sf_dir, "documents").columns
    assert all(after.columns == names for _, after in list(stages.values())[:-1])


def test_quality(stages, spark, sf_dir):
    before, after = stages["quality"]
    network = quality_network(spark, before, sf_dir)
    want = Counter(tuple(r) for r in before.collect() if brute.network_score(network, (r["text"] or "").encode()) >= 0.5)
    assert rows(after) == want


def test_near_duplicates(stages):
    before, after = stages["ngram_join"]
    held = sorted(before.collect(), key=lambda r: r["doc_id"])
    found = brute.near_documents([r["text"] for r in held])
    assert rows(after) == Counter(tuple(held[i]) for i, (_, root) in found.items() if i == root)


def test_secrets(stages):
    before, after = stages["secrets"]
    language, forest = trained_scanner(before)
    want = Counter()
    for r in before.collect():
        text = r["text"]
        for a, b, _, score in reversed(findings_in(text, r["source"], language, forest)):
            text = text[:a] + "[SECRET]" + text[b:] if score >= 0.5 else text
        want[(r["doc_id"], text, r["lang"], r["source"], len(text))] += 1
    assert rows(after) == want


def test_mixing(stages):
    before, after = stages["mixing"]
    held = before.withColumn("key", hash_key(before["doc_id"], before["text"])).collect()
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"] or "")) for r in held}
    sizes, by_source = defaultdict(int), defaultdict(list)
    for r in held:
        sizes[r["source"]] += size[r["doc_id"]]
        by_source[r["source"]].append((r["key"], r["doc_id"]))
    want = Counter()
    for source, target in brute.targets(sizes).items():
        full = int(target // sizes[source] + 1e-9)
        left = target - full * sizes[source]
        for _, doc in sorted(by_source[source]):  # by key, as long as that comes nearer to the target
            if 2 * left > size[doc] and left > 0:
                want[doc] += 1
            left = left - size[doc] if 2 * left > size[doc] else -1
        for _, doc in by_source[source]:
            want[doc] += full
    assert Counter(r["doc_id"] for r in after.collect()) == +want


def test_encoding(stages):
    before, after = stages["sentencepiece"]
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    want = Counter()
    for r in before.collect():
        ids = library.encode(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        want[(r["doc_id"], len(ids), tuple(ids), digest, decoded)] += 1
    got = Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in after.collect())
    assert got == want


def test_run(stages, spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids_sha256")
    assert rows(got) == rows(stages["sentencepiece"][1].select("doc_id", "ids_sha256"))


def test_stages_with_odd_rows(spark, sf_dir, edge, clashing, empty):
    for docs in (edge, clashing, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, sf_dir), f"odd-{name}")
            assert name == "sentencepiece" or out.columns == docs.columns
            docs = out
