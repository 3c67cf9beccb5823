"""Language identification by nearest centroid.

A text is a vector: hashed counts of its letter n-grams (one to three letters, words padded by a space), dampened,
weighted by inverse document frequency and normalised.  Each language has several centroids, found by
clustering its training vectors; the nearest centroid by cosine names the language.  A text farther from its
centroid than nearly all that the centroid was made of is marked as rejected.

Training takes at most about ``PER_LANGUAGE`` documents of a language, chosen by hash.  Their counts, of fixed size
whatever the length of the text, are written once; each language's centroids are made by a task of its own.  The driver
gets how many documents have an n-gram, and the model: ``CENTROIDS`` rows of ``BUCKETS`` numbers a language.
Classifying needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, slices, small_batches, table, worker_cache, written

BUCKETS = 1 << 12
PER_LANGUAGE = 800
CENTROIDS = 4
ROUNDS = 12
FARTHEST = 0.01  # share of a centroid's own texts that rejection would drop
UNKNOWN = "und"
PIECE = 1 << 18


def _letters():
    import regex

    return worker_cache("letters", lambda: regex.compile(r"\p{L}+"))


def counts(text: str | None) -> np.ndarray | None:
    """n-gram counts of a whole text; None without a letter.  Long texts are taken in pieces of words."""
    if not text:
        return None
    total = None
    find = _letters()
    held: list[str] = []
    size = 0

    def add() -> None:
        nonlocal total
        x = np.frombuffer((" " + " ".join(held) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        grams = [x * a, (x[:-1] * b + x[1:]) * a, ((x[:-2] * b + x[1:-1]) * b + x[2:]) * a]
        hashed = np.concatenate([(g ^ (g >> np.uint64(29))) * b >> np.uint64(52) for g in grams])
        here = np.bincount(hashed.astype(np.int64), minlength=BUCKETS)
        total = here if total is None else total + here

    for match in find.finditer(text):
        word = match.group().lower()
        held.append(word)
        size += len(word) + 1
        if size >= PIECE:
            add()
            held, size = [], 0
    if held:
        add()
    return total


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # (centroids, BUCKETS), normalised
    idf: np.ndarray
    radius: np.ndarray  # least cosine that is not rejected

    def vectors(self, rows: list[np.ndarray]) -> np.ndarray:
        x = np.log1p(np.array(rows, np.float32)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names = [UNKNOWN] * len(texts)
        score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        found = [(i, c) for i, t in enumerate(texts) if (c := counts(t)) is not None]
        if found and self.languages:
            cosines = self.vectors([c for _, c in found]) @ self.centroids.T
            best = cosines.argmax(1)
            for (i, _), k, row in zip(found, best, cosines):
                names[i] = self.languages[k]
                score[i] = min(1.0, max(0.0, float(row[k])))
                rejected[i] = row[k] < self.radius[k]
        return names, score, rejected


def clustered(x: np.ndarray, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, nearest of each row) by cosine."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    while len(centres) < min(k, len(x)):  # the row farthest from those chosen
        centres.append(x[(x @ np.array(centres).T).max(1).argmin()])
    c = np.array(centres)
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (near == j).any():
                mean = x[near == j].mean(0)
                c[j] = mean / max(float(np.linalg.norm(mean)), 1e-9)
    return c, (x @ c.T).argmax(1)


def idf_of(documents: int, having: np.ndarray) -> np.ndarray:
    """Inverse document frequency, from how many of the documents have each n-gram."""
    return (np.log((1 + documents) / (1 + having)) + 1).astype(np.float32)


def centroids_of(rows: list[np.ndarray], idf: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """(centroid, least cosine that is not rejected) of one language's counts."""
    own = Model([], np.zeros((0, BUCKETS), np.float32), idf, np.zeros(0)).vectors(rows)
    c, near = clustered(own, CENTROIDS)
    return [(c[j], float(np.quantile(own[near == j] @ c[j], FARTHEST))) for j in range(len(c)) if (near == j).any()]


def model_of(idf: np.ndarray, made: list[tuple[str, np.ndarray, float]]) -> Model:
    centroids = np.array([c for _, c, _ in made], np.float32).reshape(-1, BUCKETS)
    return Model([n for n, _, _ in made], centroids, idf, np.array([r for *_, r in made]))


def train(rows: list[tuple[str, np.ndarray]]) -> Model:
    """A model of a few (language, counts) rows; without rows it knows no language."""
    idf = idf_of(len(rows), sum((c > 0 for _, c in rows), np.zeros(BUCKETS, np.int64)))
    made = []
    for name in sorted({n for n, _ in rows}):
        made += [(name, c, r) for c, r in centroids_of([c for n, c in rows if n == name], idf)]
    return model_of(idf, made)


def pack(row: np.ndarray) -> bytes:
    return np.concatenate([np.flatnonzero(row), row[row > 0]]).astype("<u4").tobytes()


def unpack(data: bytes) -> np.ndarray:
    where, how_many = np.frombuffer(data, "<u4").reshape(2, -1)
    row = np.zeros(BUCKETS, np.float32)
    row[where] = how_many
    return row


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Train on ``labelled`` (doc_id, text, lang); rows without a language or a letter are not learned from.

    Of repeated rows of an id in a language, and of those without an id, one is learned from.  Without rows the model
    knows no language.
    """
    rows = labelled.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    share = {r["lang"]: min(1.0, per_language / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return train([])
    shares = F.broadcast(rows.sparkSession.createDataFrame(sorted(share.items()), "lang string, share double"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("lang|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10)
    chosen = rows.join(shares, "lang").where(draw.cast("double") < F.col("share") * float(2**48))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = (batch.column(i).to_pylist() for i in range(3))
            out = [(n, i, pack(c)) for n, i, t in zip(*columns) if (c := counts(t)) is not None]
            kinds = [pa.string(), batch.schema.field(1).type, pa.binary()]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["lang", "doc_id", "counts"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = chosen.select("lang", "doc_id", "text").mapInArrow(count, f"lang string, doc_id {id_type}, counts binary")
    one = written(counted.groupBy("lang", "doc_id").agg(F.min("counts").alias("counts")), "language-counts")

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                where, _ = np.frombuffer(data, "<u4").reshape(2, -1)
                total[where] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    total = np.zeros(BUCKETS, np.int64)
    sums = one.select("counts").mapInArrow(having, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in sums.collect():
        total[bucket] = n
    idf = idf_of(one.count(), total)

    def centroids(group: pa.Table) -> pa.Table:
        made = centroids_of([unpack(data) for data in sorted(group["counts"].to_pylist())], idf)
        columns = {"lang": [group["lang"][0].as_py()] * len(made), "place": list(range(len(made)))}
        columns |= {"centroid": [c.astype("<f4").tobytes() for c, _ in made], "radius": [r for _, r in made]}
        kinds = {"lang": pa.string(), "place": pa.int32(), "centroid": pa.binary(), "radius": pa.float64()}
        return pa.table({name: pa.array(columns[name], kind) for name, kind in kinds.items()})

    made = one.groupBy("lang").applyInArrow(centroids, "lang string, place int, centroid binary, radius double").collect()
    made.sort(key=lambda r: (r["lang"], r["place"]))
    return model_of(idf, [(r["lang"], np.frombuffer(r["centroid"], "<f4"), r["radius"]) for r in made])


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; columns of these names are
    replaced; without training rows every text is ``und``.
    """
    made = ("lang_pred", "score", "rejected")
    names = [c for c in docs.columns if c.lower() not in made]
    small_batches(docs.sparkSession)
    place = names.index(text_column)
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.centroids, model.idf, model.radius))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in slices(batches, 256):
            lang, score, rejected = own.classify(batch.column(place).to_pylist())
            arrays = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), *arrays], names=[*names, *made])

    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")


def op3_language(spark, sf_dir):
    """Every document with the language its whole text is nearest to."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )
