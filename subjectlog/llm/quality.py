"""Quality classifier: a convolutional network over bytes, in numpy.

Each byte has a learned vector of ``DIMS`` numbers.  Learned filters look at windows of ``WIDTH`` bytes, one
every ``STRIDE`` bytes.  A document is covered by chunks of ``CHUNK`` windows; neighbouring chunks share
``WIDTH - STRIDE`` bytes, so no window is lost between them.  Each filter is max-pooled in each chunk; the mean and the
maximum over all chunks of the document are combined into one probability.  The whole text counts.

The network is trained on the driver on a bounded sample (``SAMPLE`` labelled documents, ``SAMPLE_CHUNKS``
evenly spaced chunks of each), cut out on the executors.  Scoring runs in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, slices, small_batches, table, threshold_sample, tidied, utf8_buffer

STRIDE, BLOCKS = 4, 3
WIDTH = STRIDE * BLOCKS
DIMS, FILTERS = 8, 32
CHUNK = 128
CHUNK_BYTES = CHUNK * STRIDE + WIDTH - STRIDE
PIECE_CHUNKS = 1024  # chunks that scoring holds at a time
SAMPLE, SAMPLE_CHUNKS, EPOCHS, BATCH = 3000, 24, 6, 64
LEAST_STEPS = 300  # a small training set is gone through more often


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "bytes": rng.normal(0, 0.5, (256, DIMS)).astype(np.float32),
            "filters": rng.normal(0, 0.15, (BLOCKS, STRIDE * DIMS, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "head": np.zeros(2 * FILTERS, np.float32),
            "offset": np.zeros(1, np.float32),
        }

    def windows(self, blocks: np.ndarray) -> np.ndarray:
        """(…, n, STRIDE) bytes -> (…, n - BLOCKS + 1, FILTERS) filter values; filters are split by block, so no
        window is copied."""
        n = blocks.shape[-2]
        x = self.p["bytes"][blocks].reshape(*blocks.shape[:-1], STRIDE * DIMS)
        out = x[..., : n - BLOCKS + 1, :] @ self.p["filters"][0]
        for k in range(1, BLOCKS):
            out += x[..., k : n - BLOCKS + 1 + k, :] @ self.p["filters"][k]
        return out

    def probability(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        z = np.concatenate([mean, most], axis=-1) @ self.p["head"] + self.p["offset"][0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Probability of each text (its bytes).  Many short texts share one pass; a long one is taken in
        pieces of ``PIECE_CHUNKS`` chunks."""
        total = np.zeros((len(texts), FILTERS), np.float64)
        most = np.zeros((len(texts), FILTERS), np.float32)
        count = np.zeros(len(texts), np.int64)
        held: list[tuple[int, np.ndarray, int]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if not held:
                return
            blocks, starts, owner, at = [], [], [], 0
            for i, data, n in held:
                room = np.zeros((n + BLOCKS - 1, STRIDE), np.uint8)
                room.reshape(-1)[: len(data)] = data[: room.size]
                blocks.append(room)
                starts += range(at, at + n, CHUNK)
                owner += [i] * -(-n // CHUNK)
                starts.append(at + n)  # windows that reach into the next text
                owner.append(-1)
                at += n + BLOCKS - 1
            values = self.windows(np.concatenate(blocks + [np.zeros((BLOCKS - 1, STRIDE), np.uint8)]))
            pooled = np.maximum(np.maximum.reduceat(values, starts, axis=0) + self.p["bias"], 0)
            own = np.array(owner)
            pooled, own = pooled[own >= 0], own[own >= 0]
            np.add.at(total, own, pooled)
            np.maximum.at(most, own, pooled)
            np.add.at(count, own, 1)
            held.clear()
            size = 0

        for i, data in enumerate(texts):
            step = PIECE_CHUNKS * CHUNK * STRIDE
            for at in range(0, max(len(data), 1), step):
                # the end of a piece is followed by what its last windows reach into
                piece = data[at : at + step + WIDTH - STRIDE]
                n = max(1, -(-min(len(data) - at, step) // STRIDE))
                held.append((i, piece, n))
                size += n
                if size >= PIECE_CHUNKS * CHUNK:
                    flush()
        flush()
        return self.probability((total / count[:, None]).astype(np.float32), most)

    def fit(self, chunks: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> None:
        """``chunks``: for each document (chunks, CHUNK_BYTES + 1), the last column saying how many windows
        start inside the text."""
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(chunks)))
        for epoch in range(epochs):
            order = rng.permutation(len(chunks))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                grads = self.gradients([chunks[i] for i in batch], labels[batch])
                step += 1
                rate = 0.01 * (1 - 0.8 * epoch / epochs)
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def gradients(self, docs: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        rows = np.concatenate(docs)
        counts = np.array([len(d) for d in docs])
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        owner = np.repeat(np.arange(len(docs)), counts)
        data = rows[:, :CHUNK_BYTES].astype(np.uint8)
        values = self.windows(data.reshape(len(data), -1, STRIDE))
        values[np.arange(CHUNK)[None, :] >= rows[:, CHUNK_BYTES][:, None]] = -np.inf
        where = values.argmax(1)  # (chunks, filters)
        pooled = np.maximum(np.take_along_axis(values, where[:, None, :], 1)[:, 0] + p["bias"], 0)
        mean = np.add.reduceat(pooled, first, axis=0) / counts[:, None]
        most = np.maximum.reduceat(pooled, first, axis=0)
        d = ((self.probability(mean, most) - labels) / len(docs)).astype(np.float32)
        out = {"head": np.concatenate([mean, most], 1).T @ d + 1e-4 * p["head"], "offset": d.sum(keepdims=True)}
        back = (d[:, None] * p["head"][None, :FILTERS] / counts[:, None])[owner]
        is_most = pooled == most[owner]
        back = back + np.where(is_most, (d[:, None] * p["head"][None, FILTERS:])[owner], 0)
        back = np.where(pooled > 0, back, 0).astype(np.float32)  # (chunks, filters)
        out["bias"] = back.sum(0)
        seen = data[np.arange(len(data))[:, None, None], where[:, :, None] * STRIDE + np.arange(WIDTH)]
        x = p["bytes"][seen].reshape(len(data), FILTERS, WIDTH * DIMS)
        out["filters"] = np.einsum("cf,cfw->wf", back, x).reshape(p["filters"].shape)
        flat = p["filters"].reshape(WIDTH, DIMS, FILTERS)
        to_bytes = back[:, :, None, None] * flat.transpose(2, 0, 1)[None]
        g = np.zeros_like(p["bytes"])
        hit = np.flatnonzero(back.any(1))
        for k in range(DIMS):
            g[:, k] = np.bincount(seen[hit].reshape(-1), to_bytes[hit][..., k].reshape(-1), 256)
        out["bytes"] = g
        return {k: np.asarray(v, np.float32) for k, v in out.items()}


def spaced_chunks(data: np.ndarray, most: int = SAMPLE_CHUNKS) -> np.ndarray:
    """At most ``most`` evenly spaced chunks of a text, each with the number of its windows."""
    n = max(1, -(-len(data) // STRIDE))
    chunks = -(-n // CHUNK)
    chosen = np.unique(np.linspace(0, chunks - 1, min(most, chunks)).astype(int))
    out = np.zeros((len(chosen), CHUNK_BYTES + 1), np.int16)
    for row, c in zip(out, chosen):
        part = data[c * CHUNK * STRIDE : c * CHUNK * STRIDE + CHUNK_BYTES]
        row[: len(part)] = part
        row[CHUNK_BYTES] = min(CHUNK, n - c * CHUNK)
    return out


def fit(documents: DataFrame, labelled: DataFrame, bound: int = SAMPLE) -> Network:
    """A network for ``labelled`` (doc_id, label 0 or 1) and their texts in ``documents`` (doc_id, text).

    Rows with a null id or label, or with an id of both labels, are not learned from.  Of repeated rows of an id one
    is.  Without any labelled text the network gives 0.5 to all.
    """
    clear = labelled.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")
    )
    clear = clear.where(F.col("label") == F.col("other")).select("doc_id", "label")
    wanted = F.broadcast(threshold_sample(clear, bound, F.col("doc_id")))  # about ``bound`` small rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = utf8_buffer(batch.column(2))
            rows = [spaced_chunks(data[a:b]).astype("<i2").tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["doc_id", "label", "chunks"]
            )

    texts = documents.select("doc_id", "text").join(wanted, "doc_id").select("doc_id", "label", "text")
    kinds = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label {texts.schema['label'].dataType.simpleString()}"
    # one text an id, however often it is there: the driver gets ``bound`` rows of a bounded size
    one = texts.mapInArrow(tidied(cut), f"{kinds}, chunks binary").groupBy("doc_id", "label").agg(F.min("chunks").alias("chunks"))
    rows = sorted(one.collect())
    network = Network()
    if rows:
        chunks = [np.frombuffer(r.chunks, "<i2").reshape(-1, CHUNK_BYTES + 1) for r in rows]
        network.fit(chunks, np.array([r.label for r in rows], np.float32))
    return network


def score(docs: DataFrame, network: Network, text_column: str = "text", as_column: str = "score") -> DataFrame:
    """``docs`` with the network's probability.  A null text is an empty one, which is scored, too; a column of
    the same name is replaced; rows are independent of each other."""
    names = [c for c in docs.columns if c.lower() != as_column.lower()]
    small_batches(docs.sparkSession)
    place = names.index(text_column)
    sent = docs.sparkSession.sparkContext.broadcast(network.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network()
        own.p = sent.value
        for batch in slices(batches):
            data, offsets = utf8_buffer(batch.column(place))
            scores = own.score([data[a:b] for a, b in zip(offsets, offsets[1:])])
            kept = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=[*names, as_column])

    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(tidied(run), f"{kinds}, `{as_column}` double")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 3) == 1


def quality_network(spark, docs: DataFrame, sf_dir: str) -> Network:
    """Trained on ``labels.quality`` of the documents that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return fit(docs, labels.where(~held_out(F.col("doc_id"))))


def op6_quality(spark, sf_dir):
    """Every document with its probability of good quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, quality_network(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
