"""Similarity join on word shingles by parity sketches.

A document's set is that of its different runs of five lower-cased words.  In the sketch of a size band every
shingle XORs its code into one of the band's chunks and flips one of its bits.  One shingle more or less changes
one chunk and one bit, so the chunks (or bits) in which two sketches differ are at most as many as the
shingles in which the sets differ, and sets with a Jaccard similarity of 3/4 differ in at most a third of the
smaller one's size.  By the pigeonhole principle two such documents agree in one of any floor(n / 3) + 1 chunks that
are not empty.  Each document picks the rarest ones, by the counts of a merged sketch over all documents; that is
one order for all, so the picks of two similar documents meet.  Those that no other document has are not sent.

Bands are powers of two; a document at the upper end of its band takes part in the next one too, where its
larger partners are.  Up to 256 shingles a chunk is a shingle of its own.

Equal sets are one class from the start.  Candidates are compared by their bits and then exactly, on
their texts.  All members of a group of keys are first compared with one of them, in a few rounds; members that are then in one
component need no further look.  What is left of a group is compared in squares of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Sketch, blocked
from .common import table, tidied, utf8_buffer, written
from .components import components
from .words import mix, run_hashes, word_hashes

SHINGLE = 5
NUMERATOR, DENOMINATOR = 3, 4
LEAST_CHUNKED = 9  # bands from 2**9 on gather shingles in chunks
SQUARE = 256
ROUNDS = 4
GROUP = ["layout", "first"]
BITS_PER_SHINGLE = 4  # of the upper end of a band
CANDIDATE = "row bigint, layout int, n bigint, keys array<bigint>, bits binary, text string"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted different shingle hashes of each row of a text buffer."""
    words, counts = word_hashes(data, offsets, lower=True)
    hashes, _ = run_hashes(words, counts, SHINGLE)
    ends = np.cumsum(counts)
    runs = np.maximum(counts - SHINGLE + 1, 0)
    run_ends = np.cumsum(runs)
    out = []
    for n, end, run, run_end in zip(counts, ends, runs, run_ends):
        if n >= SHINGLE:
            own = np.sort(hashes[run_end - run : run_end])
            if len(own) > 1:
                own = own[np.r_[True, own[1:] != own[:-1]]]
        elif n:  # fewer words: the whole sequence
            own = run_hashes(words[end - n : end], np.array([n]), int(n))[0] ^ np.uint64(n)
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
    return out


def layouts(n: int) -> list[int]:
    """The bands (exponents of their upper ends) in which a set of ``n`` meets its partners."""
    own = n.bit_length()
    return [own, own + 1] if DENOMINATOR * n >= NUMERATOR << own else [own]


def chunk_keys(own: np.ndarray, layout: int) -> np.ndarray:
    """Keys of the chunks of a set that are not empty."""
    salt = np.uint64(layout * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    if layout < LEAST_CHUNKED:
        return mix(own ^ salt)
    scrambled = mix(own ^ salt)
    chunk = (scrambled >> np.uint64(20)) % np.uint64(1 << layout - 1)
    order = np.argsort(chunk)
    chunk, code = chunk[order], mix(scrambled + np.uint64(1))[order]
    first = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
    return mix(np.bitwise_xor.reduceat(code, first) + mix(chunk[first] ^ salt))


def picked(n: int) -> int:
    """How many chunks of a set of ``n`` must be looked at: one more than a third of it."""
    return n * (DENOMINATOR - NUMERATOR) // NUMERATOR + 1


def parity_bits(own: np.ndarray, layout: int) -> bytes:
    """One bit for each place in the band's sketch, set if an odd number of shingles falls there."""
    size = max(256, BITS_PER_SHINGLE << layout)
    place = (mix(own + np.uint64(layout)) >> np.uint64(13)) % np.uint64(size)
    odd = np.bincount(place.astype(np.int64), minlength=size).astype(np.uint8) & 1
    return np.packbits(odd).tobytes()


def most_apart(a, b):
    """The largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * DENOMINATOR >= NUMERATOR * (len(a) + len(b) - both)


def _sets_of(group: pa.Table) -> list[np.ndarray]:
    return shingle_sets(*utf8_buffer(group["text"]))


def _described(rows: DataFrame) -> DataFrame:
    """row, block, doc_id, n and a 128-bit digest of the set, per document."""

    def run(group: pa.Table) -> pa.Table:
        sets = _sets_of(group)
        total = [np.add.reduce(mix(s), dtype=np.uint64) if len(s) else np.uint64(0) for s in sets]
        parity = [np.bitwise_xor.reduce(mix(s ^ np.uint64(77))) if len(s) else np.uint64(0) for s in sets]
        return pa.table(
            {
                "row": group["row"],
                "block": group["block"],
                "doc_id": group["doc_id"],
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "d1": pa.array(np.array(total, np.uint64).view(np.int64)),
                "d2": pa.array(np.array(parity, np.uint64).view(np.int64)),
            }
        )

    return rows.select("row", "block", "doc_id", "text").groupBy("block").applyInArrow(
        run, "row bigint, block bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint"
    )


def _candidates(rows: DataFrame, chosen: DataFrame, shingles: float) -> DataFrame:
    """For each chosen row and band: the keys it sends, its bits, and (once) its text; only rows that send keys."""
    sketch = Sketch(shingles)
    texts = rows.select("row", "block", "text").groupBy("block")
    asked = chosen.groupBy("block").agg(F.collect_list("row").alias("rows"))  # a block has a bounded number of rows

    def own_keys(group: pa.Table, asked_rows: pa.Table):
        wanted = set(asked_rows["rows"][0].as_py()) if asked_rows.num_rows else set()
        at = [i for i, r in enumerate(group["row"].to_pylist()) if r in wanted]
        sets = _sets_of(group.select(["text"]).take(at)) if at else []
        out = []
        for i, own in zip(at, sets):
            for layout in layouts(len(own)) if len(own) else ():
                keys = chunk_keys(own, layout)
                if len(keys) < picked(len(own)):
                    raise RuntimeError("a set fills too few chunks of its band")
                out.append((i, own, layout, keys))
        return out

    def sketched(group: pa.Table, asked_rows: pa.Table) -> pa.Table:
        keys = [k for *_, k in own_keys(group, asked_rows)]
        block = group["block"][0].as_py() if group.num_rows else 0
        return sketch.messages(block, np.concatenate(keys) if keys else np.zeros(0, np.uint64))

    answers = written(
        sketch.merge(texts.cogroup(asked.groupBy("block")).applyInArrow(sketched, "block bigint, shard int, cells binary")),
        "key-counts",
    )
    # the rows asked for travel with the answers: shard -1
    back = answers.select("block", "shard", "counts", F.lit(None).cast("array<bigint>").alias("rows")).unionByName(
        asked.select("block", F.lit(-1).alias("shard"), F.lit(None).cast("binary").alias("counts"), "rows")
    )

    def sent(group: pa.Table, returned: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        is_rows = pc.equal(returned["shard"], -1)
        found = own_keys(group, returned.filter(is_rows)) if group.num_rows else []
        columns: dict[str, list] = {k: [] for k in ("row", "layout", "n", "keys", "bits", "text")}
        if found:
            level = sketch.levels(np.concatenate([k for *_, k in found]), returned.filter(pc.invert(is_rows)))
            at, given = 0, set()
            for i, own, layout, keys in found:
                here = level[at : at + len(keys)]
                at += len(keys)
                order = np.lexsort((keys, here))[: picked(len(own))]
                keys = keys[order][here[order] > 0]
                if len(keys):
                    values = (group["row"][i].as_py(), layout, len(own), keys.view(np.int64), parity_bits(own, layout))
                    for name, value in zip(columns, values):
                        columns[name].append(value)
                    columns["text"].append(None if i in given else group["text"][i].as_py())
                    given.add(i)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.string()]
        return pa.table({name: pa.array(columns[name], kind) for name, kind in zip(columns, kinds)})

    return written(texts.cogroup(back.groupBy("block")).applyInArrow(sent, CANDIDATE), "candidates")


def _near(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Those of the (a, b, layout) pairs whose bits differ in no more places than linked sets may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for bits_a, bits_b, n_a, n_b in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                apart = (int.from_bytes(bits_a, "big") ^ int.from_bytes(bits_b, "big")).bit_count()
                keep.append(apart <= most_apart(n_a, n_b))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = held.select(F.col("row").alias("a"), "layout", F.col("bits").alias("bits_a"), F.col("n").alias("n_a"))
    two = held.select(F.col("row").alias("b"), "layout", F.col("bits").alias("bits_b"), F.col("n").alias("n_b"))
    both = pairs.join(one, ["a", "layout"]).join(two, ["b", "layout"]).select("a", "b", "bits_a", "bits_b", "n_a", "n_b")
    return both.mapInArrow(tidied(run), "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Those of the (a, b) pairs that are linked, by their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = zip(*(shingle_sets(*utf8_buffer(batch.column(i))) for i in (2, 3)))
                keep = pa.array([linked(a, b) for a, b in sets], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    texts = held.where("text IS NOT NULL")
    one, two = (texts.select(F.col("row").alias(k), F.col("text").alias(f"text_{k}")) for k in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(tidied(run), "a bigint, b bigint")


def _fits(n_a, n_b):
    return (F.least(n_a, n_b) * DENOMINATOR >= F.greatest(n_a, n_b) * NUMERATOR)


def _squares(left: DataFrame, held: DataFrame) -> DataFrame:
    """Near pairs (a, b) of different components among the rows (layout, first, row, n, component) of each group.

    Members outside a group's largest component meet all members.  Both are dealt to parts of about ``SQUARE``, and each
    two parts meet in a square of their own.
    """
    each = left.groupBy(*GROUP, "component").agg(F.count("*").alias("size"))
    of_group = each.groupBy(*GROUP).agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("members"))
    parts = of_group.select(
        *GROUP,
        F.col("top.component").alias("largest"),
        F.ceil((F.col("members") - F.col("top.size")) / SQUARE).cast("int").alias("few"),
        F.ceil(F.col("members") / SQUARE).cast("int").alias("all"),
    )
    dealt = left.join(written(parts, "parts"), GROUP)
    own = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outside = dealt.where(F.col("component") != F.col("largest"))
    sides = outside.select("*", F.lit(0).alias("side"), own("few").alias("i"), every("all").alias("j")).unionByName(
        dealt.select("*", F.lit(1).alias("side"), every("few").alias("i"), own("all").alias("j"))
    )
    bits = held.select("row", "layout", "bits")
    rows = sides.join(bits, ["row", "layout"]).select(*GROUP, "i", "j", "side", "row", "n", "component", "bits")
    rows = rows.repartition(*GROUP, "i", "j").sortWithinPartitions(*GROUP, "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()

        def square(t: list[np.ndarray], bits: list[bytes]) -> Iterator[tuple[int, int]]:
            side, row, n, component = t
            a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1)))
            ok = (component[a] != component[b]) & (
                np.minimum(n[a], n[b]) * DENOMINATOR >= np.maximum(n[a], n[b]) * NUMERATOR
            )
            a, b = a[ok], b[ok]
            if not len(a):
                return
            x = np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1)
            for at in range(0, len(a), 4096):
                p, q = a[at : at + 4096], b[at : at + 4096]
                apart = np.bitwise_count(x[p] ^ x[q]).sum(1, dtype=np.int64)
                for k in np.flatnonzero(apart <= most_apart(n[p], n[q])):
                    yield tuple(sorted((int(row[p[k]]), int(row[q[k]]))))

        def emitted(t: pa.Table) -> pa.RecordBatch:
            keys = np.stack([t[c].to_numpy() for c in (*GROUP, "i", "j")], 1)
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            columns = [t[c].to_numpy() for c in ("side", "row", "n", "component")]
            bits = t["bits"].to_pylist()
            out = set()
            for a, b in zip(first, np.r_[first[1:], len(keys)]):
                if b - a > 1:
                    out.update(p for p in square([c[a:b] for c in columns], bits[a:b]) if p not in known)
            if len(known) > 1_000_000:
                known.clear()
            known.update(out)
            made = sorted(out)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in made], pa.int64()), pa.array([p[1] for p in made], pa.int64())], names=["a", "b"]
            )

        held_back = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if held_back is not None:
                t = pa.concat_tables([held_back, t])
            if not t.num_rows:
                continue
            keys = np.stack([t[c].to_numpy() for c in (*GROUP, "i", "j")], 1)
            last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield emitted(t.slice(0, last))
            held_back = t.slice(last)
        if held_back is not None and held_back.num_rows:
            yield emitted(held_back)

    return rows.mapInArrow(tidied(run), "a bigint, b bigint").distinct()


def _links(held: DataFrame) -> DataFrame:
    """(a, b) rows that connect all components of linked classes.

    Keys that have the same first member are one group, as near copies share many keys; documents that share a key share
    a group.  In each of a few rounds one member of a group meets all members that are in other components: at first
    any, later one of the group's largest component, which is likely to be linked with most of the others.
    """
    keys = held.select("layout", "n", "row", F.explode("keys").alias("key"))
    spans = keys.groupBy("key").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    shared = keys.join(spans.where("first <> last").select("key", "first"), "key").select(*GROUP, "row", "n").distinct()
    left = written(shared.withColumn("component", F.col("row")), "groups")
    edges = None
    for number in range(ROUNDS):
        drawn = F.struct(F.xxhash64("row", F.lit(number)), "row", "n")
        members = left.groupBy(*GROUP, "component").agg(F.count("*").alias("size"), F.min(drawn).alias("one"))
        # written: then the join is one that splits a group with very many members
        top = written(members.groupBy(*GROUP).agg(F.max(F.struct("size", "one", "component")).alias("top")), "pivots")
        meeting = left.join(top, GROUP).where(
            (F.col("component") != F.col("top.component")) & _fits(F.col("n"), F.col("top.one.n"))
        )
        a, b = F.least("top.one.row", "row"), F.greatest("top.one.row", "row")
        star = meeting.groupBy(a.alias("a"), b.alias("b")).agg(F.min("layout").alias("layout"))
        found = written(_verified(_near(star, held), held), "star-links")
        edges = found if edges is None else edges.unionByName(found)
        labels = components(edges).select(F.col("id").alias("row"), F.col("component").alias("now"))
        labelled = left.join(labels, "row", "left").withColumn("component", F.coalesce("now", "component")).drop("now")
        labelled = written(labelled, "labelled-groups")
        mixed = labelled.groupBy(*GROUP).agg(F.min("component").alias("low"), F.max("component").alias("high"))
        mixed = written(mixed.where("low <> high").select(*GROUP), "mixed")
        left = written(labelled.join(mixed, GROUP), "mixed-groups")
        if left.isEmpty():
            return edges
    rest = _verified(_squares(left, held), held)
    return edges.unionByName(written(rest, "square-links"))


def near_duplicates(docs: DataFrame, *carried) -> tuple[DataFrame, DataFrame]:
    """(rows, members) of ``docs`` (doc_id, text).

    ``rows`` is the written table of documents with row, block, doc_id, text and the ``carried`` columns.
    ``members`` has per row: row, block, doc_id, n_shingles, component (the smallest row reachable by links),
    component_id (the smallest doc_id reachable) and kept (for one row of each component: that with the smallest
    doc_id, the first of these).  Null, empty and blank texts have no shingles and link with nothing.  Repeated rows
    and equal texts are linked as other documents are; a null doc_id is never the smallest unless there is no other.
    """
    rows, _ = blocked(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    described = written(_described(rows), "sets")
    digest = ["n", "d1", "d2"]
    first = described.where("n > 0").groupBy(*digest).agg(F.min(F.struct("row", "block")).alias("first"))
    classes = written(first.select(*digest, "first.row", "first.block"), "classes")
    shingles = float(described.agg(F.sum("n")).head()[0] or 0)
    held = _candidates(rows, classes.select("row", "block"), shingles)
    united = components(_links(held))
    labels = united.select(F.col("id").alias("row"), "component")
    labelled = classes.join(labels, "row", "left").select(*digest, F.coalesce("component", "row").alias("class"))
    joined = described.join(labelled, digest, "left").withColumn("component", F.coalesce("class", "row")).drop("class")
    joined = written(joined, "labelled")
    least = joined.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"))
    least = least.select(F.col("component").alias("c"), "least.doc_id", "least.row").toDF("c", "component_id", "kept_row")
    least = written(least, "least")  # so that the join with it splits a component with very many documents
    members = joined.join(least, F.col("component") == F.col("c")).select(
        "row", "block", "doc_id", F.col("n").alias("n_shingles"), "component", "component_id",
        (F.col("row") == F.col("kept_row")).alias("kept"),
    )
    return rows, members


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates."""
    names = docs.columns
    rows, members = near_duplicates(docs, F.struct(*(c for c in names if c != "text")).alias("doc"))
    stays = members.where("kept").groupBy("block").agg(F.collect_list("row").alias("rows"))

    def run(group: pa.Table, kept: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        wanted = kept["rows"][0].values if kept.num_rows else pa.array([], pa.int64())
        return group.filter(pc.is_in(group["row"], wanted)).select(["text", "doc"])

    own = rows.select("row", "block", "text", "doc")
    out = own.groupBy("block").cogroup(stays.groupBy("block")).applyInArrow(run, own.select("text", "doc").schema)
    return out.select(*(F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in names))


def op9_ngram_join(spark, sf_dir):
    """Every document with the size of its set and the smallest id that links lead to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, members = near_duplicates(docs)
    return members.select("doc_id", "n_shingles", "component_id")
