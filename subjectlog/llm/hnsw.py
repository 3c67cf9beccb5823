"""Near duplicates of vectors by navigable small-world graphs.

Vectors of one label are dealt to shards.  A shard's vectors are linked into a hierarchy of graphs: level 0
holds all, each level above about one in ``DEGREE`` of the one below; every node keeps near neighbours that
are not near each other.  A search descends by the upper levels and then walks level 0 with a beam of the best
nodes seen.  Here a batch of queries walks at once, as numpy arrays.

The vectors of shard j are searched in the graph of every shard i <= j, so that each pair of shards meets once.
A query whose beam holds links only is searched again with a beam four times as wide.  Each search is audited: for
some of the queries it answers, those with links first, all links are found by an exact scan, and beams are widened until
every audited link was found.  Where a beam would be a quarter of the graph, which holds for every shard of up to 192
vectors, the rest is scanned: a beam so wide looks at all of them anyway, and may still miss some.  Cosines are verified in double precision.  What leaves a task is a count of links
per vector and a forest, not pairs; components of the forests are united over tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .components import components
from .vectors import lengths, matrix, unit, usable

SHARD = 8192
DEGREE = 16
BUILD_BEAM = 48
BEAM = 48
STEP = 4  # nodes of the beam that are expanded at a time
QUERIES = 1024
AUDITED = 64
SLACK = 1e-5


class Graph:
    """Levels of adjacency (nodes, degree), -1 where there is no neighbour."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        rng = np.random.default_rng(seed)
        height = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(DEGREE)).astype(int), 6)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (members, adjacency in places of members)
        for level in range(int(height.max()) + 1 if n else 0):
            members = np.flatnonzero(height >= level)
            members = members[rng.permutation(len(members))]
            self.levels.append((members, self._linked(self.x[members], 2 * DEGREE if level == 0 else DEGREE)))

    def _linked(self, x: np.ndarray, degree: int) -> np.ndarray:
        """Insert nodes in growing batches: each searches the graph so far, picks neighbours, and is linked back."""
        n = len(x)
        near = np.full((n, degree), -1, np.int32)
        done = 0
        while done < n:
            batch = np.arange(done, min(n, done + max(64, min(done, QUERIES))))
            among = x[batch] @ x[batch].T
            np.fill_diagonal(among, -2)
            few = min(BUILD_BEAM, len(batch))
            own = np.argpartition(-among, few - 1, axis=1)[:, :few] if few else np.zeros((len(batch), 0), int)
            candidates, sims = batch[own], np.take_along_axis(among, own, 1)
            candidates = np.where(sims > -2, candidates, -1)
            if done:
                found, found_sims = walk(x, near[:done], x[batch], BUILD_BEAM, np.zeros(len(batch), np.int64))
                candidates = np.concatenate([candidates, found], 1)
                sims = np.concatenate([sims, found_sims], 1)
            chosen = spread(x, candidates, sims, degree // 2)
            near[batch, : chosen.shape[1]] = chosen
            self._link_back(x, near, batch, chosen, degree)
            done = batch[-1] + 1
        return near

    @staticmethod
    def _link_back(x: np.ndarray, near: np.ndarray, batch: np.ndarray, chosen: np.ndarray, degree: int) -> None:
        source = np.repeat(batch, chosen.shape[1])
        target = chosen.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        if not len(nodes):
            return
        # a node that very many point at looks at the nearest of them
        sims = np.einsum("ij,ij->i", x[source], x[target])
        order = np.lexsort((-sims, target))
        source = source[order]
        most = min(int(count.max()), 2 * degree)
        place = np.arange(most)[None, :]
        incoming = np.where(place < count[:, None], source[np.minimum(first[:, None] + place, len(source) - 1)], -1)
        candidates = np.concatenate([near[nodes], incoming], 1)
        sims = np.einsum("nkd,nd->nk", x[candidates], x[nodes])
        near[nodes] = spread(x, candidates, np.where(candidates >= 0, sims, -2), degree)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, beam) nodes and similarities, -1 and -2 where the beam is not full."""
        enter = np.zeros(len(queries), np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            members, near = self.levels[level]
            found, _ = walk(self.x[members], near, queries, STEP, enter)
            below = np.empty(len(self.x), np.int64)
            lower = self.levels[level - 1][0]
            below[lower] = np.arange(len(lower))
            enter = below[members[found[:, 0]]]
        members, near = self.levels[0]
        found, sims = walk(self.x[members], near, queries, beam, enter)
        return np.where(found >= 0, members[found], -1), sims


def walk(x: np.ndarray, near: np.ndarray, queries: np.ndarray, beam: int, enter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries at once; nodes are sorted by similarity."""
    n, q = len(near), len(queries)
    seen = np.zeros((q, n), bool)
    nodes = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -2, np.float32)
    fresh = np.zeros((q, beam), bool)
    nodes[:, 0] = enter
    sims[:, 0] = np.einsum("qd,qd->q", x[enter], queries)
    fresh[:, 0] = True
    seen[np.arange(q), enter] = True
    active = np.arange(q)
    while len(active):
        waiting = np.where(fresh[active], sims[active], -3)
        step = min(STEP, beam)
        best = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
        open_ = np.take_along_axis(waiting, best, 1) > -3
        some = open_.any(1)
        active, best, open_ = active[some], best[some], open_[some]
        if not len(active):
            break
        rows = active[:, None]
        fresh[rows, best] = False
        next_ = near[np.where(open_, nodes[rows, best], 0)]
        next_ = np.where(open_[:, :, None], next_, -1).reshape(len(active), -1)
        next_ = np.sort(next_, axis=1)
        new = (next_ >= 0) & ~seen[rows, next_]
        new[:, 1:] &= next_[:, 1:] != next_[:, :-1]
        at, which = np.nonzero(new)
        found = next_[at, which]
        seen[active[at], found] = True
        got = np.full(next_.shape, -2, np.float32)
        got[at, which] = np.einsum("kd,kd->k", x[found], queries[active[at]])
        width = int(new.sum(1).max()) if len(at) else 0
        if not width:
            continue
        order = np.argsort(-got, axis=1)[:, :width]
        all_sims = np.concatenate([sims[active], np.take_along_axis(got, order, 1)], 1)
        all_nodes = np.concatenate([nodes[active], np.take_along_axis(next_, order, 1)], 1)
        all_fresh = np.concatenate([fresh[active], np.ones((len(active), width), bool)], 1)
        keep = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        sims[active] = np.take_along_axis(all_sims, keep, 1)
        nodes[active] = np.where(sims[active] > -2, np.take_along_axis(all_nodes, keep, 1), -1)
        fresh[active] = np.take_along_axis(all_fresh, keep, 1) & (sims[active] > -2)
    return nodes, sims


def spread(x: np.ndarray, candidates: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` candidates of each row, nearest first, each nearer to the row than to those chosen; what
    room is left goes to the nearest of the others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    valid = (candidates >= 0) & (sims > -2)
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    n, k = candidates.shape
    chosen = np.zeros((n, k), bool)
    blocked = ~valid
    for _ in range(min(degree, k)):
        pick = np.where(blocked | chosen, k, np.arange(k)[None, :]).min(1)
        rows = np.flatnonzero(pick < k)
        if not len(rows):
            break
        at = pick[rows]
        chosen[rows, at] = True
        node = x[candidates[rows, at]]
        to_chosen = np.einsum("nkd,nd->nk", x[candidates[rows]], node)
        blocked[rows] |= to_chosen > sims[rows]
    first = np.where(chosen, 0, np.where(valid, 1, 2))
    order = np.argsort(first, axis=1, kind="stable")[:, :degree]
    return np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(candidates, order, 1), -1)


def links(graph: Graph, queries: np.ndarray, least: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) with a cosine of ``least`` or a little less, searched and audited in batches."""
    n = len(graph.x)
    out_q, out_n = [], []
    bar = least - SLACK
    for at in range(0, len(queries), QUERIES):
        batch = queries[at : at + QUERIES].astype(np.float32)
        width = beam
        todo = np.arange(len(batch))
        while len(todo) and n:
            if 4 * width >= n:
                a, b = np.nonzero(batch[todo] @ graph.x.T >= bar)
                out_q.append(at + todo[a])
                out_n.append(b)
                break
            nodes, sims = graph.search(batch[todo], width)
            hit = sims >= bar
            full = hit[:, -1]
            width *= 4
            if not _audit(graph.x, batch[todo], hit.sum(1), ~full, bar):
                continue  # all of them again
            a, b = np.nonzero(hit & ~full[:, None])
            out_q.append(at + todo[a])
            out_n.append(nodes[a, b])
            todo = todo[full]
    return np.concatenate(out_q) if out_q else np.zeros(0, int), np.concatenate(out_n) if out_n else np.zeros(0, int)


def _audit(x: np.ndarray, queries: np.ndarray, hits: np.ndarray, answered: np.ndarray, bar: float) -> bool:
    """Whether a search has all links of ``AUDITED`` of the queries it answers: those with most, and others evenly."""
    rows = np.flatnonzero(answered)
    if len(rows) > AUDITED:
        most = rows[np.argsort(-hits[rows], kind="stable")[: AUDITED // 2]]
        rows = np.union1d(most, rows[np.linspace(0, len(rows) - 1, AUDITED - AUDITED // 2).astype(int)])
    return not len(rows) or bool((hits[rows] >= (queries[rows] @ x.T >= bar).sum(1)).all())


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that each place reaches over the links (places a and b)."""
    low = ids.copy()
    while len(a):
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        if (low == before).all():
            break
    return low


def near_duplicates(vectors: DataFrame, least: float = 0.98, shard: int = SHARD) -> DataFrame:
    """(vec_id, vector, label) -> (vec_id, n_links, component_id, kept), one row per id.

    Vectors are compared if their labels are equal and not null, and their lengths are equal.  Vectors that are null,
    empty, zero or not finite link with nothing.  Rows without an id are left out; of repeated rows of one id the first by
    (label, vector) counts, of those that can link if there are any.
    """
    spark = vectors.sparkSession
    able = F.col("label").isNotNull() & usable(F.col("vector"))
    one = vectors.where("vec_id IS NOT NULL").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct((~able).alias("unable"), "label", "vector")).alias("row")
    )
    one = written(one.select("vec_id", "row.label", "row.vector"), "vectors")
    fine = one.where(able)
    found = spark.createDataFrame([], _FOUND)
    for dims in lengths(fine, "vector"):
        found = found.unionByName(_linked(fine.where(F.size("vector") == dims), dims, least, shard))
    counted = found.groupBy(F.col("vec_id").alias("linked")).agg(F.sum("n_links").alias("n_links"))
    united = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    rows = one.select("vec_id").join(counted, F.col("vec_id") == F.col("linked"), "left").join(
        united, F.col("vec_id") == F.col("id"), "left"
    )
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )


_FOUND = "vec_id bigint, n_links bigint, root bigint"


def _linked(fine: DataFrame, dims: int, least: float, shard: int) -> DataFrame:
    """(vec_id, n_links, root) of the links of labelled, usable vectors of one length, a row a pair of shards and vector."""
    # shards of a label: as many as its size asks for, dealt by the hash of the id
    sizes = fine.groupBy("label").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = written(
        fine.join(sizes, "label").withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards").cast("int")), "shards"
    )

    def build(group: pa.Table) -> pa.Table:
        ids = group["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        x = unit(matrix(group["vector"], dims))[order]
        graph = Graph(x)
        levels = [np.concatenate([m[:, None], a], 1).astype("<i4").tobytes() for m, a in graph.levels]
        widths = [a.shape[1] + 1 for _, a in graph.levels]
        return pa.table(
            {
                "label": group["label"][:1],
                "shard": group["shard"][:1],
                "shards": group["shards"][:1],
                "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                "points": pa.array([x.astype("<f8").tobytes()], pa.binary()),
                "levels": pa.array([levels], pa.list_(pa.binary())),
                "widths": pa.array([widths], pa.list_(pa.int32())),
            }
        )

    kind = fine.schema["label"].dataType.simpleString()
    columns = "ids binary, points binary, levels array<binary>, widths array<int>"
    graphs = written(
        dealt.groupBy("label", "shard").applyInArrow(build, f"label {kind}, shard int, shards int, {columns}"), "graphs"
    )
    # shard j asks the graphs of all shards i <= j
    asking = graphs.select(
        "label", F.col("shard").alias("j"), F.explode(F.sequence(F.lit(0), "shard")).alias("shard"),
        F.col("ids").alias("asking_ids"), F.col("points").alias("asking_points"),
    )
    met = asking.join(graphs, ["label", "shard"]).select("shard", "j", "ids", "points", "levels", "widths", "asking_ids", "asking_points")
    met = met.repartition(F.col("shard"), F.col("j"), F.xxhash64("ids"))

    def compare(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                i, j, ids, points, levels, widths, asking_ids, asking_points = (batch.column(c)[at].as_py() for c in range(8))
                ids, asking_ids = np.frombuffer(ids, "<i8"), np.frombuffer(asking_ids, "<i8")
                x, y = np.frombuffer(points, "<f8").reshape(-1, dims), np.frombuffer(asking_points, "<f8").reshape(-1, dims)
                graph = Graph(x[:0])
                graph.x = x.astype(np.float32)
                for data, width in zip(levels, widths):
                    both = np.frombuffer(data, "<i4").reshape(-1, width)
                    graph.levels.append((both[:, 0].astype(np.int64), both[:, 1:]))
                q, n = links(graph, y, least)
                exact = np.concatenate([(y[q[k : k + 65536]] * x[n[k : k + 65536]]).sum(1) for k in range(0, len(q), 65536)] or [np.zeros(0)])
                q, n = q[exact >= least], n[exact >= least]
                if i == j:  # a link may have been found from one of its ends only
                    q, n = q[q != n], n[q != n]
                    pairs = np.unique(np.minimum(q, n) * len(ids) + np.maximum(q, n))
                    q, n = pairs // len(ids), pairs % len(ids)
                    both, ends = ids, (q, n)
                else:
                    both, ends = np.concatenate([ids, asking_ids]), (n, len(ids) + q)
                degree = np.bincount(np.concatenate(ends), minlength=len(both))
                root = forest(both, *ends)
                kept = degree > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[kept]), pa.array(degree[kept].astype(np.int64)), pa.array(root[kept])],
                    names=["vec_id", "n_links", "root"],
                )

    return written(met.mapInArrow(compare, _FOUND), "links")


def op10_embedding_dedup(spark, sf_dir):
    """Every vector with its links at a cosine of 0.98 within its label, and its component."""
    return near_duplicates(
        table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label")
    )
