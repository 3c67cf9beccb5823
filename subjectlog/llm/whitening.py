"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

Vectors are brought to whole numbers, so that n, the sums and the products of all pairs of dimensions are exact, and
with them the scatter ``n * sum(x x') - S S'``.  Its characteristic polynomial is found modulo many primes (Hessenberg
reduction, one prime a row of a Spark job) and put together by Chinese remainders.  A symmetric matrix has real roots
only, so the sign changes of the shifted polynomial count the roots above a point exactly; that isolates them, and
bisection in whole numbers refines them.  Each component comes from the null space of ``scatter - root``, by inverse
iteration in fixed-point numbers of ``BITS`` bits, one root a row of a second job.

What passes through the driver is bounded by the dimensions, never by the rows: the products (d * d / 2), residues
(primes * d) and components (d a root).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

SCALE, SHIFT = 64, 1_000_000  # x = floor(SCALE * c) + SHIFT; the shift cancels in all that follows
COMPONENTS = 32
LIMB, LIMBS = 40, 5  # sums travel as whole numbers to the base 2**LIMB, of which LIMBS are enough
ISOLATE, REFINE, BITS = 64, 128, 256  # binary places of isolating intervals, of roots, of null vectors
PRIME_BELOW = 1 << 31
_LARGEST = 2.0**56  # SCALE times this still is a long


def remaining(vector: Column) -> Column:
    """Whether a vector takes part: it is not null, has no null or non-finite entry and none whose x is no long."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole numbers without the shift) of the rows of each length; lengths of 0 are left out."""
    column = batch.column("vector")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    for d in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == d)
        yield at, np.floor(SCALE * flat[(ends[at] - d)[:, None] + np.arange(d)])


def _products(x: np.ndarray) -> np.ndarray:
    """Upper triangle of the sum of (1, x)(1, x)' over the rows, exact."""
    one = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    upper = np.triu_indices(one.shape[1])
    if np.abs(one).max() < 1 << 20:  # 512 products of 40 bits are exact in double
        return (one.T @ one)[upper].astype(np.int64)
    whole = np.array([[int(v) for v in row] for row in one], object)
    return (whole.T @ whole)[upper]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in slices(batches):
        for _, x in _by_length(batch):
            part = _products(x).astype(object)
            held[x.shape[1]] = held[x.shape[1]] + part if x.shape[1] in held else part
    mask = (1 << LIMB) - 1
    for d, total in held.items():
        limbs = [[int(v) >> LIMB * k & mask for v in total] for k in range(LIMBS - 1)]
        limbs.append([int(v) >> LIMB * (LIMBS - 1) for v in total])
        columns = [pa.array([d] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32())]
        columns += [pa.array(v, pa.int64()) for v in limbs]
        yield pa.RecordBatch.from_arrays(columns, names=["d", "k", *[f"l{k}" for k in range(LIMBS)]])


class Scatter(NamedTuple):
    n: int
    sums: list  # S without the shift
    matrix: list  # n * sum(x x') - S S'


def scatters(rows: DataFrame) -> dict[int, Scatter]:
    """Exact scatter of the rows (``vector``) of each length: one pass, d * d / 2 sums a task."""
    limbs = [f"l{k}" for k in range(LIMBS)]
    parts = rows.select("vector").mapInArrow(_sums, "d int, k int, " + ", ".join(f"{c} long" for c in limbs))
    summed = parts.groupBy("d", "k").agg(*[F.sum(c).alias(c) for c in limbs]).collect()
    totals: dict[int, dict[int, int]] = {}
    for r in summed:
        totals.setdefault(r["d"], {})[r["k"]] = sum(r[c] << LIMB * k for k, c in enumerate(limbs))
    found = {}
    for d, total in sorted(totals.items()):
        full = [[0] * (d + 1) for _ in range(d + 1)]
        for k, (i, j) in enumerate(zip(*np.triu_indices(d + 1))):
            full[i][j] = full[j][i] = total[k]
        n, s = full[0][0], full[0][1:]
        found[d] = Scatter(n, s, [[n * full[i + 1][j + 1] - s[i] * s[j] for j in range(d)] for i in range(d)])
    return found


def _is_prime(n: int) -> bool:
    """Miller and Rabin; these witnesses decide all numbers below 2**32."""
    r = (n - 1 & 1 - n).bit_length() - 1
    for a in (2, 7, 61):
        if n == a:
            return True
        x = pow(a, n - 1 >> r, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """Primes below 2**31, downwards, until their product is beyond ``bound``."""
    found, product, n = [], 1, PRIME_BELOW - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def charpoly_modulo(matrix: list, p: int) -> np.ndarray:
    """Coefficients, the leading one first, of det(x - matrix) modulo a prime below 2**31."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):  # to Hessenberg form, by similarity
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        i = k + 1 + int(below[0])
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        f = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - f[:, None] * h[k + 1] % p) % p
        part = h[:, k + 2 :] * f % p
        h[:, k + 1] = (h[:, k + 1] + part.sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)  # polys[k]: of the leading k rows, the constant first
    polys[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polys[k, :-1]
        new = (new - h[k, k] * polys[k]) % p
        run = 1
        for i in range(k - 1, -1, -1):
            run = run * int(h[i + 1, i]) % p
            if not run:
                break
            new = (new - int(h[i, k]) * run % p * polys[i]) % p
        polys[k + 1] = new
    return polys[d, ::-1]


def charpoly(spark: SparkSession, matrix: list) -> list[int]:
    """The characteristic polynomial of a positive semi-definite integer matrix, one row of a job a prime."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))  # of the roots' symmetric functions
    primes = primes_above(2 * bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                found = charpoly_modulo(matrix, p).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([found], pa.list_(pa.int64()))], names=["p", "c"])

    spread = spark.createDataFrame([(p,) for p in primes], "p long").repartition(len(primes))
    got = {r["p"]: r["c"] for r in spread.mapInArrow(residues, "p long, c array<long>").collect()}
    product = math.prod(primes)
    weights = [product // p * pow(product // p, -1, p) for p in primes]
    whole = [sum(got[p][k] * w for p, w in zip(primes, weights)) % product for k in range(d + 1)]
    return [v - product if 2 * v > product else v for v in whole]


def _scaled(poly: list[int], places: int) -> list[int]:
    """The polynomial whose roots are 2**places times as large."""
    return [c << places * k for k, c in enumerate(poly)]


def roots_above(poly: list[int], y: int) -> int:
    """How many roots of a polynomial with real roots only are above y, repeated ones as often: the sign changes
    among the coefficients of poly(x + y)."""
    b = list(poly)
    for last in range(len(b), 1, -1):
        for k in range(1, last):
            b[k] += y * b[k - 1]
    signs = [c > 0 for c in b if c]
    return sum(s != t for s, t in zip(signs, signs[1:]))


def largest_roots(poly: list[int], wanted: int) -> list[tuple[int, int]]:
    """The largest positive roots, downwards, as (root * 2**REFINE, how many roots are not told apart from it).

    Intervals are halved until they hold one root each or are 2**-ISOLATE wide; what is left together then is one
    root that is there several times, to any precision that a double has.
    """
    held = _scaled(poly, ISOLATE)
    top = 1 << max(1, -poly[1]).bit_length() + ISOLATE  # the trace is the sum of the roots
    found, open_ = [], [(0, top, roots_above(held, 0), 0)]
    while open_ and sum(k for _, _, k in found) < wanted:
        low, high, above_low, above_high = open_.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1 or high - low == 1:
            found.append((low, high, inside))
            continue
        middle = low + high >> 1
        above = roots_above(held, middle)
        open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    fine, roots = _scaled(poly, REFINE), []
    for low, high, inside in found:
        low, high = low << REFINE - ISOLATE, high << REFINE - ISOLATE
        if inside == 1:
            side = _positive(fine, high)
            if side is None:
                low = high
            while high - low > 1:
                middle = low + high >> 1
                at = _positive(fine, middle)
                if at is None:
                    low = high = middle
                elif at == side:
                    high = middle
                else:
                    low = middle
        roots.append((high, inside))
    return roots


def _positive(poly: list[int], y: int) -> bool | None:
    value = 0
    for c in poly:
        value = value * y + c
    return value > 0 if value else None


def null_vectors(matrix: list, root: int, times: int) -> list[list[float]]:
    """``times`` orthonormal vectors v with matrix v = root v: inverse iteration, whole numbers standing for
    multiples of 2**-BITS, on the matrix eliminated with complete pivoting."""
    d = len(matrix)
    m = np.array([[v << BITS for v in row] for row in matrix], object)
    m[np.arange(d), np.arange(d)] -= root << BITS - REFINE
    rows, columns = np.arange(d), np.arange(d)
    for k in range(d):
        i, j = divmod(int(np.argmax(np.abs(m[k:, k:]))), d - k)
        for order, a, axis in ((rows, i + k, 0), (columns, j + k, 1)):
            order[[k, a]] = order[[a, k]]
            swapped = [a, k]
            if axis:
                m[:, [k, a]] = m[:, swapped]
            else:
                m[[k, a]] = m[swapped]
        if not m[k, k]:
            m[k, k] = 1  # singular to the last place: a step of that size
        if k + 1 < d:
            m[k + 1 :, k] = (m[k + 1 :, k] << BITS) // m[k, k]
            m[k + 1 :, k + 1 :] -= (m[k + 1 :, k, None] * m[k, k + 1 :]) >> BITS

    def solved(b: np.ndarray) -> np.ndarray:
        y = b[rows]
        for k in range(d - 1):
            y[k + 1 :] -= (m[k + 1 :, k] * y[k]) >> BITS
        for k in range(d - 1, -1, -1):
            rest = y[k] - (int((m[k, k + 1 :] * y[k + 1 :]).sum() if k + 1 < d else 0) >> BITS)
            y[k] = (rest << BITS) // m[k, k]
        x = np.empty(d, object)
        x[columns] = y
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        largest = max(abs(v) for v in x) or 1
        x = (x << BITS) // largest
        return (x << BITS) // math.isqrt(int((x * x).sum()))

    # Start where the last pivots are: those columns are free.
    found = [np.array([(1 << BITS if i == rows[d - 1 - t] else 1 << BITS - 8) for i in range(d)], object) for t in range(times)]
    for _ in range(3):
        for t in range(times):
            x = unit(solved(found[t]))
            for _ in range(2):
                for other in found[:t]:
                    x = x - ((other * (int((x * other).sum()) >> BITS)) >> BITS)
            found[t] = unit(x)
    return [[v / (1 << BITS) for v in x.tolist()] for x in found]


class Model(NamedTuple):
    n: int
    sums: list
    components: np.ndarray  # (d, components)
    roots: np.ndarray  # eigenvalues of the scatter, n * n times those of the covariance
    explained: np.ndarray


def model_of(spark: SparkSession, scatter: Scatter, wanted: int) -> Model:
    d, matrix = len(scatter.matrix), scatter.matrix
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:  # one vector, or all alike
        return Model(scatter.n, scatter.sums, np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    roots = largest_roots(charpoly(spark, matrix), wanted)

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = null_vectors(matrix, int(r["root"]), r["times"])
                columns = [pa.array([r["at"]], pa.int32()), pa.array([found], pa.list_(pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "v"])

    listed = [(k, str(root), times) for k, (root, times) in enumerate(roots)]
    spread = spark.createDataFrame(listed, "at int, root string, times int").repartition(len(listed))
    got = {r["at"]: r["v"] for r in spread.mapInArrow(components, "at int, v array<array<double>>").collect()}
    vectors = [v for k in range(len(roots)) for v in got[k]][:wanted]
    values = [root for root, times in roots for _ in range(times)][:wanted]
    return Model(
        scatter.n,
        scatter.sums,
        np.array(vectors).T,
        np.array([v / (1 << REFINE) for v in values]),
        np.array([v / (trace << REFINE) for v in values]),
    )


def _deviations(x: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S of every entry, exact: as longs where their squares can be summed as such, else as Python's numbers."""
    most = model.n * (int(np.abs(x).max()) + 1) + max(abs(s) for s in model.sums)
    if most * most * x.shape[1] < 1 << 62:
        return model.n * x.astype(np.int64) - np.array(model.sums, np.int64)
    return np.array([[model.n * int(v) - s for v, s in zip(row, model.sums)] for row in x], object)


def _projected(off: np.ndarray, model: Model) -> np.ndarray:
    return off.astype(np.float64) @ model.components / np.sqrt(model.roots)


def identity_errors(rows: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Largest absolute entry of the whitened rows' covariance minus the identity, of each length."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            for _, x in _by_length(batch):
                d = x.shape[1]
                w = _projected(_deviations(x, models[d]), models[d])
                held[d] = held.get(d, 0) + np.concatenate([np.ones((len(w), 1)), w], axis=1).T @ w
        for d, total in held.items():
            flat = total.reshape(-1)
            columns = [pa.array([d] * len(flat), pa.int32()), pa.array(range(len(flat)), pa.int32()), pa.array(flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "k", "sum"])

    got: dict[int, dict[int, float]] = {}
    for r in rows.select("vector").mapInArrow(sums, "d int, k int, sum double").groupBy("d", "k").agg(F.sum("sum").alias("sum")).collect():
        got.setdefault(r["d"], {})[r["k"]] = r["sum"]
    errors = {}
    for d, model in models.items():
        wide = len(model.roots)
        if wide:
            total = np.array([got[d][k] for k in range((wide + 1) * wide)]).reshape(wide + 1, wide) / model.n
            covariance = total[1:] - np.outer(total[0], total[0])
            errors[d] = float(np.abs(covariance - np.eye(wide)).max())
    return errors


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row a remaining vector: its id, ``n``, ``deviation`` (decimal; null beyond 38 digits), arrays ``whitened``
    and ``explained`` with an entry a component, the largest first, and ``identity_error``.

    Vectors that are null or hold a null or non-finite entry (or one of 2**56 or more, which has no long) have no
    row.  Vectors of different lengths have no covariance together: each length is a fit list of its own.  Components
    without variance do not exist, so a single vector, or copies of one, and empty vectors have empty arrays.  Ids
    may be null or repeated: rows are what counts, and each has its row.  No rows give no rows.  Other columns are
    ignored.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    kept = kept.where(remaining(F.col("vector")))
    models = {d: model_of(spark, scatter, components) for d, scatter in scatters(kept).items()}
    errors = identity_errors(kept, models)
    kind = kept.schema["id"].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for at, x in _by_length(batch):
                model = models[x.shape[1]]
                off = _deviations(x, model)
                wide = len(model.roots)
                w = pa.array(_projected(off, model).reshape(-1), pa.float64())
                ends = pa.array(np.arange(len(at) + 1) * wide, pa.int32())
                explained = pa.array(np.tile(model.explained, len(at)), pa.float64())
                far = [int(v) if v < 10**38 else None for v in (off * off).sum(axis=1).tolist()]
                columns = [
                    batch.column("id").take(pa.array(at)),
                    pa.array([model.n] * len(at), pa.int64()),
                    pa.array(far, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, w),
                    pa.ListArray.from_arrays(ends, explained),
                    pa.array([errors.get(x.shape[1])] * len(at), pa.float64()),
                ]
                names = ["id", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    shape = f"id {kind.simpleString()}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    return kept.mapInArrow(rows, shape).withColumnRenamed("id", id_column)


def op11_whitening(spark, sf_dir):
    """Every remaining embedding on its first 32 whitened components."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    each = found.select(
        "vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"),
    )
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
