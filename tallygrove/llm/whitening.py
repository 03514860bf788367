"""Operator 12: whitening of embeddings by FEAST contour integration.

Entries become whole numbers x = floor(``SCALE`` * c) + ``SHIFT``. The fit list is each
distinct x vector once; its count n and sums S are exact, so x - S/n = (n*x - S) / n is
centred before anything is multiplied, whatever ``SHIFT`` is. The covariance is summed
in each task over its rows and then row by row of the matrix: its size depends on the
vectors' length alone, never on their number.

The largest eigenvalues and their vectors are found from it by FEAST:

* the matrix is brought to tridiagonal form by reflections, which keep its inertia: the
  signs of the pivots of T - s*I say how many eigenvalues lie above s, so that bisection
  finds a point below the wanted ones and cuts what lies above into intervals of few;
* around each interval runs a circle. The resolvent's integral along it, by Gauss-
  Legendre quadrature, is a projector: a random block is multiplied with it by solving
  (z*I - V) Y = X for each complex node z. These solves are rows of a Spark job, one
  for each interval and node; V is broadcast;
* Rayleigh-Ritz within the filtered block gives eigenpairs, which start the next pass.
  An interval is done if as many Ritz values lie in it as the inertia says, with small
  residuals. A last Rayleigh-Ritz step over all intervals' vectors makes them
  orthonormal to rounding.

Whitened rows are the centred ones times the components over the root of the eigenvalue;
a last pass measures how far their covariance over the fit list is from the identity.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are
dropped; vectors of different lengths are fitted each length by itself; a null id is
kept; repeated rows each get their rows, and count once in the fit list; components
whose eigenvalue is not above rounding (constant dimensions, fewer distinct vectors than
components) do not exist, so a table with one distinct vector has an empty result, as has
an empty table; an entry of more than 2^31 after scaling raises, and a deviation beyond a
long is null; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.common import read, staged
from tallygrove.llm.embedding_dedup import dense_number, lengths

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues an interval is meant to hold; nodes on the upper half of its circle.
INTERVAL, NODES = 8, 8
#: Passes at most; an interval's least width, as part of the largest eigenvalue.
PASSES, WIDTH = 30, 1e-6
#: Eigenvalues below this part of the trace are rounding.
RANK = 1e-12
#: How far above the largest eigenvalue's bound the cuts begin, should one hit another.
STARTS = (1.0, 1.013, 1.037)
LIMIT = 1 << 31
LONG = (1 << 63) - 1


def whole(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, vector): the whole numbers of every usable row."""
    v = F.col(column).cast("array<double>")
    fine = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(
        "raw",
        lambda x: F.when(F.abs(x) * scale <= LIMIT, F.floor(x * F.lit(float(scale))) + F.lit(shift)).otherwise(
            F.raise_error(F.lit("an entry is too large to whiten")).cast("long")
        ),
    )
    return (
        vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("raw"))
        .where(F.size("raw") > 0)
        .where(fine)
        .select("id", scaled.alias("vector"))
    )


def _matrix(rows: pa.Array, d: int) -> np.ndarray:
    return np.asarray(rows.flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)


def _sums(fit_list: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            n += batch.num_rows
            total += _matrix(batch.column(0), d).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([list(map(str, total))])], ["n", "sums"])

    parts = fit_list.select("vector").mapInArrow(add, "n long, sums array<string>")
    rows = parts.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    found = rows.orderBy("i").collect()  # a row for each dimension
    return (int(found[0]["n"]), [int(r["s"]) for r in found]) if found else (0, [])


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The whole numbers n*x - S, as longs where these suffice."""
    if max(float(np.abs(x).max(initial=0)) * n, max(map(abs, sums))) < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _outer(rows: DataFrame, width: int, values: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the outer product of their ``values``, ``width`` long."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = values(batch)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(list(total))], ["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[i] = sums.get(i, 0.0) + row.values.to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["i", "row"]
        )

    schema = "i int, row array<double>"
    parts = rows.mapInArrow(gram, schema).repartition(min(width, dense_number(rows)), "i")
    found = parts.mapInArrow(add, schema).orderBy("i").collect()  # width rows
    return np.array([r["row"] for r in found]) if found else np.zeros((width, width))


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a matrix similar to the symmetric ``v``."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += math.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        w = p - (x @ p) * x
        rest -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(s: float, diagonal: np.ndarray, off: np.ndarray) -> int:
    """How many eigenvalues are above ``s``: positive pivots of T - s*I."""
    count, pivot = 0, 1.0
    tiny = np.finfo(float).eps * (np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)) + 1e-300
    for i, d in enumerate(diagonal):
        pivot = d - s - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += int(pivot > 0)
    return count


def _cut(low: float, high: float, count: Callable[[float], int], width: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it) of intervals of few eigenvalues or little ``width``."""
    held = count(low) - count(high)
    if not held:
        return []
    if held <= INTERVAL or high - low <= width:
        return [(*_drawn_in(low, high, count), held)]
    a, b = low, high
    while True:  # to a point with about half of them above it
        middle = (a + b) / 2
        more = count(middle) - count(high)
        if abs(2 * more - held) <= max(1, held // 4) or b - a <= width:
            break
        a, b = (middle, b) if 2 * more > held else (a, middle)
    return _cut(low, middle, count, width) + _cut(middle, high, count, width)


def _drawn_in(low: float, high: float, count: Callable[[float], int]) -> tuple[float, float]:
    """An interval's ends moved to near its eigenvalues, off those outside."""
    a, b, below, over = low, high, count(low), count(high)
    for step in 0.5 ** np.arange(1, 16) * (high - low):
        a += step if count(a + step) == below else 0
        b -= step if count(b - step) == over else 0
    room = 0.1 * (b - a)
    return a - min(room, (a - low) / 2), b + min(room, (high - b) / 2)


def intervals(v: np.ndarray, wanted: int, start: float = 1.0) -> list[tuple[float, float, int]]:
    """Intervals that hold the ``wanted`` largest eigenvalues above rounding, and few more."""
    t = tridiagonal(v)
    high = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9) * start  # none is above
    low, top = float(np.trace(v)) * RANK, high

    def count(s: float) -> int:
        return above(s, *t)

    wanted = min(wanted, count(low))
    while count(low) > wanted and top - low > WIDTH * high:  # up to the highest point with enough above
        middle = (low + top) / 2
        low, top = (middle, top) if count(middle) >= wanted else (low, middle)
    return _cut(low, high, count, WIDTH * high)


def _nodes(low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre nodes on the upper half circle around an interval, and weights."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - x)
    radius = (high - low) / 2
    turn = np.exp(1j * angle)
    return (low + high) / 2 + radius * turn, w / 2 * radius * turn


def _filtered(spark: SparkSession, v, blocks: dict[int, np.ndarray], open_: dict) -> dict[int, np.ndarray]:
    """Each open interval's block times its projector: a task for each node's solve."""
    shared = spark.sparkContext.broadcast(blocks)
    rows = []
    for k, (low, high, _) in open_.items():
        z, w = _nodes(low, high)
        rows += [(k, float(a.real), float(a.imag), float(b.real), float(b.imag)) for a, b in zip(z, w, strict=True)]
    jobs = spark.createDataFrame(rows, "k int, zr double, zi double, wr double, wi double")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, zr, zi, wr, wi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                y = shared.value[k]
                x = np.linalg.solve(complex(zr, zi) * np.eye(len(y)) - v.value, y.astype(complex))
                part = (complex(wr, wi) * x).real
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([part.ravel()], pa.list_(pa.float64()))], ["k", "part"]
                )

    found = jobs.repartition(min(len(rows), dense_number(jobs))).mapInArrow(solve, "k int, part array<double>").collect()
    shared.unpersist()
    out = {k: np.zeros_like(blocks[k]) for k in open_}
    for r in found:  # a block for each node of each interval
        out[r["k"]] += np.array(r["part"]).reshape(out[r["k"]].shape)
    return out


def largest(spark: SparkSession, v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding, falling, and unit vectors (columns)."""
    if not np.trace(v) > 0:
        return np.empty(0), np.empty((len(v), 0))
    for start in STARTS:
        found = _by_intervals(spark, v, dict(enumerate(intervals(v, wanted, start))))
        if found is not None:
            break
    else:
        raise ArithmeticError("an interval's eigenvalues did not converge")
    q, _ = np.linalg.qr(found)
    e, s = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-e, kind="stable")[:wanted]
    order = order[e[order] > RANK * np.trace(v)]
    return e[order], q @ s[:, order]


def _by_intervals(spark: SparkSession, v: np.ndarray, parts: dict[int, tuple[float, float, int]]) -> np.ndarray | None:
    """Vectors of all eigenvalues in the intervals; None if the passes do not end."""
    rng, d = np.random.default_rng(12), len(v)
    blocks = {k: rng.normal(size=(d, min(d, 2 * held + 6))) for k, (_, _, held) in parts.items()}
    close = 4 * np.finfo(float).eps * max(d, 16) * float(np.abs(v).sum(axis=1).max())
    done: dict[int, np.ndarray] = {}
    shared = spark.sparkContext.broadcast(v)
    for _ in range(PASSES):
        open_ = {k: p for k, p in parts.items() if k not in done}
        if not open_:
            break
        for k, block in _filtered(spark, shared, {k: blocks[k] for k in open_}, open_).items():
            low, high, held = parts[k]
            q, _ = np.linalg.qr(block)
            e, s = np.linalg.eigh(q.T @ v @ q)
            q = q @ s
            inside = (e > low) & (e <= high)
            worst = np.abs(v @ q[:, inside] - q[:, inside] * e[inside]).max(initial=0)
            if inside.sum() == held and worst <= close:
                done[k] = q[:, inside]
            blocks[k] = q
    shared.unpersist()
    return np.column_stack(list(done.values())) if len(done) == len(parts) else None


def _whitened(spark: SparkSession, rows: DataFrame, d: int, wanted: int) -> DataFrame | None:
    """The result for vectors of one length; None if they have no component."""
    fit_list = staged(rows.select("vector").distinct(), "fit")
    n, total = _sums(fit_list, d)
    sums = np.array(total, object)

    def middle(batch: pa.RecordBatch) -> np.ndarray:
        return centred(_matrix(batch.column(0), d), n, sums).astype(float) / n

    v = _outer(fit_list.select("vector"), d, middle) / n
    e, c = largest(spark, v, wanted)
    if not len(e):
        return None
    scaled = spark.sparkContext.broadcast(c / np.sqrt(e))
    m = len(e)
    error = _outer(fit_list.select("vector"), m, lambda batch: middle(batch) @ scaled.value) / n - np.eye(m)
    error = float(np.abs(error).max())
    explained = (e / float(np.trace(v))).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                y = centred(_matrix(part.column(1), d), n, sums)
                if y.dtype == object or float(np.abs(y).max(initial=0)) ** 2 * d >= 1 << 62:
                    exact = (y.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([int(x) if x <= LONG else None for x in exact], pa.int64())
                else:
                    deviation = pa.array((y * y).sum(axis=1))
                white = (y.astype(float) / n) @ scaled.value
                taken = pa.array(np.repeat(np.arange(part.num_rows), m))
                k = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(taken),
                        pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)),
                        pa.array(np.full(k * m, n)),
                        deviation.take(taken),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, k)),
                        pa.array(np.full(k * m, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("id", "vector").mapInArrow(project, SCHEMA)


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    vectors: DataFrame, *, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding",
    scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """A row for each usable vector and component, by falling eigenvalue."""
    spark = vectors.sparkSession
    rows = staged(whole(vectors, id_column, column, scale, shift), "whole")
    out = spark.createDataFrame([], SCHEMA)
    for d in lengths(rows):
        found = _whitened(spark, rows.where(F.size("vector") == d), d, components)
        if found is not None:
            out = out.union(found)
    return out


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    return whiten(read(spark, sf_dir, "embeddings"))
