"""Operator 13: exact top-k search by inner product with a pivot-distance index.

Components are made whole numbers, floor(``SCALE`` * x). One more coordinate,
sqrt(M * M - |v|^2) with M the greatest length, puts all vectors on a sphere, and a
query gets 0 there. Then |q - v|^2 = |q|^2 + M^2 - 2 q.v: the largest inner product is
the nearest vector, and the triangle inequality holds.

* Index: pivots are centres learned from a bounded sample (``SAMPLE`` vectors). Every
  vector is keyed by its nearest pivot and its distance to it. A pivot's vectors are
  cut, by distances of the sample, into rings (annuli); each ring's exact least and
  greatest distance is taken over all its vectors.
* Search: no vector of a ring can be nearer to a query than the query's distance to the
  pivot lies outside the ring's bounds. A query takes its rings in the order of that
  bound, a few at first and ``GROWTH`` times as many with each round, and stops when
  the next bound says that no score left can reach the k-th one found. Bounds have a
  slack for rounding, and a ring that may hold an equal score is taken, so the answer
  is exact.
* Rings of any size are dealt in blocks of ``block_rows`` vectors; queries of a ring
  meet a block in one task, and each block hands on a query's best k + 1 rows only.

Equal vectors are one class, of which a query can need k + 1 ids at most: the smallest
are kept. Equal queries are one too. Their answers have k + 1 rows, of which each
member drops itself. Scores are computed in doubles where these are exact, else in
whole numbers of any size.

Vectors without clusters are nearly all equally far from each other: no bound can then
exclude a ring, and the search is an exhaustive one in blocks.

Defined cases: vectors null, empty, or holding null or non-finite components take no
part, nor do rows with a null id; a component beyond 2^53 after scaling and a score
beyond a long become the nearest number in that range; a query meets vectors of its own
length only, each length being a search of its own; zero vectors do take part; equal
rows count once; rows with the same id and different vectors count each, and a query's
answer holds none of the rows with its id; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.llm.common import read, staged
from tallygrove.llm.embedding_dedup import dense_number, lengths

SCALE = 256
#: Components' and scores' greatest sizes.
MOST = 1 << 53
LONG = (1 << 63) - 1
#: Vectors that pivots and rings are learned from, at most; passes over them.
SAMPLE, PASSES = 20_000, 6
#: Vectors that a ring is meant to have; pivots, and rings of a pivot, at most.
RING, PIVOTS, RINGS = 2_048, 256, 256
#: Rings a query takes in the first round, and how many times more in each next one.
FIRST, GROWTH = 2, 4
SLICE = 512


def whole(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, vector): floor(scale * x) of the components of every usable row, once."""
    v = F.col(column).cast("array<double>")
    fine = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bound = F.lit(float(MOST))
    scaled = F.transform("raw", lambda x: F.floor(F.greatest(-bound, F.least(bound, x * F.lit(float(scale))))))
    return (
        vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("raw"))
        .where("id is not null and size(raw) > 0")
        .where(fine)
        .select("id", scaled.alias("vector"))
        .distinct()
    )


def matrix(rows: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Lists of ``d`` longs as a matrix."""
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    return np.asarray(rows.flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of longs, as longs."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < MOST:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < LONG:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


def squares(x: np.ndarray) -> np.ndarray:
    f = x.astype(float)
    return (f * f).sum(axis=1)


def pivots(sample: np.ndarray, most: float, number: int, passes: int = PASSES) -> np.ndarray:
    """Centres of the sample on the sphere of radius sqrt(most), by k-means."""
    x = np.column_stack([sample.astype(float), np.sqrt(np.maximum(most - squares(sample), 0))])
    c = x[np.random.default_rng(13).choice(len(x), number, replace=False)]
    for _ in range(passes):
        near = ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=number)[:, None]
        c = np.where(count > 0, sums / np.maximum(count, 1), c)
    return c


def distances(x: np.ndarray, last: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Of rows with a last coordinate to all pivots."""
    both = np.column_stack([x.astype(float), last])
    square = (both * both).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (both @ c.T)
    return np.sqrt(np.maximum(square, 0))


def _fit(classes: DataFrame, d: int, number: int, ring: int) -> tuple[float, np.ndarray, list[np.ndarray]]:
    """The greatest square length, pivots, and each pivot's inner ring edges."""
    square = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    most = classes.agg(F.max(square)).first()[0] * (1 + 1e-9) + 1.0
    share = min(1.0, SAMPLE / number)
    chosen = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = matrix(classes.where(chosen).orderBy("id").select("vector").toArrow().column(0), d)
    if not len(sample):
        sample = matrix(classes.limit(1).select("vector").toArrow().column(0), d)
    parts = -(-number // ring)
    c = pivots(sample, most, max(1, min(PIVOTS, len(sample), round(parts**0.5))))
    far = distances(sample, np.sqrt(np.maximum(most - squares(sample), 0)), c)
    near, least = far.argmin(axis=1), far.min(axis=1)
    per_pivot = min(RINGS, -(-parts // len(c)))
    edges = [
        np.unique(np.quantile(least[near == i], np.linspace(0, 1, per_pivot + 1)[1:-1])) if (near == i).any() else np.empty(0)
        for i in range(len(c))
    ]
    return most, c, edges


def _keyed(classes: DataFrame, d: int, most: float, c: np.ndarray, edges: list[np.ndarray]) -> DataFrame:
    """ring, distance, ids, vector of every class."""
    shared = classes.sparkSession.sparkContext.broadcast((c, edges))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, cuts = shared.value
        start = np.append(0, np.cumsum([len(e) + 1 for e in cuts]))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), d)
            far = distances(x, np.sqrt(np.maximum(most - squares(x), 0)), centre)
            near, least = far.argmin(axis=1), far.min(axis=1)
            ring = np.empty(len(x), np.int32)
            for i in np.unique(near):
                mine = near == i
                ring[mine] = start[i] + np.searchsorted(cuts[i], least[mine], "right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ring), pa.array(least), *batch.columns], ["ring", "distance", "ids", "vector"]
            )

    return classes.select("ids", "vector").mapInArrow(
        key, "ring int, distance double, ids array<long>, vector array<long>"
    )


def _visits(open_: DataFrame, d: int, most: float, c: np.ndarray, rings: dict, upto: int) -> DataFrame:
    """ring, query, bar, vector: the next rings of each query that may better its answer.

    ``open_``: query, taken (how many rings it has had), bar (its k-th score, null if
    it has fewer), vector. The bounds follow from the ring's distances.
    """
    shared = open_.sparkSession.sparkContext.broadcast((c, rings))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, r = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(3), d)
            far = distances(x, np.zeros(len(x)), centre)[:, r["pivot"]]
            square = squares(x)[:, None]
            slack = 1e-6 * (np.sqrt(square) + np.sqrt(most))
            gap = np.maximum(np.maximum(far - r["high"], r["low"] - far) - slack, 0)
            # The greatest score that a ring can hold, and some more for rounding.
            bound = (square + most - gap * gap) / 2 + 1e-9 * (square + most) + 1
            order = np.argsort(-bound, axis=1, kind="stable")
            bar = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            rows, places = [], []
            for i, done in enumerate(batch.column(1).to_numpy()):
                some = order[i, done:upto]
                if not np.isnan(bar[i]):
                    some = some[bound[i, some] >= bar[i]]
                rows.append(np.full(len(some), i))
                places.append(r["ring"][some])
            taken = batch.take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(places), pa.int32()), taken.column(0), taken.column(2), taken.column(3)],
                ["ring", "query", "bar", "vector"],
            )

    return open_.select("query", "taken", "bar", "vector").mapInArrow(
        choose, "ring int, query long, bar long, vector array<long>"
    )


def _met(index: DataFrame, visits: DataFrame, blocks: DataFrame, d: int, k: int) -> DataFrame:
    """query, vec_id, score: the best k + 1 rows of each block for each of its queries.

    ``blocks``: ring, parts (blocks of a ring), groups (of its queries).
    """
    rows = index.join(F.broadcast(blocks), "ring").select(
        "ring",
        F.pmod(F.xxhash64(F.col("ids")[0]), F.col("parts")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("j"),
        F.lit(None).cast("long").alias("query"), F.lit(None).cast("long").alias("bar"), "ids", "vector",
    )
    asked = visits.join(F.broadcast(blocks), "ring").select(
        "ring",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"),
        F.pmod(F.xxhash64("query"), F.col("groups")).cast("int").alias("j"),
        "query", "bar", F.lit(None).cast("array<long>").alias("ids"), "vector",
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                key = tuple(keys[:, lo])
                if key != at:
                    yield from _best(held, d, k)
                    at, held = key, []
                held.append(batch.slice(lo, hi - lo))
        yield from _best(held, d, k)

    return (
        rows.union(asked)
        .repartition(dense_number(index), "ring", "i", "j")
        .sortWithinPartitions("ring", "i", "j")
        .mapInArrow(rank, "query long, vec_id long, score long")
    )


def _best(held: list[pa.RecordBatch], d: int, k: int) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    rows = pa.Table.from_batches(held)
    asks = rows.column("query").is_valid().to_numpy()
    if asks.all() or not asks.any():
        return
    x = matrix(rows.column("vector"), d)
    v = x[~asks]
    ids = rows.column("ids").filter(pa.array(~asks)).combine_chunks()
    start, names = np.append(0, np.cumsum(ids.value_lengths().to_numpy())), ids.flatten().to_numpy()
    queries = rows.column("query").filter(pa.array(asks)).to_numpy()
    bars = rows.column("bar").fill_null(-LONG - 1).filter(pa.array(asks)).to_numpy()
    out: tuple[list, ...] = ([], [], [])
    q = x[asks]
    few = min(k + 1, len(v))
    for lo in range(0, len(q), SLICE):
        s = products(q[lo : lo + SLICE], v)
        least = np.partition(s, s.shape[1] - few, axis=1)[:, s.shape[1] - few]
        for i in range(len(s)):
            near = np.flatnonzero(s[i] >= max(least[i], bars[lo + i]))
            mine = np.concatenate([names[start[c] : start[c + 1]] for c in near]) if len(near) else names[:0]
            score = np.repeat(s[i, near], start[near + 1] - start[near])
            top = np.lexsort((mine, -score))[: k + 1]
            out[0].append(np.full(len(top), queries[lo + i]))
            out[1].append(mine[top])
            out[2].append(score[top])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(o).astype(np.int64)) for o in out], ["query", "vec_id", "score"]
    )


def _smallest(good: DataFrame, number: int) -> DataFrame:
    """vector, ids: the ``number`` smallest ids of each distinct vector."""
    # Limited in each task before the shuffle, so that a hot vector's rows stay few.
    best = Window.partitionBy("vector").orderBy("id")
    return (
        good.withColumn("r", F.row_number().over(best))
        .where(F.col("r") <= number)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )


def _searched(good: DataFrame, asked: F.Column, d: int, k: int, ring: int) -> DataFrame:
    """query_id, vec_id, score, rank among the vectors of one length, ``d``."""
    classes = staged(_smallest(good, k + 1).withColumn("id", F.col("ids")[0]), "classes")
    number = classes.count()
    most, c, edges = _fit(classes, d, number, ring)
    index = staged(_keyed(classes, d, most, c, edges), "index")
    pivot_of = np.repeat(np.arange(len(c)), [len(e) + 1 for e in edges])
    # A row for each ring: PIVOTS * RINGS at most.
    known = index.groupBy("ring").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("n"))
    known = known.orderBy("ring").toArrow()
    rings = {n: known.column(n).to_numpy() for n in ("ring", "low", "high", "n")}
    rings["pivot"] = pivot_of[rings["ring"]]
    block = max(256, ring * 64 // max(d, 64))
    wanted = good.where(asked)
    heads = wanted.groupBy("vector").agg(F.min("id").alias("query"))
    members = staged(wanted.join(heads, "vector").select("id", "query"), "members")
    heads = staged(heads, "queries")
    found = None
    taken, upto = 0, FIRST
    while True:
        state = heads.withColumn("taken", F.lit(taken).cast("int"))
        if found is None:
            state = state.withColumn("bar", F.lit(None).cast("long"))
        else:
            bars = found.groupBy("query").agg(F.min("score").alias("bar"), F.count(F.lit(1)).alias("n"))
            bars = bars.where(F.col("n") > k).select("query", "bar")
            state = state.join(bars, "query", "left")
        visits = staged(_visits(state, d, most, c, rings, upto), "visits")
        asks = visits.groupBy("ring").agg(F.count(F.lit(1)).alias("q"))
        sizes = good.sparkSession.createDataFrame(known.select(["ring", "n"]))
        blocks = staged(
            asks.join(sizes, "ring").select(
                "ring",
                F.ceil(F.col("n") / block).cast("int").alias("parts"),
                F.ceil(F.col("q") / (4 * block)).cast("int").alias("groups"),
            ),
            "blocks",
        )
        if blocks.isEmpty() and found is not None:
            break
        more = _met(index, visits, blocks, d, k)
        best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        both = more if found is None else found.union(more)
        found = staged(
            both.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("query", "vec_id", "score"),
            "found",
        )
        taken, upto = upto, upto * GROWTH
        if taken >= len(rings["ring"]):
            break
    final = Window.partitionBy("id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        members.join(found, "query")
        .where("vec_id <> id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def top_products(
    vectors: DataFrame,
    is_query: str | F.Column,
    *,
    k: int = 5,
    id_column: str = "vec_id",
    column: str = "embedding",
    scale: int = SCALE,
    ring_rows: int = RING,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products, exactly."""
    good = staged(whole(vectors, id_column, column, scale), "whole")
    asked = F.expr(is_query) if isinstance(is_query, str) else is_query
    answer = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for d in lengths(good):
        answer = answer.union(_searched(good.where(F.size("vector") == d), asked, d, k, ring_rows))
    return answer


def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the five best of every fiftieth vector."""
    return top_products(read(spark, sf_dir, "embeddings"), "id % 50 = 0")


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM whole WHERE vec_id % 50 = 0) q
  JOIN (SELECT DISTINCT * FROM whole) c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
