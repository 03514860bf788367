"""Operator 4: approximate nearest neighbours by multiprobe p-stable hashing.

A table has ``m`` functions floor((a . x + b) / w) with Gaussian a, of unit vectors x;
their values together are a bucket. A query visits, in each table, the buckets in
falling order of the probability that a neighbour at distance ``reach`` lies there,
which the query's own position within its cells determines, and stops when those
visited hold ``success`` of that probability. Buckets are enumerated best first, each
exactly once. What the tables return is merged and ranked by the exact cosine.

Functions, width, reach, tables and success are chosen for each search (``Plan``) from
a sample: ``ASKED`` queries, whose true neighbours are found by setting them against
all vectors, in blocks, and ``SEEN`` vectors, of which a bucket holds its share. Of the
plans that find ``AIM`` of the sample's neighbours the one with the least work is taken.
Where vectors cluster, a query visits few of them; where neighbours are nearly as far
as any other vector, no plan can leave many out, and the sample shows that too.

Probes are shipped as pairs of bucket and query; those of empty buckets go before the
queries' vectors are joined to the rest. Queries and vectors of a bucket meet in blocks
of at most ``BLOCK`` vectors and as many queries; each block hands on its best ``k`` per
query only. Equal vectors are one class, of which a query can need k + 1 ids at most:
the smallest are kept, and exactly those can be in its answer. A query with fewer than
k found is compared with all vectors, in blocks.

Defined cases: vectors null, zero, or with null or non-finite components take no
part; rows with a null id neither; a query meets vectors of its own length only, and
each length is a search of its own; rows with the same id and different vectors count
each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.llm.common import read, salted_join, staged
from tallygrove.llm.embedding_dedup import dense_number, lengths, unit, usable

#: Queries and vectors that a plan is chosen by.
ASKED, SEEN = 48, 4_096
#: Share of the sample's neighbours that a plan has to find.
AIM = 0.97
#: What a plan may be made of; the width is in units of the reach.
TABLES, FUNCTIONS, WIDTHS, SUCCESSES = (1, 2, 3), (1, 2, 3, 4, 6, 8, 10, 12), (1.5, 3.0), (0.6, 0.7, 0.8, 0.9, 0.95, 0.98)
#: Probes of a query in a table at most, and the comparisons that one costs as much as.
PROBES, PROBE_COST = 512, 20
BLOCK = 2_048


class Plan(NamedTuple):
    tables: int
    m: int
    width: float
    reach: float
    success: float


class Choice(NamedTuple):
    """A plan and what the sample says of it: per query and table, but recall."""

    plan: Plan
    recall: float
    share: float
    probes: float


def hash_family(table: int, m: int, d: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1000 + table)
    return rng.normal(size=(d, m)), rng.uniform(0, width, m)


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


def probes(position: np.ndarray, deviation: float, success: float) -> Iterator[tuple[tuple[int, ...], float]]:
    """Buckets in falling order of a neighbour's probability, up to ``success`` of it.

    ``position``: (a . x + b) / w of the query for each function. Along each the
    neighbour's position differs by a normal number of the given deviation, reach / w.
    With each comes the probability of those before it.
    """
    choices = []
    for p in position:
        cells = np.arange(math.floor(p - 4 * deviation), math.floor(p + 4 * deviation) + 1)
        chance = _normal((cells + 1 - p) / deviation) - _normal((cells - p) / deviation)
        order = np.argsort(-chance, kind="stable")
        choices.append((cells[order].tolist(), np.log(np.maximum(chance[order], 1e-300)).tolist()))
    first = (0,) * len(choices)
    heap = [(-sum(c[1][0] for c in choices), 0, first)]
    before = 0.0
    while heap and before < success:
        cost, moved, ranks = heapq.heappop(heap)
        yield tuple(c[0][r] for c, r in zip(choices, ranks, strict=True)), before
        before += math.exp(-cost)
        # The next ones step on in the last function moved or a later one, so that
        # each combination comes once.
        for i in range(moved, len(ranks)):
            if ranks[i] + 1 < len(choices[i][0]):
                step = choices[i][1][ranks[i]] - choices[i][1][ranks[i] + 1]
                heapq.heappush(heap, (cost + step, i, ranks[:i] + (ranks[i] + 1,) + ranks[i + 1 :]))


def _visited(asked: np.ndarray, others: np.ndarray, table: int, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """At what probability each query visits each of the others (2: never), and the
    probabilities at its probes (2 beyond the last)."""
    a, b = hash_family(table, plan.m, asked.shape[1], plan.width)
    held: dict[tuple[int, ...], list[int]] = {}
    for i, cells in enumerate(np.floor((others @ a + b) / plan.width).astype(np.int64).tolist()):
        held.setdefault(tuple(cells), []).append(i)
    at = np.full((len(asked), len(others)), 2.0)
    steps = np.full((len(asked), PROBES + 1), 2.0)
    for q, position in enumerate((asked @ a + b) / plan.width):
        for n, (cells, before) in enumerate(probes(position, plan.reach / plan.width, plan.success)):
            steps[q, n] = before
            if n == PROBES:
                break
            if cells in held:
                at[q, held[cells]] = before
    return at, steps


def choose(asked: np.ndarray, near: np.ndarray, seen: np.ndarray, number: int) -> Choice:
    """The cheapest plan by which ``asked[i]`` finds its neighbours ``near[i]``.

    ``near``: queries x k x d, all unit vectors as ``asked`` and ``seen``, which is a
    sample of the ``number`` vectors that are searched.
    """
    queries, k, d = near.shape
    distance = np.sqrt(np.maximum(((asked[:, None] - near) ** 2).sum(axis=2), 0))
    reach = max(float(np.quantile(distance, 0.75)), 1e-3)
    others = np.concatenate([near.reshape(-1, d), seen])
    own = np.arange(queries)[:, None], np.arange(queries * k).reshape(queries, k)
    best, key = None, None
    for m in FUNCTIONS:
        for w in WIDTHS:
            plan = Plan(max(TABLES), m, w * reach, reach, max(SUCCESSES))
            looks = [_visited(asked, others, t, plan) for t in range(plan.tables)]
            for tables in TABLES:
                for success in SUCCESSES:
                    seen_at = np.min([at for at, _ in looks[:tables]], axis=0) < success
                    share = sum((at[:, queries * k :] < success).mean() for at, _ in looks[:tables])
                    asks = [(steps < success).sum(axis=1) for _, steps in looks[:tables]]
                    if max(a.max() for a in asks) > PROBES:
                        continue
                    count = sum(a.mean() for a in asks)
                    recall = float(seen_at[own].mean())
                    cost = share * number + count * PROBE_COST
                    # Short of the aim, recall counts; beyond it, work.
                    new = (min(recall, AIM), -cost)
                    if best is None or new > key:
                        best, key = Choice(plan._replace(tables=tables, success=success), recall, share, count), new
    return best


def _bucket_number(table: int, cells) -> int:
    """A bucket's cells as one number: few bits for each, hashed where too many."""
    h = table + 1
    for c in cells:
        h = (h * 0x9E3779B97F4A7C15 + int(c) + 512) % (1 << 64)
        h ^= h >> 29
    return h - (1 << 63)


def _placed(rows: DataFrame, plan: Plan, d: int, as_queries: bool) -> DataFrame:
    """bucket, id of a query's probes in every table; and the vector of one placed."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families = [hash_family(t, plan.m, d, plan.width) for t in range(plan.tables)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(batch.column(1))
            for t, (a, b) in enumerate(families):
                at = (x @ a + b) / plan.width
                row, bucket = [], []
                for i, position in enumerate(at):
                    if as_queries:
                        cells = [c for c, _ in probes(position, plan.reach / plan.width, plan.success)]
                    else:
                        cells = [np.floor(position)]
                    row += [i] * len(cells)
                    bucket += [_bucket_number(t, c) for c in cells]
                taken = batch.take(pa.array(row, pa.int64()))
                columns = [pa.array(bucket, pa.int64()), taken.column(0)]
                if as_queries:
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "id"])
                else:
                    yield pa.RecordBatch.from_arrays([*columns, taken.column(1)], ["bucket", "id", "vector"])

    schema = "bucket long, id long" + ("" if as_queries else ", vector array<double>")
    return rows.select("id", "vector").mapInArrow(place, schema)


def _best_of_blocks(vectors: DataFrame, probed: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, class_id, score: the best k classes of each block for each query.

    ``vectors``: bucket, id, vector; ``probed``: bucket, id; ``queries``: id, vector.
    """
    # As many rows as buckets are filled.
    parts = vectors.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("vb"))
    asked = probed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("qb"))
    blocks = staged(parts.join(asked, "bucket"), "blocks")
    v = salted_join(vectors, blocks, "bucket", "id").select(
        "bucket",
        F.pmod(F.xxhash64("id"), F.col("vb")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("j"),
        F.lit(False).alias("asks"),
        "id",
        "vector",
    )
    # Only probes of filled buckets get their query's vector.
    q = salted_join(probed, blocks, "bucket", "id").join(queries.select("id", "vector"), "id").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("vb") - 1)).alias("i"),
        F.pmod(F.xxhash64("id"), F.col("qb")).cast("int").alias("j"),
        F.lit(True).alias("asks"),
        "id",
        "vector",
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        best: dict[int, dict[int, float]] = {}
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                key = tuple(keys[:, lo])
                if key != at:
                    _merge(best, held, k)
                    at, held = key, []
                    if len(best) > 50_000:
                        yield _best_rows(best)
                        best = {}
                held.append(batch.slice(lo, hi - lo))
        _merge(best, held, k)
        yield _best_rows(best)

    return (
        v.union(q)
        .repartition(dense_number(vectors), "bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(rank, "query_id long, class_id long, score double")
    )


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines in double precision of all rows of two matrices."""
    return (q @ v.T) / np.sqrt((q * q).sum(axis=1))[:, None] / np.sqrt((v * v).sum(axis=1))[None, :]


def _merge(best: dict[int, dict[int, float]], held: list[pa.RecordBatch], k: int) -> None:
    """Put a block's best into each query's best so far; k + 1, as it may find itself."""
    if not held:
        return
    rows = pa.Table.from_batches(held)
    asks = rows.column("asks").to_numpy()
    if asks.all() or not asks.any():
        return
    ids = rows.column("id").to_numpy()
    x = np.asarray(rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), -1)
    order = np.flatnonzero(~asks)[np.argsort(ids[~asks], kind="stable")]
    s = _scores(x[asks], x[order])
    few = min(k + 1, s.shape[1])
    bar = -np.partition(-s, few - 1, axis=1)[:, few - 1]
    for i, query in enumerate(ids[asks]):
        near = np.flatnonzero(s[i] >= bar[i] - 1e-12)
        near = near[np.lexsort((ids[order][near], -s[i][near]))][: 2 * few]
        mine = best.setdefault(int(query), {})
        mine.update(zip(ids[order][near].tolist(), s[i][near].tolist(), strict=True))
        if len(mine) > 4 * (k + 1):
            top = sorted(mine.items(), key=lambda e: (-e[1], e[0]))[: 2 * (k + 1)]
            best[int(query)] = dict(top)


def _best_rows(best: dict[int, dict[int, float]]) -> pa.RecordBatch:
    rows = [(q, c, s) for q, found in best.items() for c, s in found.items()]
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    types = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["query_id", "class_id", "score"]
    )


def nearest(
    vectors: DataFrame,
    is_query: str | F.Column,
    *,
    k: int = 5,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, nearest first."""
    good = usable(vectors, id_column, column).withColumn("vector", F.col("vector").cast("array<double>"))
    good = staged(good.distinct(), "vectors")
    asked = F.expr(is_query) if isinstance(is_query, str) else is_query
    answer = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in lengths(good):
        answer = answer.union(_nearest(good.where(F.size("vector") == d), asked, d, k))
    return answer


def _nearest(good: DataFrame, asked: F.Column, d: int, k: int) -> DataFrame:
    """The answers of the queries among vectors of one length, ``d``."""
    classes = staged(good.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
    number = classes.count()
    heads = classes.select("vector", F.col("id").alias("class_id"))
    members = staged(good.join(heads, "vector").select("id", "class_id"), "members")
    queries = staged(good.where(asked), "queries")
    plan = _plan(classes, queries, number, d, k).plan
    probed = staged(_placed(queries, plan, d, True).distinct(), "probed")
    found = _best_of_blocks(staged(_placed(classes, plan, d, False), "placed"), probed, queries, k)
    found = staged(found.distinct(), "found")
    answer = staged(_ranked(found, members, k), "ranked")
    # Queries that the probed buckets gave too little are set against all vectors.
    enough = answer.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = queries.join(enough, queries["id"] == enough["query_id"], "left_anti").select("id", "vector")
    short = staged(short, "short")
    if number and not short.isEmpty():
        again = _ranked(_against_all(classes, short, k).distinct(), members, k)
        kept = answer.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
        answer = kept.select("query_id", "rank", "vec_id", "score").union(again.select("query_id", "rank", "vec_id", "score"))
    return answer.select("query_id", "rank", "vec_id", "score")


def _against_all(classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, class_id, score: best classes of queries that meet all vectors, in blocks."""
    # No literal: joined by one, the single rows of two tables would be a cross join.
    one = F.col("id").bitwiseAND(F.lit(0)).alias("bucket")
    return _best_of_blocks(classes.select(one, "id", "vector"), queries.select(one, "id").distinct(), queries, k)


def _plan(classes: DataFrame, queries: DataFrame, number: int, d: int, k: int) -> Choice:
    """The plan for a search, from the true neighbours of a few queries."""
    none = Choice(Plan(1, 1, 1.0, 0.5, max(SUCCESSES)), 1.0, 1.0, 1.0)
    asked = staged(queries.orderBy(F.xxhash64("id"), "id").limit(ASKED), "asked")
    if not number or asked.isEmpty():
        return none
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class_id")
    # Its own class is among a query's k + 1 best, as a rule.
    near = _against_all(classes, asked, k).distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    near = near.select("query_id", "r", F.col("class_id").alias("id")).join(classes.select("id", "vector"), "id")
    near = near.toArrow().sort_by([("query_id", "ascending"), ("r", "ascending")])
    given = dict(zip((q := asked.toArrow()).column("id").to_pylist(), unit(q.column("vector").combine_chunks()), strict=True))
    met: dict[int, list[np.ndarray]] = {}
    for query, x in zip(near.column("query_id").to_pylist(), unit(near.column("vector").combine_chunks()), strict=True):
        if np.abs(given[query] - x).max() > 1e-12:
            met.setdefault(query, []).append(x)
    # Queries with as many other classes beside them as the fullest one, up to k.
    most = min(k, max(map(len, met.values()), default=0))
    full = [query for query, found in met.items() if len(found) >= most]
    if not most:
        return none
    seen = classes.select("vector").orderBy(F.xxhash64("id"), "id").limit(SEEN).toArrow()
    return choose(
        np.stack([given[query] for query in full]),
        np.stack([np.stack(met[query][:most]) for query in full]),
        unit(seen.column("vector").combine_chunks()),
        number,
    )


def _ranked(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The classes found for a query as its k nearest vectors, itself left out."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class_id")
    near = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 2 * (k + 1))
    # A class's k + 1 smallest ids: a hot class's members are ranked in salted parts.
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    part = Window.partitionBy("class_id", "salt").orderBy("id")
    some = members.withColumn("salt", salt).withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
    whole = Window.partitionBy("class_id").orderBy("id")
    some = some.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= k + 1).select("class_id", "id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.join(some, "class_id")
        .where("id <> query_id")
        .select("query_id", F.col("id").alias("vec_id"), "score")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the five nearest of every fiftieth vector."""
    return nearest(read(spark, sf_dir, "embeddings"), "id % 50 = 0")
