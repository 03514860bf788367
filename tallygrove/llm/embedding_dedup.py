"""Operator 6: near-duplicate embeddings by spherical k-means cells.

Unit vectors are assigned to the nearest of ``k`` centres, learned from a bounded
sample (``SAMPLE`` vectors, chosen by a hash of the id). A cell's vectors are put into
blocks by their angle to its centre. Two blocks are compared, once, unless their
angles and the one between their centres leave no room for a link:

* of one cell: the rings lie further apart than the threshold's angle;
* of two cells: the centres lie further apart than both rings' outer angles and the
  threshold's together.

A block pair meets in one task as a product of matrices in double precision. Degrees
are counted there, and of the links only a spanning part leaves, so that a group of
copies costs no more rows than it has members; components are joined across blocks.

Equal vectors are one class from the start. A class's smallest id stands for it.
Vectors are shipped as they were given and widened to double where they are compared.

Defined cases: null, empty and zero vectors and those with null or non-finite
components link with nothing; vectors of different lengths do not link, and each
length is a job of its own; rows with the same vec_id and different vectors count as
one vector that holds the links of either; a null vec_id is left alone; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.llm.common import components, local_roots, read, staged

COSINE = 0.9
#: Vectors that the centres are learned from, at most; passes over them.
SAMPLE, PASSES = 20_000, 8
#: Members a cell is meant to have, and centres at most.
CELL, CELLS = 2_000, 1_024
#: Vectors of a block, about; rows of a product of matrices.
BLOCK, SLICE = 4_096, 1_024
#: Rings that angles to a centre are told apart by.
RINGS = 256


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, vector): rows with finite, non-zero vectors, as doubles unless they are floats."""
    v = F.col(column)
    if vectors.schema[column].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("vector"))
        .where("id is not null")
        .where((F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull()))
        .where(fine & F.exists("vector", lambda x: x != 0))
    )


def lengths(good: DataFrame) -> list[int]:
    """The lengths of the vectors; a table has one or a few."""
    return sorted(r[0] for r in good.select(F.size("vector")).distinct().collect())


def unit(rows: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The unit vectors of lists of equal length."""
    flat = np.asarray(rows.flatten().to_numpy(zero_copy_only=False), float)
    x = flat.reshape(len(rows), -1) if len(rows) else np.empty((0, 1))
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) if len(x) else x


def centres(sample: np.ndarray, k: int, passes: int = PASSES) -> np.ndarray:
    """Spherical k-means: unit centres that the sample's vectors are nearest to."""
    rng = np.random.default_rng(7)
    c = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(passes):
        near = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    return c


def dense_number(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _placed(classes: DataFrame, c: np.ndarray) -> DataFrame:
    """cell, ring, id, n, vector: each class's nearest centre and its angle to it."""
    shared = classes.sparkSession.sparkContext.broadcast(c)
    kind = classes.schema["vector"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = shared.value
        for batch in batches:
            x = unit(batch.column(2))
            if not len(x):
                continue
            near = x @ centre.T
            home = near.argmax(axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(x)), home], -1, 1))
            ring = np.minimum((angle * (RINGS / np.pi)).astype(np.int32), RINGS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(home, pa.int32()), pa.array(ring), *batch.columns], ["cell", "ring", "id", "n", "vector"]
            )

    return classes.select("id", "n", "vector").mapInArrow(place, f"cell int, ring int, id long, n long, vector {kind}")


def _blocks(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, id, n, vector) and (cell, block, low, high: the angles of a block).

    A cell's rings are cut into blocks in the order of their angles; a ring of more
    than a block's vectors is dealt to several by a hash of the id.
    """
    before = Window.partitionBy("cell").orderBy("ring").rowsBetween(Window.unboundedPreceding, 0)
    # As many rows as cells have rings: CELLS * RINGS at most.
    rings = placed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("m")).withColumn("upto", F.sum("m").over(before))
    first = F.floor((F.col("upto") - F.col("m")) / BLOCK)
    base = F.col("cell") * F.lit(1 << 32)
    rings = staged(
        rings.select(
            "cell", "ring", (base + first).alias("first"), (F.floor((F.col("upto") - 1) / BLOCK) - first + 1).alias("parts")
        ),
        "rings",
    )
    rows = placed.join(F.broadcast(rings), ["cell", "ring"]).select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).alias("block"), "id", "n", "vector"
    )
    width = np.pi / RINGS
    ranges = (
        rings.select("cell", "ring", F.explode(F.expr("sequence(first, first + parts - 1)")).alias("block"))
        .groupBy("cell", "block")
        .agg((F.min("ring") * width).alias("low"), ((F.max("ring") + 1) * width).alias("high"))
    )
    return rows, ranges


def _block_pairs(ranges: DataFrame, c: np.ndarray, threshold: float) -> DataFrame:
    """(i, j), i <= j: the blocks that may hold a link between them."""
    reach = float(np.arccos(threshold)) + 1e-6
    a, b = np.triu_indices(len(c))
    angle = np.where(a == b, 0.0, np.arccos(np.clip((c @ c.T)[a, b], -1, 1)))
    cells = ranges.sparkSession.createDataFrame(
        pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "angle": angle})
    )
    left = ranges.select(F.col("cell").alias("a"), F.col("block").alias("i"), F.col("low").alias("li"), F.col("high").alias("hi"))
    right = ranges.select(F.col("cell").alias("b"), F.col("block").alias("j"), F.col("low").alias("lj"), F.col("high").alias("hj"))
    same = (F.col("a") == F.col("b")) & (F.col("i") <= F.col("j")) & (F.col("lj") <= F.col("hi") + reach)
    apart = (F.col("a") != F.col("b")) & (F.col("angle") <= F.col("hi") + F.col("hj") + reach)
    return cells.join(left, "a").join(right, "b").where(same | apart).select("i", "j")


def _block_links(rows: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): b null: ``a`` has ``links`` in this pair of blocks; else a spanning link."""
    pairs = staged(pairs, "pairs")
    left = rows.join(pairs, rows["block"] == pairs["i"]).select("i", "j", F.lit(True).alias("own"), "id", "n", "vector")
    right = rows.join(pairs.where("i <> j"), rows["block"] == F.col("j")).select(
        "i", "j", F.lit(False).alias("own"), "id", "n", "vector"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(2)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for p, q in zip(cuts[:-1], cuts[1:], strict=True):
                if q == p:
                    continue
                key = tuple(keys[:, p])
                if key != at:
                    yield from _block(parts, at, threshold)
                    at, parts = key, []
                parts.append(batch.slice(p, q - p))
        yield from _block(parts, at, threshold)

    return (
        left.union(right)
        .repartition(dense_number(rows), "i", "j")
        .sortWithinPartitions("i", "j")
        .mapInArrow(compare, "a long, b long, links long")
    )


def _block(parts: list[pa.RecordBatch], pair: tuple | None, threshold: float) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    own = rows.column("own").to_numpy()
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy().astype(float)
    x = unit(rows.column("vector").combine_chunks())
    left = np.flatnonzero(own)
    right = left if pair[0] == pair[1] else np.flatnonzero(~own)
    names, node = np.unique(ids, return_inverse=True)
    degree = np.zeros(len(ids))
    root = np.arange(len(names))
    for k in range(0, len(left), SLICE):
        some = left[k : k + SLICE]
        near = x[some] @ x[right].T >= threshold
        near &= ids[some][:, None] != ids[right][None, :]
        if not near.any():
            continue
        degree[some] += near @ n[right]
        if right is not left:
            degree[right] += near.T @ n[some]
        a, b = np.nonzero(near)
        # What is joined already goes on as one link per name.
        joined = np.flatnonzero(root != np.arange(len(root)))
        root = local_roots(
            len(names), np.append(node[some][a], joined), np.append(node[right][b], root[joined])
        )
    counted = np.flatnonzero(degree)
    linked = np.flatnonzero(root != np.arange(len(root)))
    if not len(counted):
        return
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([ids[counted], names[linked]])),
            pa.array(
                np.concatenate([np.zeros(len(counted), np.int64), names[root[linked]]]),
                mask=np.arange(len(counted) + len(linked)) < len(counted),
            ),
            pa.array(np.concatenate([np.rint(degree[counted]).astype(np.int64), np.zeros(len(linked), np.int64)])),
        ],
        ["a", "b", "links"],
    )


def _linked(good: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(a, b) that join vectors of one length, and (id, n_links); ``good``: id, vector."""
    classes = staged(
        good.groupBy("vector").agg(F.min("id").alias("id"), F.countDistinct("id").alias("n")), "classes"
    )
    members = good.join(classes.select("vector", F.col("id").alias("head"), F.col("n").alias("copies")), "vector").select(
        "id", "head", "copies"
    )
    members = staged(members.distinct(), "members")
    number = classes.count()
    share = min(1.0, SAMPLE / number)
    picked = classes.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("id").select("vector")
    sample = unit(picked.toArrow().column(0).combine_chunks())
    if len(sample) == 0:
        sample = unit(classes.limit(1).select("vector").toArrow().column(0).combine_chunks())
    c = centres(sample, max(1, min(CELLS, len(sample), number // CELL)))
    rows, ranges = _blocks(staged(_placed(classes, c), "placed"))
    found = staged(_block_links(rows, _block_pairs(ranges, c, threshold), threshold), "links")
    degrees = found.where("b is null").groupBy(F.col("a").alias("head")).agg(F.sum("links").alias("others"))
    joined = found.where("b is not null").select("a", "b").distinct()
    same = members.where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    links = members.join(degrees, "head", "left").select(
        "id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return joined.union(same), links


def near_vectors(
    vectors: DataFrame, *, threshold: float = COSINE, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``."""
    good = usable(vectors, id_column, column)
    ids = vectors.select(F.col(id_column).cast("long").alias("vec_id"))
    none = vectors.sparkSession.createDataFrame([], "a long, b long, id long, n_links long")
    joined, links = none.select("a", "b"), none.select("id", "n_links")
    for length in lengths(good):
        more_joined, more_links = _linked(good.where(F.size("vector") == length), threshold)
        joined, links = joined.union(more_joined), links.union(more_links)
    groups = components(joined, "a", "b")
    links = links.groupBy(F.col("id").alias("vec_id")).agg(F.sum("n_links").alias("n_links"))
    return (
        ids.join(links, "vec_id", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
        )
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every embedding."""
    return near_vectors(read(spark, sf_dir, "embeddings"))
