"""Operator 9: near-duplicates by DartMinHash signatures and banded joining.

A document is the weighted set of its five-word shingles, weight being how often
one occurs. For each shingle, darts are thrown into the region weight x rank by a
generator seeded with its hash alone: the weight axis is cut into slabs (0,1],
(1,2], (2,4], ..., and along each slab's rank axis darts arrive at a rate of the
slab's width. A dart counts if it lies below the document's weight; it hashes to a
coordinate of the signature, and each coordinate keeps its dart of lowest rank.
About K ln K + 2K darts are looked at per document, however long it is; if a
coordinate got none, the ranks looked at are doubled. Two signatures agree at a
coordinate with probability equal to the weighted Jaccard similarity.

Documents that agree in all coordinates of a band are candidates:

* texts with the same shingles are one class from the start;
* in each bucket all others are compared with one of its members (a star), by exact
  similarity, so work is linear in the bucket;
* linked classes are joined to components; then, in buckets that still hold several
  components, members of different components are compared as well: those outside a
  bucket's most frequent component, its strangers, with all others. A pair inside one
  component can add nothing, so no link that matters is passed over;
* small buckets hand on the pairs to compare. Larger ones are dealt out in blocks of
  strangers against blocks of members, and of the links between components only a
  spanning part leaves a task; of buckets with the same members one is compared.

Two documents of similarity 0.8 share none of ``BANDS`` buckets with probability
below 3e-5; no bucket is capped.

Defined cases: null texts and texts without words have no shingles and are alone;
a text of fewer than five words is one shingle of all its words; rows with the same
doc_id count as one document that holds the links of any, and are kept or not
together; rows with a null doc_id take no part: they link with nothing, have the
class null and are kept; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.common import (
    components,
    local_roots,
    mix,
    multiset_jaccard,
    read,
    salted_join,
    shingles,
    sieved,
    staged,
)

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
#: Larger buckets are compared in blocks of ``BLOCK`` members.
GROUP, BLOCK = 24, 512

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _times(factor: int, odd: int) -> np.uint64:
    """A product modulo 2 to the 64."""
    return np.uint64(factor * odd % (1 << 64))


def _uniform(seed: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1] that depend on seed and salt alone."""
    bits = mix(seed + _times(salt, 0x9E3779B97F4A7C15)) >> np.uint64(11)
    return (bits.astype(np.float64) + 1.0) / float(1 << 53)


def dart_signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """For each set and each of ``k`` coordinates, the dart of lowest rank.

    Sets lie one behind the other: the first ``sizes[0]`` of the ``elements``, distinct
    64-bit hashes with positive ``weights``, are the first set, and so on; no set is
    empty.
    """
    sets = len(sizes)
    owner = np.repeat(np.arange(sets), sizes)
    slab_of = np.ceil(np.log2(np.maximum(weights, 1.0))).astype(int)
    parts = []
    for s in range(int(slab_of.max()) + 1):
        has = np.flatnonzero(slab_of >= s)
        width = float(1 << max(s - 1, 0))
        parts.append((mix(elements[has] + _times(s, 0xD1B54A32D192ED03)), has, width, width if s else 0.0))
    seed = np.concatenate([p[0] for p in parts])
    index = np.concatenate([p[1] for p in parts])
    width = np.concatenate([np.full(len(p[1]), p[2]) for p in parts])
    low = np.concatenate([np.full(len(p[1]), p[3]) for p in parts])
    top, owner = weights[index], owner[index]
    limit = (k * np.log(k) + 2 * k) / np.add.reduceat(weights, np.append(0, np.cumsum(sizes)[:-1]))
    kept = np.zeros(sets * k, np.uint64)
    open_ = np.ones(sets, bool)
    while open_.any():
        alive = np.flatnonzero(open_[owner])
        rank = np.zeros(len(alive))
        thrown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        number = 0
        while len(alive):
            rank = rank - np.log(_uniform(seed[alive], 3 * number + 1)) / width[alive]
            near = rank <= limit[owner[alive]]
            alive, rank = alive[near], rank[near]
            inside = low[alive] + width[alive] * _uniform(seed[alive], 3 * number + 2) <= top[alive]
            hit = alive[inside]
            darts = mix(seed[hit] + _times(3 * number + 3, 0x9E3779B97F4A7C15))
            thrown.append((owner[hit] * k + (darts % np.uint64(k)).astype(np.int64), rank[inside], darts))
            number += 1
        at, ranks, darts = (np.concatenate([t[i] for t in thrown]) for i in range(3))
        order = np.argsort(-ranks, kind="stable")  # the lowest rank is written last
        full = np.zeros(sets * k, bool)
        full[at] = True
        kept[at[order]] = darts[order]
        open_ &= ~full.reshape(sets, k).all(axis=1)
        limit = np.where(open_, limit * 2.0, limit)
    return kept.reshape(sets, k)


def band_keys(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each set and band; bands never share keys but by chance."""
    signature = dart_signatures(elements, weights, sizes, bands * rows).reshape(len(sizes), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, (len(sizes), 1))
    for i in range(rows):
        key = mix(key ^ signature[:, :, i]) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    return key


def _signed(sets: list[np.ndarray]) -> tuple[list[bytes | None], list[np.ndarray | None]]:
    """A digest and the band keys of each shingle set; None for empty ones."""
    digests: list[bytes | None] = []
    found = []
    for s in sets:
        if not len(s):
            digests.append(None)
            continue
        elements, counts = np.unique(s, return_counts=True)
        both = mix(elements + counts.astype(np.uint64) * _GOLDEN)
        digests.append(int(both.sum()).to_bytes(8, "big") + int(np.bitwise_xor.reduce(mix(both))).to_bytes(8, "big"))
        found.append((elements, counts.astype(float)))
    if not found:
        return digests, [None] * len(sets)
    keys = iter(
        band_keys(
            np.concatenate([f[0] for f in found]),
            np.concatenate([f[1] for f in found]),
            np.array([len(f[0]) for f in found]),
        ).view(np.int64)
    )
    return digests, [None if d is None else next(keys) for d in digests]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, set_id (a digest of the shingle set, null without words), keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list = []
            waiting: list[np.ndarray] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                waiting.append(shingles(text.as_py(), SHINGLE_WORDS))
                if sum(map(len, waiting[-64:])) > 1 << 16 or len(waiting) >= 256:
                    yield _signed_batch(ids, waiting)
                    ids, waiting = [], []
            yield _signed_batch(ids, waiting)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, set_id binary, keys array<long>"
    )


def _signed_batch(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    digests, keys = _signed(sets)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
        ["doc_id", "set_id", "keys"],
    )


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text of the documents named in ``ids``; others stay out of the shuffle."""
    known = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    return sieved(known, "doc_id", ids).join(ids, "doc_id")


def _similar(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b: doc_ids) whose texts are similar enough, exactly."""
    needed = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "needed")
    texts = staged(_texts(docs, needed).dropDuplicates(["doc_id", "text"]), "texts")
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2), batch.column(3), strict=True):
                x, y = ta.as_py(), tb.as_py()
                if y != last:  # a star's centre comes many times in a row
                    last, known = y, shingles(y, SHINGLE_WORDS)
                keep.append(multiset_jaccard(shingles(x, SHINGLE_WORDS), known) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(verify, "a long, b long").distinct()


def marks(text: str | None) -> np.ndarray:
    """Sorted numbers, one for each shingle and repeat of it: the multiset as a set."""
    s = np.sort(shingles(text, SHINGLE_WORDS))
    start = np.flatnonzero(np.append(True, s[1:] != s[:-1])[: len(s)])
    repeat = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
    return np.sort(mix(s + repeat.astype(np.uint64) * _GOLDEN))


def _in_blocks(placed: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between components, of strangers with others, bucket by bucket.

    ``placed``: key, doc_id, component, main (the bucket's most frequent component), n
    and strangers (how many documents the bucket holds, and outside ``main``).
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [marks(t.as_py()).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "marks"]
            )

    needed = staged(placed.select("doc_id").distinct(), "needed")
    marked = _texts(docs, needed).mapInArrow(mark, "doc_id long, marks array<long>").where(F.size("marks") > 0)
    marked = staged(marked.distinct(), "marks")
    rows = placed.join(marked, "doc_id").withColumns(
        {
            "lb": F.ceil(F.col("strangers") / BLOCK).cast("int"),
            "rb": F.ceil(F.col("n") / BLOCK).cast("int"),
        }
    )
    own = F.xxhash64("doc_id", F.lit(7))
    left = rows.where("component <> main").select(
        "key",
        F.pmod(own, F.col("lb")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("j"),
        F.lit(True).alias("own"), "component", "marks",
    )
    right = rows.select(
        "key",
        F.explode(F.sequence(F.lit(0), F.col("lb") - 1)).alias("i"),
        F.pmod(own, F.col("rb")).cast("int").alias("j"),
        F.lit(False).alias("own"), "component", "marks",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for p, q in zip(cuts[:-1], cuts[1:], strict=True):
                if q == p:
                    continue
                key = tuple(keys[:, p])
                if key != at:
                    yield from _block(parts, threshold)
                    at, parts = key, []
                parts.append(batch.slice(p, q - p))
        yield from _block(parts, threshold)

    count = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        left.union(right)
        .repartition(count, "key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(compare, "a long, b long")
        .distinct()
    )


def _block(parts: list[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    own = rows.column("own").to_numpy()
    names, component = np.unique(rows.column("component").to_numpy(), return_inverse=True)
    sets = [row.values.to_numpy().view(np.uint64) for row in rows.column("marks")]
    right = np.flatnonzero(~own)
    if not own.any() or not len(right):
        return
    # Which of the right sets hold a mark, all marks one behind the other.
    sizes = np.array([len(sets[r]) for r in right])
    flat = np.concatenate([sets[r] for r in right])
    order = np.argsort(flat, kind="stable")
    holder = np.repeat(np.arange(len(right)), sizes)[order]
    known, first, times = np.unique(flat[order], return_index=True, return_counts=True)
    a, b = [], []
    for x in np.flatnonzero(own):
        at = np.minimum(np.searchsorted(known, sets[x]), len(known) - 1)
        at = at[known[at] == sets[x]]
        if not len(at):
            continue
        n = times[at]
        place = np.repeat(first[at] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        shared = np.bincount(holder[place], minlength=len(right))
        near = np.unique(component[right[shared / (len(sets[x]) + sizes - shared) >= threshold]])
        near = near[near != component[x]]
        a.append(np.full(len(near), component[x]))
        b.append(near)
    if not a:
        return
    root = local_roots(len(names), np.concatenate(a), np.concatenate(b))
    joined = np.flatnonzero(root != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[joined]), pa.array(names[root[joined]])], ["a", "b"])


def near_duplicates(docs: DataFrame, *, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (its group's smallest doc_id) and kept, per document.

    A group is a connected component of documents linked by a similarity of at
    least ``threshold``; the document whose id is class_id is kept.
    """
    signed = staged(signatures(docs).where("doc_id is not null"), "signatures")
    sets = signed.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("head"))
    heads = signed.where("set_id is not null").select("doc_id", "set_id").join(sets, "set_id").select("doc_id", "head").distinct()
    heads = staged(heads, "heads")
    # One signature for each class; a bucket is of use if it has two of them.
    buckets = (
        signed.where("set_id is not null")
        .join(sets.select(F.col("head").alias("doc_id"), F.col("set_id")), ["doc_id", "set_id"], "left_semi")
        .select("doc_id", F.explode("keys").alias("key"))
        .distinct()
    )
    buckets = staged(buckets, "buckets")
    centre = (
        buckets.groupBy("key")
        .agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id")).alias("c"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", F.col("c.doc_id").alias("centre"))
    )
    shared = staged(buckets.join(centre, "key"), "shared")
    stars = shared.where("doc_id <> centre").select(
        F.greatest("doc_id", "centre").alias("a"), F.least("doc_id", "centre").alias("b")
    ).distinct()
    stars = staged(stars, "pairs")
    links = staged(_similar(stars, docs, threshold), "similar")
    groups = staged(components(links, "a", "b"), "groups")

    # Buckets that still hold several components: across these, all are compared.
    placed = shared.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    frequent = placed.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc_id", F.lit(5))).alias("members")
    )
    mixed = (
        frequent.groupBy("key")
        .agg(
            F.max(F.struct("n", "component")).alias("top"),
            F.sum("n").alias("n"),
            F.bit_xor("members").alias("members"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .groupBy("n", "members")  # buckets of the same members: one of them
        .agg(F.min("key").alias("key"), F.min("top").alias("top"))
        .select("key", F.col("top.component").alias("main"), "n", (F.col("n") - F.col("top.n")).alias("strangers"))
    )
    placed = staged(salted_join(placed, mixed, "key", "doc_id"), "placed")
    few = placed.where(F.col("n") <= GROUP)
    left = few.where("component <> main").select("key", F.col("doc_id").alias("x"), F.col("component").alias("cx"))
    right = few.select("key", F.col("doc_id").alias("y"), F.col("component").alias("cy"), "main")
    across = (
        left.join(right, "key")
        .where("cx <> cy and (cy = main or cx < cy)")
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    more = _similar(staged(across, "across"), docs, threshold)
    more = more.union(_in_blocks(placed.where(F.col("n") > GROUP), docs, threshold))
    more = staged(more.distinct(), "similar")
    same = heads.where("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    # What is joined already goes on from its components.
    groups = components(groups.select("node", "component").union(more).union(same).toDF("a", "b"), "a", "b")
    return (
        docs.select(F.col("doc_id").cast("long"))
        .join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("component", "doc_id").alias("class_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
        )
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, kept of every document."""
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
