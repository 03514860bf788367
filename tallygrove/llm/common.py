"""What the corpus operators share: tables, staging, word hashes, components."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.sources import shared_path

# Python workers live on between tasks: what a batch took goes back to the system.
pa.set_memory_pool(pa.system_memory_pool())

#: ASCII punctuation and digits' neighbours become blanks before words are cut.
_BLANKS = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_out(df: DataFrame) -> DataFrame:
    """A narrow table's rows dealt evenly, however few files it was read from."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Bits of the map that keeps rows without a partner out of a shuffle: 8 MB.
BITS = 1 << 26


def sieved(df: DataFrame, column: str, needed: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among those of ``needed``.

    A bit map of fixed size is broadcast, so no row moves; a join behind it decides.
    The more values are needed, the more rows pass, all of them at worst.
    """
    at = F.pmod(F.xxhash64(column), F.lit(bits))
    maps = (
        needed.select(at.alias("_at"))
        .groupBy(F.expr("bitmap_bucket_number(_at)").alias("_bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_at))").alias("_bits"))
    )
    byte = F.expr("conv(hex(substring(_bits, cast(bitmap_bit_position(_at) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    bit = F.expr("cast(shiftleft(1, cast(bitmap_bit_position(_at) % 8 as int)) as int)")
    return (
        df.withColumn("_at", at)
        .join(F.broadcast(maps), F.expr("bitmap_bucket_number(_at)") == F.col("_bucket"))
        .where(byte.bitwiseAND(bit) != 0)
        .drop("_at", "_bucket", "_bits")
    )


def salted_join(large: DataFrame, small: DataFrame, key: str, by: str, parts: int = 16) -> DataFrame:
    """``large`` joined with ``small``, which has a row or none for each ``key``.

    Rows of one key are dealt by ``by`` to ``parts`` partitions, to each of which the
    small side's row goes, so that a hot key fills several tasks.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = large.withColumn("_salt", F.pmod(F.xxhash64(by, F.lit(11)), F.lit(parts)).cast("int"))
    return left.join(small.withColumn("_salt", salts), [key, "_salt"]).drop("_salt")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; ASCII punctuation and white space separate."""
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANKS).split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """One 32-bit hash per word, as uint64 to be mixed further."""
    return np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))


def two_words_hashes(tokens: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word, from two independent 32-bit sums."""
    low = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    high = np.fromiter(map(zlib.adler32, tokens), np.uint64, len(tokens))
    return mix(low | (high << np.uint64(32)))


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Hashes of all runs of ``width`` words, repeats included.

    A text of fewer words is one shingle of them all; one without words has none.
    """
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = two_words_hashes(tokens)
    width = min(width, len(tokens))
    out = np.zeros(len(tokens) - width + 1, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(out) + k]
    return mix(out)


def multiset_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller counts over sum of larger counts; two empty sets have 0."""
    if not len(a) or not len(b):
        return 0.0
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    shared = int(np.minimum(ca[ia], cb[ib]).sum())
    return shared / (len(a) + len(b) - shared)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 joined by edges ``a[i]-b[i]``: the smallest node reachable."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """The smallest node reachable from each linked node, as (node, component).

    Alternates two star contractions until nothing changes: each node first hands
    its larger neighbours, then itself and its smaller ones, to the least of them.
    Rounds are staged, minima are summed before the shuffle, and a hub's rows are
    split by the engine's skew join. Nothing but two totals comes to the driver.
    """
    edges = staged(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = staged(small.select("e.u", "e.v").where("u <> v").distinct(), "stars")
        now = edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
        if now == before:
            break
        before = now
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return own.union(roots)


def no_extra(names: Iterable[str], df: DataFrame) -> DataFrame:
    """``df`` cut to the named columns, so that no other column's name can clash."""
    return df.select(*names)
