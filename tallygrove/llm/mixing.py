"""Operator 1: mixing sources to target weights by hash-threshold histograms.

Each source gets a budget of words. Whole rounds over a source are taken by every
document of it; what is left of the budget goes to the documents whose hash lies
below a threshold, which take one round more. The threshold is found without a
sort: sizes are summed by source and leading hash digits, the running sums show the
bucket in which the budget ends, and only that bucket is split by its next digits,
until it holds one document or one hash. Budgets thus nest: with a larger budget a
document is never taken less often.

Defined cases: a null text has size 0, like an empty one; null sources are a source
of their own, after all others; a null doc_id hashes like an empty id; rows with
the same doc_id share a hash and go in or stay out together; an empty table gives
an empty result. Sources are collected (one row each, at most ``max_sources``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.llm.common import read, staged

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, DIGIT_BITS = 60, 12
LEVELS = HASH_BITS // DIGIT_BITS
MOST_ROUNDS = 3


def size(text: str = "text") -> F.Column:
    """The number of words of a text: runs free of the six ASCII white spaces."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(key: str = "doc_id") -> F.Column:
    """A 60-bit number that depends on the id alone, so that reruns agree."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: int, most: int = MOST_ROUNDS) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size.

    What a capped source cannot use is shared among the others by weight, again
    and again, until none is above its cap.
    """
    capped: set[int] = set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = {
            i
            for i, w in enumerate(weights)
            if i not in capped and left * w > most * sizes[i] * weight
        }
        if not over:
            break
        capped |= over
    return [
        float(most * s) if i in capped else (float(left) * w / weight if weight else 0.0)
        for i, (s, w) in enumerate(zip(sizes, weights, strict=True))
    ]


def budgets(docs: DataFrame, *, weights: Sequence[float] = (1, 2, 3), max_sources: int = 100_000) -> DataFrame:
    """source, source_size, target, rounds, threshold of each source of ``docs``.

    ``docs`` needs doc_id, size and source and is read several times: stage it first.
    ``weights`` repeat over the sources in code point order.
    """
    known = docs.groupBy("source").agg(F.sum("size").alias("n")).limit(max_sources + 1).collect()
    if len(known) > max_sources:
        raise ValueError(f"more than {max_sources} sources to mix")
    known.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["n"] for r in known]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], sum(sizes))
    number = {r["source"]: i for i, r in enumerate(known)}
    rounds = [min(MOST_ROUNDS, int(t // s)) if s else 0 for t, s in zip(goal, sizes, strict=True)]
    rest = [t - r * s for t, r, s in zip(goal, rounds, sizes, strict=True)]
    threshold = _thresholds(docs, number, rest)
    return docs.sparkSession.createDataFrame(
        list(zip(number, sizes, goal, rounds, threshold, strict=True)),
        "source string, source_size long, target double, rounds long, threshold long",
    )


def mix(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``docs`` with source_size, target and copies, how often each is to be taken.

    ``chosen`` comes from ``budgets``: one row per source, so it is broadcast and
    no document moves.
    """
    table = F.broadcast(chosen.withColumnRenamed("source", "_source"))
    more = (order_hash() < F.col("threshold")).cast("long")
    return docs.join(table, docs["source"].eqNullSafe(table["_source"])).select(
        *[docs[c] for c in docs.columns], "source_size", "target", (F.col("rounds") + more).alias("copies")
    )


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size of every document, written to the shared folder."""
    return staged(docs.select("doc_id", "source", size().alias("size")), "sizes")


def _thresholds(rows: DataFrame, number: dict[str | None, int], rest: list[float]) -> list[int]:
    """Per source: the hash below which its documents' sizes come nearest to ``rest``."""
    spark = rows.sparkSession
    rows = rows.select("source", "size", order_hash().alias("hash"))
    schema = T.StructType(
        [T.StructField("key", T.StringType()), T.StructField("prefix", T.LongType()), T.StructField("need", T.DoubleType())]
    )
    found = {i: 0 for i in number.values()}
    need = {i: rest[i] for i in number.values() if rest[i] > 0}
    prefix = dict.fromkeys(need, 0)
    names = {i: s for s, i in number.items()}
    for level in range(1, LEVELS + 1):
        if not need:
            break
        shift = HASH_BITS - level * DIGIT_BITS
        open_ = F.broadcast(spark.createDataFrame([(names[i], prefix[i], float(need[i])) for i in need], schema))
        inside = rows["source"].eqNullSafe(open_["key"]) & (
            F.shiftright("hash", shift + DIGIT_BITS) == F.col("prefix")
        )
        bucket = F.shiftright("hash", shift)
        sums = rows.join(open_, inside).groupBy("source", "need", bucket.alias("bucket")).agg(
            F.sum("size").alias("n"), F.countDistinct("hash").alias("hashes")
        )
        # The buckets of a source are 4096 at most, whatever it holds.
        running = F.sum("n").over(_by_source())
        ends = (
            sums.withColumn("upto", running)
            .where("upto > need")
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "n", "hashes")).alias("b"))
            .select("source", "b.*")
            .collect()
        )
        ended = set()
        for r in ends:
            i = number[r["source"]]
            ended.add(i)
            before = r["upto"] - r["n"]
            if r["hashes"] > 1 and level < LEVELS:
                need[i] -= before
                prefix[i] = r["bucket"]
                continue
            nearer = r["upto"] - need[i] < need[i] - before
            found[i] = (r["bucket"] + 1 if nearer else r["bucket"]) << shift
            del need[i]
        for i in set(need) - ended:  # rounding only: the budget is the whole bucket
            found[i] = (prefix[i] + 1) << (shift + DIGIT_BITS)
            del need[i]
    return [found[i] for i in range(len(rest))]


def _by_source():
    return Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken and source of every document."""
    rows = sized(read(spark, sf_dir, "documents"))
    return mix(rows, budgets(rows)).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP1_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source),
ratio AS (
  SELECT *, 3.0 * source_size / w AS r, sum(source_size) OVER () AS total FROM per_source),
level AS (
  SELECT *, total - coalesce(sum(3 * source_size) OVER before, 0) AS remaining,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weight
  FROM ratio
  WINDOW before AS (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT remaining, weight FROM level WHERE remaining * w <= 3 * source_size * weight
  ORDER BY r, source NULLS LAST LIMIT 1),
goal AS (
  SELECT source, source_size,
         CASE WHEN (SELECT remaining FROM water) * w > 3 * source_size * (SELECT weight FROM water)
              THEN (3 * source_size)::DOUBLE
              ELSE (SELECT remaining FROM water)::DOUBLE * w / (SELECT weight FROM water) END AS target
  FROM per_source),
round AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(3, floor(target / source_size)) END::BIGINT AS rounds
  FROM goal),
by_hash AS (
  SELECT source, hash, sum(size) AS n FROM sized GROUP BY source, hash),
running AS (
  SELECT source, hash, n, sum(n) OVER (PARTITION BY source ORDER BY hash) AS upto FROM by_hash),
taken AS (
  SELECT v.source, v.hash,
         v.upto <= g.target - g.rounds * g.source_size
         OR (v.upto - v.n <= g.target - g.rounds * g.source_size
             AND v.upto - (g.target - g.rounds * g.source_size)
                 < (g.target - g.rounds * g.source_size) - (v.upto - v.n)) AS more
  FROM running v JOIN round g ON v.source IS NOT DISTINCT FROM g.source)
SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
       (d.size * (g.rounds + t.more::INT))::BIGINT AS taken
FROM sized d
JOIN round g ON d.source IS NOT DISTINCT FROM g.source
JOIN taken t ON d.source IS NOT DISTINCT FROM t.source AND d.hash = t.hash
"""
