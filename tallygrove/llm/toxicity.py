"""Operator 8: toxicity by FTRL-proximal logistic regression on hashed word n-grams.

A text's features are the hashed single words, word pairs, pairs with one word
between (skip-grams) and word stems it holds, each once. The learner keeps a rate
of its own for each coordinate and drives weights of uninformative ones to exactly
zero (L1), so the model is a short list of weights, at most ``DIMENSIONS`` long.

Training reads a bounded sample of the labelled rows: ``max_rows``, chosen and
ordered by a hash of doc_id, so the same on every run. All tasks find their features;
one task learns, as each step depends on the one before. Scoring reads every text.

Defined cases: a null text scores like an empty one, that is the bias alone; null
or conflicting labels: null ones are ignored, of several labels of a document the
largest counts; repeated documents are scored once per row; without any labelled
row the score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.common import mix, read, word_hashes, words

DIMENSIONS = 1 << 18
STEM_BYTES = 4
PASSES = 3
#: Scores from here on are predictions of label 1.
THRESHOLD = 0.3
RATE, RATE_BASE, L1, L2 = 0.3, 1.0, 4.0, 1.0


def _all_features(text: str | None) -> np.ndarray:
    """The feature numbers of a text, each below ``DIMENSIONS``, repeats included."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.int64)
    h = mix(word_hashes(tokens))
    stems = mix(word_hashes([w[:STEM_BYTES] for w in tokens]) + np.uint64(1 << 40))
    parts = [h, stems]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(h) > gap:
            parts.append(mix(h[:-gap] * np.uint64(salt) + h[gap:]))
    return (np.concatenate(parts) & np.uint64(DIMENSIONS - 1)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """The distinct feature numbers of a text."""
    return np.unique(_all_features(text))


def ftrl(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights after ``PASSES`` passes; the bias comes last and is not shrunk."""
    z = np.zeros(DIMENSIONS + 1)
    n = np.zeros(DIMENSIONS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at == DIMENSIONS, 0.0, L1), 0.0)
        return -shrunk / ((RATE_BASE + np.sqrt(n[at])) / RATE + L2)

    for _ in range(PASSES):
        for row, label in zip(rows, labels, strict=True):
            at = np.append(row, DIMENSIONS)  # not kept: the rows are the larger part of memory
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / RATE
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(DIMENSIONS + 1))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()).astype(np.int32) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
            ["rank", "label", "features"],
        )


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for batch in batches:
        labels += batch.column(1).to_pylist()
        rows += [row.values.to_numpy() for row in batch.column(2)]
    w = ftrl(rows, np.array(labels))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["feature", "weight"])


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 16_384) -> np.ndarray:
    """A weight vector learned from documents (doc_id, text) and labels (doc_id, toxic).

    Only rows of ``labels`` given here are seen; leave held-out ones out before.
    The sample, and so what is broadcast to find its texts, has about ``max_rows``
    rows whatever the tables' size.
    """
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("double")).alias("label"))
    )
    number = known.count()
    if not number:
        return np.append(np.zeros(DIMENSIONS), -40.0)
    share = min(1.0, max_rows / number)
    rank = F.md5(F.concat(F.lit("toxicity"), F.col("doc_id").cast("string")))
    rank = F.conv(F.substring(rank, 1, 8), 16, 10).cast("long")
    sample = known.withColumn("rank", rank).where(F.col("rank") < F.lit(int(share * (1 << 32))))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("rank", "label", "text")
    learned = (
        rows.mapInArrow(_feature_rows, "rank long, label double, features array<int>")
        .repartition(1)
        .sortWithinPartitions("rank", "label", "features")
        .mapInArrow(_learn, "feature long, weight double")
        .toPandas()
    )
    if learned.empty:  # no labelled text is there
        return np.append(np.zeros(DIMENSIONS), -40.0)
    weights = np.zeros(DIMENSIONS + 1)
    weights[learned["feature"].to_numpy(np.int64)] = learned["weight"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, *, into: str = "score") -> DataFrame:
    """``docs`` with the score of its ``text``, 0 to 1, as column ``into``."""
    bias, dense = weights[-1], weights[:-1].astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(dense)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        weighs = w != 0
        for texts in batches:
            sums = []
            for t in texts:
                found = _all_features(t)
                found = np.unique(found[weighs[found]])  # few features weigh anything
                sums.append(float(w[found].sum(dtype=np.float64)))
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(sums) + bias, -35, 35))), dtype=float)

    return docs.withColumn(into, scored(F.col("text")))


def held_out(column: str = "doc_id") -> F.Column:
    """The rows kept from learning: a quarter, by the checksum of the id's text."""
    return F.crc32(F.col(column).cast("string")) % 4 == 2


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    known = read(spark, sf_dir, "labels").where(~held_out())
    weights = train(docs, known)
    return score(docs, weights).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
