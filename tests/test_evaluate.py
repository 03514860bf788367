"""A0-A10, J4."""

import math

import numpy as np
import pytest
from conftest import plan_of, rows
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tallygrove.operators import confusion, metrics, per_class
from tallygrove.plans import evaluate

# Our name -> the library's.
LIBRARY = {
    "accuracy": "accuracy",
    "weightedFalsePositiveRate": "weightedFalsePositiveRate",
    "weightedTruePositiveRate": "weightedTruePositiveRate",
    "weightedFMeasure": "weightedFMeasure",
    "weightedPrecision": "weightedPrecision",
    "weightedRecall": "weightedRecall",
    "f1": "f1",
}


def _scored(spark, pairs):
    data = [(int(a), float(b)) for a, b in pairs]
    return spark.createDataFrame(data, "label int, prediction double")


def _values(table):
    return {r.metric: r.value for r in table.collect()}


def test_a0_counts_per_pair(spark):
    df = _scored(spark, [(1, 1), (1, 1), (1, 2), (0, 1)])
    assert rows(confusion(df)) == [(0.0, 1.0, 1), (1.0, 1.0, 2), (1.0, 2.0, 1)]


def test_a0_counts_before_the_shuffle_and_reads_two_columns(spark, tmp_path, lineitem):
    df = lineitem.select(
        F.col("l_linenumber").alias("label"), F.col("l_tax").alias("prediction"), "l_quantity"
    )
    df.write.parquet(str(tmp_path / "t"))
    plan = plan_of(confusion(spark.read.parquet(str(tmp_path / "t"))))
    assert "ReadSchema: struct<label:int,prediction:double>" in plan
    assert plan.count("Exchange") >= 1 and "partial_count" in plan
    assert plan.index("partial_count") > 0


@pytest.mark.parametrize("pair", [(None, 1.0), (1, None)])
def test_a0_null_raises(spark, pair):
    df = spark.createDataFrame([pair], "label int, prediction double")
    with pytest.raises(Exception, match="is null in a scored row"):
        confusion(df).collect()


def test_per_class_counts_include_classes_never_labelled(spark):
    df = _scored(spark, [(1, 1), (1, 2), (0, 0), (0, 2), (0, 1)])
    assert rows(per_class(confusion(df))) == [(0.0, 3, 1, 1), (1.0, 2, 2, 1), (2.0, 0, 2, 0)]


def test_hand_made_case_with_a_class_never_labelled(spark):
    got = _values(metrics(confusion(_scored(spark, [(1, 1), (1, 2), (0, 0), (0, 2), (0, 1)]))))
    expected = {
        "accuracy": 0.4,
        "f1": 0.5,
        "weightedPrecision": 0.8,
        "weightedRecall": 0.4,
        "weightedTruePositiveRate": 0.4,
        "weightedFMeasure": 0.5,
        "weightedFalsePositiveRate": 2 / 15,
    }
    assert got == pytest.approx(expected, abs=1e-12)


def test_empty_table(spark):
    got = _values(metrics(confusion(_scored(spark, []))))
    assert math.isnan(got.pop("accuracy"))
    assert set(got.values()) == {0.0}


def test_one_class_only_has_no_false_positives(spark):
    got = _values(metrics(confusion(_scored(spark, [(3, 3), (3, 3)]))))
    assert got.pop("weightedFalsePositiveRate") == 0.0
    assert set(got.values()) == {1.0}


@pytest.mark.parametrize("seed", range(4))
def test_metrics_equal_the_library_on_random_tables(spark, seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(2, 9))
    labels = rng.choice(k, size=300, p=rng.dirichlet(np.ones(k)))
    guesses = np.where(rng.random(300) < 0.5, labels, rng.integers(0, k + 1, size=300))
    df = _scored(spark, zip(labels, guesses, strict=True)).cache()
    got = _values(metrics(confusion(df)))
    evaluator = MulticlassClassificationEvaluator()
    for name, theirs in LIBRARY.items():
        evaluator.setMetricName(theirs)
        assert got[name] == pytest.approx(evaluator.evaluate(df), abs=1e-12), name
    assert all(0.0 <= v <= 1.0 for v in got.values())
    recalls = (got["accuracy"], got["weightedRecall"], got["weightedTruePositiveRate"])
    assert recalls == pytest.approx((got["accuracy"],) * 3, abs=1e-12)
    df.unpersist()


def test_names_select_and_order_the_rows(spark):
    df = confusion(_scored(spark, [(1, 1), (0, 1)]))
    out = metrics(df, ("weightedRecall", "accuracy"), dataset="d").collect()
    assert [tuple(r) for r in out] == [("d", "weightedRecall", 0.5), ("d", "accuracy", 0.5)]


def test_a_hot_class_sends_one_row_per_task_and_pair(spark):
    """A third of a million rows in one class: what is shuffled stays tiny."""
    df = spark.range(0, 1_000_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 7).cast("int")).alias("label"),
        (F.col("id") % 2).cast("double").alias("prediction"),
    )
    counts = confusion(df)
    assert sum(r["count"] for r in counts.collect()) == 1_000_000
    assert counts.count() == 14


def test_j4_evaluation_passes_over_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = _scored(spark, [(1, 1), (0, 1), (2, 2)]).mapInPandas(count, "label int, prediction double")
    report = evaluate(df)
    for _ in range(2):
        assert _values(report)["accuracy"] == pytest.approx(2 / 3)
    assert seen.value == 3
    assert [r.metric for r in report.collect()] == [
        "accuracy",
        "f1",
        "weightedPrecision",
        "weightedRecall",
    ]


def test_very_many_classes_meet_in_no_single_task(spark):
    n = 100_000
    pairs = spark.range(n).select(F.col("id").alias("label"), (F.col("id") + (F.col("id") % 2)).alias("prediction"))
    found = metrics(confusion(pairs))
    plan = plan_of(found)
    assert "Window" not in plan and "Join" not in plan
    values = {r.metric: r.value for r in found.collect()}
    assert values["accuracy"] == 0.5 and values["weightedRecall"] == pytest.approx(0.5)
