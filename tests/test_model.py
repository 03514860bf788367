"""M2-M6, K2, S4."""

import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallygrove.operators import (
    assemble,
    classifier,
    confusion,
    fit,
    linear_parts,
    load,
    metrics,
    predictions,
    save,
    score,
)
from tallygrove.plans import TRAINING_METRICS


@pytest.fixture(scope="module")
def table(spark, lineitem):
    """Grades 3, 5 and 8 that overlap in quantity, so the fit is not perfect."""
    quantity = F.col("l_quantity") + 100 * F.col("l_tax")
    grade = F.when(quantity <= 18, 3).when(quantity <= 36, 5).otherwise(8)
    return lineitem.select(grade.alias("label"), "l_quantity", "l_discount").repartition(3).cache()


FEATURES = ["l_quantity", "l_discount"]


@pytest.fixture(scope="module")
def model(table):
    return fit(assemble(table, FEATURES))


def test_m2_settings_and_defaults(model):
    fitted = classifier(model)
    effective = {p.name: v for p, v in fitted.extractParamMap().items()}
    expected = {
        "maxIter": 100,
        "regParam": 0.0,
        "elasticNetParam": 0.8,
        "tol": 1e-6,
        "family": "auto",
        "fitIntercept": True,
        "standardization": True,
        "threshold": 0.5,
        "aggregationDepth": 2,
    }
    assert {k: effective[k] for k in expected} == expected


def test_m2_class_count_is_largest_label_plus_one(model):
    weights, intercepts = linear_parts(model)
    assert classifier(model).numClasses == 9
    assert (len(weights), len(weights[0]), len(intercepts)) == (9, 2, 9)


def test_m2_repeating_and_repartitioning_keep_the_predictions(table, model):
    again = fit(assemble(table.repartition(5), FEATURES))
    merged = fit(assemble(table, FEATURES), partitions=1)
    wanted = rows(confusion(predictions(model, table, FEATURES)))
    assert len(wanted) > 3
    for other in (again, merged):
        assert rows(confusion(predictions(other, table, FEATURES))) == wanted


def test_m2_partitions_are_those_the_fit_runs_with(spark, table, monkeypatch):
    from pyspark.ml import Pipeline

    seen = []
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()))
    many = assemble(table.repartition(9), FEATURES)
    fit(many)
    fit(many, partitions=3)
    assert seen == [9, 3]


@pytest.mark.parametrize("label", ["CAST(-1 AS INT)", "CAST(0.5 AS DOUBLE)"])
def test_m2_labels_outside_the_domain_raise(table, label):
    with pytest.raises(Exception, match="Labels MUST"):
        fit(assemble(table.withColumn("label", F.expr(label)), FEATURES))


def test_m2_empty_table_raises(table):
    with pytest.raises(Exception):
        fit(assemble(table.where("label = 99"), FEATURES))


def test_m3_m4_pipeline_of_one_stage(model):
    assert [type(s).__name__ for s in model.stages] == ["LogisticRegressionModel"]
    assert classifier(model) is model.stages[0]


def test_m5_scored_columns(table, model):
    assert score(model, assemble(table, FEATURES)).dtypes == [
        ("label", "int"),
        ("features", "vector"),
        ("rawPrediction", "vector"),
        ("probability", "vector"),
        ("prediction", "double"),
    ]


def test_m6_training_metrics_equal_the_models_summary(table, model):
    counts = confusion(predictions(model, table, FEATURES))
    ours = {r.metric: r.value for r in metrics(counts, tuple(TRAINING_METRICS)).collect()}
    summary = classifier(model).summary
    theirs = {
        "accuracy": summary.accuracy,
        "weightedFalsePositiveRate": summary.weightedFalsePositiveRate,
        "weightedTruePositiveRate": summary.weightedTruePositiveRate,
        "weightedFMeasure": summary.weightedFMeasure(),
        "weightedPrecision": summary.weightedPrecision,
        "weightedRecall": summary.weightedRecall,
    }
    assert 0.5 < theirs["accuracy"] < 1.0
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_k2_s4_a_saved_model_scores_alike_and_has_no_summary(table, model, tmp_path):
    path = str(tmp_path / "model")
    save(model, path)
    save(model, path)
    loaded = load(path)
    assert not classifier(loaded).hasSummary
    assert linear_parts(loaded) == linear_parts(model)
    data = assemble(table, FEATURES)
    columns = ["label", "prediction", vector_to_array("probability").alias("p")]
    assert rows(score(loaded, data).select(*columns)) == rows(score(model, data).select(*columns))


def test_k2_an_unwritable_path_raises(model, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception):
        save(model, str(tmp_path / "file" / "model"))
