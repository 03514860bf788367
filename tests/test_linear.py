"""Scoring as column expressions."""

import math

import numpy as np
import pytest
from conftest import plan_of
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallygrove.operators import (
    assemble,
    classifier,
    fit,
    linear_parts,
    linear_scores,
    predictions,
    score,
)


def _random_table(spark, features, classes, n=400, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, features))
    noise = rng.normal(scale=0.7, size=n)
    y = np.clip(np.floor((x[:, 0] + noise + 2) * classes / 4), 0, classes - 1).astype(int)
    names = [f"f{i}" for i in range(features)]
    data = [(int(label), *map(float, row)) for label, row in zip(y, x, strict=True)]
    schema = "label int, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(data, schema).repartition(3), names


def test_declared_weights_against_numpy(spark):
    df, names = _random_table(spark, 3, 4)
    rng = np.random.default_rng(1)
    w, b = rng.normal(size=(5, 3)), rng.normal(size=5)
    out = linear_scores(df, w.tolist(), b.tolist(), names).toPandas()
    x = out[names].to_numpy()
    margins = x @ w.T + b
    shares = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
    assert list(out.columns) == [*df.columns, "rawPrediction", "probability", "prediction"]
    assert np.allclose(np.stack(out["rawPrediction"]), margins, atol=1e-12)
    assert np.allclose(np.stack(out["probability"]), shares, atol=1e-12)
    assert (out["prediction"].to_numpy() == margins.argmax(axis=1)).all()


def test_first_class_wins_a_tie_and_large_margins_do_not_overflow(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,)], "x double")
    out = linear_scores(df, [[-1000.0], [1000.0], [1000.0]], [0.0, 0.0, 0.0], ["x"]).collect()
    assert [r.prediction for r in out] == [1.0, 0.0]
    assert list(out[0].probability) == [0.0, 0.5, 0.5]
    assert list(out[1].probability) == [1.0, 0.0, 0.0]


def test_binomial_raw_pair_and_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-2.0,)], "x double")
    out = linear_scores(df, [[2.0]], [0.0], ["x"]).collect()
    assert [list(r.rawPrediction) for r in out] == [[0.0, 0.0], [-2.0, 2.0], [4.0, -4.0]]
    assert [r.prediction for r in out] == [0.0, 1.0, 0.0]
    assert out[1].probability[1] == pytest.approx(1 / (1 + math.exp(-2)), abs=1e-15)


def test_shape_and_type_of_inputs_are_checked(spark):
    df = spark.createDataFrame([(1.0, "u")], "x double, s string")
    with pytest.raises(ValueError, match="one row per intercept"):
        linear_scores(df, [[1.0, 2.0]], [0.0], ["x"])
    with pytest.raises(TypeError, match="'s' is string"):
        linear_scores(df, [[1.0]], [0.0], ["s"])


@pytest.mark.parametrize("classes", [2, 5])
def test_expressions_agree_with_the_fitted_model_on_every_row(spark, classes):
    df, names = _random_table(spark, 4, classes)
    model = fit(assemble(df, names))
    assert len(linear_parts(model)[0]) == (1 if classes == 2 else classes)
    theirs = score(model, assemble(df, names, keep=names)).select(
        *names,
        F.col("prediction").alias("p0"),
        vector_to_array("rawPrediction").alias("r0"),
        vector_to_array("probability").alias("s0"),
    )
    ours = linear_scores(df, *linear_parts(model), names)
    both = ours.join(theirs, names).toPandas()
    assert len(both) == 400
    assert (both["prediction"] == both["p0"]).all()
    assert np.allclose(np.stack(both["rawPrediction"]), np.stack(both["r0"]), atol=1e-9)
    assert np.allclose(np.stack(both["probability"]), np.stack(both["s0"]), atol=1e-12)


@pytest.mark.parametrize("label", [5, 0, 1])
def test_a_single_label_is_predicted_for_every_row(spark, label):
    df = spark.createDataFrame([(label, float(i), 1.0) for i in range(10)], "label int, a double, b double")
    model = fit(assemble(df, ["a", "b"]))
    theirs = score(model, assemble(df, ["a", "b"])).select(
        "prediction", vector_to_array("probability").alias("probability")
    )
    ours = linear_scores(df, *linear_parts(model), ["a", "b"])
    assert {r.prediction for r in theirs.collect()} == {float(label)}
    assert {r.prediction for r in predictions(model, df, ["a", "b"]).collect()} == {float(label)}
    assert [list(r.probability) for r in ours.collect()] == [
        list(r.probability) for r in theirs.collect()
    ]


def test_only_what_is_used_is_computed_and_no_function_is_opaque(spark, lineitem):
    features = ["l_quantity", "l_tax"]
    out = linear_scores(lineitem, [[1.0, 2.0], [0.5, 9.0], [0.1, 0.2]], [0.0, 1.0, 2.0], features)
    plan = plan_of(out.select("l_linenumber", "prediction"))
    assert "UDF" not in plan and "EXP" not in plan and "array" not in plan
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_tax:double>" in plan
    assert "WholeStageCodegen" in plan or "[codegen id" in plan
    assert "Exchange" not in plan


def test_each_margin_is_computed_once(spark, lineitem):
    out = linear_scores(lineitem, [[3.25], [4.5], [5.75]], [0.0, 1.0, 2.0], ["l_tax"])
    plan = plan_of(out.select("rawPrediction", "probability", "prediction"))
    physical = plan[plan.index("(1)") :]
    assert physical.count("3.25 * ") <= 2  # the node's input line may repeat its output


@pytest.mark.parametrize("scorer", ["model", "expressions"])
def test_either_scorer_answers_alike(spark, scorer):
    df, names = _random_table(spark, 30, 6, n=200)
    model = fit(assemble(df, names), maxIter=3)
    theirs = score(model, assemble(df, names)).groupBy("label", "prediction").count()
    ours = predictions(model, df, names, scorer=scorer).groupBy("label", "prediction").count()
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_a_threshold_of_the_model_is_honoured_or_refused(spark):
    df, names = _random_table(spark, 2, 2)
    model = fit(assemble(df, names), threshold=0.9)
    assert classifier(model).getThreshold() == 0.9
    theirs = score(model, assemble(df, names)).groupBy("prediction").count()
    ours = predictions(model, df, names).groupBy("prediction").count()
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    with pytest.raises(ValueError, match="threshold"):
        predictions(model, df, names, scorer="expressions")
    with pytest.raises(ValueError, match="scorer"):
        predictions(model, df, names, scorer="fast")


@pytest.mark.parametrize("classes", [2, 5])
def test_infinite_features_score_as_the_model_scores_them(spark, classes):
    df, names = _random_table(spark, 3, classes)
    model = fit(assemble(df, names), maxIter=5)
    inf, big = math.inf, 1e308
    values = [0.5, -0.5, inf, -inf, big, -big]
    odd = spark.createDataFrame(
        [(0, a, b, c) for a in values for b in values for c in values], df.schema
    )
    model_rows = score(model, assemble(odd, names, keep=names))
    theirs = model_rows.select(
        *names, *(vector_to_array(c).alias(c) for c in ("rawPrediction", "probability")), "prediction"
    ).collect()
    ours = linear_scores(odd, *linear_parts(model), names).drop("label").collect()

    def shown(found):
        return sorted(
            (repr([r[n] for n in names]), repr([round(v, 9) if abs(v) < 1e300 else v for v in r.rawPrediction]),
             repr([round(v, 9) for v in r.probability]), r.prediction)
            for r in found
        )

    assert shown(ours) == shown(theirs)
    assert any(math.isnan(v) for r in ours for v in r.rawPrediction)
