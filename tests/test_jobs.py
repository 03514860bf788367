"""J1-J4 on a synthetic measurement table, and the command line."""

import numpy as np
import pytest
from conftest import plan_of, rows
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tallygrove.cli import FEATURES, LABEL, main
from tallygrove.operators import assemble, classifier, fit, load, score
from tallygrove.sources import shared_dir
from tallygrove.plans import EVALUATION_METRICS, Source, predict_job, prepared, train_job

# File order, lowest, highest, decimals (None: whole numbers).
COLUMNS = {
    "fixed acidity": (4.7, 15.6, 1),
    "volatile acidity": (0.21, 1.04, 2),
    "citric acid": (0.0, 0.75, 2),
    "residual sugar": (1.2, 15.5, 1),
    "chlorides": (0.045, 0.467, 3),
    "free sulfur dioxide": (1, 52, None),
    "total sulfur dioxide": (10, 151, None),
    "density": (0.9924, 1.00315, 5),
    "pH": (2.86, 3.85, 2),
    "sulphates": (0.42, 1.98, 2),
    "alcohol": (8.4, 13.4, 1),
}


def _measurements(path, n, seed, sep=",", quote=""):
    """Labels 3..8 that depend on two of the columns, noise, repeats, gaps."""
    rng = np.random.default_rng(seed)

    def line(fields):
        return sep.join(f"{quote}{f}{quote}" if quote else str(f) for f in fields)

    lines = [line([*COLUMNS, LABEL])]
    for _ in range(n):
        values = []
        for low, high, decimals in COLUMNS.values():
            x = rng.uniform(low, high)
            values.append(int(x) if decimals is None else round(x, decimals))
        merit = (values[10] - 8.4) / 5 - (values[1] - 0.21) + rng.normal(scale=0.15) + 0.5
        lines.append(line([*values, int(np.clip(3 + merit * 4, 3, 8))]))
    lines += lines[1 : 1 + n // 7]
    broken = lines[1].split(sep)
    broken[4] = ""
    lines.append(sep.join(broken))
    path.write_text("\n".join(lines) + "\n")
    return str(path), len(lines) - 2


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("measurements")
    train, n_train = _measurements(folder / "train.csv", 600, 1)
    check, n_check = _measurements(folder / "check.csv", 160, 2)
    return {"train": train, "check": check, "n_train": n_train, "n_check": n_check}


def _values(table, dataset):
    return {r.metric: r.value for r in table.collect() if r.dataset == dataset}


@pytest.fixture(scope="module")
def trained(spark, files, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    report = train_job(
        spark,
        Source(files["train"], LABEL, FEATURES),
        Source(files["check"], LABEL, FEATURES),
        model_path=str(out / "model"),
        scored_path=str(out / "scored"),
    )
    return report, out


def test_j1_prepared_table(spark, files):
    flat = prepared(spark, Source(files["train"], LABEL, FEATURES))
    assert flat.columns == ["label", *FEATURES]
    assert flat.count() == files["n_train"]
    types = [t for _, t in flat.dtypes]
    assert types.count("double") == 9 and types.count("int") == 3
    declared = ", ".join(
        f"`{c}` {'int' if d is None else 'double'}" for c, (_, _, d) in COLUMNS.items()
    )
    again = Source(files["train"], LABEL, FEATURES, read={"schema": f"{declared}, {LABEL} int"})
    assert rows(prepared(spark, again)) == rows(flat)


def test_j1_semicolon_dialect(spark, tmp_path):
    path, n = _measurements(tmp_path / "t.csv", 20, 3, sep=";", quote='"')
    read = {"sep": ";", "quote": '"'}
    assert prepared(spark, Source(path, LABEL, FEATURES, read=read)).count() == n
    with pytest.raises(ValueError, match="separator"):
        prepared(spark, Source(path, LABEL, FEATURES))


def test_j2_equals_the_same_steps_done_with_the_library(spark, files, trained):
    report, _ = trained
    train = assemble(prepared(spark, Source(files["train"], LABEL, FEATURES)), FEATURES)
    check = assemble(prepared(spark, Source(files["check"], LABEL, FEATURES)), FEATURES)
    model = fit(train)
    summary = classifier(model).summary
    training = _values(report.metrics, "training")
    assert training["accuracy"] == pytest.approx(summary.accuracy, abs=1e-12)
    assert training["weightedFMeasure"] == pytest.approx(summary.weightedFMeasure(), abs=1e-12)
    assert training["weightedFalsePositiveRate"] == pytest.approx(
        summary.weightedFalsePositiveRate, abs=1e-12
    )
    assert len(training) == 6 and 0.3 < training["accuracy"] < 1.0
    scored = score(model, check)
    validation = _values(report.metrics, "validation")
    assert list(validation) == list(EVALUATION_METRICS)
    for name, value in validation.items():
        evaluator = MulticlassClassificationEvaluator(metricName=name)
        assert value == pytest.approx(evaluator.evaluate(scored), abs=1e-12)
    assert rows(report.scored.groupBy("label", "prediction").count()) == rows(
        scored.groupBy("label", "prediction").count()
    )


def test_j2_writes_scored_rows_and_model(spark, files, trained):
    report, out = trained
    written = spark.read.parquet(str(out / "scored"))
    assert written.count() == files["n_check"]
    assert written.dtypes == [
        ("label", "int"),
        ("features", "vector"),
        ("rawPrediction", "vector"),
        ("probability", "vector"),
        ("prediction", "double"),
    ]
    assert classifier(load(str(out / "model"))).numClasses == 9
    assert report.preview.columns == ["features", "label", "prediction"]
    assert report.preview.count() == 5


def test_j2_reports_without_training_data_in_their_plans(files, trained):
    report, out = trained
    assert files["train"] not in plan_of(report.metrics)
    assert files["check"] not in plan_of(report.metrics)
    assert str(out / "scored") in plan_of(report.preview)


@pytest.mark.parametrize("reuse", ["rescan", "cache"])
def test_j2_reuse_does_not_change_the_result(spark, files, trained, tmp_path, reuse):
    report = train_job(
        spark,
        Source(files["train"], LABEL, FEATURES),
        Source(files["check"], LABEL, FEATURES),
        model_path=str(tmp_path / "model"),
        scored_path=str(tmp_path / "scored"),
        reuse=reuse,
        partitions=2,
    )
    for dataset in ("training", "validation"):
        # The order in which classes are summed may move the last digit.
        assert _values(report.metrics, dataset) == pytest.approx(
            _values(trained[0].metrics, dataset), abs=1e-12
        )


def test_j2_the_model_comes_back_as_saved_without_a_summary(trained):
    fitted = classifier(trained[0].model)
    assert not fitted.hasSummary
    with pytest.raises(Exception, match="[Nn]o training summary"):
        _ = fitted.summary.accuracy


def test_jobs_leave_no_tables_behind_and_metrics_are_local_rows(spark, files, tmp_path):
    import os

    folder = shared_dir(spark)
    os.makedirs(folder, exist_ok=True)

    before = set(os.listdir(folder))
    where = {"model_path": str(tmp_path / "m"), "scored_path": str(tmp_path / "s")}
    source = Source(files["train"], LABEL, FEATURES)
    report = train_job(spark, source, Source(files["check"], LABEL, FEATURES), spread=3, **where)
    predict_job(spark, Source(files["check"], LABEL, FEATURES), **where)
    new = set(os.listdir(folder)) - before
    for name in new:
        assert spark.read.parquet(os.path.join(folder, name)).count() == 0, name
    plan = plan_of(report.metrics)
    assert "Exchange" not in plan and "FileScan" not in plan and report.metrics.count() == 10


def test_j2_failure_to_write_raises(spark, files, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception):
        train_job(
            spark,
            Source(files["train"], LABEL, FEATURES),
            Source(files["check"], LABEL, FEATURES),
            model_path=str(tmp_path / "file" / "model"),
            scored_path=str(tmp_path / "scored"),
        )


def test_j3_loaded_model_repeats_the_validation_report(spark, files, trained, tmp_path):
    report, out = trained
    again = predict_job(
        spark,
        Source(files["check"], LABEL, FEATURES),
        model_path=str(out / "model"),
        scored_path=str(tmp_path / "scored"),
    )
    assert _values(again.metrics, "test") == pytest.approx(
        _values(report.metrics, "validation"), abs=1e-12
    )
    assert again.scored.count() == files["n_check"]


@pytest.mark.parametrize("scorer", ["model", "expressions"])
def test_j3_arrays_hold_what_the_vectors_hold(spark, files, trained, tmp_path, scorer):
    from pyspark.ml.functions import vector_to_array

    report, out = trained
    again = predict_job(
        spark,
        Source(files["check"], LABEL, FEATURES),
        model_path=str(out / "model"),
        scored_path=str(tmp_path / "scored"),
        arrays=True,
        scorer=scorer,
    )
    assert dict(again.scored.dtypes)["probability"] == "array<double>"
    theirs = report.scored.select(
        "label", vector_to_array("features").alias("features"), "prediction",
        F.array_max(vector_to_array("probability")).alias("p"),
    )
    ours = again.scored.select("label", "features", "prediction", F.array_max("probability").alias("p"))
    for a, b in zip(rows(ours), rows(theirs), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-9)


def test_j3_keys_are_kept(spark, files, trained, tmp_path):
    _, out = trained
    table = spark.read.csv(files["check"], header=True, inferSchema=True).withColumn(
        "row", F.monotonically_increasing_id()
    )
    for arrays in (False, True):
        scored = predict_job(
            spark,
            Source(table, LABEL, FEATURES, keep=["row"]),
            model_path=str(out / "model"),
            scored_path=str(tmp_path / f"scored{arrays}"),
            arrays=arrays,
        ).scored
        assert scored.select("row").distinct().count() == files["n_check"]


def test_command_line_trains_then_predicts(spark, files, tmp_path, capsys):
    paths = ["--model-path", str(tmp_path / "m"), "--scored-path", str(tmp_path / "s")]
    main(["train", files["train"], files["check"], *paths])
    printed = capsys.readouterr().out.splitlines()
    for name in ("Accuracy", "FPR", "TPR", "F-measure", "Precision", "Recall", "F1 Score",
                 "Weighted Precision", "Weighted Recall"):
        assert any(line.startswith(f"{name}: 0.") for line in printed), name
    assert any("features" in line and "prediction" in line for line in printed)
    main(["predict", files["check"], *paths])
    again = capsys.readouterr().out.splitlines()
    assert [x for x in again if x.startswith("F1")] == [x for x in printed if x.startswith("F1")]
