"""The registered queries: every operator over the whole given tables.

Three views of ``lineitem`` serve as labelled tables:

* flat: label ``l_linenumber`` (1..7) and four measures;
* dirty: flat with null for a zero discount and NaN for a zero tax;
* bands: a grade 3, 5 or 8 by tax, with other limits for high discounts, and the one
  feature whether the discount is high. Such a model has one weight per distinct
  input, so its answer is the most frequent grade there, which SQL knows; its
  metrics are neither 0 nor 1.

The two other small fits are of that kind as well: fitted probabilities must equal
observed frequencies. Of the wide fit, the conditions of its optimum are checked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.operators import (
    assemble,
    classifier,
    confusion,
    fit,
    linear_parts,
    linear_scores,
    load,
    metrics,
    per_class,
    predictions,
    prepare_table,
    save,
    score,
)
from tallygrove.plans.jobs import (
    TRAINING_METRICS,
    Source,
    evaluate,
    predict_job,
    prepared,
    train_job,
)
from tallygrove.sources import (
    preview,
    read_table,
    shared_path,
    stage,
    write_scored,
)

LABEL = "l_linenumber"
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
BAND_FEATURES = ("high",)
KEY = ("l_orderkey", "l_linenumber")

# A declared model with classes 0..7. Class k scores k * s - k * k / 2, where s
# is a weighted sum of the measures, so the class nearest to s wins.
DECLARED_WEIGHTS = [[0.07 * k, 0.00002 * k, 10.0 * k, 12.0 * k] for k in range(8)]
DECLARED_INTERCEPTS = [0.0 - k * k / 2 for k in range(8)]

# A declared model whose classes weigh discount and tax with either sign: infinite
# measures give margins of both infinities and, where these meet, no number.
NONFINITE_WEIGHTS = [
    [0.01, 0.0001, 1.0, 1.0],
    [0.02, 0.0001, 2.0, -1.0],
    [0.03, 0.0001, -1.0, 2.0],
    [0.04, 0.0001, -1.0, -1.0],
]
NONFINITE_INTERCEPTS = [0.5, 0.25, 0.125, 0.0]

EMBEDDING_SIZE = 64
#: How near a fitted mean comes to the observed one at the optimum.
OPTIMUM = 1e-5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", format="parquet")


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_table(_table(spark, sf_dir, "lineitem"), LABEL, FEATURES)


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").withColumns(
        {
            "l_discount": F.when(F.col("l_discount") != 0, F.col("l_discount")),
            "l_tax": F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")),
        }
    )


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    high, tax = F.col("l_discount") >= 0.05, F.col("l_tax")
    grade = F.when(high, F.when(tax <= 0.01, 3).when(tax <= 0.06, 5).otherwise(8)).otherwise(
        F.when(tax <= 0.05, 3).when(tax <= 0.07, 5).otherwise(8)
    )
    return _table(spark, sf_dir, "lineitem").withColumns({"grade": grade, "high": high.cast("int")})


def _bands_source(spark: SparkSession, sf_dir: str) -> Source:
    return Source(graded(spark, sf_dir), "grade", BAND_FEATURES)


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, _bands_source(spark, sf_dir))


def _fit(flat: DataFrame, features: Sequence[str]) -> PipelineModel:
    return fit(assemble(flat, features))


def _fit_bands(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    flat = _bands(spark, sf_dir)
    return _fit(flat, BAND_FEATURES), flat


def _declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_scores(
        _flat(spark, sf_dir), DECLARED_WEIGHTS, DECLARED_INTERCEPTS, FEATURES
    )


def _numbered(array: str, prefix: str, size: int) -> list:
    return [F.round(F.col(array)[k], 6).alias(f"{prefix}{k}") for k in range(size)]


def _as_csv(df: DataFrame, **options) -> str:
    path = shared_path(df.sparkSession, "csv")
    df.write.csv(path, header=True, **options)
    return path


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(LABEL, *FEATURES)


# -- scans ------------------------------------------------------------------


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred types."""
    return read_table(spark, _as_csv(_labelled(spark, sf_dir)))


def csv_scan_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 without the inference pass, reading two of five columns."""
    table = _labelled(spark, sf_dir)
    scan = read_table(spark, _as_csv(table), schema=table.schema)
    return scan.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity")
    )


def csv_scan_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another separator, every field quoted."""
    table = _table(spark, sf_dir, "lineitem").select(*KEY, "l_returnflag", "l_tax")
    path = _as_csv(table, sep=";", quote="'", quoteAll=True)
    scan = read_table(spark, path, sep=";", quote="'")
    return scan.withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


# -- preparation ------------------------------------------------------------


def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and features in a declared order, nothing else."""
    return prepare_table(_table(spark, sf_dir, "lineitem"), LABEL, FEATURES[::-1])


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete rows of the flat table."""
    return prepare_table(_dirty(spark, sf_dir), LABEL, FEATURES)


def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector with an integer feature, one column per slot."""
    features = ("l_tax", "l_suppkey", "l_quantity")
    flat = prepare_table(_dirty(spark, sf_dir), LABEL, features)
    slots = vector_to_array("features")
    return assemble(flat, features).select(
        "label", *(slots[i].alias(f"slot{i}") for i in range(len(features)))
    )


# -- scoring with declared weights ------------------------------------------


def linear_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5a."""
    return _declared(spark, sf_dir).select("label", *_numbered("rawPrediction", "margin", 8))


def linear_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5b."""
    return _declared(spark, sf_dir).select("label", *_numbered("probability", "p", 8))


def linear_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5c with infinite measures, so that margins are infinite or not numbers."""
    flat = _flat(spark, sf_dir).withColumns(
        {
            "l_discount": F.when(F.col("l_discount") == 0, math.inf)
            .when(F.col("l_discount") > 0.09, -math.inf)
            .otherwise(F.col("l_discount")),
            "l_tax": F.when(F.col("l_tax") == 0, math.inf)
            .when(F.col("l_tax") > 0.07, -math.inf)
            .otherwise(F.col("l_tax")),
        }
    )
    return confusion(linear_scores(flat, NONFINITE_WEIGHTS, NONFINITE_INTERCEPTS, FEATURES))


def linear_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5c."""
    return _declared(spark, sf_dir).select("label", *FEATURES, "prediction")


# -- evaluation -------------------------------------------------------------


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A0."""
    return confusion(_declared(spark, sf_dir))


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled, predicted and hit rows per class, behind A1-A10."""
    return per_class(confusion(_declared(spark, sf_dir)))


def _rounded(table: DataFrame) -> DataFrame:
    return table.withColumn("value", F.round("value", 6))


def metrics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A10, K4. Class 0 is predicted and never a label."""
    return _rounded(metrics(confusion(_declared(spark, sf_dir))))


def metrics_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7-A10 of one column of given labels taken as a prediction of another."""
    counts = confusion(_table(spark, sf_dir, "labels"), label="quality", prediction="toxic")
    return _rounded(metrics(counts))


# -- fitted models ----------------------------------------------------------


def fit_bands_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, M3, M5: fit, score with the model, count."""
    model, flat = _fit_bands(spark, sf_dir)
    return confusion(score(model, assemble(flat, BAND_FEATURES)))


def fit_bands_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the training rows, as the model's own summary has them."""
    model, _ = _fit_bands(spark, sf_dir)
    summary = classifier(model).summary
    own = {
        "accuracy": summary.accuracy,
        "weightedFalsePositiveRate": summary.weightedFalsePositiveRate,
        "weightedTruePositiveRate": summary.weightedTruePositiveRate,
        "weightedFMeasure": summary.weightedFMeasure(),
        "weightedPrecision": summary.weightedPrecision,
        "weightedRecall": summary.weightedRecall,
    }
    return _rounded(spark.createDataFrame(list(own.items()), "metric string, value double"))


def fit_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted probabilities of three tax grades, given high discount."""
    high = (F.col("l_discount") >= 0.05).cast("int")
    tax = F.col("l_tax")
    grade = F.when(high == 0, F.when(tax <= 0.02, 1).when(tax <= 0.05, 2).otherwise(3)).otherwise(
        F.when(tax <= 0.05, 1).when(tax <= 0.07, 2).otherwise(3)
    )
    table = _table(spark, sf_dir, "lineitem").select(grade.alias("grade"), high.alias("high"))
    flat = prepare_table(table, "grade", ["high"])
    model = _fit(flat, ["high"])
    share = vector_to_array("probability")
    scored = score(model, assemble(flat, ["high"], keep=["high"]))
    means = scored.groupBy("high").agg(
        F.count(F.lit(1)).alias("rows"), *(F.avg(share[k]).alias(f"p{k}") for k in range(4))
    )
    return means.select("high", "rows", *(F.round(f"p{k}", 3).alias(f"p{k}") for k in range(4)))


def fit_binary_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, M5a-M5c for two classes: probability of good quality given toxicity."""
    flat = prepare_table(_table(spark, sf_dir, "labels"), "quality", ["toxic"])
    model = _fit(flat, ["toxic"])
    weights, intercepts = linear_parts(model)
    scored = linear_scores(flat, weights, intercepts, ["toxic"])
    return scored.groupBy("toxic", "prediction").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col("probability")[1]), 4).alias("p1")
    )


def fit_embeddings_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, M5 on a wide table: 64 features, 10 classes.

    At the optimum of a fit without penalty, the mean of p_k * x_j over all rows is
    that of x_j over the rows of label k with 0 for others, and the mean of p_k is the
    share of label k (feature -1). ``mean`` is the observed one; ``optimal`` says
    whether the fitted one is within ``OPTIMUM`` of it.
    """
    names = [f"e{i}" for i in range(EMBEDDING_SIZE)]
    wide = _table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", *(F.col("embedding")[i].alias(n) for i, n in enumerate(names))
    )
    flat = prepare_table(wide, "label", names)
    model = _fit(flat, names)
    scored = score(model, assemble(flat, names))
    rows = scored.select(
        "label",
        vector_to_array("features").alias("x"),
        F.posexplode(vector_to_array("probability")).alias("class", "p"),
    )
    seen = (F.col("label") == F.col("class")).cast("double")
    inputs = [F.lit(1.0), *(F.col("x")[j] for j in range(EMBEDDING_SIZE))]
    means = rows.groupBy("class").agg(
        *(F.avg(F.col("p") * x).alias(f"fitted{j}") for j, x in enumerate(inputs)),
        *(F.avg(seen * x).alias(f"seen{j}") for j, x in enumerate(inputs)),
    )
    entries = [
        F.struct(
            F.lit(j - 1).alias("feature"),
            # A value that rounds to zero from below is zero.
            (F.round(f"seen{j}", 6) + F.lit(0.0)).alias("mean"),
            (F.abs(F.col(f"fitted{j}") - F.col(f"seen{j}")) < OPTIMUM).alias("optimal"),
        )
        for j in range(len(inputs))
    ]
    return means.select("class", F.inline(F.array(*entries)))


def model_roundtrip_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save, load, score."""
    model, flat = _fit_bands(spark, sf_dir)
    path = shared_path(spark, "model")
    save(model, path)
    loaded = load(path)
    rows = score(loaded, assemble(flat, BAND_FEATURES))
    classes = classifier(loaded).numClasses
    return rows.groupBy("label", "prediction").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(classes).alias("classes")
    )


def scored_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: write, replace, read back, count by prediction."""
    model, flat = _fit_bands(spark, sf_dir)
    path = shared_path(spark, "scored")
    write_scored(flat.select("label"), path)  # something else, to be replaced
    write_scored(score(model, assemble(flat, BAND_FEATURES)), path)
    written = read_table(spark, path, format="parquet")
    return written.groupBy("prediction").agg(F.count(F.lit(1)).alias("rows"))


def preview_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five scored rows by key."""
    key = ("l_orderkey", "l_partkey", "l_suppkey")
    source = Source(graded(spark, sf_dir), "grade", BAND_FEATURES, keep=key)
    flat = prepared(spark, source)
    model = _fit(flat.drop(*key), BAND_FEATURES)
    scored = score(model, assemble(flat, BAND_FEATURES, keep=key))
    top = preview(
        scored,
        columns=(*key, "features", "label", "prediction"),
        order_by=(*key, "label", vector_to_array("features")),
    )
    slots = vector_to_array("features")
    return top.select(
        *key, *(slots[i].alias(f) for i, f in enumerate(BAND_FEATURES)), "label", "prediction"
    )


# -- jobs -------------------------------------------------------------------


def train_job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on a text table, validate on a columnar one."""
    columns = graded(spark, sf_dir).select("grade", *BAND_FEATURES)
    report = train_job(
        spark,
        Source(_as_csv(columns), "grade", BAND_FEATURES, read={"schema": columns.schema}),
        _bands_source(spark, sf_dir),
        model_path=shared_path(spark, "model"),
        scored_path=shared_path(spark, "scored"),
    )
    return _rounded(report.metrics)


def _predicted(spark: SparkSession, sf_dir: str):
    model, _ = _fit_bands(spark, sf_dir)
    path = shared_path(spark, "model")
    save(model, path)
    columns = graded(spark, sf_dir).select("grade", *BAND_FEATURES)
    return predict_job(
        spark,
        Source(_as_csv(columns), "grade", BAND_FEATURES, read={"schema": columns.schema}),
        model_path=path,
        scored_path=shared_path(spark, "scored"),
    )


def predict_job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a loaded model on a text table."""
    return _rounded(_predicted(spark, sf_dir).metrics)


def predict_job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the job wrote."""
    slots = vector_to_array("features")
    return _predicted(spark, sf_dir).scored.select(
        "label", *(slots[i].alias(f) for i, f in enumerate(BAND_FEATURES)), "prediction"
    )


def evaluate_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 on a scored table that was written before."""
    scored = stage(_declared(spark, sf_dir).select("label", "prediction"), "scored")
    return _rounded(evaluate(scored))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        csv_scan,
        csv_scan_declared,
        csv_scan_semicolon,
        rename_project,
        drop_incomplete,
        assemble_vector,
        linear_margins,
        linear_softmax,
        linear_argmax,
        linear_nonfinite,
        confusion_counts,
        class_counts,
        metrics_all,
        metrics_labels,
        fit_bands_confusion,
        fit_bands_summary,
        fit_frequencies,
        fit_binary_frequencies,
        fit_embeddings_scored,
        model_roundtrip_score,
        scored_parquet_roundtrip,
        preview_scored,
        train_job_metrics,
        predict_job_metrics,
        predict_job_rows,
        evaluate_staged,
    )
}
