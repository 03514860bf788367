"""SQL that answers each registered query from the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from tallygrove.plans.contract import (
    DECLARED_INTERCEPTS,
    DECLARED_WEIGHTS,
    FEATURES,
    EMBEDDING_SIZE,
    LABEL,
    NONFINITE_INTERCEPTS,
    NONFINITE_WEIGHTS,
)
from tallygrove.plans.jobs import EVALUATION_METRICS, TRAINING_METRICS

_CLASSES = range(len(DECLARED_WEIGHTS))
_COLUMNS = ", ".join(FEATURES)


def _margin(k: int) -> str:
    terms = " + ".join(
        f"CAST({w!r} AS DOUBLE) * {f}" for w, f in zip(DECLARED_WEIGHTS[k], FEATURES, strict=True)
    )
    return f"{terms} + CAST({DECLARED_INTERCEPTS[k]!r} AS DOUBLE)"


_MARGINS = (
    f"margins AS (SELECT {LABEL} AS label, {_COLUMNS}, "
    + ", ".join(f"{_margin(k)} AS m{k}" for k in _CLASSES)
    + " FROM lineitem)"
)
_TOP = "greatest(" + ", ".join(f"m{k}" for k in _CLASSES) + ")"
_SCORED = (
    f"{_MARGINS}, scored AS (SELECT label, {_COLUMNS}, CAST(CASE "
    + " ".join(f"WHEN m{k} = {_TOP} THEN {k}" for k in _CLASSES)
    + " END AS DOUBLE) AS prediction FROM margins)"
)
_BANDS = """graded AS (
  SELECT CASE WHEN l_discount >= 0.05
              THEN CASE WHEN l_tax <= 0.01 THEN 3 WHEN l_tax <= 0.06 THEN 5 ELSE 8 END
              ELSE CASE WHEN l_tax <= 0.05 THEN 3 WHEN l_tax <= 0.07 THEN 5 ELSE 8 END
         END AS label, CAST(l_discount >= 0.05 AS INTEGER) AS high,
         l_orderkey, l_partkey, l_suppkey
  FROM lineitem),
frequent AS (
  SELECT high, CAST(arg_max(label, n) AS DOUBLE) AS prediction
  FROM (SELECT high, label, count(*) AS n FROM graded GROUP BY ALL) GROUP BY high),
bands AS (SELECT * FROM graded JOIN frequent USING (high))"""
_DIRTY = """dirty AS (
  SELECT l_linenumber, l_suppkey, l_quantity, l_extendedprice,
         CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount,
         CASE WHEN l_tax = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax
  FROM lineitem)"""

_BAND_SCORES = "SELECT label, prediction FROM bands"


def _nonfinite() -> str:
    """Margins with infinite measures; a NaN is told by isnan, as SQL ranks it highest."""
    measures = ["l_quantity", "l_extendedprice"]
    for name, top in (("l_discount", 0.09), ("l_tax", 0.07)):
        measures.append(
            f"CASE WHEN {name} = 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {name} > {top} THEN CAST('-Infinity' AS DOUBLE) ELSE {name} END"
        )
    margins = ", ".join(
        " + ".join(f"CAST({w!r} AS DOUBLE) * x{i}" for i, w in enumerate(row)) + f" + CAST({b!r} AS DOUBLE) AS m{k}"
        for k, (row, b) in enumerate(zip(NONFINITE_WEIGHTS, NONFINITE_INTERCEPTS, strict=True))
    )
    columns = ", ".join(f"{m} AS x{i}" for i, m in enumerate(measures))
    number = [f"CASE WHEN isnan(m{k}) THEN CAST('-Infinity' AS DOUBLE) ELSE m{k} END" for k in range(4)]
    top = f"greatest({', '.join(number)})"
    chain = " ".join(f"WHEN NOT isnan(m{k}) AND m{k} = {top} THEN {k}" for k in range(4))
    return f"""
        WITH measures AS (SELECT l_linenumber, {columns} FROM lineitem),
        margins AS (SELECT l_linenumber, {margins} FROM measures)
        SELECT CAST(l_linenumber AS DOUBLE) AS label,
               CAST(CASE WHEN isnan(m0) THEN 0 {chain} ELSE 0 END AS DOUBLE) AS prediction,
               count(*) AS count
        FROM margins GROUP BY ALL"""


_FORMULAS = {
    "accuracy": "sum(hits) / max(total)",
    "weightedFalsePositiveRate": """sum(CASE WHEN total = labelled THEN 0
        ELSE labelled / total * (predicted - hits) / (total - labelled) END)""",
    "weightedTruePositiveRate": "sum(labelled / total * recall)",
    "weightedFMeasure": "sum(labelled / total * f)",
    "weightedPrecision": "sum(labelled / total * precis)",
    "weightedRecall": "sum(labelled / total * recall)",
    "f1": "sum(labelled / total * f)",
}


def _metrics(scored: str, names: Sequence[str] = tuple(_FORMULAS), dataset: str = "") -> str:
    """Metrics of a relation with ``label`` and ``prediction``, as a SELECT."""
    prefix = f"'{dataset}' AS dataset, " if dataset else ""
    rows = " UNION ALL ".join(
        f"SELECT {prefix}'{n}' AS metric, "
        f"round(CAST({_FORMULAS[n]} AS DOUBLE), 6) AS value FROM rates"
        for n in names
    )
    return f"""SELECT * FROM (WITH pairs AS (
      SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction
      FROM ({scored})),
    labels_seen AS (
      SELECT label AS class, CAST(count(*) AS DOUBLE) AS labelled,
             CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) AS hits
      FROM pairs GROUP BY label),
    predictions_seen AS (
      SELECT prediction AS class, CAST(count(*) AS DOUBLE) AS predicted
      FROM pairs GROUP BY prediction),
    counts AS (
      SELECT class, labelled, hits, coalesce(predicted, 0) AS predicted,
             (SELECT CAST(count(*) AS DOUBLE) FROM pairs) AS total
      FROM labels_seen LEFT JOIN predictions_seen USING (class)),
    shares AS (
      SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precis,
             hits / labelled AS recall
      FROM counts),
    rates AS (
      SELECT *, CASE WHEN precis + recall = 0 THEN 0
                     ELSE 2 * precis * recall / (precis + recall) END AS f
      FROM shares)
    {rows})"""


_FREQUENCIES = """WITH graded AS (
  SELECT CAST(l_discount >= 0.05 AS INTEGER) AS high,
         CASE WHEN l_discount >= 0.05
              THEN CASE WHEN l_tax <= 0.05 THEN 1 WHEN l_tax <= 0.07 THEN 2 ELSE 3 END
              ELSE CASE WHEN l_tax <= 0.02 THEN 1 WHEN l_tax <= 0.05 THEN 2 ELSE 3 END
         END AS grade
  FROM lineitem)
SELECT high, count(*) AS rows, CAST(0 AS DOUBLE) AS p0, """ + ", ".join(
    f"round(CAST(count(*) FILTER (WHERE grade = {k}) AS DOUBLE) / count(*), 3) AS p{k}"
    for k in (1, 2, 3)
) + " FROM graded GROUP BY high"

ORACLES: dict[str, str] = {
    "csv_scan": f"SELECT {LABEL}, {_COLUMNS} FROM lineitem",
    "csv_scan_declared": f"""
        SELECT {LABEL}, count(*) AS rows, sum(l_quantity) AS quantity
        FROM lineitem GROUP BY {LABEL}""",
    "csv_scan_semicolon": "SELECT l_orderkey, l_linenumber, l_returnflag, l_tax FROM lineitem",
    "rename_project": f"SELECT {LABEL} AS label, {_COLUMNS} FROM lineitem",
    "drop_incomplete": f"""
        WITH {_DIRTY} SELECT {LABEL} AS label, {_COLUMNS} FROM dirty
        WHERE {LABEL} IS NOT NULL AND """
    + " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in FEATURES),
    "assemble_vector": f"""
        WITH {_DIRTY} SELECT {LABEL} AS label, l_tax AS slot0,
               CAST(l_suppkey AS DOUBLE) AS slot1, l_quantity AS slot2
        FROM dirty WHERE l_tax IS NOT NULL AND NOT isnan(l_tax)""",
    "linear_margins": f"WITH {_MARGINS} SELECT label, "
    + ", ".join(f"round(m{k}, 6) AS margin{k}" for k in _CLASSES)
    + " FROM margins",
    "linear_softmax": f"WITH {_MARGINS}, shifted AS (SELECT label, "
    + ", ".join(f"exp(m{k} - {_TOP}) AS e{k}" for k in _CLASSES)
    + " FROM margins) SELECT label, "
    + ", ".join(
        f"round(e{k} / ({' + '.join(f'e{j}' for j in _CLASSES)}), 6) AS p{k}" for k in _CLASSES
    )
    + " FROM shifted",
    "linear_argmax": f"WITH {_SCORED} SELECT label, {_COLUMNS}, prediction FROM scored",
    "confusion_counts": f"""
        WITH {_SCORED} SELECT CAST(label AS DOUBLE) AS label, prediction, count(*) AS count
        FROM scored GROUP BY ALL""",
    "class_counts": f"""
        WITH {_SCORED}, sides AS (
          SELECT CAST(label AS DOUBLE) AS class, 1 AS labelled, 0 AS predicted,
                 CAST(label = prediction AS INTEGER) AS hits FROM scored
          UNION ALL SELECT prediction, 0, 1, 0 FROM scored)
        SELECT class, CAST(sum(labelled) AS BIGINT) AS labelled,
               CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(hits) AS BIGINT) AS hits
        FROM sides GROUP BY class""",
    "metrics_all": f"WITH {_SCORED} " + _metrics("SELECT label, prediction FROM scored"),
    "metrics_labels": _metrics("SELECT quality AS label, toxic AS prediction FROM labels"),
    "fit_bands_confusion": f"""
        WITH {_BANDS} SELECT CAST(label AS DOUBLE) AS label,
               prediction, count(*) AS count
        FROM bands GROUP BY ALL""",
    "fit_bands_summary": f"WITH {_BANDS} " + _metrics(_BAND_SCORES, tuple(TRAINING_METRICS)),
    "fit_frequencies": _FREQUENCIES,
    "linear_nonfinite": _nonfinite(),
    "fit_embeddings_scored": f"""
        WITH classes AS (SELECT unnest(range(0, (SELECT max(label) + 1 FROM embeddings))) AS class),
        entries AS (
          SELECT label, unnest(range(-1, {EMBEDDING_SIZE})) AS feature, embedding FROM embeddings),
        cells AS (
          SELECT label, feature,
                 CASE WHEN feature < 0 THEN 1.0 ELSE CAST(embedding[feature + 1] AS DOUBLE) END AS x
          FROM entries)
        SELECT CAST(class AS INTEGER) AS class, CAST(feature AS INTEGER) AS feature,
               round(sum(CASE WHEN label = class THEN x ELSE 0 END) / count(*), 6) + 0.0::DOUBLE AS mean,
               TRUE AS optimal
        FROM cells, classes GROUP BY ALL""",
    "fit_binary_frequencies": """
        WITH shares AS (
          SELECT toxic, count(*) AS rows, CAST(sum(quality) AS DOUBLE) / count(*) AS p
          FROM labels GROUP BY toxic)
        SELECT toxic, CAST(p > 0.5 AS INTEGER)::DOUBLE AS prediction, rows, round(p, 4) AS p1
        FROM shares""",
    "model_roundtrip_score": f"""
        WITH {_BANDS} SELECT label, prediction, count(*) AS rows,
               (SELECT max(label) + 1 FROM bands) AS classes
        FROM bands GROUP BY label, prediction""",
    "scored_parquet_roundtrip": f"""
        WITH {_BANDS} SELECT prediction, count(*) AS rows
        FROM bands GROUP BY prediction""",
    "preview_scored": f"""
        WITH {_BANDS} SELECT l_orderkey, l_partkey, l_suppkey, CAST(high AS DOUBLE) AS high,
               label, prediction
        FROM bands
        ORDER BY l_orderkey, l_partkey, l_suppkey, label, high LIMIT 5""",
    "train_job_metrics": f"WITH {_BANDS} "
    + _metrics(_BAND_SCORES, tuple(TRAINING_METRICS), "training")
    + " UNION ALL "
    + _metrics(_BAND_SCORES, tuple(EVALUATION_METRICS), "validation"),
    "predict_job_metrics": f"WITH {_BANDS} "
    + _metrics(_BAND_SCORES, tuple(EVALUATION_METRICS), "test"),
    "predict_job_rows": f"""
        WITH {_BANDS} SELECT label, CAST(high AS DOUBLE) AS high, prediction FROM bands""",
    "evaluate_staged": f"WITH {_SCORED} "
    + _metrics("SELECT label, prediction FROM scored", tuple(EVALUATION_METRICS)),
}
