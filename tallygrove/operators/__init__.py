from tallygrove.operators.evaluate import confusion, metrics, per_class
from tallygrove.operators.model import classifier, fit, linear_parts, load, save
from tallygrove.operators.prepare import assemble, prepare_table
from tallygrove.operators.score import check_scorer, linear_scores, predictions, score, scorer_weights

__all__ = [
    "assemble",
    "check_scorer",
    "classifier",
    "confusion",
    "fit",
    "linear_parts",
    "linear_scores",
    "load",
    "metrics",
    "per_class",
    "predictions",
    "prepare_table",
    "save",
    "score",
    "scorer_weights",
]
