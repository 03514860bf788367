from tallygrove.plans.jobs import (
    EVALUATION_METRICS,
    TRAINING_METRICS,
    PredictReport,
    Source,
    TrainReport,
    evaluate,
    predict_job,
    prepared,
    train_job,
)

__all__ = [
    "EVALUATION_METRICS",
    "TRAINING_METRICS",
    "PredictReport",
    "Source",
    "TrainReport",
    "evaluate",
    "predict_job",
    "prepared",
    "train_job",
]
