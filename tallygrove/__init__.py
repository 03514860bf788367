"""Tabular classification on Spark: prepare, fit, score, evaluate, persist."""
