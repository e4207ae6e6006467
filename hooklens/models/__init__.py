"""Spark ML text features, classifiers and the experiment matrix."""
