"""Phishing-message analytics as Spark DataFrame operators."""
