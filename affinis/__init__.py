"""Recommendation, text-mining and clustering operators as Spark DataFrame functions."""
