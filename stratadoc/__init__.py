"""Spark-first document analytics and retrieval engine."""
