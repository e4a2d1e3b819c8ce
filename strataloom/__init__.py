"""Spark-first analytics over source-repository activity."""
