"""Spark-first extraction and cleaning of advertisement text."""
