"""Spark-first curation engine for text and image metadata."""
