"""Operators of a training-data pipeline: filtering, deduplication,
decontamination, formatting and packing of text corpora on Spark."""
