"""Operators of a training-data pipeline: filtering, deduplication, mixing and materialisation of text."""
