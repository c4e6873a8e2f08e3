"""Operators for large training-data pipelines, each a set of Spark jobs over whole tables."""
