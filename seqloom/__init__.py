"""Sequence-similarity analytics on Spark: every operator is a function from DataFrame to DataFrame."""
