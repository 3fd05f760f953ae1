"""Free SQL over results."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_views(spark: SparkSession, tables: dict[str, str]) -> None:
    """A temporary view for each Parquet table (name -> path)."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
