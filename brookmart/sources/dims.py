"""Dimension and code tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_dim(spark: SparkSession, path: str | None = None, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A dimension table from parquet files or over JDBC, with every column as text.

    For a large JDBC table pass partitionColumn, lowerBound, upperBound and numPartitions.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either a path or JDBC options")
    df = spark.read.parquet(path) if path else spark.read.format("jdbc").options(**jdbc).load()
    return df.select(*[df[c].cast("string").alias(c) for c in df.columns])
