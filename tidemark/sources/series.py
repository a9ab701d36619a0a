"""Integer series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def integer_series(
    spark: SparkSession, first: int, last: int, name: str = "n", partitions: int | None = None
) -> DataFrame:
    """``first`` to ``last``, both included, spread over the cluster without a source."""
    return spark.range(first, last + 1, 1, partitions).withColumnRenamed("id", name)
