"""Snapshot scan of a file-based source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_snapshot(
    spark: SparkSession,
    location: str,
    columns: list[str] | None = None,
    schema: T.StructType | str | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Read named columns of a source as one consistent view.

    The list of files is fixed when the DataFrame is made, so every count and scan built on the
    same DataFrame sees the same rows although the source keeps growing.  A declared ``schema``
    saves the footer read for inference.
    """
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    source = reader.load(location)
    return source if columns is None else source.select(*columns)
