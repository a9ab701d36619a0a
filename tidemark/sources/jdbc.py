"""Relational databases as source and sink, through Spark's JDBC data source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class DatabaseConfig:
    host: str
    name: str
    user: str
    password: str
    port: int = 5432
    sslmode: str = "disable"
    driver: str = "org.postgresql.Driver"

    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.name}?sslmode={self.sslmode}"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url(),
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


def partition_options(
    key: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options that split the read by key range. The bounds only set the stride: no row is lost."""
    return {
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(
    spark: SparkSession,
    config: DatabaseConfig,
    table: str,
    key: str,
    columns: list[str],
    partitions: int = 32,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read ``table`` in parallel by key range, with filters and columns pushed to the database.

    Each partition uses its own connection, so the parts are not one database snapshot: register
    such a source with ``stage=True`` and a job copies it once before it counts and loads.
    """
    reader = spark.read.format("jdbc").options(**config.options())
    bounds = (
        reader.option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}")
        .load()
        .first()
    )
    reader = spark.read.format("jdbc").options(**config.options()).option("dbtable", table)
    if bounds.lo is not None:
        reader = reader.options(
            **partition_options(key, bounds.lo, bounds.hi + 1, partitions, fetch_size)
        )
    return reader.load().select(*columns)


def write_jdbc(
    df: DataFrame, config: DatabaseConfig, table: str, batch_size: int = 10_000
) -> None:
    """Append rows that are known to be absent. Give the table a staging name to keep it atomic."""
    (
        df.write.format("jdbc")
        .options(**config.options())
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
