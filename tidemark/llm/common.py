"""What several operators need: shipping functions to tasks, names in sort order, staged tables."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_path, scratch_path

# Fixed value: the white space that documents are normalised by, as a character class.
WHITE = r"[\x20\x09-\x0D]"

ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 512


def ship(name: str) -> None:
    """Send the functions of a module with the task, so executors need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def give_back() -> None:
    """Return freed memory to the machine: a Python worker lives on, idle, while others work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what Python makes of one stays small beside the batch itself."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def small_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in batches of ``BATCH_ROWS``, if its user chose no size.

    A batch of texts is held several times over, by the executor and by its worker, and Spark's
    own default of 10,000 rows takes far more memory than the work on it.  It changes no result.
    """
    if spark.conf.get(ROWS_PER_BATCH, None) is None:
        spark.conf.set(ROWS_PER_BATCH, str(BATCH_ROWS))


class Scratch:
    """Staged tables of one call, in the folder that all executors share.

    ``stage`` writes a frame once and reads it back: that cuts the lineage, survives a lost
    executor, and fixes ids that would differ when computed again.  ``drop`` removes a table that
    is no longer read; what the returned frame reads stays for the owner of the shared folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self._paths: dict[int, str] = {}

    def stage(self, df: DataFrame, what: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{what}")
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(staged)] = path
        self._keep = getattr(self, "_keep", []) + [staged]
        return staged

    def drop(self, *staged: DataFrame) -> None:
        for df in staged:
            remove_path(self.spark, self._paths.pop(id(df)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_text(column: str = "text"):
    """Null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


ship(__name__)
