"""Delete of target rows by the keys derived from a range of source ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import uuid5
from tidemark.plans.spec import TransformSpec
from tidemark.sources.series import integer_series
from tidemark.sources.target import Folder


def doomed_keys(
    spark: SparkSession,
    spec: TransformSpec,
    first: int,
    last: int,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Target keys of every id from ``first`` to ``last``.

    All integers of the range are used, so no source is needed.  Where ids are far apart (a range
    much larger than its rows), pass the ``ids`` in use instead; they are limited to the range.
    """
    if ids is None:
        ids = integer_series(spark, first, last, spec.key)
    else:
        ids = ids.select(spec.key).where(F.col(spec.key).between(first, last)).distinct()
    return ids.select(uuid5(F.col(spec.key), spec.namespace).alias(spec.key_output))


def rows_to_keep(target: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    return target.join(doomed, key, "left_anti")


def rows_to_delete(target: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    return target.join(doomed, key, "left_semi")


def split_folders(
    folders: list[Folder], first: int, last: int, drop_whole: bool = True
) -> tuple[list[Folder], list[Folder]]:
    """Folders whose rows all go, and folders that must be read; the rest is left alone."""
    met = [f for f in folders if f.meets(first, last)]
    whole = [f for f in met if drop_whole and f.within(first, last)]
    return whole, [f for f in met if f not in whole]


def bounds_left(folder: Folder, first: int, last: int) -> tuple[int | None, int | None]:
    """Bounds of the ids a folder may still hold without those from ``first`` to ``last``."""
    if folder.first is None or folder.last is None:
        return None, None
    low = last + 1 if first <= folder.first <= last < folder.last else folder.first
    high = first - 1 if folder.first < first <= folder.last <= last else folder.last
    return low, high
