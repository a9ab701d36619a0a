"""Insert-if-absent on a key, and its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stage


def first_per_key(rows: DataFrame, key: str, order: list) -> DataFrame:
    """One row per key, the first in ``order``; make ``order`` total for a repeatable choice.

    Catalyst turns the rank filter into a limit per key on both sides of the shuffle, so a key
    that holds a large share of the rows leaves each map task as a single row.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def absent_keys(
    rows: DataFrame, existing: DataFrame, key: str, find_first: bool = False
) -> DataFrame:
    """Rows whose key the target lacks; only the key column of the target is read.

    With ``find_first`` the keys that the target already has are found from the key columns alone
    and staged, so where there are none the rows need not be shuffled at all.  No side is forced:
    adaptive execution sees the bytes of both and picks the join, at every size.
    """
    keys = existing.select(key)
    if not find_first:
        return rows.join(keys, key, "left_anti")
    found = stage(_never_null(rows.select(key)).join(keys, key, "left_semi").distinct(), "found-keys")
    return rows if found.isEmpty() else rows.join(found, key, "left_anti")


def _never_null(keys: DataFrame) -> DataFrame:
    """Text keys declared not null, or the join would first compute each derived key to test it."""
    (column,) = keys.schema.fields
    if not isinstance(column.dataType, T.StringType):
        return keys
    return keys.select(F.coalesce(column.name, F.lit("")).alias(column.name))


def insert_if_absent(
    rows: DataFrame,
    existing: DataFrame,
    key: str,
    order: list | None = None,
    find_first: bool = False,
    unique: bool = False,
) -> DataFrame:
    """The rows to append: first of each key, where the target lacks the key.

    Without ``order`` the first row is the smallest by all columns.  ``unique`` says that no key
    repeats within ``rows`` (count it, do not guess), which saves the deduplication; with
    ``find_first`` too, a load into an empty or disjoint target writes without a wide shuffle.
    A batch with repeated keys is shuffled once, for the deduplication and the anti join.
    """
    if unique:
        return absent_keys(rows, existing, key, find_first)
    order = order or [c for c in rows.columns if c != key] or [key]
    return absent_keys(first_per_key(rows, key, order), existing, key)


def load_counts(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """What a load would report: staged rows, rows inserted, rows skipped.

    Keys are counted before the shuffle, so repeated keys cost nothing to move.
    """
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    present = existing.select(key).distinct().withColumn("_present", F.lit(True))
    inserted = F.count_if(F.col("_present").isNull())
    staged = F.coalesce(F.sum("_n"), F.lit(0))
    return (
        per_key.join(present, key, "left")
        .agg(staged.alias("staged"), inserted.alias("inserted"))
        .withColumn("skipped", F.col("staged") - F.col("inserted"))
    )


def dry_run_counts(valid: DataFrame) -> DataFrame:
    """A dry run writes nothing and counts every valid row as inserted."""
    return valid.agg(F.count(F.lit(1)).alias("inserted")).withColumn(
        "skipped", F.lit(0).cast("long")
    )
