"""Checks: reconciliation of counts, uniqueness, lengths and missing values."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(source_count: DataFrame, counts: DataFrame) -> DataFrame:
    """Compare rows of the source range with rows accounted for in the target.

    ``source_count`` has one row with ``source_count``; ``counts`` has one row with ``inserted``,
    ``skipped`` and ``rejected``.  Rejects are missing from the target and are reported beside.
    """
    zero = F.lit(0).cast("long")
    both = source_count.select(
        "source_count", zero.alias("inserted"), zero.alias("skipped"), zero.alias("rejected")
    ).unionByName(counts.select(zero.alias("source_count"), "inserted", "skipped", "rejected"))
    totals = both.agg(
        *[F.sum(c).alias(c) for c in ("source_count", "inserted", "skipped", "rejected")]
    )
    missing = F.col("source_count") - F.col("target_count")
    return (
        totals.withColumn("target_count", F.col("inserted") + F.col("skipped"))
        .select(
            "source_count",
            "target_count",
            missing.alias("missing"),
            (missing == 0).alias("is_consistent"),
            "rejected",
        )
    )


def duplicates(rows: DataFrame, *keys: str, where: Column | None = None) -> DataFrame:
    """Key values that occur more than once among the rows that match ``where``."""
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def violations(
    rows: DataFrame, row_id: str, limits: dict[str, int], not_null: tuple[str, ...] = ()
) -> DataFrame:
    """One row per value that is too long or missing, from a single scan.

    Rows without a finding are filtered out first, in generated code.
    """
    checks = []
    for column, limit in limits.items():
        size = F.length(column)
        checks.append((size > limit, _finding(column, "too long", size)))
    for column in not_null:
        missing = F.lit(None).cast("int")
        checks.append((F.col(column).isNull(), _finding(column, "null", missing)))
    any_finding = reduce(or_, [F.coalesce(bad, F.lit(False)) for bad, _ in checks])
    found = F.array_compact(F.array(*[F.when(bad, finding) for bad, finding in checks]))
    return rows.where(any_finding).select(F.col(row_id).alias("row_id"), F.inline(found))


def _finding(column: str, problem: str, size: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column_name"),
        F.lit(problem).alias("problem"),
        size.alias("n_chars"),
    )
