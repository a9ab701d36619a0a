"""Watermark and range filters, counts, key bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def after_watermark(rows: DataFrame, key: str, watermark: int | None) -> DataFrame:
    """Rows above the watermark; ``None`` means no lower bound, so ids of zero and less move too."""
    return rows if watermark is None else rows.where(F.col(key) > watermark)


def key_range(rows: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """Rows with a key from ``first`` to ``last``, both included."""
    return rows.where(F.col(key).between(first, last))


def key_bounds(rows: DataFrame, key: str) -> tuple[int, int] | None:
    """Lowest and highest key, or ``None`` where there is none. Reads the key column only."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    return None if low is None else (low, high)


def remaining_count(rows: DataFrame, key: str, watermark: int | None) -> DataFrame:
    return after_watermark(rows, key, watermark).agg(F.count(key).alias("remaining"))


def labelled_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: its label, all rows, and rows with a value in the given column."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_keys")).select(
            F.lit(label).alias("info"), "n_rows", "n_keys"
        )
        for label, (rows, column) in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result
