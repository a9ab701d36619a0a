"""Reconciliation that finds the rows: checksums of key ranges, then only the ranges that differ.

Both tables are read once to add up, for every range of ``2**LEAF_BITS`` keys, the rows and their
hashes, those of the second table with a minus: a range whose sums are all zero holds the same
rows, in whatever order.  The sums are formed before the shuffle, which carries a row per range.
Ranges that differ, in number at most the differences, are looked at again: coarser levels are
made of them until at most ``MAX_INTERVALS`` remain, and these reach both scans as bounds of the
key.  Within them only keys of differing ranges are added up one by one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

LEAF_BITS = 12
FAN_BITS = 6  # a range of a level is made of 2**FAN_BITS ranges of the level below
LEVELS = (63 - LEAF_BITS) // FAN_BITS + 1  # the coarsest has a handful of ranges in all
MAX_INTERVALS = 64

# The hash is added up in three parts, so sums hold for 2**41 rows of one range.
PART_BITS = 22
PARTS = ("low", "middle", "high")
SUMS = ("n", *PARTS)


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _hashed(rows: DataFrame, key: str, columns: list[str], sign: int) -> DataFrame:
    """``key``, and what a row adds to the sums of its range."""
    # A null leaves the hash as it was, so where nulls are is hashed as well.
    value = F.xxhash64(*[x for c in columns for x in (_name(c), _name(c).isNull())])
    mask = (1 << PART_BITS) - 1
    hashed = rows.where(_name(key).isNotNull()).select(_name(key).cast("long").alias("key"), value.alias("h"))
    pieces = (
        F.col("h").bitwiseAND(mask),
        F.shiftrightunsigned("h", PART_BITS).bitwiseAND(mask),
        F.shiftrightunsigned("h", 2 * PART_BITS),
    )
    return hashed.select(
        "key", F.lit(sign).cast("long").alias("n"),
        *[(piece * sign).alias(part) for piece, part in zip(pieces, PARTS)],
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS]


def _differs() -> Column:
    return reduce(or_, [F.col(c) != 0 for c in SUMS])


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``range``: the number, ``key >> LEAF_BITS``, of every range whose rows are not the same."""
    both = _hashed(left, key, columns, 1).unionAll(_hashed(right, key, columns, -1))
    leaves = both.groupBy(F.shiftright("key", LEAF_BITS).alias("range")).agg(*_sums())
    return leaves.where(_differs()).select("range")


def key_intervals(ranges: DataFrame) -> list[tuple[int, int]]:
    """First and last key of at most ``MAX_INTERVALS`` intervals that cover the ranges."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level")
    up = F.expr(f"shiftright(range, level * {FAN_BITS})")
    tree = ranges.select("range", levels).select("level", up.alias("range")).distinct()
    # One row per level.
    widths = tree.groupBy("level").count().where(F.col("count") <= MAX_INTERVALS)
    finest = widths.agg(F.min("level")).first()[0]
    if finest is None:
        return []
    bits = LEAF_BITS + finest * FAN_BITS
    found = sorted(row.range for row in tree.where(F.col("level") == finest).collect())
    return [(number << bits, ((number + 1) << bits) - 1) for number in found]


def row_differences(
    left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None
) -> DataFrame:
    """``row_key, difference`` of every key whose rows are not the same in both tables.

    ``missing``: only ``left`` has the key; ``extra``: only ``right`` has it; ``changed``: both do,
    with other values or another number of rows.  ``columns`` are compared (default: all of
    ``left``), by a 64-bit hash of their values and types; null equals null only.  The order of rows
    does not matter, repeated rows count as often as they occur.  The key must be an integer; rows
    without a key cannot be named and are left out.  Equal or empty tables give no rows.  Maps
    cannot be compared.
    """
    columns = columns or left.columns
    ranges = stage(differing_ranges(left, right, key, columns), "differing-ranges")
    intervals = key_intervals(ranges)
    inside = reduce(or_, [_name(key).between(a, b) for a, b in intervals], F.lit(False))
    near = _hashed(left.where(inside), key, columns, 1).unionAll(
        _hashed(right.where(inside), key, columns, -1)
    )
    near = near.withColumn("range", F.shiftright("key", LEAF_BITS)).join(ranges, "range", "left_semi")
    per_key = near.groupBy("key").agg(
        *_sums(), F.max(F.col("n") > 0).alias("in_left"), F.max(F.col("n") < 0).alias("in_right")
    )
    difference = F.when(~F.col("in_right"), "missing").when(~F.col("in_left"), "extra").otherwise("changed")
    return per_key.where(_differs()).select(F.col("key").alias("row_key"), difference.alias("difference"))
