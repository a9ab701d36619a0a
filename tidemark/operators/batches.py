"""Dense batch numbers in key order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

SLICE = "_slice"
ROW_BITS = 33  # monotonically_increasing_id keeps the row of a partition in its low 33 bits


def whole_part(number: Column, size: int) -> Column:
    """Integer quotient; a division of doubles is not exact for large numbers."""
    return F.call_function("div", number, F.lit(size).cast("long"))


def number_rows(rows: DataFrame, *order: str, partitions: int | None = None) -> DataFrame:
    """Add ``row_no``: the position of each row, from 0, in the total order ``order``.

    One range shuffle sorts the table into pieces (``partitions``, or the session's number of
    shuffle partitions merged by adaptive execution), which are written once to the shared folder: the bounds are sampled, so a piece computed a second time could differ.  The
    rows per piece are then counted from one column, and the running totals (one number a piece)
    are joined back.  ``order`` must tell rows apart; a column shared by very many rows needs more
    columns after it, and those split it over several pieces.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), *order)
    in_order = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    written = stage(in_order, "numbered")
    piece = F.shiftright("_place", ROW_BITS)
    sizes = written.groupBy(piece.alias("piece")).agg(F.count("*").alias("n_rows")).collect()
    starts, total = [], 0
    for number, size in sorted(sizes):
        starts.append((number, total))
        total += size
    # At most one row per piece, whatever the size of the table.
    start_of = spark.createDataFrame(starts, "_piece long, _start long")
    return (
        written.withColumn("_piece", piece)
        .join(F.broadcast(start_of), "_piece")
        .withColumn("row_no", F.col("_start") + F.col("_place").bitwiseAND((1 << ROW_BITS) - 1))
        .drop("_piece", "_start", "_place")
    )


def assign_batches(
    rows: DataFrame, *order: str, batch_size: int, partitions: int | None = None
) -> DataFrame:
    """Add ``batch_no`` so that each batch holds ``batch_size`` consecutive rows."""
    numbered = number_rows(rows, *order, partitions=partitions)
    batch = whole_part(F.col("row_no"), batch_size)
    return numbered.withColumn("batch_no", batch).drop("row_no")


def nth_batch(batched: DataFrame, number: int) -> DataFrame:
    return batched.where(F.col("batch_no") == number)


def batch_metrics(batched: DataFrame, key: str, error: str = "error") -> DataFrame:
    """Counters and key range of every batch."""
    return batched.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col(error).isNull()).alias("valid"),
        F.count(error).alias("rejected"),
        F.min(key).alias("first_id"),
        F.max(key).alias("last_id"),
    )


def fold_progress(metrics: DataFrame) -> DataFrame:
    """Totals over the batches: sums, the first id once, the last id replaced."""
    return metrics.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("processed").alias("processed"),
        F.sum("valid").alias("valid"),
        F.sum("rejected").alias("rejected"),
        F.min("first_id").alias("first_id"),
        F.max("last_id").alias("last_id"),
    )


def percentage(done: Column, total: Column) -> Column:
    """Share in percent; null while the total is not known or zero."""
    return F.when(total > 0, done / total * 100)


def slice_rows(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Add ``_slice``: consecutive slices of ``size`` rows in key order, no key in two of them.

    The rows are sorted and staged once.  Rows without a key go to the first slice.  A key whose
    rows reach over the end of a slice belongs to the slice it begins in, and that slice takes all
    of them; the place of a row is part of the order, so even a key with very many rows is sorted in
    several pieces.
    """
    place = "_place_of_row"
    keyed = rows.where(F.col(key).isNotNull()).withColumn(place, F.monotonically_increasing_id())
    number = whole_part(F.col("row_no"), size).cast("int")
    numbered = number_rows(keyed, key, place).drop(place).withColumn(SLICE, number)
    ends = numbered.where(F.col("row_no") % size == size - 1).select(key, F.col(SLICE).alias("_first"))
    starts = numbered.where(F.col("row_no") % size == 0).select(key).distinct()
    # A row for each key at the end of a slice that goes on in the next.
    split = stage(ends.join(starts, key).groupBy(key).agg(F.min("_first").alias("_first")), "split")
    numbered = numbered.drop("row_no")
    if not split.isEmpty():
        first = F.coalesce("_first", SLICE)
        numbered = numbered.join(split, key, "left").withColumn(SLICE, first).drop("_first")
    keyless = rows.where(F.col(key).isNull()).withColumn(SLICE, F.lit(0))
    return numbered.unionByName(keyless)
