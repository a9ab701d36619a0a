"""Exact deduplication by deterministic block naming, in DataFrame operations only.

A text without its white space is cut into blocks of fixed size.  Distinct blocks are sorted and
named by integers, distinct pairs of neighbouring names are sorted and named in turn, and after
log2(blocks) rounds each document has one name.  A name stands for one content, so equal names of
texts of equal length mean equal texts: no hash decides anything.

Documents whose (length, first block, last block) occurs once need no further rounds: that already
is an identity of their own.  Only the others are named in full.

Cost: two scans; the text is shuffled once, to find the rows that need naming; only blocks of
those are shuffled again.  Copies collapse before the shuffle wherever names are made, and the
joins that bring names back to rows are plain equi-joins, which adaptive execution splits where a
block is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, Scratch, plain_text

END_CHARS = 64  # of the blocks at both ends that settle most documents
BLOCK_CHARS = 4096


def _named(scratch: Scratch, values: DataFrame, what: str) -> DataFrame:
    """Distinct rows with an integer ``name``; staged, so that names stay fixed.

    Equal rows meet in one partition, which is sorted and numbered in order; no two partitions
    share a number.
    """
    ordered = values.distinct().sortWithinPartitions(*values.columns)
    return scratch.stage(ordered.withColumn("name", F.monotonically_increasing_id()), what)


def _identities(
    scratch: Scratch, docs: DataFrame, block_chars: int, keep_columns: bool
) -> tuple[DataFrame, DataFrame]:
    """Staged rows with ``_uid``, and (``_uid``, ``_length``, ``_name``) of those named in full."""
    def squeezed(text: str):
        return F.regexp_replace(plain_text(text), f"{WHITE}+", "")

    texts = docs.select(
        F.col("doc_id").cast("long").alias("_doc_id"),
        F.length(plain_text()).cast("long").alias("_points"),
        squeezed("text").alias("_squeezed"),
        *([F.struct("*").alias("_row")] if keep_columns else []),
    )
    keys = ["_length", "_first", "_last"]
    ends = [
        F.length("_squeezed").alias("_length"),
        F.left("_squeezed", F.lit(END_CHARS)).alias("_first"),
        F.right("_squeezed", F.lit(END_CHARS)).alias("_last"),
    ]
    shared = (
        texts.select(*ends).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    ).select(*keys, F.lit(True).alias("_shared"))
    rows = texts.select("*", *ends)
    if keep_columns:  # the whole row is moved, so its text is squeezed again and not moved twice
        rows = rows.drop("_squeezed").join(shared, keys, "left")
        rows = rows.withColumn("_squeezed", squeezed("_row.text"))
    else:
        rows = rows.join(shared, keys, "left")
    rows = scratch.stage(
        rows.select(
            F.monotonically_increasing_id().alias("_uid"),
            "_doc_id",
            "_points",
            "_length",
            F.sha2("_squeezed", 256).alias("_sha256"),
            F.when(F.col("_shared"), F.col("_squeezed")).alias("_text"),
            *(["_row"] if keep_columns else []),
        ),
        "rows",
    )
    pieces = F.when(F.col("_length") == 0, F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    )
    blocks = rows.where(F.col("_text").isNotNull()).select(
        "_uid",
        "_length",
        F.posexplode(pieces).alias("_at", "_block"),
    )
    dictionary = _named(scratch, blocks.select("_block"), "blocks")
    names = scratch.stage(
        blocks.join(dictionary, "_block").select(
            "_uid", "_length", F.col("_at").cast("long").alias("_at"), "name"
        ),
        "level",
    )
    scratch.drop(dictionary)
    left = names.agg(F.max("_at")).first()[0] or 0
    size = F.col("_length") > block_chars
    done = names.where(~size).select("_uid", "_length", F.col("name").alias("_name"))
    spans = block_chars
    names = names.where(size)
    while left > 0:
        half = F.shiftright("_at", 1).alias("_at")
        pairs = names.groupBy("_uid", "_length", half).agg(
            F.min_by("name", "_at").alias("left"),
            F.when(F.count(F.lit(1)) == 2, F.max_by("name", "_at")).otherwise(-1).alias("right"),
        )
        pairs = scratch.stage(pairs, "pairs")
        dictionary = _named(scratch, pairs.select("left", "right"), "names")
        level = pairs.join(dictionary, ["left", "right"]).select("_uid", "_length", "_at", "name")
        level = scratch.stage(level, "level")
        scratch.drop(pairs, dictionary)
        left, spans = left >> 1, spans * 2
        size = F.col("_length") > spans
        finished = level.where(~size).select("_uid", "_length", F.col("name").alias("_name"))
        done = done.unionByName(finished)
        names = level.where(size)
    return rows, done


def _grouped(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with ``_keep`` (uid and doc_id of the row that stays) and ``_size``."""
    rank = F.struct(-F.col("_points"), F.col("_doc_id").isNull(), "_doc_id", "_uid")
    wide = rows.join(names.select("_uid", "_name"), "_uid", "left")
    groups = (
        wide.where(F.col("_name").isNotNull())
        .groupBy("_length", "_name")
        .agg(F.min(rank).alias("_best"), F.count(F.lit(1)).alias("_size"))
        .where("_size > 1")
    )
    return wide.join(groups, ["_length", "_name"], "left")


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after removal of white space.  Of equal texts the one with the
    most code points stays, then the smallest ``doc_id`` (a null one comes last), then any one of
    rows that agree in both; exactly one row of a group is ``kept``.  Null and empty texts are
    equal to each other.  Repeated rows count as rows.  An empty table gives no rows; columns
    other than ``doc_id`` and ``text`` are not read.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows, names = _identities(scratch, docs, block_chars, keep_columns=False)
    alone = F.col("_best").isNull()
    return _grouped(rows.drop("_text"), names).select(
        F.col("_doc_id").alias("doc_id"),
        F.when(alone, F.col("_doc_id")).otherwise(F.col("_best._doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_best._uid") == F.col("_uid"))).alias("kept"),
        F.col("_sha256").alias("text_sha256"),
    )


def without_exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows that stay, with all their columns, under the rules of :func:`exact_duplicates`."""
    scratch = Scratch(docs.sparkSession, "exact")
    rows, names = _identities(scratch, docs, block_chars, keep_columns=True)
    label = rows.select("_uid", "_doc_id", "_points", "_length")
    dropped = (
        _grouped(label, names)
        .where(F.col("_best._uid") != F.col("_uid"))
        .select("_uid")
    )
    return rows.join(dropped, "_uid", "left_anti").select("_row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS squeezed
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY squeezed) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(squeezed) AS text_sha256
FROM d WINDOW best AS (PARTITION BY squeezed ORDER BY points DESC, doc_id)
"""
