"""Lengths of documents in flat token files that have no index, by a scan for separators.

A file is a row of fixed-width token ids in which an end-of-document id closes each document.  It
is read in blocks that know nothing of documents.  In each block one array comparison finds the
separators; documents that begin and end there are known at once.  What is open at a block's edges
is stitched by a prefix scan over one summary row per block: sums of separators give a document's
number, and the tokens after the last separator are carried to the next block that has one.

The scan over blocks runs in two levels, within groups of ``GROUP`` blocks and over the groups, and
files are read by byte ranges that are dealt over tasks, so that a single file may hold most of the
corpus.  Files are opened by ``pyarrow.fs``, in a folder that driver and executors share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.chat import _codec
from tidemark.llm.common import Scratch, plain_text, ship, slices

BLOCK_TOKENS = 1 << 16
RANGE_BYTES = 16 << 20  # that a row of read_files stands for
GROUP = 4096


def write_blocks(docs: DataFrame, path: str, pattern: str, block: int = BLOCK_TOKENS) -> DataFrame:
    """Token files of documents as rows ``file, block_no, payload``: one file per task.

    Each document is its ids (16-bit, little endian) and the end-of-document id, which is the one
    after the vocabulary.  Blocks are cut at fixed sizes wherever that falls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        end = np.array([codec.turn], "<u2").tobytes()
        file, number, size = TaskContext.get().partitionId(), 0, block * 2
        rest = bytearray()

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, rest
            while len(rest) >= size or last and rest:
                yield pa.RecordBatch.from_pydict(
                    {"file": pa.array([file], pa.int64()), "block_no": pa.array([number], pa.int64()),
                     "payload": pa.array([bytes(rest[:size])], pa.binary())}
                )
                number += 1
                del rest[:size]

        for batch in batches:
            for text in batch.column("text"):
                ids = codec.bpe.encode_ordinary(text.as_py())
                rest += np.array(ids, "<u2").tobytes() + end
                yield from cut(last=False)
        yield from cut(last=True)

    texts = docs.select(plain_text().alias("text"))
    return texts.mapInArrow(run, "file long, block_no long, payload binary")


def write_files(docs: DataFrame, folder: str, path: str, pattern: str) -> DataFrame:
    """Writes flat token files, one per task, and gives ``path, doc_no, doc_id`` of their documents.

    Ids are as in :func:`write_blocks`.  A file has the name of its task's attempt, so what a
    failed or repeated attempt leaves is in no row: stage the rows once, and read their files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        end = np.array([codec.turn], "<u2").tobytes()
        task, number, out, name = TaskContext.get(), 0, None, ""
        for batch in slices(batches):
            if out is None and batch.num_rows:
                store, top = fs.FileSystem.from_uri(folder)
                store.create_dir(top, recursive=True)
                file = f"/{task.partitionId()}-{task.taskAttemptId()}.ids"
                out, name = store.open_output_stream(top + file), folder + file
            for text in batch.column("text"):
                out.write(np.array(codec.bpe.encode_ordinary(text.as_py()), "<u2").tobytes() + end)
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {"path": pa.array([name] * n, pa.string()),
                 "doc_no": pa.array(range(number, number + n), pa.int64()),
                 "doc_id": batch.column("doc_id")}
            )
            number += n
        if out is not None:
            out.close()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    return texts.mapInArrow(run, "path string, doc_no long, doc_id long")


def file_name(path: str = "path"):
    """The number that stands for a file."""
    return F.xxhash64(path)


def read_files(
    spark: SparkSession, paths: list[str], width: int, block: int = BLOCK_TOKENS,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Blocks of flat files, named by a hash of their path.

    The driver holds a row per file.  A task gets ranges of about ``range_bytes``, seeks to each
    and reads it block by block.  Bytes after the last whole id of a file are an error.
    """
    step = block * width
    sizes = []
    for path in sorted(set(paths)):
        store, name = fs.FileSystem.from_uri(path)
        info = store.get_file_info(name)
        if info.type != fs.FileType.File:
            raise FileNotFoundError(path)
        if info.size % width:
            raise ValueError(f"{path}: {info.size} bytes are no whole ids of {width}")
        sizes.append((path, info.size))
    span = max(1, range_bytes // step) * step
    n = sum(-(-size // span) for _, size in sizes)
    ranges = spark.createDataFrame(sizes, "path string, size long").where("size > 0").select(
        "path", file_name().alias("file"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(span).cast("long"))).alias("offset"),
        "size",
    )
    ranges = ranges.select("path", "file", "offset", F.least(F.lit(span), F.col("size") - F.col("offset")).alias("length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, name = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(name) as file:
                    file.seek(row["offset"])
                    for at in range(row["offset"], row["offset"] + row["length"], step):
                        size = min(step, row["offset"] + row["length"] - at)
                        payload = file.read(size)
                        if len(payload) != size:
                            raise OSError(f"{row['path']} ends within {at}:{at + size}")
                        yield pa.RecordBatch.from_pydict(
                            {"file": pa.array([row["file"]], pa.int64()),
                             "block_no": pa.array([at // step], pa.int64()),
                             "payload": pa.array([payload], pa.binary())}
                        )

    return ranges.repartition(max(1, n)).mapInArrow(run, "file long, block_no long, payload binary")


def _scan(separator: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, separators, tails, ends = [], [], [], []
            for payload in batch.column("payload"):
                ids = np.frombuffer(payload.as_buffer(), dtype)
                found = np.flatnonzero(ids == separator)
                sizes.append(len(ids))
                separators.append(len(found))
                tails.append(len(ids) - (found[-1] + 1 if len(found) else 0))
                ends.append(found)
            yield pa.RecordBatch.from_pydict(
                {"file": batch.column("file"), "block_no": batch.column("block_no"),
                 "size": pa.array(sizes, pa.int64()), "separators": pa.array(separators, pa.int64()),
                 "tail": pa.array(tails, pa.int64()), "ends": pa.array(ends, pa.list_(pa.int32()))}
            )

    return run


def prefix_scan(blocks: DataFrame, group: int = GROUP) -> DataFrame:
    """Per block what lies before it in its file: ``tokens_before``, ``docs_before``, ``carry``.

    ``carry`` is the number of tokens since the last separator.
    """
    blocks = blocks.withColumn("_group", F.floor(F.col("block_no") / group))
    # Tokens up to and with the last separator, where a block has one.
    closed = F.when(F.col("separators") > 0, F.col("_upto") + F.col("size") - F.col("tail"))
    inside = Window.partitionBy("file", "_group").orderBy("block_no")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("file").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    here = blocks.withColumn("_upto", F.coalesce(F.sum("size").over(before), none)).withColumn(
        "_closed", closed
    )
    here = here.withColumn("_docs", F.coalesce(F.sum("separators").over(before), none)).withColumn(
        "_last", F.max("_closed").over(before)
    )
    groups = here.groupBy("file", "_group").agg(
        F.sum("size").alias("size"), F.sum("separators").alias("separators"), F.max("_closed").alias("closed")
    )
    groups = groups.withColumn("_tokens", F.coalesce(F.sum("size").over(over), none))
    groups = groups.select(
        "file", "_group", "_tokens",
        F.coalesce(F.sum("separators").over(over), none).alias("_earlier"),
        F.coalesce(F.max(F.col("_tokens") + F.col("closed")).over(over), none).alias("_earlier_end"),
    )
    tokens = F.col("_tokens") + F.col("_upto")
    last = F.coalesce(F.col("_tokens") + F.col("_last"), F.col("_earlier_end"))
    return here.join(groups, ["file", "_group"]).select(
        *[c for c in blocks.columns if c != "_group"],
        tokens.alias("tokens_before"),
        (F.col("_earlier") + F.col("_docs")).alias("docs_before"),
        (tokens - last).alias("carry"),
    )


def count_tokens(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """One row per document: ``file, doc_no, start, n_tokens``, without the separator.

    ``blocks`` has ``file, block_no, payload``; blocks of a file are numbered from 0 without gaps
    and hold whole ids.  Neighbouring separators give a document of no tokens.  Tokens after the
    last separator of a file are a document of their own.  Empty blocks and an empty table give
    nothing; null payloads count as empty; other columns are not read.
    """
    scratch = Scratch(blocks.sparkSession, "tokens")
    rows = blocks.select("file", "block_no", F.coalesce("payload", F.lit(b"")).alias("payload"))
    found = rows.mapInArrow(
        _scan(separator, dtype),
        "file long, block_no long, size long, separators long, tail long, ends array<int>",
    )
    found = scratch.stage(found, "separators")
    places = prefix_scan(found.drop("ends"))
    end = F.col("tokens_before") + F.col("end")
    start = F.when(F.col("i") == 0, F.col("tokens_before") - F.col("carry")).otherwise(
        F.col("tokens_before") + F.col("previous") + 1
    )
    ends = F.transform("ends", lambda e, i: F.struct(i.alias("i"), e.alias("end"), F.get("ends", i - 1).alias("previous")))
    closed = (
        places.join(found.select("file", "block_no", "ends"), ["file", "block_no"])
        .select("file", "tokens_before", "docs_before", "carry", F.inline(ends))
        .select(
            "file", (F.col("docs_before") + F.col("i")).alias("doc_no"), start.alias("start"),
            (end - start).alias("n_tokens"),
        )
    )
    final = places.groupBy("file").agg(
        F.sum("separators").alias("doc_no"),
        F.sum("size").alias("all"),
        F.max(
            F.when(F.col("separators") > 0, F.col("tokens_before") + F.col("size") - F.col("tail"))
        ).alias("last"),
    )
    start = F.coalesce("last", F.lit(0).cast("long"))
    rest = final.select("file", "doc_no", start.alias("start"), (F.col("all") - start).alias("n_tokens"))
    return closed.unionByName(rest.where("n_tokens > 0"))


ship(__name__)
