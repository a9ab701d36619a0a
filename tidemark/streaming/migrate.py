"""The same load as a Structured Streaming job over files that keep arriving."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.jobs import Migration
from tidemark.plans.spec import lookup
from tidemark.session import is_folder


def file_stream(
    spark: SparkSession,
    location: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """New parquet files of a folder; files or bytes per micro-batch hold the load back.

    A single file works as well: it is the only one of its folder that is taken.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if is_folder(spark, location):
        return reader.load(location)
    folder, name = location.rstrip("/").rsplit("/", 1)
    return reader.option("pathGlobFilter", name).load(folder)


class StreamStopped(Exception):
    """Raised inside a micro-batch that must not be moved any more."""


def stream_job(
    migration: Migration,
    job_id: str,
    stream: DataFrame,
    checkpoint: str,
    processing_time: str | None = None,
    should_stop: Callable[[], bool] | None = None,
) -> StreamingQuery:
    """Start a streaming run of a job; without ``processing_time`` it drains the source and ends.

    The checkpoint remembers the files already moved, so a stopped query goes on where it was.  A
    micro-batch that is run again replaces its own load and adds nothing.  Before each micro-batch
    the run asks ``should_stop`` and the ledger whether to end; a batch that is not moved for that
    is the first of the next run.
    """
    run_id = uuid.uuid4().hex
    job = migration.mark_running(job_id, run_id)
    spec = lookup(job.source_table, job.target_table)

    def load(rows: DataFrame, batch_id: int) -> None:
        if (should_stop is not None and should_stop()) or migration.stop_requested(job_id, run_id):
            raise StreamStopped(run_id)
        migration.load(job, spec, rows, f"{job_id}.batch-{batch_id}")

    trigger = {"availableNow": True}
    if processing_time is not None:
        trigger = {"processingTime": processing_time}
    try:
        return (
            stream.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .queryName(run_id)
            .trigger(**trigger)
            .start()
        )
    except BaseException:
        migration.end_run(job_id, run_id, "failed")
        raise


def finish_stream(migration: Migration, job_id: str, query: StreamingQuery) -> None:
    """Wait for a run to end, and record how it did: drained, stopped or failed.

    The total is known once the source is drained.
    """
    run_id = query.name
    try:
        query.awaitTermination()
    except BaseException as error:
        stopped = StreamStopped.__name__ in str(error)
        migration.end_run(job_id, run_id, "paused" if stopped else "failed")
        if stopped:
            return
        raise
    if migration.stop_requested(job_id, run_id):
        migration.end_run(job_id, run_id, "paused")
        return
    migration.record_total(job_id)
    migration.end_run(job_id, run_id, "completed")


def pause_stream(migration: Migration, job_id: str, query: StreamingQuery) -> None:
    """Stop a running query; a micro-batch that was cut off runs again at the next start.

    This also ends a stream that waits for files and would see a request only with the next ones.
    """
    query.stop()
    migration.end_run(job_id, query.name, "paused")
