"""Folds over an append-only table of job events.

Every fold is a grouped aggregate with partial sums before the shuffle, so a job that owns a large
share of the events does not load one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.batches import number_rows, whole_part

# The states of a job.
STATUSES = ["pending", "running", "paused", "completed", "failed", "rolled_back"]
ACTIVE = ["pending", "running"]

# State changes that are allowed; the first state of a job follows "none".
ALLOWED_CHANGES = [
    ("none", "pending"),
    ("pending", "running"),
    ("running", "paused"),
    ("running", "completed"),
    ("running", "failed"),
    ("paused", "running"),
    ("failed", "running"),
    ("paused", "rolled_back"),
    ("completed", "rolled_back"),
    ("failed", "rolled_back"),
]


@dataclass(frozen=True)
class EventColumns:
    """Names of the columns of an event table; ``seq`` orders the events and is unique."""

    job: str = "job_id"
    seq: str = "seq"
    status: str = "status"
    at: str = "at"


def latest_status(columns: EventColumns = EventColumns()) -> Column:
    """Aggregate: the status with the highest ``seq``; null statuses do not count.

    The status travels as a small number, which keeps the fold in a hash aggregate.
    """
    names = F.array(*[F.lit(s) for s in STATUSES])
    code = F.array_position(names, F.col(columns.status))
    when_set = F.when(F.col(columns.status).isNotNull(), F.col(columns.seq))
    return F.get(names, F.max_by(code, when_set).cast("int") - 1)


def latest_state(events: DataFrame, columns: EventColumns = EventColumns()) -> DataFrame:
    """Current state of every job."""
    return events.groupBy(columns.job).agg(
        latest_status(columns).alias("status"),
        F.count(F.lit(1)).alias("n_events"),
        F.max(columns.seq).alias("last_seq"),
        F.min(columns.at).alias("created_at"),
        F.max(columns.at).alias("updated_at"),
    )


def status_times(events: DataFrame, columns: EventColumns = EventColumns()) -> DataFrame:
    """When each job first and last started, completed, and was rolled back."""

    def time_of(status: str) -> Column:
        return F.when(F.col(columns.status) == status, F.col(columns.at))

    return events.groupBy(columns.job).agg(
        F.min(time_of("running")).alias("first_started_at"),
        F.max(time_of("running")).alias("started_at"),
        F.max(time_of("completed")).alias("completed_at"),
        F.max(time_of("failed")).alias("failed_at"),
        F.max(time_of("rolled_back")).alias("rolled_back_at"),
    )


def with_status(jobs: DataFrame, status: str | None, job: str = "job_id") -> DataFrame:
    """Jobs in a state (all for ``None``), newest first."""
    chosen = jobs if status is None else jobs.where(F.col("status") == status)
    return chosen.orderBy(F.desc("created_at"), job)


def latest_completed(
    runs: DataFrame, pair: list[str], newest: str, values: list[str]
) -> DataFrame:
    """The newest completed run of every pair; ``newest`` is unique and orders the runs."""
    return (
        runs.where(F.col("status") == "completed")
        .groupBy(*pair)
        .agg(*[F.max_by(v, newest).alias(v) for v in values])
    )


def resume_points(
    runs: DataFrame, pair: list[str], newest: str, last_id: str, start_after: str | None = None
) -> DataFrame:
    """Where the next run of every pair starts: after the highest id its newest completed run read.

    A run that read nothing hands on its own start.  Dry runs wrote nothing and do not count.
    """
    reached = F.col(last_id) if start_after is None else F.coalesce(last_id, start_after)
    real = runs.where(~F.col("dry_run")).withColumn("resume_after", reached)
    return latest_completed(real, pair, newest, ["resume_after"])


def bad_transitions(
    spark: SparkSession,
    events: DataFrame,
    columns: EventColumns = EventColumns(),
    chunk_width: int = 1 << 17,
) -> DataFrame:
    """State changes that are not allowed.

    The events are numbered in the order of job and ``seq``, and the previous state is looked up
    within chunks of ``chunk_width`` of them, however far apart their ``seq`` are: no task holds
    more than that many events of one job.  The last state of each chunk is carried to the next one
    from a table of one row per job and chunk.
    """
    job, seq, status = columns.job, columns.seq, columns.status
    # Events that report something else carry no status and are no change of it.
    changing = events.where(F.col(status).isNotNull()).select(job, seq, status)
    chunked = number_rows(changing, job, seq).withColumn(
        "_chunk", whole_part(F.col("row_no"), chunk_width)
    )
    inside = Window.partitionBy(job, "_chunk").orderBy(seq)
    chunk_ends = chunked.groupBy(job, "_chunk").agg(latest_status(columns).alias("_end"))
    carried = chunk_ends.select(
        job,
        "_chunk",
        F.lag("_end").over(Window.partitionBy(job).orderBy("_chunk")).alias("_carried"),
    )
    changes = (
        chunked.withColumn("_inside", F.lag(status).over(inside))
        .join(carried, [job, "_chunk"])
        .select(
            job,
            seq,
            F.coalesce("_inside", "_carried", F.lit("none")).alias("previous_status"),
            status,
        )
    )
    # A fixed table of ten rows.
    allowed = spark.createDataFrame(ALLOWED_CHANGES, f"previous_status string, {status} string")
    return changes.join(F.broadcast(allowed), ["previous_status", status], "left_anti")


def error_pages(errors: DataFrame, page: list[str], id_name: str = "id") -> DataFrame:
    """Error entries as JSON arrays with their sizes, one array per page.

    ``page`` must bound its group, as a batch number or a load does: an array of all errors of a
    job would have to fit into one row.
    """
    entry = F.struct(F.col(id_name), F.col("error"))
    return errors.groupBy(*page).agg(
        F.to_json(F.sort_array(F.collect_list(entry))).alias("errors"),
        F.count(F.lit(1)).alias("total"),
    )


def parse_errors(pages: DataFrame, keep: list[str], id_name: str = "id") -> DataFrame:
    """Rows back from the JSON arrays."""
    schema = f"array<struct<{id_name}:bigint,error:string>>"
    return pages.select(*keep, F.inline(F.from_json("errors", schema)))
