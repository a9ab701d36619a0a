"""Migration jobs: create, start or resume, stop, roll back, validate, and their ledger.

The ledger is a log of numbered commits.  A change of a job's state is decided from the commits so far
and put as the next one, so of several drivers that decide at the same time one wins and the others decide
again.  Data is always written and listed before the event that reports it, and a load that runs
again replaces what it had listed, so a crash between the two is repaired by running again.
"""

from __future__ import annotations

import datetime
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import batches, extract, ledger, load, quality, rollback, transform
from tidemark.plans.spec import TransformSpec, lookup
from tidemark.session import list_names, path_exists, remove_path, run_folder, scratch_path, stage
from tidemark.sources.commits import CHECKPOINT, CommitLog
from tidemark.sources.target import Folder, TargetTable

def _struct(**types: str) -> T.StructType:
    schema = T.StructType()
    for name, data_type in types.items():
        schema.add(name, data_type)
    return schema


EVENTS = _struct(
    seq="long",
    at="timestamp",
    job_id="string",
    status="string",
    source_table="string",
    target_table="string",
    batch_size="integer",
    batch_delay_ms="integer",
    dry_run="boolean",
    start_after="long",
    total_records="long",
    load_id="string",
    processed="long",
    success="long",
    failed="long",
    skipped="long",
    first_id="long",
    last_id="long",
    target_version="integer",
    run_id="string",
    stop_run="string",
)
ERROR_FILE = _struct(id="long", error="string")
ERRORS = _struct(id="long", error="string", job_id="string", load_id="string")


COUNTERS = ("processed", "success", "failed", "skipped")

# What decides whether a job's state may change.
CONTROL = ("status", "source_table", "target_table", "run_id", "stop_run")

# Events of a commit are in order of their place; the number of the commit comes before it.
PLACE_BITS = 32

# Folded per load first, then per job; the last status is kept as its number in the list.
STATUS_NAMES = f"array({', '.join(repr(s) for s in ledger.STATUSES)})"
JOBS = f"""
WITH loads AS (
  SELECT job_id, load_id,
         max(source_table) AS source_table, max(target_table) AS target_table,
         max(batch_size) AS batch_size, max(batch_delay_ms) AS batch_delay_ms,
         max(dry_run) AS dry_run, max(start_after) AS start_after,
         max_by(total_records, seq) FILTER (WHERE total_records IS NOT NULL) AS total_records,
         max(seq) FILTER (WHERE total_records IS NOT NULL) AS total_seq,
         max_by(array_position({STATUS_NAMES}, status), seq) FILTER (WHERE status IS NOT NULL)
           AS status_no,
         max_by(run_id, seq) FILTER (WHERE status = 'running') AS run_id,
         max_by(stop_run, seq) FILTER (WHERE stop_run IS NOT NULL) AS stop_run,
         max_by(processed, seq) AS processed, max_by(success, seq) AS success,
         max_by(failed, seq) AS failed, max_by(skipped, seq) AS skipped,
         max_by(first_id, seq) AS first_id, max_by(last_id, seq) AS last_id,
         min(seq) AS created_seq, min(at) AS created_at, max(at) AS updated_at,
         max(at) FILTER (WHERE status = 'running') AS started_at,
         max(at) FILTER (WHERE status = 'completed') AS completed_at,
         max(at) FILTER (WHERE status = 'rolled_back') AS rolled_back_at
  FROM {{events}} GROUP BY job_id, load_id)
SELECT job_id, max(source_table) AS source_table, max(target_table) AS target_table,
       get({STATUS_NAMES}, CAST(max(status_no) AS INT) - 1) AS status,
       coalesce(max_by(total_records, total_seq), 0L) AS total_records,
       coalesce(sum(processed), 0L) AS processed, coalesce(sum(success), 0L) AS success,
       coalesce(sum(failed), 0L) AS failed, coalesce(sum(skipped), 0L) AS skipped,
       min(first_id) AS first_processed_id, max(last_id) AS last_processed_id,
       max(batch_size) AS batch_size, max(batch_delay_ms) AS batch_delay_ms,
       max(dry_run) AS dry_run, max(start_after) AS start_after,
       max(run_id) AS run_id, max(stop_run) AS stop_run,
       min(created_seq) AS created_seq, min(created_at) AS created_at,
       max(updated_at) AS updated_at, max(started_at) AS started_at,
       max(completed_at) AS completed_at, max(rolled_back_at) AS rolled_back_at
FROM loads GROUP BY job_id
"""


class JobStateError(RuntimeError):
    """The job's state does not allow the request."""


@dataclass(frozen=True)
class Source:
    """How to read a source table.

    ``stage`` copies the rows to move once at the start of a run; set it where two reads of the
    source may differ, as with a database.
    """

    read: Callable[[SparkSession], DataFrame]
    stage: bool = False


class Migration:
    """Jobs over the tables below ``root``: ``ledger/``, ``errors/`` and ``targets/<name>/``."""

    def __init__(self, spark: SparkSession, root: str, sources: dict[str, Source]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sources = sources
        self.ledger = CommitLog(spark, f"{self.root}/ledger")
        self._states: tuple[int, dict[str, dict]] = (0, {})

    # -- jobs ---------------------------------------------------------------------------------

    def create_job(
        self,
        source_table: str,
        target_table: str,
        batch_size: int | None = None,
        batch_delay_ms: int = 0,
        dry_run: bool = False,
    ) -> str:
        """Record a pending job that starts where the last completed run of the pair ended.

        ``batch_size`` is the number of rows per commit; ``None`` moves everything in one pass,
        which is the fastest, and smaller commits are for runs that must be stopped in between.
        """
        lookup(source_table, target_table)
        if batch_size is not None and batch_size <= 0:
            raise ValueError("batch_size must be positive")
        pair = (F.col("source_table") == source_table) & (F.col("target_table") == target_table)
        done = (F.col("status") == "completed") & ~F.col("dry_run")
        reached = F.coalesce("last_processed_id", "start_after")
        job_id = str(uuid.uuid4())

        def decide(states: dict[str, dict], number: int) -> dict:
            for job in states.values():
                own = (job["source_table"], job["target_table"]) == (source_table, target_table)
                if own and job["status"] in ledger.ACTIVE:
                    raise JobStateError(
                        "this pair has a job that is pending or running: wait for it or stop it"
                    )
            runs = self._jobs(self._events(number)).where(pair & done)
            known = runs.agg(F.max_by(reached, "created_seq").alias("resume_after")).first()
            return {
                "status": "pending",
                "source_table": source_table,
                "target_table": target_table,
                "batch_size": batch_size,
                "batch_delay_ms": batch_delay_ms,
                "dry_run": dry_run,
                "start_after": known.resume_after,
            }

        self._decide(job_id, decide)
        return job_id

    def start_job(
        self,
        job_id: str,
        should_stop: Callable[[], bool] | None = None,
        slices_per_commit: int | None = None,
    ) -> Row:
        """Run a pending, paused or failed job.

        A job with a batch size commits ``slices_per_commit`` slices at a time, in one write and
        one ledger commit however many there are.  The default is all of them, or one by one if
        there is something to do in between: ``should_stop``, which is asked before every commit,
        or a delay.  A stop through the ledger takes effect between commits too.
        """
        run_id = uuid.uuid4().hex
        job = self.mark_running(job_id, run_id)
        try:
            status = self._run(job, run_id, should_stop, slices_per_commit)
        except BaseException:
            self.end_run(job_id, run_id, "failed")
            raise
        self.end_run(job_id, run_id, status)
        return self.get_job(job_id)

    def end_run(self, job_id: str, run_id: str, status: str) -> None:
        """Record how a run ended, unless somebody has taken the job away from it."""

        def decide(states: dict[str, dict], number: int) -> dict | None:
            job = self._known(states, job_id)
            own = job["status"] == "running" and job["run_id"] == run_id
            return {"status": status} if own else None

        self._decide(job_id, decide)

    def mark_running(self, job_id: str, run_id: str | None = None) -> Row:
        """Take a job that may start into the running state, and return how it was before.

        Of several drivers that do so for one target exactly one succeeds.  ``run_id`` names a run
        that will see requests to stop and record its own end.
        """

        def decide(states: dict[str, dict], number: int) -> dict:
            job = self._known(states, job_id)
            if job["status"] == "running":
                raise JobStateError("this job runs at the moment")
            if job["status"] in ("completed", "rolled_back"):
                raise JobStateError(f"a {job['status']} job cannot be started again")
            for other in states.values():
                if other["target_table"] == job["target_table"] and other["status"] == "running":
                    raise JobStateError("another job is writing to this target")
            return {"status": "running", "run_id": run_id}

        number = self._decide(job_id, decide)
        return self._job(self._jobs(self._events(number - 1)), job_id)

    def mark(self, job_id: str, status: str) -> None:
        """Change a job's state, if that change is allowed."""

        def decide(states: dict[str, dict], number: int) -> dict:
            now = states[job_id]["status"] if job_id in states else "none"
            if (now, status) not in ledger.ALLOWED_CHANGES:
                raise JobStateError(f"a job cannot go from {now} to {status}")
            return {"status": status}

        self._decide(job_id, decide)

    def record_total(self, job_id: str) -> None:
        """Take what was read so far as the job's total, where it is known only at the end."""
        self._append(job_id, total_records=self.get_job(job_id).processed)

    def stop_job(self, job_id: str, abandoned: bool = False) -> None:
        """Ask a running job to stop.

        Its run ends before its next commit and records the pause itself, so a paused job has no
        write under way.  A job that no run looks after is paused at once; so is one whose driver
        is known to be gone, if it is given up as ``abandoned``.
        """

        def decide(states: dict[str, dict], number: int) -> dict:
            job = self._known(states, job_id)
            if job["status"] != "running":
                raise JobStateError("only a running job can be stopped")
            if job["run_id"] is None or abandoned:
                return {"status": "paused"}
            return {"stop_run": job["run_id"]}

        self._decide(job_id, decide)

    def stop_requested(self, job_id: str, run_id: str) -> bool:
        """Whether a run should end: it was asked to, or is not the job's run any more."""
        job = self._known(self._states_at(self.ledger.latest()), job_id)
        return job["status"] != "running" or job["run_id"] != run_id or job["stop_run"] == run_id

    def rollback_job(self, job_id: str, ids: DataFrame | None = None) -> int:
        """Delete the target rows of the job's whole id range and return how many there were.

        Rows of the range that an earlier job had inserted go too.  ``ids`` replaces the integers
        of the range where the ids in use are few and far apart.  Folders outside the range are
        neither read nor written, those inside it leave the list unread, and only folders that
        straddle it are written anew.
        """
        job = self.get_job(job_id)
        if job.status in ledger.ACTIVE:
            raise JobStateError(f"cannot roll back a {job.status} job: stop it first")
        if job.status == "rolled_back":
            raise JobStateError("its rows were rolled back before")
        if job.dry_run or job.first_processed_id is None:
            raise JobStateError("nothing was loaded that could be rolled back")
        self._check_idle(self._states_at(self.ledger.latest()), job)
        spec = lookup(job.source_table, job.target_table)
        target = self.target(spec)
        first, last = job.first_processed_id, job.last_processed_id
        version = target.version()
        before = target.folders()
        gone, kept = rollback.split_folders(before, first, last, drop_whole=ids is None)
        deleted = sum(f.rows for f in gone)
        rewritten = []
        for folder in kept:
            low = first if folder.first is None else max(first, folder.first)
            high = last if folder.last is None else min(last, folder.last)
            doomed = rollback.doomed_keys(self.spark, spec, low, high, ids)
            rows = rollback.rows_to_keep(target.read_folders([folder]), doomed, spec.key_output)
            bounds = rollback.bounds_left(folder, first, last)
            rewritten.append(target.write_folder(rows, folder.load_id, *bounds))
            deleted += folder.rows - rewritten[-1].rows

        def change(live: list[Folder]) -> tuple[list[Folder], list[Folder]]:
            if {f.name for f in live} != {f.name for f in before}:
                raise JobStateError("the target changed while its rows were rolled back: try again")
            return [f for f in rewritten if f.rows], gone + kept

        target.list_folders(change, version + 1)

        def decide(states: dict[str, dict], number: int) -> dict:
            self._check_idle(states, job)
            return {"status": "rolled_back"}

        self._decide(job_id, decide)
        return deleted

    @staticmethod
    def _check_idle(states: dict[str, dict], job: Row) -> None:
        for other in states.values():
            if other["target_table"] == job.target_table and other["status"] in ledger.ACTIVE:
                raise JobStateError("cannot roll back while another job of the target is active")

    def validate_job(self, job_id: str) -> DataFrame:
        """Rows of the source range against the rows the job accounts for."""
        job = self.get_job(job_id)
        if job.first_processed_id is None:
            raise JobStateError("no range to validate: no row was read so far")
        spec = lookup(job.source_table, job.target_table)
        source = self.sources[spec.source].read(self.spark)
        in_range = extract.key_range(
            source, spec.key, job.first_processed_id, job.last_processed_id
        )
        counts = self.spark.range(1).select(
            F.lit(job.success).alias("inserted"),
            F.lit(job.skipped).alias("skipped"),
            F.lit(job.failed).alias("rejected"),
        )
        result = quality.reconcile(in_range.agg(F.count(spec.key).alias("source_count")), counts)
        return result.select(
            F.lit(job_id).alias("job_id"), F.lit(spec.source).alias("source_table"), "*"
        )

    # -- views --------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        return self._events(self.ledger.latest())

    def _events(self, number: int) -> DataFrame:
        """All events of the commits up to ``number``: the newest checkpoint and what follows."""
        start = self.ledger.checkpoint() if number >= CHECKPOINT else 0
        files = [self.ledger.file(n) for n in range(start + 1, number + 1)]
        events = None
        if start:
            events = self.spark.read.schema(EVENTS).parquet(self.ledger.checkpoint_path(start))
        if files:
            commit = F.regexp_substr("_metadata.file_name", F.lit("[0-9]+")).cast("long")
            seq = F.shiftleft(commit, PLACE_BITS) + F.col("seq")
            rows = self.spark.read.schema(EVENTS).json(files).withColumn("seq", seq)
            events = rows if events is None else events.unionByName(rows)
        return self.spark.createDataFrame([], EVENTS) if events is None else events

    def jobs_table(self) -> DataFrame:
        """The current state of every job, folded from its events.

        Events are folded per load first: a load that ran twice reports twice, and its last report
        describes what is stored.  Events without a load carry the job's own values.
        """
        return self._jobs(self.events())

    def _jobs(self, events: DataFrame) -> DataFrame:
        jobs = self.spark.sql(JOBS, events=events)
        share = batches.percentage(F.col("processed"), F.col("total_records"))
        return jobs.withColumn("percentage", share)

    def list_jobs(self, status: str | None = None) -> DataFrame:
        """Jobs, newest first, all or those in one state."""
        return ledger.with_status(self.jobs_table(), status)

    def get_job(self, job_id: str) -> Row:
        return self._job(self.jobs_table(), job_id)

    @staticmethod
    def _job(jobs: DataFrame, job_id: str) -> Row:
        job = jobs.where(F.col("job_id") == job_id).first()
        if job is None:
            raise LookupError(f"the ledger has no job {job_id}")
        return job

    def job_errors(self, job_id: str) -> DataFrame:
        """Rejected rows of a job: source id, message, and the load that met them."""
        if not path_exists(self.spark, f"{self.root}/errors"):
            return self.spark.createDataFrame([], ERRORS)
        errors = self.spark.read.schema(ERRORS).parquet(f"{self.root}/errors")
        return errors.where(F.col("job_id") == job_id)

    def job_error_pages(self, job_id: str, page_size: int = 5_000) -> DataFrame:
        """The same as JSON arrays of at most ``page_size`` entries, in id order.

        Rows without a key all have one id and message; their place in the stored files tells them
        apart, so that they spread over tasks like any others.
        """
        entries = self.job_errors(job_id).select(
            "id", "error", F.monotonically_increasing_id().alias("place")
        )
        paged = batches.assign_batches(entries, "id", "error", "place", batch_size=page_size)
        return ledger.error_pages(paged.withColumnRenamed("batch_no", "page"), ["page"])

    def target(self, spec: TransformSpec) -> TargetTable:
        """The target of a pair; the source is asked for the columns only before the first load."""
        target = TargetTable(self.spark, f"{self.root}/targets/{spec.target}")
        if target.exists():
            return target
        source = self.sources[spec.source].read(self.spark)
        mapped = transform.map_rows(source, spec)
        return TargetTable(self.spark, target.path, transform.valid_rows(mapped, spec).schema)

    def target_version(self, target_table: str) -> int:
        """The version of a target's list of folders: every roll-back makes a new one."""
        return TargetTable(self.spark, f"{self.root}/targets/{target_table}").version()

    def target_rows(self, source_table: str) -> DataFrame:
        return self.target(lookup(source_table)).ensure().read()

    # -- running ------------------------------------------------------------------------------

    def _run(
        self,
        job: Row,
        run_id: str,
        should_stop: Callable[[], bool] | None,
        slices_per_commit: int | None,
    ) -> str:
        spec = lookup(job.source_table, job.target_table)
        source = self.sources[spec.source]
        after = job.start_after if job.last_processed_id is None else job.last_processed_id
        rows = source.read(self.spark)
        if spec.prepare is None:
            rows = rows.select(*spec.source_columns())
        rows = extract.after_watermark(rows, spec.key, after)
        if job.batch_size is None:
            if (should_stop is not None and should_stop()) or self.stop_requested(job.job_id, run_id):
                return "paused"
            with run_folder(self.spark, f"job-{job.job_id}"):
                rows = stage(rows, "snapshot") if source.stage else rows
                self.load(job, spec, rows, self._load_id(job, after), whole_run=True)
            return "completed"
        with run_folder(self.spark, f"job-{job.job_id}"):
            rows = stage(rows, "snapshot") if source.stage else rows
            sliced = batches.slice_rows(rows, spec.key, job.batch_size)
            found = sliced.agg(F.max(batches.SLICE), F.count(F.lit(1))).first()
            last, n_rows = (-1 if found[0] is None else found[0]), found[1]
            self._append(job.job_id, total_records=job.processed + n_rows)
            step = slices_per_commit
            if step is None:
                step = last + 1 if should_stop is None and not job.batch_delay_ms else 1
            for start in range(0, last + 1, max(1, step)):
                if start and job.batch_delay_ms:
                    time.sleep(job.batch_delay_ms / 1000)
                if should_stop is not None and should_stop():
                    return "paused"
                if self.stop_requested(job.job_id, run_id):
                    return "paused"
                wave = sliced.where(F.col(batches.SLICE).between(start, start + step - 1))
                after = self._load_slices(job, spec, wave, after)
        return "completed"

    @staticmethod
    def _load_id(job: Row, after: int | None) -> str:
        return f"{job.job_id}.{'start' if after is None else after}"

    def load(
        self,
        job: Row,
        spec: TransformSpec,
        rows: DataFrame,
        load_id: str,
        whole_run: bool = False,
    ) -> dict[str, int]:
        """Move ``rows`` as one load, then report it; ``whole_run`` says it is all of the run.

        The counters come from a pass over the few columns they need and not from metrics gathered
        in passing, which a lost executor would count twice.
        """
        with run_folder(self.spark, "load"):
            mapped = transform.map_rows(rows, spec)
            seen = mapped.agg(*self._seen()).first()
            if seen.processed == 0:
                return dict.fromkeys(COUNTERS, 0)
            inserted = self._write(job, spec, mapped, seen, load_id)
        counts = {
            "processed": seen.processed,
            "success": inserted,
            "failed": seen.failed,
            "skipped": seen.processed - seen.failed - inserted,
        }
        total = job.processed + seen.processed if whole_run else None
        self._append(
            job.job_id, load_id=load_id, total_records=total,
            first_id=seen.first_id, last_id=seen.last_id, **counts,
        )
        return counts

    @staticmethod
    def _seen() -> list:
        return [
            F.count(F.lit(1)).alias("processed"),
            F.count(transform.ERROR).alias("failed"),
            F.min(transform.SOURCE_ID).alias("first_id"),
            F.max(transform.SOURCE_ID).alias("last_id"),
            F.count_distinct(transform.SOURCE_ID).alias("ids"),
            F.count(transform.SOURCE_ID).alias("with_id"),
        ]

    def _write(
        self,
        job: Row,
        spec: TransformSpec,
        mapped: DataFrame,
        seen: Row,
        load_id: str,
        beside: tuple[str, ...] = (),
    ) -> int:
        """Write what the target lacks, and the rejects; return the number of rows inserted.

        Only folders that may hold ids of the load's range are searched for its keys.
        """
        inserted = n_valid = seen.processed - seen.failed
        if not job.dry_run and n_valid:
            target = self.target(spec).ensure()
            near = [
                f for f in target.folders()
                if f.load_id != load_id and f.meets(seen.first_id, seen.last_id)
            ]
            valid = mapped.where(F.col(transform.ERROR).isNull())
            valid = valid.select(*spec.target_columns(), *beside)
            unique = seen.ids == seen.with_id
            if near or not unique:
                valid = load.insert_if_absent(
                    valid, target.read_folders(near), spec.key_output, find_first=True, unique=unique
                )
            bounds = (seen.first_id, seen.last_id)
            inserted = target.write_load(valid, load_id, None, *bounds, beside=beside)
        errors = f"{self.root}/errors/job_id={job.job_id}/load_id={load_id}"
        if seen.failed or path_exists(self.spark, errors):
            rejects = transform.rejected_rows(mapped).withColumn("id", F.col("id").cast("long"))
            rejects.write.mode("overwrite").parquet(errors)
        return inserted

    def _load_slices(
        self, job: Row, spec: TransformSpec, rows: DataFrame, after: int | None
    ) -> int | None:
        """Load slices in one write and report each, all in one ledger commit; return the last id.

        The slice is stored beside the rows it inserted, from where the rows per slice are counted.
        """
        load_id = self._load_id(job, after)
        with run_folder(self.spark, "load"):
            mapped = transform.map_rows(rows, spec, keep=(batches.SLICE,))
            slices = stage(mapped.groupBy(batches.SLICE).agg(*self._seen()), "seen")
            seen = slices.agg(
                *[F.sum(c).alias(c) for c in ("processed", "failed", "ids", "with_id")],
                F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"),
            ).first()
            self._write(job, spec, mapped, seen, load_id, beside=(batches.SLICE,))
            valid = F.col("processed") - F.col("failed")
            success = valid
            if not job.dry_run:
                target = self.target(spec).ensure()
                own = [f"{target.path}/{f.name}" for f in target.folders() if f.load_id == load_id]
                stored = T.StructType([T.StructField(batches.SLICE, T.IntegerType())])
                written = self.spark.read.schema(stored).parquet(*own) if own else self.spark.createDataFrame([], stored)
                inserted = written.groupBy(batches.SLICE).agg(F.count(F.lit(1)).alias("inserted"))
                slices = slices.join(inserted, batches.SLICE, "left")
                success = F.coalesce("inserted", F.lit(0).cast("long"))
            # Slices are numbered and hold consecutive ids; each is named after where it starts.
            before = Window.orderBy(batches.SLICE)
            start = F.coalesce(F.lag("last_id").over(before).cast("string"), F.lit("start" if after is None else str(after)))
            events = slices.select(
                (F.row_number().over(before) - 1).cast("long").alias("seq"),
                F.lit(self._now()).alias("at"),
                F.lit(job.job_id).alias("job_id"),
                F.concat(F.lit(f"{job.job_id}."), start).alias("load_id"),
                "processed", success.alias("success"), "failed",
                (valid - success).alias("skipped"),
                F.col("first_id").cast("long"), F.col("last_id").cast("long"),
            )
            self._append_rows(events)
        return after if seen.last_id is None else seen.last_id

    # -- ledger commits -----------------------------------------------------------------------

    @staticmethod
    def _now() -> str:
        return datetime.datetime.now(datetime.UTC).isoformat()

    def _append(self, job_id: str, **values) -> None:
        """Record what no other commit can contradict."""
        line = json.dumps({"seq": 0, "at": self._now(), "job_id": job_id, **values})
        while not self._commit(self.ledger.latest() + 1, lambda number: self.ledger.put(number, line)):
            pass

    def _append_rows(self, events: DataFrame) -> None:
        """The same for any number of events, which Spark writes as the file of one commit."""
        while True:
            draft = scratch_path(self.spark, "commit")
            events.coalesce(1).write.json(draft)
            (name,) = [n for n in list_names(self.spark, draft) if n.endswith(".json")]
            done = self._commit(
                self.ledger.latest() + 1, lambda number: self.ledger.put_file(number, f"{draft}/{name}")
            )
            remove_path(self.spark, draft)
            if done:
                return

    def _decide(
        self, job_id: str, decide: Callable[[dict[str, dict], int], dict | None]
    ) -> int:
        """Append what ``decide`` makes of the jobs' states so far, again if another commit came
        between; return the number of the commit, or the newest where there was nothing to say."""
        while True:
            number = self.ledger.latest()
            values = decide(self._states_at(number), number)
            if values is None:
                return number
            line = json.dumps({"seq": 0, "at": self._now(), "job_id": job_id, **values})
            if self._commit(number + 1, lambda n: self.ledger.put(n, line)):
                return number + 1

    def _states_at(self, number: int) -> dict[str, dict]:
        """What the commits up to ``number`` say of each job's state: a few names per job.

        A commit that changes a state is a single row; of others the first row is enough to see
        that they do not.
        """
        known, states = self._states
        if known > number:
            known, states = 0, {}
        start = self.ledger.checkpoint() if number - known >= CHECKPOINT else 0
        if known < start <= number:
            known, states = start, json.loads(self.ledger.read_checkpoint(start))
        states = {job_id: dict(job) for job_id, job in states.items()}
        for commit in range(known + 1, number + 1):
            event = json.loads(self.ledger.first_line(commit))
            given = {name: event[name] for name in CONTROL if event.get(name) is not None}
            if not given:
                continue
            if "status" in given and given["status"] == "running":
                given.setdefault("run_id", None)
            states.setdefault(event["job_id"], dict.fromkeys(CONTROL)).update(given)
        self._states = (number, states)
        return states

    @staticmethod
    def _known(states: dict[str, dict], job_id: str) -> dict:
        if job_id not in states:
            raise LookupError(f"the ledger has no job {job_id}")
        return states[job_id]

    def _commit(self, number: int, put: Callable[[int], bool]) -> bool:
        if not put(number):
            return False
        if number % CHECKPOINT == 0:
            self._events(number).write.mode("overwrite").parquet(self.ledger.checkpoint_path(number))
            self.ledger.write_checkpoint(number, json.dumps(self._states_at(number)))
        return True
