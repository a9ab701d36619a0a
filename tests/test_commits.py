"""The commit log, target manifests, one writer per target, roll-back by folder."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import Clinic, counters, keys_of
from tidemark import JobStateError, Migration
from tidemark.operators import batches, ledger, rollback
from tidemark.plans.spec import PATIENTS
from tidemark.functions import uuid5
from tidemark.sources import TargetTable, commits
from tidemark.sources.commits import CommitLog
from tidemark.sources.target import Folder


@pytest.fixture
def clinic(spark, tmp_path):
    return Clinic(spark, str(tmp_path))


def test_of_32_writers_of_a_number_one_wins(spark, tmp_path):
    logs = [CommitLog(spark, str(tmp_path / "log")) for _ in range(32)]
    with ThreadPoolExecutor(32) as pool:
        won = list(pool.map(lambda k: logs[k].put(1, f"{k}"), range(32)))
    assert sum(won) == 1 and logs[0].read(1) == str(won.index(True))

    def append(k):
        while not logs[k].put(logs[k].latest() + 1, f"{k}"):
            pass

    with ThreadPoolExecutor(32) as pool:
        list(pool.map(append, range(32)))
    assert logs[5].latest() == 33
    assert sorted(int(logs[0].read(n)) for n in range(2, 34)) == list(range(32))
    left = {p.name for p in (tmp_path / "log").iterdir()}
    assert left == {f"{n:020d}.json" for n in range(1, 34)}  # no drafts


def test_a_rename_puts_once_as_well(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    log._local = None  # as on a file system without hard links
    assert log.put(1, "a") and not log.put(1, "b")
    assert log.read(1) == "a" and log.latest() == 1


def test_of_many_drivers_one_starts_the_target(clinic, spark):
    clinic.add(1, 10)
    first = clinic.create()
    clinic.migration.mark_running(first)
    clinic.migration.stop_job(first)
    second = clinic.create()
    drivers = [Migration(spark, clinic.migration.root, clinic.migration.sources) for _ in range(8)]

    def start(k):
        try:
            drivers[k].mark_running((first, second)[k % 2])
            return 1
        except JobStateError:
            return 0

    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(start, range(8))) == 1
    running = clinic.migration.list_jobs("running")
    assert running.count() == 1
    assert ledger.bad_transitions(spark, clinic.migration.events()).isEmpty()


def test_of_many_drivers_one_creates_a_job(clinic, spark):
    drivers = [Migration(spark, clinic.migration.root, clinic.migration.sources) for _ in range(6)]

    def create(migration):
        try:
            return migration.create_job("pasien", "pasien")
        except JobStateError:
            return None

    with ThreadPoolExecutor(6) as pool:
        assert sum(j is not None for j in pool.map(create, drivers)) == 1


def test_changes_that_are_not_allowed_are_refused(clinic):
    clinic.add(1, 10)
    job = clinic.run()
    for status in ("running", "paused", "pending", "failed"):
        with pytest.raises(JobStateError, match="cannot go from completed"):
            clinic.migration.mark(job.job_id, status)
    with pytest.raises(JobStateError, match="from none"):
        clinic.migration.mark("new", "running")


def test_the_ledger_folds_the_same_beyond_checkpoints(clinic, spark, monkeypatch):
    monkeypatch.setattr("tidemark.plans.jobs.CHECKPOINT", 4)
    clinic.add(1, 40)
    whole = clinic.run(batch_size=10)
    clinic.add(41, 60)
    last = clinic.run()
    assert clinic.migration.ledger.checkpoint() >= 4
    assert counters(whole) == (40, 40, 36, 4, 0) and counters(last) == (20, 20, 18, 2, 0)
    again = Migration(spark, clinic.migration.root, clinic.migration.sources)
    assert again.get_job(whole.job_id) == whole
    assert again.events().select("seq").distinct().count() == again.events().count()


def test_slices_share_one_commit(clinic, monkeypatch):
    clinic.add(1, 100)
    loads = []
    original = TargetTable.write_load
    monkeypatch.setattr(TargetTable, "write_load", lambda *a, **k: loads.append(a[2]) or original(*a, **k))
    few, before = clinic.run(batch_size=50), clinic.migration.ledger.latest()
    assert counters(few) == (100, 100, 90, 10, 0)
    clinic.add(101, 200)
    many = clinic.run(batch_size=5)
    assert counters(many) == (100, 100, 90, 10, 0) and len(loads) == 2
    assert clinic.migration.ledger.latest() == 2 * before
    events = clinic.migration.events().where((F.col("job_id") == many.job_id) & F.col("load_id").isNotNull())
    rows = events.orderBy("first_id").collect()
    assert [(r.first_id, r.last_id, r.processed) for r in rows] == [(101 + 5 * k, 105 + 5 * k, 5) for k in range(20)]
    assert [r.load_id.split(".")[1] for r in rows] == [str(100 + 5 * k) for k in range(20)]
    assert clinic.keys() == keys_of(1, 200)


def test_slices_in_waves(clinic):
    clinic.add(1, 60)
    job_id = clinic.create(batch_size=10)
    asked = []
    job = clinic.migration.start_job(job_id, lambda: asked.append(1) or len(asked) > 2, slices_per_commit=2)
    assert (job.status, job.processed, job.last_processed_id) == ("paused", 40, 40)
    job = clinic.migration.start_job(job_id)
    assert (job.status, job.processed) == ("completed", 60) and clinic.keys() == keys_of(1, 60)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_slices_never_split_a_key(spark, size):
    keys = [1, 1, 1, 1, 2, 3, 3, 4, 5, 5, 5, 5, 5, 6, 9, 9, None, None]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v long").repartition(3)
    got = batches.slice_rows(rows, "k", size).collect()
    assert sorted(r.v for r in got) == list(range(len(keys)))
    ordered = sorted(k for k in keys if k is not None)
    want = {k: ordered.index(k) // size for k in ordered}
    # A slice holds a key with the row at which the key ends a slice, or with its first row.
    for k in want:
        found = {r[batches.SLICE] for r in got if r.k == k}
        assert len(found) == 1
        places = [at // size for at, x in enumerate(ordered) if x == k]
        ends = [at // size for at, x in enumerate(ordered) if x == k and at % size == size - 1]
        assert found == {min(ends) if ends else places[0]}
    assert {r[batches.SLICE] for r in got if r.k is None} == {0}


# -- target ranges ------------------------------------------------------------------------------


def scanned(monkeypatch):
    names = []
    original = TargetTable.read_folders

    def read(self, folders):
        names.append([(f.first, f.last) for f in folders])
        return original(self, folders)

    monkeypatch.setattr(TargetTable, "read_folders", read)
    return names


def test_a_load_reads_no_folder_outside_its_range(clinic, monkeypatch):
    names = scanned(monkeypatch)
    for first in (1, 101, 201):
        clinic.add(first, first + 99)
        clinic.run()
    assert names == []  # ids above all there were: no folder is searched
    clinic.add(151, 151)
    clinic.add(301, 320)
    spec = PATIENTS
    job = clinic.migration.get_job(clinic.create())
    rows = clinic.spark.read.parquet(clinic.location).where("id_pasien = 151")
    counts = clinic.migration.load(job, spec, rows.limit(1), "again")
    assert counts["skipped"] + counts["failed"] == 1
    assert names == [[(101, 200)]]


def test_files_outside_the_range_are_not_in_the_plan(spark, tmp_path):
    rows = spark.range(30).withColumnRenamed("id", "k")
    target = TargetTable(spark, str(tmp_path / "target"), rows.schema).ensure()
    for first in (0, 10, 20):
        target.write_load(rows.where(F.col("k").between(first, first + 9)), f"l{first}", None, first, first + 9)
    files = target.read(first=12, last=19).inputFiles()
    assert files and all("/l10-" in f for f in files)
    assert sorted(r.k for r in target.read(first=5, last=12).collect()) == list(range(20))
    assert target.read(first=30, last=40).count() == 0
    target.write_load(rows.where("k = 3"), "unknown")  # without bounds it may hold any id
    assert {f.split("/")[-2].split("-")[0] for f in target.read(first=12, last=19).inputFiles()} == {"l10", "unknown"}


def test_roll_back_by_folder(clinic, monkeypatch):
    for first in (1, 101, 201):
        clinic.add(first, first + 99)
        clinic.run()
    jobs = clinic.migration.list_jobs("completed").collect()
    names = scanned(monkeypatch)
    kept = {f.name for f in clinic.migration.target(PATIENTS).folders() if f.first != 101}
    assert clinic.migration.rollback_job(jobs[1].job_id) == 90
    assert names == []  # nothing was read or written
    assert {f.name for f in clinic.migration.target(PATIENTS).folders()} == kept
    assert clinic.keys() == sorted(keys_of(1, 100) + keys_of(201, 300))
    assert clinic.migration.target_version("pasien") == 2


def test_only_straddling_folders_are_rewritten(spark, clinic):
    clinic.add(1, 60)
    job = clinic.run()
    target = clinic.migration.target(PATIENTS)
    rows = target.read()
    ids = spark.range(1, 200).select(uuid5(F.col("id").cast("string"), PATIENTS.namespace).alias("pasien_uuid"), "id")
    extra = rows.limit(1).drop("pasien_uuid").crossJoin(ids.where("id between 51 and 80")).drop("id")
    target.write_load(extra, "other", None, 51, 80)
    before = {f.load_id: f.name for f in target.folders()}
    deleted = clinic.migration.rollback_job(job.job_id)
    assert deleted == 54 + 10
    after = {f.load_id: f for f in target.folders()}
    assert set(after) == {"other"} and after["other"].name != before["other"]
    assert (after["other"].first, after["other"].last, after["other"].rows) == (61, 80, 20)


@pytest.mark.parametrize(
    ("bounds", "want"),
    [((5, 9), (10, 20)), ((5, 20), None), ((15, 30), (10, 14)), ((1, 12), (13, 20)), ((12, 14), (10, 20)), ((21, 30), (10, 20))],
)
def test_bounds_left(bounds, want):
    folder = Folder("f", "l", 11, 10, 20)
    gone, kept = rollback.split_folders([folder], *bounds)
    if want is None:
        assert gone == [folder] and not kept
    else:
        assert not gone and bool(kept) == folder.meets(*bounds)
        assert rollback.bounds_left(folder, *bounds) == want


def test_manifests_beyond_a_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sources.target.CHECKPOINT", 4)
    rows = spark.range(3).withColumnRenamed("id", "k")
    target = TargetTable(spark, str(tmp_path / "target"), rows.schema).ensure()
    for k in range(6):
        target.write_load(rows.where(F.col("k") == k % 3), f"l{k % 4}", None, k % 3, k % 3)
    target.write_version(target.read().where("k > 0"), 2)
    again = TargetTable(spark, str(tmp_path / "target"))
    assert again.log.checkpoint() >= 4 and again.version() == 2
    assert sorted(r.k for r in again.read().collect()) == [1, 2, 2]
    assert again.schema == rows.schema
    for k in range(8):
        target.write_load(rows, f"m{k}")
    with pytest.raises(LookupError):
        again.read(1)
    assert commits.CHECKPOINT == 32


def test_parallel_loads_are_all_listed(spark, tmp_path):
    rows = spark.range(5).withColumnRenamed("id", "k")
    TargetTable(spark, str(tmp_path / "target"), rows.schema).ensure()

    def write(k):
        TargetTable(spark, str(tmp_path / "target")).write_load(rows, f"load{k}")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(12)))
    assert TargetTable(spark, str(tmp_path / "target")).read().count() == 60


# -- stopping -----------------------------------------------------------------------------------


def test_no_roll_back_while_a_stopped_load_is_still_being_written(clinic, monkeypatch):
    clinic.add(1, 20)
    migration = clinic.migration
    job_id = clinic.create()
    original = TargetTable.write_load
    refused = []

    def stopped_meanwhile(self, *args, **kwargs):
        migration.stop_job(job_id)
        assert migration.get_job(job_id).status == "running"  # the run itself writes the pause
        with pytest.raises(JobStateError):
            migration.rollback_job(job_id)
        refused.append(1)
        return original(self, *args, **kwargs)

    monkeypatch.setattr(TargetTable, "write_load", stopped_meanwhile)
    job = migration.start_job(job_id)
    assert refused and (job.status, job.processed) == ("completed", 20)


def test_an_abandoned_run_can_be_taken_over(clinic):
    clinic.add(1, 20)
    job_id = clinic.create()
    clinic.migration.mark_running(job_id, "a run whose driver died")
    clinic.migration.stop_job(job_id)
    assert clinic.migration.get_job(job_id).status == "running"
    clinic.migration.stop_job(job_id, abandoned=True)
    assert clinic.migration.get_job(job_id).status == "paused"
    clinic.migration.end_run(job_id, "a run whose driver died", "completed")  # too late
    assert clinic.migration.get_job(job_id).status == "paused"
    assert clinic.migration.start_job(job_id).status == "completed"
