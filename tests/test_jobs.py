import json
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark import JobStateError, Migration
from tidemark.operators import batches, ledger
from tidemark.plans.jobs import Source
from tidemark.plans.spec import PATIENT_NAMESPACE
from tidemark.sources import integer_series, patients


class Clinic:
    """A patient source that can grow, and a migration over it. Every tenth name is blank."""

    def __init__(self, spark, folder, stage=False):
        self.spark = spark
        self.location = f"{folder}/source"
        self.migration = Migration(
            spark,
            f"{folder}/work",
            {"pasien": Source(lambda s: s.read.parquet(self.location), stage=stage)},
        )

    def add(self, first, last):
        rows = patients(integer_series(self.spark, first, last))
        blank = F.col("id_pasien") % 10 == 0
        for name in ("nama_depan", "nama_belakang"):
            rows = rows.withColumn(name, F.when(blank, " ").otherwise(F.col(name)))
        rows.withColumn("id_pasien", F.col("id_pasien").cast("int")).write.mode("append").parquet(
            self.location
        )

    def create(self, **options):
        return self.migration.create_job("pasien", "pasien", **options)

    def run(self, **options):
        return self.migration.start_job(self.create(**options))

    def keys(self):
        return sorted(r.pasien_uuid for r in self.migration.target_rows("pasien").collect())


def keys_of(first, last):
    return sorted(
        str(uuid.uuid5(PATIENT_NAMESPACE, str(i))) for i in range(first, last + 1) if i % 10
    )


@pytest.fixture
def clinic(spark, tmp_path):
    return Clinic(spark, str(tmp_path))


def counters(job):
    return (job.total_records, job.processed, job.success, job.failed, job.skipped)


def test_incremental_runs(clinic):
    clinic.add(-5, 100)
    first = clinic.run()
    assert first.status == "completed"
    assert counters(first) == (106, 106, 95, 11, 0)
    assert (first.first_processed_id, first.last_processed_id) == (-5, 100)
    assert first.percentage == 100.0
    assert first.started_at and first.completed_at and not first.rolled_back_at
    clinic.add(101, 150)
    second = clinic.run()
    assert second.start_after == 100
    assert counters(second) == (50, 50, 45, 5, 0)
    third = clinic.run()
    assert counters(third) == (0, 0, 0, 0, 0)
    assert (third.start_after, third.percentage) == (150, None)
    assert clinic.keys() == keys_of(-5, 150)


def test_an_empty_run_hands_its_start_on(clinic):
    clinic.add(1, 10)
    clinic.run()
    clinic.run()
    job = clinic.migration.get_job(clinic.create())
    assert job.start_after == 10


def test_dry_run_writes_nothing_and_does_not_move_the_start(clinic):
    clinic.add(1, 50)
    dry = clinic.run(dry_run=True)
    assert counters(dry) == (50, 50, 45, 5, 0)
    assert clinic.keys() == []
    real = clinic.run()
    assert real.start_after is None
    assert clinic.keys() == keys_of(1, 50)
    with pytest.raises(JobStateError):
        clinic.migration.rollback_job(dry.job_id)


@pytest.mark.parametrize("stage", [False, True])
def test_stop_and_resume_in_slices(spark, tmp_path, stage):
    clinic = Clinic(spark, str(tmp_path), stage)
    clinic.add(1, 95)
    job_id = clinic.create(batch_size=30)
    asked = []

    def stop_after_two():
        asked.append(1)
        return len(asked) > 2

    paused = clinic.migration.start_job(job_id, stop_after_two)
    assert paused.status == "paused"
    assert counters(paused) == (95, 60, 54, 6, 0)
    assert paused.last_processed_id == 60
    assert round(paused.percentage, 3) == round(60 / 95 * 100, 3)
    assert clinic.keys() == keys_of(1, 60)
    done = clinic.migration.start_job(job_id)
    assert done.status == "completed"
    assert counters(done) == (95, 95, 86, 9, 0)
    assert clinic.keys() == keys_of(1, 95)
    with pytest.raises(JobStateError):
        clinic.migration.start_job(job_id)


def test_failure_is_recorded_and_the_same_job_goes_on(clinic, monkeypatch):
    clinic.add(1, 40)
    job_id = clinic.create()
    # Data is written, then the process dies before the ledger hears of it.
    original = clinic.migration._append

    def broken(job, **values):
        if "load_id" in values:
            raise OSError("lost")
        original(job, **values)

    monkeypatch.setattr(clinic.migration, "_append", broken)
    with pytest.raises(OSError):
        clinic.migration.start_job(job_id)
    assert clinic.migration.get_job(job_id).status == "failed"
    assert clinic.keys() == keys_of(1, 40)
    monkeypatch.undo()
    done = clinic.migration.start_job(job_id)
    assert counters(done) == (40, 40, 36, 4, 0)  # the load overwrote itself
    assert clinic.keys() == keys_of(1, 40)


def test_rollback(clinic):
    clinic.add(1, 100)
    first = clinic.run()
    clinic.add(101, 130)
    second = clinic.run()
    assert clinic.migration.rollback_job(second.job_id) == 27
    assert clinic.keys() == keys_of(1, 100)
    state = clinic.migration.get_job(second.job_id)
    assert state.status == "rolled_back"
    assert state.rolled_back_at
    with pytest.raises(JobStateError):
        clinic.migration.rollback_job(second.job_id)
    again = clinic.run()
    assert again.start_after == 100
    assert clinic.keys() == keys_of(1, 130)
    source = clinic.spark.read.parquet(clinic.location)
    assert clinic.migration.rollback_job(first.job_id, ids=source) == 90
    assert clinic.keys() == keys_of(101, 130)


def test_one_active_job_per_pair(clinic):
    clinic.add(1, 10)
    job_id = clinic.create()
    with pytest.raises(JobStateError):
        clinic.create()
    with pytest.raises(JobStateError):
        clinic.migration.rollback_job(job_id)
    with pytest.raises(JobStateError):
        clinic.migration.stop_job(job_id)
    clinic.migration.mark_running(job_id)
    with pytest.raises(JobStateError):
        clinic.migration.start_job(job_id)
    clinic.migration.stop_job(job_id)
    clinic.create()  # a paused job does not block the next one


def test_no_rollback_beside_an_active_job(clinic):
    clinic.add(1, 10)
    done = clinic.run()
    clinic.create()
    with pytest.raises(JobStateError, match="another job"):
        clinic.migration.rollback_job(done.job_id)


@pytest.mark.parametrize("batch_size", [None, 2])
def test_rows_without_a_key_are_rejected(spark, tmp_path, batch_size):
    clinic = Clinic(spark, str(tmp_path))
    clinic.add(1, 5)
    nameless = spark.read.parquet(clinic.location).limit(1)
    nameless.withColumn("id_pasien", F.lit(None).cast("int")).write.mode("append").parquet(
        clinic.location
    )
    job = clinic.run(batch_size=batch_size)
    assert counters(job) == (6, 6, 5, 1, 0)
    assert [r.id for r in clinic.migration.job_errors(job.job_id).collect()] == [None]


def test_later_runs_do_not_see_rows_without_a_key(clinic, spark):
    clinic.add(1, 5)
    clinic.run()
    nameless = spark.read.parquet(clinic.location).limit(1)
    nameless.withColumn("id_pasien", F.lit(None).cast("int")).write.mode("append").parquet(
        clinic.location
    )
    clinic.add(6, 7)
    assert counters(clinic.run()) == (2, 2, 2, 0, 0)


def test_values_beyond_the_limits_are_rejected(clinic, spark):
    rows = patients(integer_series(spark, 1, 9))
    long = F.when(F.col("id_pasien") == 4, "9" * 21).otherwise(F.col("no_telepon"))
    rows.withColumn("no_telepon", long).write.parquet(clinic.location)
    job = clinic.run()
    assert counters(job) == (9, 9, 8, 1, 0)
    error = clinic.migration.job_errors(job.job_id).first()
    assert (error.id, error.error) == (
        4, "transform id_pasien=4: telepon holds more than 20 characters"
    )


def test_equal_rejects_spread_over_pages(clinic, spark):
    clinic.add(1, 1)
    nameless = spark.read.parquet(clinic.location).withColumn("id_pasien", F.lit(None).cast("int"))
    nameless.crossJoin(spark.range(1000)).drop("id").write.mode("append").parquet(clinic.location)
    job = clinic.run()
    pages = clinic.migration.job_error_pages(job.job_id, page_size=300).collect()
    assert sorted(p.total for p in pages) == [100, 300, 300, 300]


def test_roll_back_works_without_the_source(clinic, spark):
    clinic.add(1, 20)
    job = clinic.run()

    def gone(session):
        raise OSError("the source is gone")

    migration = Migration(spark, clinic.migration.root, {"pasien": Source(gone)})
    assert migration.rollback_job(job.job_id) == 18
    changes = ledger.bad_transitions(spark, migration.events())
    assert changes.count() == 0 and clinic.keys() == []


def test_requests_are_checked(clinic):
    with pytest.raises(LookupError):
        clinic.migration.create_job("pasien", "elsewhere")
    with pytest.raises(LookupError):
        clinic.migration.create_job("dokter", "dokter")
    with pytest.raises(ValueError):
        clinic.create(batch_size=0)
    with pytest.raises(LookupError):
        clinic.migration.get_job("unknown")


def test_validation(clinic):
    clinic.add(1, 100)
    job = clinic.run()
    row = clinic.migration.validate_job(job.job_id).first()
    assert (row.source_count, row.target_count, row.missing, row.is_consistent, row.rejected) == (
        100,
        90,
        10,
        False,
        10,
    )
    empty = clinic.run()
    with pytest.raises(JobStateError):
        clinic.migration.validate_job(empty.job_id)


def test_errors(clinic):
    clinic.add(1, 100)
    job = clinic.run()
    errors = clinic.migration.job_errors(job.job_id)
    assert sorted(r.id for r in errors.collect()) == list(range(10, 101, 10))
    pages = {r.page: r for r in clinic.migration.job_error_pages(job.job_id, page_size=4).collect()}
    assert [pages[p].total for p in sorted(pages)] == [4, 4, 2]
    first = json.loads(pages[0].errors)[0]
    assert first["id"] == 10
    assert first["error"].startswith("transform id_pasien=10: nama_lengkap is empty")


def test_rows_that_exist_are_skipped_and_unchanged(clinic):
    clinic.add(1, 20)
    clinic.run()
    before = clinic.migration.target_rows("pasien").orderBy("pasien_uuid").collect()
    version = clinic.migration.target_version("pasien")
    spec_target = clinic.migration.target_rows("pasien")
    changed = spec_target.withColumn("kota", F.lit("elsewhere"))
    from tidemark.operators.load import insert_if_absent

    fresh = insert_if_absent(changed, spec_target, "pasien_uuid", find_first=True)
    assert fresh.count() == 0
    assert version == 1
    assert clinic.migration.target_rows("pasien").orderBy("pasien_uuid").collect() == before


def test_repeated_source_ids_are_skipped(clinic):
    clinic.add(1, 20)
    clinic.add(11, 20)
    job = clinic.run()
    assert counters(job) == (30, 30, 18, 3, 9)
    assert clinic.keys() == keys_of(1, 20)


def test_listing(clinic):
    clinic.add(1, 10)
    first, second = clinic.run(), clinic.run(dry_run=True)
    listed = clinic.migration.list_jobs()
    assert [r.job_id for r in listed.collect()] == [second.job_id, first.job_id]
    assert clinic.migration.list_jobs("failed").count() == 0


def test_slices_equal_one_pass(spark, tmp_path):
    one, many = Clinic(spark, str(tmp_path / "one")), Clinic(spark, str(tmp_path / "many"))
    for clinic in (one, many):
        clinic.add(1, 60)
    a, b = one.run(), many.run(batch_size=25)
    assert counters(a) == counters(b)
    left, right = one.migration.target_rows("pasien"), many.migration.target_rows("pasien")
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    loads = many.migration.events().where("load_id is not null")
    assert loads.count() == 3
    folded = batches.fold_progress(
        loads.select(
            "processed",
            (F.col("success") + F.col("skipped")).alias("valid"),
            F.col("failed").alias("rejected"),
            "first_id",
            "last_id",
        )
    ).first()
    assert tuple(folded) == (3, 60, 54, 6, 1, 60)


def test_a_stopped_run_writes_no_more_and_stays_stopped(clinic):
    clinic.add(1, 20)
    migration = clinic.migration
    job_id = clinic.create(batch_size=5)
    asked = []

    def stop_after_one_slice():
        asked.append(1)
        if len(asked) == 2:
            migration.stop_job(job_id)
        return False

    job = migration.start_job(job_id, stop_after_one_slice)
    assert (job.status, job.processed) == ("paused", 5)
    other = clinic.create()
    migration.mark_running(job_id)
    with pytest.raises(JobStateError):
        migration.start_job(other)


def test_the_ledger_of_a_clean_job_has_no_bad_change(clinic, spark):
    clinic.add(1, 20)
    clinic.run()
    assert ledger.bad_transitions(spark, clinic.migration.events()).count() == 0


def test_parallel_writers_keep_every_event(clinic):
    migration = clinic.migration
    before = migration.events().count()
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: migration.mark(f"job-{k}", "pending"), range(12)))
    assert migration.events().count() == before + 12


def test_a_job_of_rejects_alone_rolls_back_nothing(clinic):
    clinic.add(10, 10)
    job = clinic.run()
    assert job.failed == 1 and clinic.migration.rollback_job(job.job_id) == 0
