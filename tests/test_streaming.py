import pytest

from tidemark.sources import integer_series, patients
from tidemark.streaming import file_stream, finish_stream, pause_stream, stream_job
from tests.test_jobs import Clinic, keys_of


@pytest.fixture
def clinic(spark, tmp_path):
    clinic = Clinic(spark, str(tmp_path))
    clinic.checkpoint = str(tmp_path / "checkpoint")
    return clinic


def add_file(clinic, first, last):
    patients(integer_series(clinic.spark, first, last, partitions=1)).write.mode("append").parquet(
        clinic.location
    )


def stream(clinic, job_id, **options):
    schema = clinic.spark.read.parquet(clinic.location).schema
    files = file_stream(clinic.spark, clinic.location, schema, max_files=1)
    return stream_job(clinic.migration, job_id, files, clinic.checkpoint, **options)


def all_keys(first, last):
    import uuid

    from tidemark.plans.spec import PATIENT_NAMESPACE

    return sorted(str(uuid.uuid5(PATIENT_NAMESPACE, str(i))) for i in range(first, last + 1))


def test_drains_and_goes_on_with_new_files_only(clinic):
    for first in (1, 21, 41):
        add_file(clinic, first, first + 19)
    job_id = clinic.create()
    finish_stream(clinic.migration, job_id, stream(clinic, job_id))
    job = clinic.migration.get_job(job_id)
    assert (job.status, job.processed, job.success) == ("completed", 60, 60)
    assert (job.total_records, job.percentage) == (60, 100.0)
    loads = clinic.migration.events().where("load_id is not null")
    assert loads.count() == 3  # one file per micro-batch
    assert clinic.keys() == all_keys(1, 60)

    add_file(clinic, 51, 80)  # the first ten are known already
    second = clinic.create()
    finish_stream(clinic.migration, second, stream(clinic, second))
    job = clinic.migration.get_job(second)
    assert (job.processed, job.success, job.skipped) == (30, 20, 10)
    assert clinic.keys() == all_keys(1, 80)


def test_a_batch_run_again_changes_nothing(clinic):
    add_file(clinic, 1, 30)
    job_id = clinic.create()
    query = stream(clinic, job_id)
    finish_stream(clinic.migration, job_id, query)
    before = clinic.migration.get_job(job_id)
    # The same micro-batch again, as after a crash between the load and the stream's commit.
    from tidemark.plans.spec import lookup

    rows = clinic.spark.read.parquet(clinic.location)
    clinic.migration.load(before, lookup("pasien"), rows, f"{job_id}.batch-0")
    after = clinic.migration.get_job(job_id)
    assert (after.processed, after.success, after.skipped) == (30, 30, 0)
    assert clinic.keys() == all_keys(1, 30)


def test_pause_and_resume(clinic):
    add_file(clinic, 1, 30)
    job_id = clinic.create()
    query = stream(clinic, job_id, processing_time="100 milliseconds")
    query.processAllAvailable()
    assert query.lastProgress is not None
    pause_stream(clinic.migration, job_id, query)
    assert clinic.migration.get_job(job_id).status == "paused"
    add_file(clinic, 31, 40)
    finish_stream(clinic.migration, job_id, stream(clinic, job_id))
    job = clinic.migration.get_job(job_id)
    assert (job.status, job.processed) == ("completed", 40)
    assert clinic.keys() == all_keys(1, 40)


def test_batch_and_stream_agree(clinic, spark, tmp_path):
    clinic.add(1, 50)
    other = Clinic(spark, str(tmp_path / "batch"))
    other.add(1, 50)
    other.run()
    job_id = clinic.create()
    finish_stream(clinic.migration, job_id, stream(clinic, job_id))
    assert clinic.keys() == other.keys() == keys_of(1, 50)


def test_a_stopped_stream_ends_paused_and_goes_on(clinic, spark):
    for first in (1, 51, 101):
        add_file(clinic, first, first + 49)
    job_id = clinic.create()
    asked = []

    def stop_before_the_second():
        asked.append(1)
        if len(asked) == 2:
            clinic.migration.stop_job(job_id)
        return False

    finish_stream(clinic.migration, job_id, stream(clinic, job_id, should_stop=stop_before_the_second))
    job = clinic.migration.get_job(job_id)
    assert (job.status, job.processed) == ("paused", 50)
    finish_stream(clinic.migration, job_id, stream(clinic, job_id))
    job = clinic.migration.get_job(job_id)
    assert (job.status, job.processed, job.success, job.total_records) == ("completed", 150, 150, 150)
    from tidemark.operators import ledger

    assert ledger.bad_transitions(spark, clinic.migration.events()).isEmpty()
    assert clinic.keys() == all_keys(1, 150)


def test_a_stream_that_fails_is_recorded_as_failed(clinic, monkeypatch):
    add_file(clinic, 1, 10)
    job_id = clinic.create()

    def broken(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(clinic.migration, "load", broken)
    query = stream(clinic, job_id)
    with pytest.raises(Exception, match="lost"):
        finish_stream(clinic.migration, job_id, query)
    assert clinic.migration.get_job(job_id).status == "failed"
