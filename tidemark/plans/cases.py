"""The registered queries: every operator over whole driver tables.

PERSON stands for the patient table: customers, nameless where their balance is negative.  The
rows an earlier run had moved are the customers of one market segment.  LEDGER reads the events as
status events of jobs.  Watermarks and ranges are taken from the key bounds of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (
    is_uuid,
    merge_text,
    random_uuid,
    trim_unicode,
    truncate_chars,
    uuid5,
)
from tidemark.operators import batches, differences, extract, ledger, load, quality, rollback, transform
from tidemark.plans.jobs import Migration, Source
from tidemark.plans.spec import PATIENT_NAMESPACE, Copy, Merge, TransformSpec, register
from tidemark.session import scratch_path
from tidemark.sources import integer_series, read_snapshot, synth
from tidemark.streaming import file_stream, finish_stream, stream_job

BATCH = 500
MOVED_SEGMENT = "BUILDING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_person(customers: DataFrame) -> DataFrame:
    parts = F.split("c_name", "#")
    nameless = F.col("c_acctbal") < 0
    return customers.select(
        F.col("c_custkey").alias("id"),
        F.when(nameless, "  ").otherwise(parts[0]).alias("first"),
        F.when(~nameless, parts[1]).alias("last"),
        F.concat(
            F.lower("c_mktsegment"), F.lit("."), F.col("c_custkey").cast("string"), F.lit("@email.com")
        ).alias("email"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


PERSON = register(
    TransformSpec(
        source="customer",
        target="person",
        key="id",
        key_output="person_uuid",
        namespace=PATIENT_NAMESPACE,
        description="customers with split names",
        fields=(
            Merge(("first", "last"), "full_name", max_chars=100, required=True),
            Copy("email", "email", max_chars=100),
            Copy("segment", "market_segment"),
            Copy("nation", "nation_id"),
            Copy("balance", "balance"),
        ),
        limits={"full_name": 100, "email": 100},
        not_null=("person_uuid", "full_name"),
    )
)


DOCUMENT = TransformSpec(
    source="documents",
    target="document",
    key="doc_id",
    key_output="document_uuid",
    namespace=PATIENT_NAMESPACE,
    description="documents with limits that some of them break",
    fields=(Copy("text", "body"), Copy("lang", "language"), Copy("source", "origin")),
    limits={"body": 2_000, "language": 2},
    not_null=("document_uuid", "origin"),
)


def short_documents_without_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; texts below 200 characters lose their source, so that checks find nulls."""
    source = F.when(F.length("text") >= 200, F.col("source"))
    return table(spark, sf_dir, "documents").withColumn("source", source)


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_person(table(spark, sf_dir, "customer"))


def mapped_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.map_rows(person(spark, sf_dir), PERSON)


def valid_person(rows: DataFrame) -> DataFrame:
    return transform.valid_rows(transform.map_rows(rows, PERSON), PERSON)


def moved_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target before the run."""
    rows = person(spark, sf_dir)
    return valid_person(rows.where(F.col("segment") == MOVED_SEGMENT))


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth purchase stands for a roll-back."""
    event = F.col("event_type")
    status = (
        F.when((event == "purchase") & (F.col("event_id") % 4 == 0), "rolled_back")
        .when(event == "signup", "pending")
        .when(event == "view", "running")
        .when(event == "click", "paused")
        .when(event == "purchase", "completed")
        .when(event == "error", "failed")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("seq"),
        status.alias("status"),
        F.col("ts").alias("at"),
        "value",
        "props",
    )


def ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one run of a pair, the pair being the user."""
    k = F.from_json("props", "k long")["k"]
    return ledger_events(spark, sf_dir).select(
        F.col("job_id").alias("pair"),
        F.col("seq").alias("run"),
        "status",
        F.col("at").alias("created_at"),
        k.alias("last_id"),
        (F.col("value") < 10).alias("dry_run"),
    )


def middle(rows: DataFrame, key: str) -> int:
    low, high = extract.key_bounds(rows, key)
    return (low + high) // 2


def inner_half(rows: DataFrame, key: str) -> tuple[int, int]:
    low, high = extract.key_bounds(rows, key)
    quarter = (high - low) // 4
    return low + quarter, high - quarter


# -- scans ------------------------------------------------------------------------------------


def snapshot_scan(spark, sf_dir):
    return read_snapshot(
        spark,
        f"{sf_dir}/customer.parquet",
        columns=["c_custkey", "c_name", "c_mktsegment"],
        schema="c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )


def incremental_extract(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return extract.after_watermark(orders, "o_orderkey", middle(orders, "o_orderkey"))


def remaining_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return extract.remaining_count(orders, "o_orderkey", middle(orders, "o_orderkey"))


def range_filter_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = extract.key_range(orders, "o_orderkey", *inner_half(orders, "o_orderkey"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def table_counts(spark, sf_dir):
    return extract.labelled_counts(
        {
            "customers": (table(spark, sf_dir, "customer"), "c_custkey"),
            "suppliers": (table(spark, sf_dir, "supplier"), "s_suppkey"),
        }
    )


# -- batches ----------------------------------------------------------------------------------


def batch_assign(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return batches.assign_batches(orders, "o_orderkey", batch_size=BATCH)


def nth_batch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    batched = batches.assign_batches(orders, "o_orderkey", batch_size=BATCH)
    return batches.nth_batch(batched, 3).select("o_orderkey", "o_custkey")


def _batched_person(spark, sf_dir):
    """Ids and messages only: the other columns are not needed for counters."""
    checked = mapped_person(spark, sf_dir).select(
        F.col(transform.SOURCE_ID).alias("id"), F.col(transform.ERROR).alias("error")
    )
    return batches.assign_batches(checked, "id", batch_size=BATCH)


def batch_metrics(spark, sf_dir):
    return batches.batch_metrics(_batched_person(spark, sf_dir), "id")


def progress_fold(spark, sf_dir):
    return batches.fold_progress(batch_metrics(spark, sf_dir))


def progress_percentage(spark, sf_dir):
    """Share of the table done at the end of each batch; row numbers are dense, so no window."""
    checked = person(spark, sf_dir).select("id")
    numbered = batches.number_rows(checked, "id")
    total = checked.count()
    batch = batches.whole_part(F.col("row_no"), BATCH)
    done = numbered.groupBy(batch.alias("batch_no")).agg(
        (F.max("row_no") + 1).alias("processed")
    )
    share = batches.percentage(F.col("processed"), F.col("total"))
    return done.withColumn("total", F.lit(total).cast("long")).withColumn("percentage", share)


# -- projections ------------------------------------------------------------------------------


def surrogate_key(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key, uuid5(key, PATIENT_NAMESPACE).alias("order_uuid")
    )


def uuid_is_valid(spark, sf_dir):
    """Keys of PERSON; without their second hyphen where the balance is negative."""
    key = uuid5(F.col("id"), PATIENT_NAMESPACE)
    spoilt = F.concat(F.substring(key, 1, 13), F.substring(key, 15, 22))
    given = F.when(F.col("balance") < 0, spoilt).otherwise(key)
    return person(spark, sf_dir).select("id", given.alias("key")).withColumn(
        "is_valid", is_uuid(F.col("key"))
    )


def random_job_ids(spark, sf_dir):
    """Random keys for every order differ and are well formed."""
    drawn = table(spark, sf_dir, "orders").select("o_orderkey", random_uuid().alias("job_id"))
    return drawn.groupBy("job_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("jobs"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.count_if(is_uuid(F.col("job_id"))).alias("valid_ids"),
    )


def merge_name(spark, sf_dir):
    return person(spark, sf_dir).select(
        "id", merge_text(F.col("first"), F.col("last")).alias("full_name")
    )


def transform_rename(spark, sf_dir):
    outputs = ("email", "market_segment", "nation_id", "balance")
    return mapped_person(spark, sf_dir).select(
        F.col(transform.SOURCE_ID).alias("id"), *outputs
    )


def valid_rows(spark, sf_dir):
    return transform.valid_rows(mapped_person(spark, sf_dir), PERSON)


def rejected_rows(spark, sf_dir):
    return transform.rejected_rows(mapped_person(spark, sf_dir))


def limit_rejects(spark, sf_dir):
    """Rows that the target's limits and not-null columns refuse, with the first reason."""
    documents = short_documents_without_source(spark, sf_dir)
    return transform.rejected_rows(transform.map_rows(documents, DOCUMENT))


def surviving_source_rows(spark, sf_dir):
    return transform.surviving_source_rows(person(spark, sf_dir), PERSON)


def truncate_text(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", truncate_chars(text, 100).alias("text_100"), F.length(text).alias("n_text")
    )


def trim_text(spark, sf_dir):
    """Texts come without blanks around them, so some are put there first."""
    blanks = F.concat(F.lit("\u00a0 \t"), F.col("text"), F.lit(" \n\u3000"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", trim_unicode(blanks).alias("trimmed"), F.length(blanks).alias("n_before")
    )


# -- loads ------------------------------------------------------------------------------------


def _order_lines(spark, sf_dir):
    """Order lines keyed by their order, so most keys come several times."""
    return table(spark, sf_dir, "lineitem").select(
        uuid5(F.col("l_orderkey"), PATIENT_NAMESPACE).alias("order_uuid"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )


def _moved_orders(spark, sf_dir):
    """Orders an earlier run had moved: the finished ones."""
    finished = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return finished.select(uuid5(F.col("o_orderkey"), PATIENT_NAMESPACE).alias("order_uuid"))


def insert_if_absent(spark, sf_dir):
    return load.insert_if_absent(
        _order_lines(spark, sf_dir),
        _moved_orders(spark, sf_dir),
        "order_uuid",
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
    )


def load_counts(spark, sf_dir):
    return load.load_counts(
        _order_lines(spark, sf_dir), _moved_orders(spark, sf_dir), "order_uuid"
    )


def dry_run_counts(spark, sf_dir):
    return load.dry_run_counts(valid_rows(spark, sf_dir))


def _loaded(rows: DataFrame, target: DataFrame) -> DataFrame:
    """The target after a load."""
    fresh = load.insert_if_absent(valid_person(rows), target, PERSON.key_output)
    return target.unionByName(fresh)


def replay_is_noop(spark, sf_dir):
    rows = person(spark, sf_dir)
    before = moved_person(spark, sf_dir)
    after = _loaded(rows, before)
    first = load.load_counts(valid_person(rows), before, PERSON.key_output)
    second = load.load_counts(valid_person(rows), after, PERSON.key_output)
    return first.select(F.lit("first").alias("run"), "*").unionByName(
        second.select(F.lit("second").alias("run"), "*")
    )


def resume_equivalence(spark, sf_dir):
    """Move up to the watermark, then from it: the target must equal that of one run."""
    rows = person(spark, sf_dir)
    low, _ = extract.key_bounds(rows, "id")
    stop = middle(rows, "id")
    paused = _loaded(extract.key_range(rows, "id", low, stop), moved_person(spark, sf_dir))
    return _loaded(extract.after_watermark(rows, "id", stop), paused)


def _doomed(spark, sf_dir):
    first, last = inner_half(person(spark, sf_dir), "id")
    return rollback.doomed_keys(spark, PERSON, first, last)


def rollback_remaining(spark, sf_dir):
    target = moved_person(spark, sf_dir)
    return rollback.rows_to_keep(target, _doomed(spark, sf_dir), PERSON.key_output)


def rollback_deleted_count(spark, sf_dir):
    target = moved_person(spark, sf_dir)
    gone = rollback.rows_to_delete(target, _doomed(spark, sf_dir), PERSON.key_output)
    return gone.agg(F.count(F.lit(1)).alias("deleted"))


# -- checks -----------------------------------------------------------------------------------


def validate_counts(spark, sf_dir):
    rows = person(spark, sf_dir)
    moved = extract.key_range(rows, "id", *inner_half(rows, "id"))
    mapped = transform.map_rows(moved, PERSON)
    inserted = load.load_counts(
        transform.valid_rows(mapped, PERSON), moved_person(spark, sf_dir), PERSON.key_output
    ).withColumn("rejected", F.lit(0).cast("long"))
    rejected = mapped.agg(
        F.lit(0).cast("long").alias("inserted"),
        F.lit(0).cast("long").alias("skipped"),
        F.count(transform.ERROR).alias("rejected"),
    )
    counts = inserted.drop("staged").unionByName(rejected)
    totals = counts.agg(*[F.sum(c).alias(c) for c in ("inserted", "skipped", "rejected")])
    return quality.reconcile(moved.agg(F.count("id").alias("source_count")), totals)


def reconcile_rows(spark, sf_dir):
    """Orders against a copy in which some are missing, some cost more and some have another key."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    dearer = F.col("o_totalprice") + F.when(key % 1009 == 5, 1.0).otherwise(0.0)
    copied = orders.where(key % 997 != 3).withColumn("o_totalprice", dearer)
    moved = orders.where(key % 1013 == 7).withColumn("o_orderkey", -key - 1)
    return differences.row_differences(orders, copied.unionAll(moved), "o_orderkey")


def key_duplicates(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def active_duplicates(spark, sf_dir):
    active = F.col("o_orderstatus").isin("O", "P")
    return quality.duplicates(table(spark, sf_dir, "orders"), "o_custkey", where=active)


def constraint_violations(spark, sf_dir):
    parts = quality.violations(
        table(spark, sf_dir, "part"), "p_partkey", {"p_name": 10, "p_brand": 7}, ("p_type",)
    )
    documents = quality.violations(
        short_documents_without_source(spark, sf_dir), "doc_id", {"text": 2_000, "lang": 2}, ("source",)
    )
    return parts.select(F.lit("part").alias("table_name"), "*").unionByName(
        documents.select(F.lit("documents").alias("table_name"), "*")
    )


# -- ledger -----------------------------------------------------------------------------------


def ledger_latest_state(spark, sf_dir):
    return ledger.latest_state(ledger_events(spark, sf_dir))


def ledger_status_times(spark, sf_dir):
    return ledger.status_times(ledger_events(spark, sf_dir))


def ledger_list_by_status(spark, sf_dir):
    return ledger.with_status(ledger_latest_state(spark, sf_dir), "completed")


def ledger_bad_transitions(spark, sf_dir):
    return ledger.bad_transitions(spark, ledger_events(spark, sf_dir))


def latest_completed(spark, sf_dir):
    return ledger.latest_completed(
        ledger_runs(spark, sf_dir), ["pair"], "run", ["run", "created_at", "last_id"]
    )


def resume_point(spark, sf_dir):
    return ledger.resume_points(ledger_runs(spark, sf_dir), ["pair"], "run", "last_id")


def error_log_json(spark, sf_dir):
    rejects = _batched_person(spark, sf_dir).where(F.col("error").isNotNull())
    return ledger.error_pages(rejects, ["batch_no"])


def error_log_parse(spark, sf_dir):
    """Failed events as JSON pages of one job and range, read back into rows."""
    failed = ledger_events(spark, sf_dir).where(F.col("status") == "failed")
    page = batches.whole_part(F.col("seq"), BATCH)
    entries = failed.select(
        "job_id", page.alias("page"), F.col("seq").alias("id"), F.col("props").alias("error")
    )
    return ledger.parse_errors(ledger.error_pages(entries, ["job_id", "page"]), ["job_id"])


# -- generators -------------------------------------------------------------------------------


def gen_series(spark, sf_dir):
    first, last = extract.key_bounds(table(spark, sf_dir, "orders"), "o_orderkey")
    return integer_series(spark, first, last)


def _order_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"))


def gen_patients(spark, sf_dir):
    return synth.patients(_order_ids(spark, sf_dir))


def gen_doctors(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("n"))
    return synth.doctors(parts)


def gen_postcode(spark, sf_dir):
    """Whole prices as ids: they pass 90,000, from where a code would have six digits."""
    n = F.floor("o_totalprice").cast("long")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", synth.postcode(n).alias("kode_pos"), synth.phone(n, 3, 0, 0).alias("telepon")
    )


def gen_dates(spark, sf_dir):
    n = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        synth.day_after("1940-01-01", n % 30_000).alias("tanggal_lahir"),
        synth.day_after("2010-01-01", n % 5_475).alias("tanggal_registrasi"),
    )


def seed_growth_counts(spark, sf_dir):
    """Patients exist for the customer ids; patients for the order ids are added where absent."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id_pasien"))
    grown = synth.patients(_order_ids(spark, sf_dir))
    added = load.load_counts(grown.select("id_pasien"), customers, "id_pasien")
    zero = F.lit(0).cast("long")
    parts = customers.agg(F.count("id_pasien").alias("before_count"), zero.alias("added")).unionByName(
        added.select(zero.alias("before_count"), F.col("inserted").alias("added"))
    )
    totals = parts.agg(F.sum("before_count").alias("before_count"), F.sum("added").alias("added"))
    return totals.withColumn("after_count", F.col("before_count") + F.col("added"))


# -- whole jobs -------------------------------------------------------------------------------


def _migration(spark, sf_dir) -> Migration:
    source = Source(lambda session: person(session, sf_dir))
    return Migration(spark, scratch_path(spark, "migration"), {"customer": source})


def migrate_job(spark, sf_dir):
    """A dry run, a real run, an incremental run that finds nothing new: the folded ledger."""
    migration = _migration(spark, sf_dir)
    for dry_run in (True, False, False):
        migration.start_job(migration.create_job("customer", "person", dry_run=dry_run))
    jobs = migration.jobs_table()
    return jobs.groupBy("status", "dry_run", "start_after").agg(
        *[
            F.sum(c).alias(c)
            for c in ("total_records", "processed", "success", "failed", "skipped")
        ],
        F.min("first_processed_id").alias("first_processed_id"),
        F.max("last_processed_id").alias("last_processed_id"),
    )


def migrate_target(spark, sf_dir):
    """The target after one job was loaded and rolled back, and a second one loaded again."""
    migration = _migration(spark, sf_dir)
    first = migration.create_job("customer", "person")
    migration.start_job(first)
    migration.rollback_job(first)
    migration.start_job(migration.create_job("customer", "person"))
    return migration.target_rows("customer")


def migrate_sliced(spark, sf_dir):
    """A job in three slices, stopped through the ledger after the first and then taken up again:
    its state when it stopped, and at the end."""
    migration = _migration(spark, sf_dir)
    size = -(-table(spark, sf_dir, "customer").count() // 3)
    job_id = migration.create_job("customer", "person", batch_size=size)
    asked = []

    def stop_before_the_second():
        asked.append(1)
        if len(asked) == 2:
            migration.stop_job(job_id)
        return False

    stopped = migration.start_job(job_id, stop_before_the_second)
    done = migration.start_job(job_id)
    columns = ["status", "total_records", "processed", "success", "failed", "skipped",
               "first_processed_id", "last_processed_id"]
    states = [tuple(job[c] for c in columns) for job in (stopped, done)]
    longs = ", ".join(f"{c} long" for c in columns[1:])
    return spark.createDataFrame(states, f"status string, {longs}")


def _in_thirds(spark, sf_dir):
    """Three incremental runs, each over the next third of the ids; the migration and its jobs."""
    rows = person(spark, sf_dir)
    low, high = extract.key_bounds(rows, "id")
    reached = [low]
    source = Source(lambda session: person(session, sf_dir).where(F.col("id") <= reached[-1]))
    migration = Migration(spark, scratch_path(spark, "migration"), {"customer": source})
    jobs = []
    for third in (1, 2, 3):
        reached.append(low + (high - low) * third // 3)
        jobs.append(migration.start_job(migration.create_job("customer", "person")).job_id)
    return migration, jobs


def target_ranges(spark, sf_dir):
    """What the target's list says of three loads: their id ranges and numbers of rows."""
    migration, _ = _in_thirds(spark, sf_dir)
    folders = migration.target(PERSON).folders()
    listed = [(f.first, f.last, f.rows) for f in folders]
    return spark.createDataFrame(listed, "first_id long, last_id long, n_rows long")


def rollback_middle(spark, sf_dir):
    """The target after the second of three runs was rolled back: no other folder is touched."""
    migration, jobs = _in_thirds(spark, sf_dir)
    migration.rollback_job(jobs[1])
    return migration.target_rows("customer")


def slice_assign(spark, sf_dir):
    """Orders in slices by customer, whose rows no slice shares with another."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sliced = batches.slice_rows(orders, "o_custkey", BATCH)
    return sliced.groupBy(F.col(batches.SLICE).cast("long").alias("slice_no")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_custkey").alias("first_id"),
        F.max("o_custkey").alias("last_id"),
    )


def ensure_orders(spark, sf_dir):
    """Patients seeded for the orders where the table is missing; a second call leaves them."""
    location = scratch_path(spark, "ensured")
    seeded = synth.ensure_table(spark, location, lambda: gen_patients(spark, sf_dir))
    again = synth.ensure_table(spark, location, lambda: gen_patients(spark, sf_dir))
    counts = spark.read.parquet(location).agg(F.count("id_pasien").alias("n_rows"))
    return counts.select(F.lit(seeded).alias("seeded"), F.lit(again).alias("seeded_again"), "n_rows")


def stream_by_file(spark, sf_dir):
    """The customers in four files, one per micro-batch: the loads and the job they add up to."""
    location = scratch_path(spark, "files")
    customers = table(spark, sf_dir, "customer")
    customers.repartition(4).write.parquet(location)
    migration = _migration(spark, sf_dir)
    job_id = migration.create_job("customer", "person")
    files = as_person(file_stream(spark, location, customers.schema, max_files=1))
    finish_stream(
        migration, job_id, stream_job(migration, job_id, files, scratch_path(spark, "stream"))
    )
    loads = migration.events().agg(F.count_distinct("load_id")).first()[0]
    job = migration.jobs_table().select("status", "total_records", "processed", "failed", "percentage")
    return job.withColumn("loads", F.lit(loads).cast("long"))


def stream_stopped(spark, sf_dir):
    """A stream of four files that is asked to stop after the first and then goes on: the job when
    it stopped, and at the end, and how many forbidden changes of state the ledger holds."""
    location = scratch_path(spark, "files")
    customers = table(spark, sf_dir, "customer")
    for part in range(4):
        rows = customers.where(F.col("c_custkey") % 4 == part)
        rows.coalesce(1).write.mode("append").parquet(location)
    migration = _migration(spark, sf_dir)
    job_id = migration.create_job("customer", "person")
    checkpoint = scratch_path(spark, "stream")
    asked = []

    def stop_before_the_second():
        asked.append(1)
        if len(asked) == 2:
            migration.stop_job(job_id)
        return False

    states = []
    for should_stop in (stop_before_the_second, None):
        files = as_person(file_stream(spark, location, customers.schema, max_files=1))
        query = stream_job(migration, job_id, files, checkpoint, should_stop=should_stop)
        finish_stream(migration, job_id, query)
        job = migration.get_job(job_id)
        states.append((job.status, job.processed, job.success, job.failed))
    bad = ledger.bad_transitions(spark, migration.events()).count()
    rows = spark.createDataFrame(states, "status string, processed long, success long, failed long")
    return rows.withColumn("bad_changes", F.lit(bad).cast("long"))


def stream_migrate(spark, sf_dir):
    """The customer files as a stream that is drained into the target."""
    migration = _migration(spark, sf_dir)
    job_id = migration.create_job("customer", "person")
    schema = table(spark, sf_dir, "customer").schema
    files = as_person(file_stream(spark, f"{sf_dir}/customer.parquet", schema, max_files=100))
    checkpoint = scratch_path(spark, "stream")
    finish_stream(migration, job_id, stream_job(migration, job_id, files, checkpoint))
    return migration.target_rows("customer")


CASES = {
    case.__name__: case
    for case in (
        snapshot_scan,
        incremental_extract,
        remaining_count,
        range_filter_count,
        table_counts,
        batch_assign,
        nth_batch,
        batch_metrics,
        progress_fold,
        progress_percentage,
        surrogate_key,
        uuid_is_valid,
        random_job_ids,
        merge_name,
        transform_rename,
        valid_rows,
        rejected_rows,
        limit_rejects,
        surviving_source_rows,
        truncate_text,
        insert_if_absent,
        load_counts,
        dry_run_counts,
        replay_is_noop,
        resume_equivalence,
        rollback_remaining,
        rollback_deleted_count,
        validate_counts,
        reconcile_rows,
        key_duplicates,
        active_duplicates,
        constraint_violations,
        ledger_latest_state,
        ledger_status_times,
        ledger_list_by_status,
        ledger_bad_transitions,
        latest_completed,
        resume_point,
        error_log_json,
        error_log_parse,
        gen_series,
        gen_patients,
        gen_doctors,
        gen_postcode,
        gen_dates,
        seed_growth_counts,
        migrate_job,
        migrate_target,
        migrate_sliced,
        target_ranges,
        rollback_middle,
        slice_assign,
        ensure_orders,
        stream_migrate,
        stream_by_file,
        stream_stopped,
    )
} | {"trim_unicode": trim_text}
