import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import load, quality, rollback
from tidemark.plans.spec import PATIENTS
from tidemark.functions import uuid5
from tidemark.sources import TargetTable, append_bucketed, create_catalog_table

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ROWS = st.lists(st.tuples(st.integers(0, 9), st.integers(0, 5)), max_size=40)


def expected(rows, existing):
    first = {}
    for key, value in sorted(rows):
        first.setdefault(key, value)
    return sorted((k, v) for k, v in first.items() if k not in existing)


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("strategy", ["plan", "found first"])
@FEW
@given(ROWS, st.sets(st.integers(0, 9)))
def test_every_strategy_gives_the_same_rows(spark, strategy, unique, rows, existing):
    if unique:
        rows = expected(rows, set())
    new = spark.createDataFrame(rows, "k string, v long")
    target = spark.createDataFrame([(k,) for k in existing], "k string")
    first = strategy == "found first"
    got = load.insert_if_absent(new, target, "k", ["v"], find_first=first, unique=unique)
    assert sorted((int(r.k), r.v) for r in got.collect()) == expected(rows, existing)


@FEW
@given(ROWS, st.sets(st.integers(0, 9)))
def test_counts(spark, rows, existing):
    new = spark.createDataFrame(rows, "k long, v long")
    target = spark.createDataFrame([(k,) for k in existing] * 2, "k long")
    inserted = len(expected(rows, existing))
    got = load.load_counts(new, target, "k").first()
    assert tuple(got) == (len(rows), inserted, len(rows) - inserted)


def test_first_row_by_all_columns_without_an_order(spark):
    rows = spark.createDataFrame([(8, "B", "D"), (8, "A", "C")], "k int, a string, b string")
    got = load.insert_if_absent(rows, rows.limit(0).select("k"), "k").collect()
    assert [tuple(r) for r in got] == [(8, "A", "C")]


def test_a_hot_key_leaves_each_map_task_once(spark, plan_of):
    """The limit per key is applied before the shuffle, and the rows are shuffled once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1_000).select((F.col("id") % 3).alias("k"), "id")
        plan = plan_of(load.insert_if_absent(rows, spark.range(1).select(F.col("id").alias("k")), "k", ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 2  # new rows and target keys


def test_unique_rows_into_an_empty_target_need_no_shuffle(spark, plan_of):
    rows = spark.range(1_000).withColumnRenamed("id", "k")
    plan = plan_of(
        load.insert_if_absent(rows, rows.limit(0), "k", find_first=True, unique=True)
    )
    assert "Exchange" not in plan


def test_bucketed_target_is_not_shuffled(spark, plan_of):
    spark.sql("DROP TABLE IF EXISTS bucketed_target")
    append_bucketed(spark.range(0, 100).withColumnRenamed("id", "k"), "bucketed_target", "k", 4)
    append_bucketed(spark.range(100, 150).withColumnRenamed("id", "k"), "bucketed_target", "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.range(140, 160).withColumnRenamed("id", "k")
        fresh = load.insert_if_absent(new, spark.table("bucketed_target"), "k", ["k"])
        plan = plan_of(fresh)
        assert plan.count("Exchange hashpartitioning") == 1
        assert sorted(r.k for r in fresh.collect()) == list(range(150, 160))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_target")


def test_dry_run_counts_valid_rows(spark):
    assert tuple(load.dry_run_counts(spark.range(7)).first()) == (7, 0)


def test_target_loads_and_versions(spark, tmp_path):
    rows = spark.range(10).withColumnRenamed("id", "k")
    target = TargetTable(spark, str(tmp_path / "target"), rows.schema).ensure()
    assert target.read().count() == 0
    assert target.write_load(rows.where("k < 6"), "a") == 6
    assert target.write_load(rows.where("k >= 6"), "b") == 4
    assert target.write_load(rows.where("k >= 6"), "b") == 4  # again: same rows, same count
    assert sorted(r.k for r in target.read().collect()) == list(range(10))
    assert sorted(r.k for r in target.read(without_load="b").collect()) == list(range(6))
    assert target.write_load(rows.where("k > 99"), "c") == 0
    target.write_version(target.read().where("k > 2"), 2)
    assert target.read(2).count() == 7
    assert target.read(1).count() == 10


def test_writing_nothing_after_a_join_counts_zero(spark, tmp_path):
    rows = spark.range(10).withColumnRenamed("id", "k")
    target = TargetTable(spark, str(tmp_path / "target"), rows.schema).ensure()
    target.write_load(rows, "a")
    fresh = load.insert_if_absent(rows, target.read(), "k", ["k"])
    assert target.write_load(fresh, "b") == 0
    assert target.read().count() == 10


def people(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id_pasien int").select(
        uuid5(F.col("id_pasien"), PATIENTS.namespace).alias("pasien_uuid"), "id_pasien"
    )


@pytest.mark.parametrize("sparse", [False, True])
def test_range_delete(spark, sparse):
    target = people(spark, [1, 5, 6, 7, 20])
    ids = spark.createDataFrame([(5,), (5,), (6,), (7,), (20,)], "id_pasien int") if sparse else None
    doomed = rollback.doomed_keys(spark, PATIENTS, 5, 10, ids)
    kept = rollback.rows_to_keep(target, doomed, "pasien_uuid")
    gone = rollback.rows_to_delete(target, doomed, "pasien_uuid")
    assert sorted(r.id_pasien for r in kept.collect()) == [1, 20]
    assert sorted(r.id_pasien for r in gone.collect()) == [5, 6, 7]


def test_duplicates(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "y")], "k int, s string")
    assert [tuple(r) for r in quality.duplicates(rows, "k").collect()] == [(1, 3)]
    only_y = quality.duplicates(rows, "s", where=F.col("s").isin("y"))
    assert [tuple(r) for r in only_y.collect()] == [("y", 2)]


@pytest.mark.parametrize(
    ("source", "inserted", "skipped", "rejected", "expected"),
    [
        (10, 7, 3, 0, (10, 10, 0, True, 0)),
        (10, 7, 1, 2, (10, 8, 2, False, 2)),
        (0, 0, 0, 0, (0, 0, 0, True, 0)),
    ],
)
def test_reconcile(spark, source, inserted, skipped, rejected, expected):
    counted = spark.createDataFrame([(source,)], "source_count long")
    counts = spark.createDataFrame(
        [(inserted, skipped, rejected)], "inserted long, skipped long, rejected long"
    )
    assert tuple(quality.reconcile(counted, counts).first()) == expected


def test_catalog_table_enforces_limits(spark):
    spark.sql("DROP TABLE IF EXISTS limited_target")
    rows = spark.sql("SELECT 1L AS k, 'abc' AS name")
    try:
        assert create_catalog_table(spark, "limited_target", rows.schema, {"name": 3}) is True
        assert create_catalog_table(spark, "limited_target", rows.schema, {"name": 3}) is False
        rows.write.insertInto("limited_target")
        with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
            rows.withColumn("name", F.lit("abcd")).write.insertInto("limited_target")
        assert spark.table("limited_target").count() == 1
    finally:
        spark.sql("DROP TABLE limited_target")


def test_derived_keys_are_not_computed_to_test_for_null(spark, plan_of):
    rows = spark.range(10).select(uuid5(F.col("id"), PATIENTS.namespace).alias("k"))
    nullable = rows.select(F.nullif("k", F.lit("x")).alias("k"))
    plan = plan_of(load.absent_keys(nullable, rows, "k", find_first=True))
    assert "isnotnull(coalesce" not in plan
