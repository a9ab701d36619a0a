import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import batches, extract


def numbered(spark, rows, columns, *order, partitions=7):
    frame = spark.createDataFrame(rows, columns)
    return batches.number_rows(frame, *order, partitions=partitions)


def test_row_numbers_are_dense_and_in_order(spark):
    keys = random.Random(1).sample(range(-10_000, 10_000), 3_000)
    result = numbered(spark, [(k,) for k in keys], "k long", "k").collect()
    assert {r.k: r.row_no for r in result} == {k: i for i, k in enumerate(sorted(keys))}


def test_a_hot_value_is_split_by_the_next_column(spark):
    rows = [(0, i) for i in range(2_000)] + [(i, 0) for i in range(1, 1_000)]
    result = numbered(spark, rows, "k long, tie long", "k", "tie")
    got = [(r.k, r.tie) for r in sorted(result.collect(), key=lambda r: r.row_no)]
    assert got == sorted(rows)


def test_no_rows(spark):
    assert numbered(spark, [], "k long", "k").collect() == []


def test_numbering_needs_no_window_and_one_exchange_of_the_rows(spark, plan_of):
    frame = numbered(spark, [(1,)], "k long", "k")
    plan = plan_of(frame)
    assert "Window" not in plan
    assert "hashpartitioning" not in plan
    assert "rangepartitioning" not in plan  # the sorted pieces are read from the shared folder


@pytest.mark.parametrize("size", [1, 3, 500])
def test_batches(spark, size):
    frame = spark.range(0, 1_000).withColumn("error", F.when(F.col("id") < 5, "bad"))
    batched = batches.assign_batches(frame, "id", batch_size=size, partitions=5)
    metrics = {r.batch_no: r for r in batches.batch_metrics(batched, "id").collect()}
    assert len(metrics) == -(-1_000 // size)
    for number, row in metrics.items():
        last = min(1_000, (number + 1) * size) - 1
        assert (row.first_id, row.last_id) == (number * size, last)
        assert row.processed == row.valid + row.rejected
    folded = batches.fold_progress(batches.batch_metrics(batched, "id")).first()
    assert tuple(folded) == (len(metrics), 1_000, 995, 5, 0, 999)
    assert batches.nth_batch(batched, 1).count() == metrics[1].processed


def test_whole_part_is_exact_for_large_numbers(spark):
    number = (1 << 60) + 1
    row = spark.range(1).select(batches.whole_part(F.lit(number), 3)).first()
    assert row[0] == number // 3


def test_percentage(spark):
    rows = spark.createDataFrame([(1, 4), (0, 0), (1, None)], "a long, b long")
    got = [r[0] for r in rows.select(batches.percentage(F.col("a"), F.col("b"))).collect()]
    assert got == [25.0, None, None]


def test_watermark(spark):
    rows = spark.range(-3, 4)
    assert extract.after_watermark(rows, "id", None).count() == 7
    assert extract.after_watermark(rows, "id", 0).count() == 3
    assert extract.after_watermark(rows, "id", -1).count() == 4
    assert extract.remaining_count(rows, "id", 1).first()[0] == 2
    assert extract.key_bounds(rows, "id") == (-3, 3)
    assert extract.key_bounds(rows.limit(0), "id") is None


def test_watermark_and_columns_reach_the_scan(spark, plan_of, tmp_path):
    location = str(tmp_path / "t")
    spark.range(100).withColumn("a", F.lit("x")).withColumn("b", F.lit("y")).write.parquet(location)
    rows = extract.after_watermark(spark.read.parquet(location), "id", 50).select("id", "a")
    plan = plan_of(rows)
    assert "GreaterThan(id,50)" in plan
    assert "ReadSchema: struct<id:bigint,a:string>" in plan


def test_snapshot_does_not_see_later_files(spark, tmp_path):
    location = str(tmp_path / "t")
    spark.range(10).write.parquet(location)
    snapshot = spark.read.parquet(location)
    spark.range(10, 20).write.mode("append").parquet(location)
    assert snapshot.count() == 10
    assert spark.read.parquet(location).count() == 20


def test_labelled_counts(spark):
    rows = spark.createDataFrame([(1,), (None,)], "k int")
    found = extract.labelled_counts({"a": (rows, "k"), "b": (rows.limit(0), "k")})
    assert sorted(tuple(r) for r in found.collect()) == [("a", 2, 1), ("b", 0, 0)]
