from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import differences
from tidemark.operators.differences import LEAF_BITS, MAX_INTERVALS, key_intervals, row_differences

SCHEMA = "id long, a string, b int"


def found(spark, left, right):
    rows = row_differences(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "id")
    return sorted(map(tuple, rows.collect()))


def expected(left, right):
    by_side = [{}, {}]
    for side, rows in zip(by_side, (left, right)):
        for row in rows:
            if row[0] is not None:
                side.setdefault(row[0], Counter())[row] += 1
    one, two = by_side
    named = {k: "missing" if k not in two else "extra" if k not in one else "changed"
             for k in one.keys() | two.keys() if one.get(k) != two.get(k)}
    return sorted(named.items())


ids = st.sampled_from([None, 0, 1, -1, 4095, 4096, -4097, 1 << 40, (1 << 63) - 1, -(1 << 63)])
rows = st.lists(st.tuples(ids, st.sampled_from([None, "", "x"]), st.sampled_from([None, 0, 1])), max_size=8)


@settings(max_examples=6, deadline=None)
@given(rows, rows)
def test_equals_plain_comparison(spark, left, right):
    assert found(spark, left, right) == expected(left, right)


def test_nulls_copies_and_swaps(spark):
    left = [(1, None, 1), (2, "x", None), (3, "x", 1), (3, "x", 1), (4, "x", 1), (4, "x", 1), (None, "n", 1), (6, "p", 1), (7, "q", 1)]
    right = [(1, "1", None), (2, "x", None), (3, "x", 1), (4, "y", 1), (4, "y", 1), (5, "x", 1), (6, "q", 1), (7, "p", 1)]
    assert found(spark, left, right) == expected(left, right)
    assert found(spark, left, left[::-1]) == found(spark, [], []) == []


def test_odd_column_names(spark):
    left = spark.createDataFrame([(1, 2, 3)], "`a.b` long, key int, range int")
    right = left.withColumn("range", F.lit(4))
    assert [tuple(r) for r in row_differences(left, right, "a.b").collect()] == [(1, "changed")]


def test_second_scan_reads_within_key_bounds(spark, tmp_path, plan_of):
    spark.range(200_000).select("id", (F.col("id") * 3).alias("v")).write.parquet(f"{tmp_path}/left")
    left = spark.read.parquet(f"{tmp_path}/left")
    left.where("id <> 150000").withColumn("v", F.when(F.col("id") == 70_000, 1).otherwise(F.col("v"))).write.parquet(f"{tmp_path}/right")
    right = spark.read.parquet(f"{tmp_path}/right")
    rows = row_differences(left, right, "id")
    assert sorted(map(tuple, rows.collect())) == [(70_000, "changed"), (150_000, "missing")]
    plan = plan_of(rows).split("Initial Plan")[0]
    assert plan.count(f"GreaterThanOrEqual(id,{70_000 >> LEAF_BITS << LEAF_BITS})") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_ranges_are_covered_by_few_intervals(spark):
    ranges = spark.range(0, 100_000, 7).select(F.col("id").alias("range"))
    intervals = key_intervals(ranges)
    assert 0 < len(intervals) <= MAX_INTERVALS
    assert all(a <= 0 or b < intervals[k + 1][0] for k, (a, b) in enumerate(intervals[:-1]))
    assert intervals[0][0] <= 0 and intervals[-1][1] >= 99_995 << LEAF_BITS
    assert differences.LEVELS * differences.FAN_BITS <= 63
