import pytest

from tidemark.session import (
    path_exists,
    run_folder,
    shared_dir,
    shuffle_partitions_for,
    stage,
)
from tidemark.sources import DatabaseConfig, read_snapshot
from tidemark.sources.jdbc import partition_options


def test_database_options():
    config = DatabaseConfig("db.example", "clinic", "reader", "secret", port=5433, sslmode="require")
    assert config.url() == "jdbc:postgresql://db.example:5433/clinic?sslmode=require"
    assert config.options()["user"] == "reader"
    assert partition_options("id", 1, 101, 10)["numPartitions"] == "10"


def test_snapshot_with_declared_schema(spark, tmp_path):
    location = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, 'x' AS b, 2.0D AS c").write.parquet(location)
    rows = read_snapshot(spark, location, ["b"], "a int, b string, c double")
    assert [tuple(r) for r in rows.collect()] == [("x",)]


def test_staging_goes_to_the_shared_folder(spark):
    rows = stage(spark.range(5), "example")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_dir(spark) in name for name in rows.inputFiles())
    with run_folder(spark, "run") as folder:
        copy = stage(spark.range(5), "example")
        assert all(folder in name for name in copy.inputFiles())
        assert copy.count() == 5
    assert not path_exists(spark, folder)
    assert rows.count() == 5


@pytest.mark.parametrize(("size", "expected"), [(0, 8), (100 << 40, 546_134)])
def test_shuffle_partitions(size, expected):
    assert shuffle_partitions_for(size) == expected
