"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(
    app: str = "tidemark",
    cores: int | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build a session. ``cores`` makes a local one; leave it out under spark-submit.

    ``input_bytes``, the size of the tables to shuffle, sets the number of shuffle partitions to
    start from; adaptive execution merges those that turn out small.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(BASE_CONF)
    if cores is not None:
        builder = builder.master(f"local[{cores}]")
        settings |= {
            "spark.sql.shuffle.partitions": str(cores),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        }
    if input_bytes is not None:
        start = str(shuffle_partitions_for(input_bytes))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = start
    for name, value in (settings | conf).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 192 << 20) -> int:
    """Shuffle partitions that keep one partition of ``input_bytes`` within a task's memory."""
    return max(8, -(-input_bytes // target_bytes))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the current run's folder, or below the shared folder outside a run."""
    folder = _run_folder.get() or f"{shared_dir(spark)}/tidemark"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """Keep what is staged inside the block in one folder, and remove it at the end."""
    path = scratch_path(spark, name)
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        remove_path(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and unlike ``checkpoint()`` stays columnar, so later
    passes read only the columns they use.  Within :func:`run_folder` the copy goes when the run
    ends; otherwise it stays for the owner of the shared folder to clean, as checkpoints do.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = file_system(spark, path)
    return system.exists(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    system, hadoop_path = file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(hadoop_path)]


def is_folder(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = file_system(spark, path)
    return system.getFileStatus(hadoop_path).isDirectory()


def remove_path(spark: SparkSession, path: str) -> None:
    system, hadoop_path = file_system(spark, path)
    system.delete(hadoop_path, True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
