"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call sites of every column expression cost more than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", app: str = "tidemark", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    cores = str(cpus)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    partitions = cores if cores.isdigit() else "8"
    local = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.driver.memory": "12g",
    }
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Lets Python workers import this package where the session was started from another folder.

    The package's folder has to exist on all machines; else install the package or send it with
    ``--py-files``, and this changes nothing.
    """
    home, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if home not in paths:
        known["PYTHONPATH"] = os.pathsep.join([home, *paths])


def with_code(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``job``, whose first argument is a session, after ``share_code`` in that session."""

    @functools.wraps(job)
    def run(spark: SparkSession, *rest: object) -> DataFrame:
        share_code(spark)
        return job(spark, *rest)

    return run


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, the path): any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    store, where = _file_system(spark, path)
    return store.exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    store, where = _file_system(spark, path)
    store.delete(where, True)


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_root(spark)}/tidemark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application has settled; for callers that are done with the results."""
    delete_path(spark, scratch_root(spark))


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder once, so that many later passes read files.

    Used before iterative fits: each pass reads just the columns it needs, and a lost
    executor costs a file read, not a recomputation from the raw tables.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
