"""Session settings the operators count on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions of a hot key are merged inside each input partition before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC time and adaptive execution; the master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; in local mode without one (tests) one local folder per process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="plumbline-"))
    return _LOCAL[0]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, empty path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a reduced table once to the shared folder and go on from the files: the raw rows below
    it are read once, and a lost executor costs a re-read of the table, not of the raw rows."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a freshly read table over all cores when it comes as fewer splits than there are cores.

    For expensive row work (patterns, digests of long texts) on few or large files. Inputs of
    cluster size have more splits than cores and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, *keys: str, rows: int = 1 << 18) -> DataFrame:
    """The rows dealt by `keys` into partitions of about `rows` rows each, whatever the size of the input.

    For groupings with nearly as many groups as rows: a join or grouping on these keys then runs in these partitions, so the
    memory of a task stays the same and their number grows. Costs one count of `df`.
    """
    return df.repartition(max(1, -(-df.count() // rows)), *keys)
