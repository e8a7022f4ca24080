"""Session factory and table access."""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of large rows, about.
BATCH = 4 << 20


def get_session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; on a cluster the submitter's settings win."""
    builder = (
        SparkSession.builder.master(master)
        .appName("lectern")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a temporary one, in local mode only."""
    sc = spark.sparkContext
    if found := sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir"):
        return found
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lectern-"))
    return sc.getCheckpointDir()


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """For jobs within it whose rows are large: batches go to Python at BATCH bytes, as a JVM holds several times a batch
    outside its heap for each task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH))
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def settled(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder: what is built on it has a short plan, and reads it instead of
    making it anew."""
    sc, folder = df.sparkSession.sparkContext, shared_folder(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
