"""Fresh folders in the storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _root(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir, or the checkpoint
    folder of the context. Only a session whose executors are threads of this
    machine gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if found := context.getCheckpointDir():
        return found
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("executors share no folder: set spark.checkpoint.dir to one that all of them can read and write")
    return tempfile.mkdtemp(prefix="shelfscore-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder in the storage that all executors share."""
    return f"{_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, every query's shuffle files go when it ends, and not when the
    driver collects its garbage; for steps that each write their result."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: several readers share one evaluation, and a lost
    executor costs a re-read instead of a recomputation. What was shuffled for
    it leaves the disk."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, label: str) -> DataFrame:
    """A table with one row per key, written before large tables join it.

    Adaptive execution splits a hot key only where both join inputs come
    straight from a shuffle. An aggregate by the join key sits between shuffle
    and join and would leave the hot key in one task; its written result is
    shuffled (or broadcast, by its real size) for the join alone."""
    return written(df, label)
