"""Shared helpers: tables in the cluster's folder and bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.sources.scratch import scratch_dir, shuffles_dropped, written

__all__ = ["bounded_batches", "content_words", "number_array", "read", "scratch_dir", "shuffles_dropped", "spaced", "written"]

# Upper bound in bytes of one batch of rows that is handed to Python.
BATCH_BYTES = 16 * 1024 * 1024

# Fixed value: the white space that separates words in every operator here.
SPACE = r"[\x20\x09-\x0D]+"


# Joins that move whole texts carry the hint "merge", so that they take the
# same way at every size of the other side.


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of long texts in Python workers, unless the session
    has a bound of its own that is tighter."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    set_to = spark.conf.get(key, None)
    if set_to is None or not set_to.isdigit() or int(set_to) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spaced(text: Column) -> Column:
    """Every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def content_words(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def number_array(values: list[int]) -> Column:
    """Whole numbers of a model of fixed size as one array constant. It is
    written as text, which the optimizer turns into the array once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
