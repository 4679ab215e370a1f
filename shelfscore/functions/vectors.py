"""Sparse ml vectors to and from plain columns, inside the JVM."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfscore.sources.scratch import scratch_dir

def vector_entries(vector: Column) -> Column:
    """array<struct<indices, values>> of a sparse vector column."""
    plain = F.unwrap_udt(vector)
    return F.arrays_zip(plain["indices"].alias("indices"), plain["values"].alias("values"))


def vector_indices(vector: Column) -> Column:
    return F.unwrap_udt(vector)["indices"]


def sparse_struct(size: int, indices: Column, values: Column) -> Column:
    """The stored form of a sparse vector, from sorted indices and values."""
    return F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).alias("size"),
        indices.alias("indices"),
        values.alias("values"),
    )


def as_vectors(df: DataFrame, column: str, label: str) -> DataFrame:
    """Turn a column of stored forms into a vector column. A struct has no cast
    to the vector type; written and read with that type it is one."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    fields = [StructField(f.name, VectorUDT() if f.name == column else f.dataType) for f in df.schema]
    return df.sparkSession.read.schema(StructType(fields)).parquet(path)
