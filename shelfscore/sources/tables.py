"""Catalogue-shaped views over the parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelfscore.sources.scratch import lookup


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


TRAIN = StructType(
    [*_strings("id", "product_uid", "title", "search_term").fields, StructField("relevance", DoubleType())]
)
TEST = _strings("id", "product_uid", "title", "search_term")
ATTRIBUTES = _strings("product_uid", "name", "value")
DESCRIPTIONS = _strings("product_uid", "description")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with the files that it has now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, product_uid, title, search_term, relevance: one row per user turn.

    A conversation is a product here and may be long. Names and labels are
    joined first and written, so the turns meet one table in one join, both
    sides straight from a shuffle, and a hot product is split. The id is text:
    no number of turns makes two rows share one."""
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("conv_id"), "p_name")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"), "quality")
    products = lookup(parts.join(labels, "conv_id", "left"), "products")
    score = (1 + F.coalesce("quality", F.lit(0))).cast("double") + F.lit(0.33) * (F.col("turn") % 3)
    return turns.join(products, "conv_id").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("conv_id").alias("product_uid"),
        F.col("p_name").alias("title"),
        F.col("text").alias("search_term"),
        F.round(score, 2).alias("relevance"),
    )


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train(spark, sf_dir).drop("relevance")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_uid, name, value: each part unpivoted in one scan."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_uid"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_size").cast("string").alias("size"),
    )
    return parts.unpivot("product_uid", ["brand", "type", "size"], "name", "value")


def product_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_uid"), F.col("text").alias("description")
    )
