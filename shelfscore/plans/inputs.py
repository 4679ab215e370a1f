"""Inputs that several registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.operators import bags, features
from shelfscore.plans.sql import STOPWORDS
from shelfscore.sources import tables


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.training_tokens(tables.train(spark, sf_dir), STOPWORDS)


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.search_tokens(tables.train(spark, sf_dir))


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.description_tokens(tables.product_descriptions(spark, sf_dir), STOPWORDS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptions(spark, sf_dir).withColumnRenamed("product_uid", "id")


def shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.shared_bag(
        tables.train(spark, sf_dir),
        tables.attributes(spark, sf_dir),
        tables.product_descriptions(spark, sf_dir),
        STOPWORDS,
    )


def bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.product_bundle(
        tables.train(spark, sf_dir),
        tables.attributes(spark, sf_dir),
        tables.product_descriptions(spark, sf_dir),
        STOPWORDS,
    )


def bundle_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, term, tf) of the bundle."""
    return bundle(spark, sf_dir).where(F.col("term").isNotNull()).select("id", "term", "tf")


def bundle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, index, value): hashed counts of the bundle. Texts are hashed where
    they lie, so only buckets are shuffled."""
    texts = bags.product_texts(
        tables.train(spark, sf_dir),
        tables.attributes(spark, sf_dir),
        tables.product_descriptions(spark, sf_dir),
        STOPWORDS,
    )
    counts = features.hashed_bag(texts, "product_uid")
    return features.hashed_bundle(training(spark, sf_dir), counts)
