"""The corpus pipeline: documents in, packed training sequences out.

Every stage reads what the stage before it kept. A stage that drops documents
drops them by their id, so rows without an id are never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.llm import exact, minhash, mixing, packing, toxicity
from shelfscore.llm.queries import tokenizer_path
from shelfscore.llm.storage import read, written

# A source is repeated no more often than this; no document is left out.
MAX_REPEATS = 1.25


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under one half."""
    found = toxicity.toxicity(docs, read(spark, sf_dir, "labels"))
    return found.where("toxic_score < 0.5").select(*docs.columns)


def _without(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """docs without those whose verdict is to go."""
    gone = written(verdicts.where(~F.col("kept")).select(F.col("id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone.hint("merge"), F.col("doc_id") == F.col("gone_id"), "left_anti")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, and one row of each document
    that occurs several times."""
    verdicts = written(exact.deduplicate(docs), "verdicts")
    kept = _without(docs, verdicts)
    repeated = verdicts.where("id is not null").groupBy("id", "digest").agg(F.count("*").alias("n")).where("n > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _without(docs, minhash.near_duplicates(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by temperature: every document at least once, rare sources more."""
    return mixing.temperature_mix(docs, max_repeats=MAX_REPEATS).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return packing.best_fit_packing(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained score and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
