"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.llm import exact, fim, html, minhash, mixing, packing, quality, quotes, spelling, substring, toxicity, urls, warc
from shelfscore.llm.sql import SQL
from shelfscore.llm.storage import read, written

__all__ = ["QUERIES", "SQL"]

# The host and path rules of the query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    found = warc.round_trip(pages.select("page_id", "url", "html"), payloads=False)
    return found.select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.toxicity(docs, read(spark, sf_dir, "labels"))
    score = F.col("toxic_score")
    return found.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def replies(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: every turn quotes the one before it, which itself
    quotes the one before that. Repeated rows of one (conv_id, turn) stay rows
    of their own; a later turn quotes one text of them, the smallest, so no row
    is multiplied."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", text.alias("own"))
    quotable = turns.groupBy("conv_id", "turn").agg(F.min("own").alias("own"))

    def back(n: int) -> DataFrame:
        return quotable.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("own").alias(f"own{n}"))

    def quoted(of: str, mark: str) -> Column:
        return F.concat(F.lit("\n\n"), F.regexp_replace(of, "(?m)^", mark))

    mails = turns.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    parts = [F.col("own"), *[F.coalesce(quoted(f"own{n}", "> " * n), F.lit("")) for n in (1, 2)]]
    name = F.concat_ws("-", "conv_id", "turn").alias("id")
    return mails.select(name, "conv_id", "turn", F.concat(*parts).alias("text"))


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = replies(read(spark, sf_dir, "conversations"))
    found = quotes.linked(mails, "id", "conv_id", "turn", "text")
    return found.select(
        F.col("thread").alias("conv_id"),
        F.col("position").alias("turn"),
        "reply_to",
        "conversation",
        "depth",
        "n_quoted",
        "n_linked",
        F.sha2("own_text", 256).alias("own_sha256"),
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.filtered(read(spark, sf_dir, "pages"), RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", "source", mixing.word_tokens(F.col("text")).alias("n_tokens"))
    sizes = written(sizes, "doc-tokens")
    budget = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    drawn = mixing.temperature_mix(sizes, tokens=F.col("n_tokens"), budget=float(budget), max_repeats=2.0)
    return drawn.select(
        "doc_id",
        "source",
        "n_tokens",
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_block").alias("block"),
        F.col("mix_slot").alias("slot"),
    )


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.deduplicated(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.deduplicate(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(read(spark, sf_dir, "pages"), ["page_id", "url"])


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_quotes": op4_quotes,
    "op5_urls": op5_urls,
    "op6_minhash": op6_minhash,
    "op7_mixing": op7_mixing,
    "op8_substring": op8_substring,
    "op9_packing": op9_packing,
    "op10_exact": op10_exact,
    "op11_html": op11_html,
    "op12_spelling": op12_spelling,
    "op13_fim": op13_fim,
}
