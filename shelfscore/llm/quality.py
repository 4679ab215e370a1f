"""Quality rules on columns: simple counts, and an n-gram test.

The test compares two multinomials over words and word pairs: trusted documents
and the whole corpus. A text's score is the mean over its n-grams of
log(p_trusted / p_corpus); texts under a fixed threshold are dropped. Corpus
counts cover every document, trusted counts every document that is marked good.
Both lie in a table by n-gram that grows with the corpus; the n-grams of each
text join it. Counts and joins are made in rounds over parts of the n-grams, so
that only one part's shuffle lies on disk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.storage import content_words, shuffles_dropped, written

# An n-gram is counted under its whole 64-bit hash.
BUCKETS = 1 << 64
THRESHOLD = -0.1
# N-grams of the corpus that the trusted counts are mixed with, so that they do
# not condemn what they happen to lack: as many per trusted n-gram, and so many
# by place of the hash (327,680 in all) at least.
PRIOR_PER_TRUSTED = 4.0
PRIOR = 327_680 / BUCKETS
WINDOW = 5
# Parts of the n-grams, by hash, that are counted, and joined, one after another.
COUNT_ROUNDS = 3
JOIN_ROUNDS = 4
# The most frequent n-grams, so many at most, meet the texts where they lie.
HEAD = 1 << 17
# So many trusted ids are sent to the texts (some 40 MB); more are merged with them.
SENT_IDS = 1 << 20
# Marks that count as symbols, and white space.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"


def _removed(text: Column, marks: str) -> Column:
    return F.translate(text, marks, "")


def base_counts(docs: DataFrame, text: Column, words: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; `words`
    is the column of the text's words."""
    known = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(known, "\n"), lambda x: F.ltrim(x, F.lit(BLANKS)) != "")
    row = F.col(words)
    windows = F.transform(
        F.slice(row, F.lit(1), F.greatest(F.size(row) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(row, i + k) for k in range(1, WINDOW)]),
    )
    df = docs.withColumns(
        {
            "n_words": F.size(row).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            # Few texts have any.
            "n_symbols": F.when(known.rlike(f"[{SYMBOLS}]"), F.length(known) - F.length(_removed(known, SYMBOLS))).otherwise(0).cast("long"),
            "lines_": lines,
            "windows_": windows,
        }
    )
    # Most texts repeat no window; only the others are sorted.
    repeated = F.size(F.array_distinct("windows_")) < F.size("windows_")
    sorted_ = F.sort_array(F.transform("windows_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumns(
        {
            "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
            "sorted_": F.when(repeated, sorted_),
        }
    )
    all_ = F.col("sorted_")
    twice = F.filter(
        all_,
        lambda p, k: F.coalesce(p["h"] == F.get(all_, k + 1)["h"], F.lit(False))
        | F.coalesce(p["h"] == F.get(all_, k - 1)["h"], F.lit(False)),
    )
    df = df.withColumn("starts_", F.sort_array(F.transform(twice, lambda p: p["i"])))
    starts = F.col("starts_")
    steps = F.transform(starts, lambda p, k: F.least(F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(
        "lines_", "windows_", "sorted_", "starts_"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def gram_buckets(words: str, buckets: int = BUCKETS) -> Column:
    """The hashes of all words and word pairs of a text; with fewer than all
    64-bit places they are folded, and n-grams get mixed."""
    row = F.col(words)
    ones = F.transform(row, lambda w: F.xxhash64(w))
    firsts = F.slice(row, F.lit(1), F.greatest(F.size(row) - 1, F.lit(0)))
    twos = F.transform(firsts, lambda w, i: F.xxhash64(w, F.get(row, i + 1)))
    grams = F.concat(ones, twos)
    return grams if buckets >= BUCKETS else F.transform(grams, lambda h: F.pmod(h, F.lit(buckets)))


def gram_rows(texts: DataFrame, *columns: str) -> DataFrame:
    """(columns, gram) with one row for each hash of gram_buckets("words"). The
    words are hashed as rows, in generated code, which array functions lack."""
    row = F.col("words")
    # The last word has no next one.
    following = F.slice(row, F.lit(2), F.greatest(F.size(row), F.lit(1)))
    pairs = texts.select(*columns, F.inline(F.arrays_zip(row, following)).alias("one_", "next_"))
    hashes = F.array(F.xxhash64("one_"), F.when(F.col("next_").isNotNull(), F.xxhash64("one_", "next_")))
    return pairs.select(*columns, F.explode(hashes).alias("gram")).where("gram is not null")


def _in_round(k: int, rounds: int) -> Column:
    return F.pmod("gram", F.lit(rounds)) == k


def _log_ratio(trusted: Column, corpus: Column, n: int, m: int) -> Column:
    """log(p_trusted / p_corpus) in millionths, of n and m n-grams in all."""
    prior = max(PRIOR * BUCKETS, PRIOR_PER_TRUSTED * m)
    n, m = max(1, n), max(1, m)
    return F.round(1e6 * F.log((trusted / (corpus / F.lit(float(n))) + prior) / F.lit(m + prior))).cast("long")


def gram_ratios(docs: DataFrame, trusted: DataFrame, n: int, m: int) -> DataFrame:
    """(gram, corpus, ratio) of every n-gram that occurs more than once and in a
    trusted document. The others need no row: the ratio of what no trusted
    document has does not depend on its corpus count, so it is that of an n-gram
    that occurs once. docs is (id, text), trusted a table of ids of any length."""
    marks = trusted.select(F.col("id").alias("trusted_id"))
    marks = marks.hint("broadcast" if marks.count() <= SENT_IDS else "merge")
    rows = docs.join(marks, F.col("id") == F.col("trusted_id"), "left")
    rows = rows.select(F.col("trusted_id").isNotNull().cast("int").alias("t"), content_words(F.col("text")).alias("words"))
    grams = gram_rows(rows, "t")
    parts = []
    for k in range(COUNT_ROUNDS):
        counts = grams.where(_in_round(k, COUNT_ROUNDS)).groupBy("gram").agg(F.count("*").alias("corpus"), F.sum("t").alias("trusted"))
        ratio = _log_ratio(F.col("trusted"), F.col("corpus"), n, m).alias("ratio")
        parts.append(written(counts.where("corpus > 1 and trusted > 0").select("gram", "corpus", ratio), "gram-ratios"))
    return reduce(DataFrame.unionByName, parts)


def _head_level(level: Column, ratios: DataFrame) -> int:
    """The lowest level of corpus counts from which on at most HEAD n-grams lie."""
    sizes = {r["level"]: r["n"] for r in ratios.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    lowest, held = max(sizes, default=0) + 1, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > HEAD:
            break
        lowest = at
    return lowest


def gram_sums(docs: DataFrame, ratios: DataFrame) -> DataFrame:
    """(key, total, alone, n_grams) by text: the sum of its known ratios and how
    many of its n-grams occur nowhere else, or in no trusted document, and have
    none. Ratios of the most frequent n-grams are sent to the texts; the other
    n-grams of the texts are shuffled to theirs."""
    rows = docs.select(text_key(), content_words(F.col("text")).alias("words"))
    grams = gram_rows(rows, "key")
    level = F.floor(4 * F.log2("corpus")).cast("int")
    lowest = _head_level(level, ratios)
    head = F.broadcast(ratios.where(level >= lowest).select("gram", "ratio"))
    rest = ratios.where(level < lowest).select("gram", "ratio")

    def summed(met: DataFrame, size: Column) -> DataFrame:
        known = met.groupBy("key").agg(F.sum("ratio").alias("total"), F.count("ratio").alias("known"), size.alias("n_grams"))
        return written(known, "gram-sums")

    parts = [summed(grams.join(head, "gram", "left"), F.count("*"))]
    for k in range(JOIN_ROUNDS):
        mine = _in_round(k, JOIN_ROUNDS)
        others = grams.where(mine).join(head, "gram", "left_anti")
        parts.append(summed(others.join(rest.where(mine), "gram"), F.sum(F.lit(0).cast("long"))))
    sums = reduce(DataFrame.unionByName, parts).groupBy("key")
    sums = sums.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.sum("known").alias("known"), F.sum("n_grams").alias("n_grams"))
    return written(sums.select("key", "total", (F.col("n_grams") - F.col("known")).alias("alone"), "n_grams"), "gram-sums")


def text_key() -> Column:
    """Equal texts have equal scores and are scored under one key."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")


def trusted_ids(labels: DataFrame, id_col: str, quality_col: str) -> DataFrame:
    """Ids of all documents that are marked good."""
    good = labels.where((F.col(quality_col) == 1) & F.col(id_col).isNotNull())
    return written(good.select(F.col(id_col).alias("id")).distinct(), "trusted")


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: id, the base counts, score, base_failed, kept.

    Defined cases: a null or blank text has no words, a score of 0 and fails the
    base rules. Without trusted documents every score is about 0. Repeated rows get equal verdicts. Null labels and labels of a null id
    are not read. An empty table gives an empty result. Other columns of the
    input are not read."""
    trusted = trusted_ids(labels, id_col, quality_col)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.withColumn("words", content_words(F.col("text")))
    rows = written(base_counts(rows, F.col("text"), "words").select("id", text_key(), *counts), "base-counts")
    marks = trusted.select(F.col("id").alias("trusted_id"))
    rows = rows.join(marks, F.col("id") == F.col("trusted_id"), "left")
    rows = written(rows.withColumn("trusted", F.col("trusted_id").isNotNull().cast("int")).drop("trusted_id"), "marked")
    # As many words and one pair less.
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    sizes = rows.agg(F.sum(grams).alias("n"), F.sum(grams * F.col("trusted")).alias("m")).first()
    n, m = sizes["n"] or 0, sizes["m"] or 0
    with shuffles_dropped(docs.sparkSession):
        sums = gram_sums(docs, gram_ratios(docs, trusted, n, m))
    # What has no ratio occurs once in the corpus, and is trusted if its only row
    # is, or in no trusted row, so that this one is not.
    rows = rows.join(sums, "key", "left").withColumn("once", _log_ratio(F.col("trusted"), F.lit(1), n, m))
    mean = (F.col("total") + F.col("alone") * F.col("once")) / (F.col("n_grams") * F.lit(1e6))
    rows = rows.withColumn("score", F.coalesce(mean, F.lit(0.0)))
    return rows.select("id", *counts, "score", base_failed().alias("base_failed"), (~base_failed() & (F.col("score") >= threshold)).alias("kept"))
