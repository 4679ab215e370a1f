"""Spelling variants grouped by permuterm rotations.

Every vocabulary word w is marked with a terminator, w$, and all rotations of
w$ are listed. Two words of equal length that differ in one place i share the
rotation that starts after i with its last character (the edited one) cut
off; a word one shorter than w, made by deleting place i, has that cut
rotation of w as one of its own full rotations. So replacements and indels
become equal keys: the rotations are grouped by key (Spark sorts or hashes
them, which is the sorted rotation list scanned group by group), and each
group yields, per member, the number of its neighbours and its best neighbour.
No pair of words is listed: a group holds at most one word per letter of the
alphabet and one shorter word, so its members are few, and what a member
needs is counted from the group as a whole.

Defined cases: a null text has no runs; a null doc_id gives no hash, so its
runs stay unchanged; repeated rows count as often as they occur; words shorter
than MIN_LENGTH or rarer than MIN_COUNT are no vocabulary words; ties of the
best neighbour go to the smallest word in code-point order; a word without a
form is its own root. An empty table gives an empty result. Extra input
columns are ignored. A very long run is one word; its rotations take time
square in its length, as the method lists them all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.storage import written

__all__ = ["noisy_words", "spelling_variants", "vocabulary"]

# The letters of a run, the drop rule of the noise, the least
# length and count of a vocabulary word, and how much more often a word's
# form must occur.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5
# Marks the end of a word in its rotations; no run contains it.
END = "$"


def noisy_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word) per run of every text: A-Z lower-cased, and where 199 divides
    the crc32 h of "<doc_id>:<run>", the code point h % length deleted."""
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), 0)).alias("r"))
    low = F.translate("r", UPPER, LOWER)
    h = F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit(":"), low), "UTF-8"))
    size = F.char_length(low)
    at = F.pmod(h, size).cast("int")
    dropped = F.concat(F.substring(low, 1, at), F.substring(low, at + 2, size))
    return runs.select(F.when(F.pmod(h, F.lit(DROP_EVERY)) == 0, dropped).otherwise(low).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n): distinct words long and frequent enough. Counts combine in
    each task before they are shuffled, so a frequent word costs one row per
    task."""
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.char_length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def _rotation(word: Column, size: Column, at: Column, cut: bool) -> Column:
    """Rotation of word$ that starts at place `at` (0-based); cut drops its
    last character, which is word[at - 1] (or $ for at = 0)."""
    rest = F.substring(word, at + 1, size)
    head = F.substring(word, 1, at - 1 if cut else at)
    return F.concat(rest, F.lit(END), head)


def _keys(vocab: DataFrame) -> DataFrame:
    """(key, word, n, kind, first): kind r is a rotation cut after place i,
    i = 0 .. L-1 (shared by replacements at i and by the deletion of i); kind
    f is a full rotation (shared with words one longer). first marks a cut at
    the first place of a run of equal letters, so that a deletion from a run
    is counted once."""
    size = F.char_length("word")
    cut_at = F.sequence(F.lit(1), size)
    full_at = F.sequence(F.lit(0), size)
    cut = vocab.select("word", "n", F.explode(cut_at).alias("at"), F.lit("r").alias("kind"))
    cut = cut.select(
        _rotation(F.col("word"), size, F.col("at"), True).alias("key"),
        "word",
        "n",
        "kind",
        ((F.col("at") == 1) | (F.substring("word", F.col("at") - 1, 1) != F.substring("word", F.col("at"), 1))).alias(
            "first"
        ),
    )
    full = vocab.select("word", "n", F.explode(full_at).alias("at"), F.lit("f").alias("kind"))
    full = full.select(_rotation(F.col("word"), size, F.col("at"), False).alias("key"), "word", "n", "kind", F.lit(False).alias("first"))
    return cut.unionByName(full)


def _best(members: Column) -> Column:
    """The member of largest n, ties to the smallest word: members are
    structs (m = -n, word), so the least one."""
    return F.array_min(members)


def _neighbours(keys: DataFrame) -> DataFrame:
    """(word, n_near, best): per word the number of near words and the best
    of them as a struct (m = -n, word), from the groups of equal keys."""
    member = F.struct(F.negative("n").alias("m"), "word", "kind", "first")
    groups = keys.groupBy("key").agg(F.collect_list(member).alias("ms"))
    entry = lambda x: F.struct(x["m"].alias("m"), x["word"].alias("word"))
    replaced = F.filter("ms", lambda x: x["kind"] == "r")
    firsts = F.filter("ms", lambda x: (x["kind"] == "r") & x["first"])
    shorter = F.filter("ms", lambda x: x["kind"] == "f")
    stats = groups.select(
        "ms",
        F.size(replaced).alias("nr"),
        F.size(firsts).alias("nrf"),
        F.size(shorter).alias("nf"),
        F.slice(F.array_sort(F.transform(replaced, entry)), 1, 2).alias("top"),
        _best(F.transform(firsts, entry)).alias("best_longer"),
        _best(F.transform(shorter, entry)).alias("best_shorter"),
    )
    each = stats.select("*", F.explode("ms").alias("x")).drop("ms")
    is_r = F.col("x.kind") == "r"
    other = F.when(F.get("top", 0)["word"] == F.col("x.word"), F.get("top", 1)).otherwise(F.get("top", 0))
    count = F.when(is_r, F.col("nr") - 1 + F.when(F.col("x.first"), F.col("nf")).otherwise(0)).otherwise(F.col("nrf"))
    best = F.when(is_r, F.least(other, F.when(F.col("x.first"), F.col("best_shorter")))).otherwise(F.col("best_longer"))
    found = each.select(F.col("x.word").alias("word"), count.alias("c"), best.alias("best"))
    return found.groupBy("word").agg(F.sum("c").cast("long").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, root): forms followed to the end by pointer doubling. A form
    occurs at least FORM_FACTOR times as often as its word, so a chain has at
    most `longest` steps and ceil(log2) rounds of doubling reach its end."""
    step = forms.select("word", F.coalesce("form", "word").alias("up"))
    for _ in range(max(1, math.ceil(math.log2(longest + 1)))):
        ahead = step.select(F.col("word").alias("up"), F.col("up").alias("up2"))
        step = written(step.join(ahead, "up", "left").select("word", F.coalesce("up2", "up").alias("up")), "spelling-roots")
    return step.withColumnRenamed("up", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every vocabulary word.

    n_near counts the vocabulary words at edit distance exactly one (one
    code point inserted, deleted or replaced). form is the near word of
    largest n (ties: smallest word) if its n is at least FORM_FACTOR times the
    word's, else null; root follows forms to the last."""
    vocab = written(vocabulary(noisy_words(docs, id_col, text_col)), "spelling-vocabulary")
    near = _neighbours(_keys(vocab))
    best_n = F.negative(F.col("best.m"))
    has_form = best_n >= FORM_FACTOR * F.col("n")
    forms = vocab.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.word")).alias("form"),
        F.when(has_form, best_n).cast("long").alias("form_n"),
    )
    forms = written(forms, "spelling-forms")
    top = forms.agg(F.max("n")).first()[0] or MIN_COUNT
    longest = max(1, math.ceil(math.log(max(top, MIN_COUNT) / MIN_COUNT, FORM_FACTOR)) + 1)
    roots = _roots(forms, longest)
    return forms.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
