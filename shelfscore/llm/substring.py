"""Removal of long passages that an earlier document has as well.

Seeds are short runs of words, picked by winnowing so that two equal windows of
WINDOW words always share a seed. Documents meet in their seeds; each seed that
several documents have is extended both ways to every window that holds it, and
equal windows of one document that follow each other join into maximal repeats.
Extensions of a seed are compared by grouping, so a passage that very many
documents share costs each of them one row per window and never a pair.

Words, seeds and windows are compared by 64-bit hashes of their whole content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.hashing import mix, sequence_hashes, word_hashes
from shelfscore.llm.storage import bounded_batches, written

WINDOW = 50
SEED = 10
_ODD = np.uint64(0x9E3779B97F4A7C15)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def winnow(words: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the seeds: the last smallest of every run of
    window - seed + 1 seeds that follow each other."""
    hashes, span = sequence_hashes(words, seed), window - seed + 1
    if len(hashes) < span:
        return hashes[:0], np.zeros(0, dtype=np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(hashes[::-1], span)
    least = len(hashes) - 1 - (runs.argmin(axis=1) + np.arange(len(runs)))
    at = np.unique(least)
    return hashes[at], at


def holding(seeds: np.ndarray, words: int, window: int, seed: int) -> np.ndarray:
    """Starts of all windows inside the text that hold one of the seeds."""
    seeds = seeds[seeds + seed <= words]
    if words < window or not len(seeds):
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(words + 2, dtype=np.int32)
    np.add.at(change, np.maximum(seeds + seed - window, 0), 1)
    np.add.at(change, np.minimum(seeds, words - window) + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: words - window + 1] > 0)


def covered(starts: np.ndarray, words: int, window: int) -> np.ndarray:
    """Which words lie in a window that begins at one of the starts."""
    change = np.zeros(words + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change)[:words] > 0


def spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal repeats: windows that touch or overlap, joined."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window) + 1
    return [(int(p[0]), int(p[-1]) + window) for p in np.split(starts, breaks)]


def _surveyed(docs: DataFrame, kind: str, window: int, seed: int) -> DataFrame:
    """(id, n_words, sha256, sequence, seeds, places) of every document."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                text = text or b""
                words = word_hashes(text)
                order = np.arange(1, len(words) + 1, dtype=np.uint64)
                folds = [mix(words + order * _ODD).sum(dtype=np.uint64), mix(words ^ mix(order)).sum(dtype=np.uint64)]
                hashes, at = winnow(words, window, seed)
                sha = hashlib.sha256(b" ".join(text.split())).hexdigest()
                rows.append((len(words), sha, np.array(folds).tobytes(), hashes.view(np.int64), at))
            types = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["id", "n_words", "sha256", "sequence", "seeds", "places"],
            )

    schema = f"id {kind}, n_words bigint, sha256 string, sequence binary, seeds array<bigint>, places array<bigint>"
    return docs.mapInArrow(survey, schema)


def _windows(seeded: DataFrame, kind: str, window: int, seed: int) -> DataFrame:
    """(id, part, start, hash) of the windows around shared seeds."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for k, (text, places) in enumerate(zip(texts, batch["places"].to_pylist(), strict=True)):
                words = word_hashes(text)
                starts = holding(np.array(places, dtype=np.int64), len(words), window, seed)
                hashes = sequence_hashes(words, window)[starts].view(np.int64)
                same = pa.array(np.full(len(starts), k))
                columns = [batch["id"].take(same), batch["part"].take(same), pa.array(starts, pa.int64()), pa.array(hashes)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "part", "start", "hash"])

    return seeded.mapInArrow(extend, f"id {kind}, part bigint, start bigint, hash bigint")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED):
    """(survey, copies, seeded, starts).

    survey: one row per document. copies: (id, sha256) of documents
    whose whole word sequence an earlier one has. seeded: documents with text that share a seed.
    starts: (id, part, starts) of the windows that begin in an earlier document too."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    survey = written(_surveyed(source, kind, window, seed), "survey")
    long = survey.where((F.col("n_words") >= window) & F.col("id").isNotNull())
    firsts = written(long.groupBy("sequence").agg(F.min("id").alias("first")), "sequences")
    ranked = long.select("id", "sequence", "sha256", "seeds", "places").join(firsts, "sequence")
    copies = ranked.where(F.col("id") > F.col("first")).select("id", "sha256").distinct()
    places = F.arrays_zip("seeds", "places")
    own = ranked.where(F.col("id") == F.col("first")).select("id", F.explode(places).alias("s"))
    own = written(own.select("id", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place")), "seeds")
    shared = own.groupBy("seed").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = written(shared.where(F.col("low") < F.col("high")).select("seed"), "shared")
    held = own.join(shared, "seed", "left_semi").groupBy("id").agg(F.collect_list("place").alias("places"))
    part = F.xxhash64("text").alias("part")
    seeded = written(source.select("id", "text", part).join(written(held, "places").hint("merge"), "id"), "seeded")
    windows = written(_windows(seeded, kind, window, seed), "windows")
    first = windows.groupBy("hash").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    first = written(first.where(F.col("low") < F.col("high")).select("hash", "low"), "first")
    later = windows.join(first, "hash").where(F.col("id") > F.col("low"))
    starts = later.groupBy("id", "part").agg(F.collect_set("start").alias("starts"))
    return survey, copies, seeded, written(starts, "starts")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, and repeats
    (spans of words that were removed).

    Defined cases: a null text has no words. Texts shorter than a window keep
    all words. A row without an id keeps all its words and removes none of
    others. Rows with the same id are one document, so they do not remove each
    other's words. An empty table gives an empty result. Other columns of the
    input are not read."""
    survey, copies, seeded, starts = repeats(docs, id_col, text_col, window, seed)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["starts"].to_pylist(), strict=True):
                words, at = text.split(), np.array(starts, dtype=np.int64)
                at = at[at + window <= len(words)]
                gone = covered(at, len(words), window)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                full = hashlib.sha256(b" ".join(words)).hexdigest()
                found = [{"first": a, "end": b} for a, b in spans(at, window)]
                rows.append((full, int(gone.sum()), hashlib.sha256(kept).hexdigest(), found))
            span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = [pa.string(), pa.int64(), pa.string(), span]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["id", "sha256", "cut", "kept", "repeats"],
            )

    schema = f"id {kind}, sha256 string, cut bigint, kept string, repeats array<struct<first:bigint,end:bigint>>"
    parts = seeded.drop("places").join(starts.hint("merge"), ["id", "part"]).mapInArrow(cut, schema).distinct()
    whole = copies.withColumn("copy", F.lit(True))
    rows = survey.select("id", "n_words", "sha256").join(written(whole, "copies"), ["id", "sha256"], "left")
    rows = rows.join(written(parts, "parts"), ["id", "sha256"], "left")
    copy = F.coalesce("copy", F.lit(False))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))
    return rows.select(
        "id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
        F.when(copy, everything).otherwise(F.coalesce("repeats", F.array().cast("array<struct<first:bigint,end:bigint>>"))).alias("repeats"),
    )
