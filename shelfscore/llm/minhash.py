"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its
smallest and its largest, so half the permutations fill a signature. Values of
ROWS permutations make a band; the minima and the maxima of the same
permutations make two bands. With 5 rows and 50 bands a pair at the similarity
of 0.75 meets in some band but for one case in 700,000.

Documents of equal sets are one class. In a band bucket every class is paired
with the smallest class only. Links are confirmed on full sets. Classes of buckets that
still lie in several components then meet across components by their rarest
shingles, which loses no similar pair, so that a large family of near copies is
not listed pair by pair."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscore.llm import components as cc
from shelfscore.llm.hashing import mix, shingle_set
from shelfscore.llm.storage import bounded_batches, written

SHINGLE = 5
PERCENT = 75
ROWS = 5
BANDS = 50
# Shingles that are permuted at once; bounds a task's memory for long texts.
_BLOCK = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(75)
    factors = rng.integers(1, 2**63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, (n, 1), dtype=np.uint64)


def min_max(shingles: np.ndarray, permutations: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of a non-empty set under each permutation."""
    factors, masks = permutations
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(len(factors), dtype=np.uint64)
    for k in range(0, len(shingles), _BLOCK):
        values = (shingles[None, k : k + _BLOCK] ^ masks) * factors
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band: minima bands first, then maxima bands."""
    keys = np.concatenate([low, high]).reshape(-1, rows)
    folded = np.arange(1, len(keys) + 1, dtype=np.uint64) * _ODD
    for k in range(rows):
        folded = mix(folded + keys[:, k])
    return folded


def _sketch(batches: Iterator[pa.RecordBatch], rows: int, bands: int) -> Iterator[pa.RecordBatch]:
    permutations = _permutations(rows * bands // 2)
    for batch in batches:
        sizes, sets, keys = [], [], []
        for text in batch["text"].cast(pa.binary()).to_pylist():
            shingles = shingle_set(text, SHINGLE)
            sizes.append(len(shingles))
            # Two unlike folds of the sorted set name it with 128 bits.
            order = np.arange(1, len(shingles) + 1, dtype=np.uint64)
            folds = [mix(shingles + order * _ODD).sum(dtype=np.uint64), mix(shingles * order ^ _ODD).sum(dtype=np.uint64)]
            sets.append(np.array(folds, dtype=np.uint64).tobytes())
            keys.append(band_keys(*min_max(shingles, permutations), rows).view(np.int64) if len(shingles) else [])
        columns = [batch["id"], pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "set_digest", "keys"])


def sketches(docs: DataFrame, id_col: str, text_col: str, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(id, n_shingles, set_digest, keys): one row per document."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_shingles bigint, set_digest binary, keys array<bigint>"
    return texts.mapInArrow(partial(_sketch, rows=rows, bands=bands), schema)


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        alike = []
        for a, left, right in zip(
            batch["a"].to_pylist(),
            batch["left"].cast(pa.binary()).to_pylist(),
            batch["right"].cast(pa.binary()).to_pylist(),
            strict=True,
        ):
            # Pairs come sorted by their first document.
            if known.get("text") != left:
                known = {"text": left, "set": shingle_set(left, SHINGLE)}
            one, two = known["set"], shingle_set(right, SHINGLE)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            alike.append(100 * shared >= percent * (len(one) + len(two) - shared) and shared > 0)
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(alike, pa.bool_()))


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. texts is (id, text).

    Both joins take their inputs straight from a shuffle, so a document with
    very many partners is split between tasks."""
    with_right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    both = with_right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    kind = pairs.schema["a"].dataType.simpleString()
    return both.select("a", "left", "b", "right").mapInArrow(partial(_confirm, percent=percent), f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Defined cases: a null text or one without words has an empty set and is a
    component of its own. Shorter texts than a shingle are one shingle. Rows of
    one id are one document: if their texts differ, both link for it. A row
    without an id joins the component of its set; if no row of it has an id,
    component_id is null and the row is kept. An empty table gives an empty
    result. Other columns of the input are not read."""
    bounded_batches(docs.sparkSession)
    drawn = written(sketches(docs, id_col, text_col, rows, bands), "sketches")
    classes = drawn.where("n_shingles > 0").groupBy("set_digest").agg(F.min("id").alias("node"))
    classes = written(classes, "classes")
    firsts = drawn.join(classes, (drawn["set_digest"] == classes["set_digest"]) & (drawn["id"] == classes["node"]), "left_semi")
    firsts = written(firsts.select(F.col("id").alias("node"), "keys"), "firsts")
    buckets = firsts.select("node", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = written(shared.where(F.col("low") < F.col("high")).select("key", "low"), "buckets")
    met = written(buckets.join(shared, "key"), "met")
    star = met.where(F.col("node") != F.col("low")).select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    star = written(star, "pairs")
    partners = met.select(F.col("node").alias("id")).distinct()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = written(source.join(written(partners, "partners"), "id", "left_semi"), "texts")
    links = written(confirmed(star, texts, percent), "links")
    names = written(cc.components(links), "names")
    found = classes.join(names, "node", "left").select("set_digest", "node", F.coalesce("component", "node").alias("component"))
    found = written(found, "found")
    placed = found.select("node", "component")
    more = written(confirmed(_across(met, placed, texts, star, percent), texts, percent), "links")
    # Whole components hang together by what is left.
    tops = placed.select(F.col("node").alias("a"), F.col("component").alias("x"))
    lifted = more.join(tops, "a").join(tops.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    tops = written(cc.components(lifted).toDF("component", "top"), "tops")
    found = found.join(tops, "component", "left").select("set_digest", F.coalesce("top", "component").alias("component"))
    out = drawn.join(written(found, "found"), "set_digest", "left")
    component = F.coalesce("component", "id").alias("component_id")
    out = out.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, component).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t, SHINGLE).view(np.int64) for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])


def _across(met: DataFrame, placed: DataFrame, texts: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs that may still be similar, out of buckets whose documents lie in
    several components.

    Of a similar pair either document's rarest shingles hold a common one, as
    all the others together are too few: with s = percent / 100, the first
    n - ceil(s * n) + 1 of n. Variants that went far from each other have many
    shingles of their own, which come first and meet nothing. The places of the
    common one bound what can be shared. (a, b) have different components and
    were not tried before."""
    kind = texts.schema["id"].dataType.simpleString()
    rows = met.select("key", "node").join(placed, "node")
    rows = written(rows, "placed")
    open_keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    crowd = rows.join(written(open_keys.select("key"), "open"), "key", "left_semi").select("node", "component").distinct()
    crowd = written(crowd, "crowd")
    chosen = texts.join(crowd, texts["id"] == crowd["node"]).select("id", "text")
    sets = written(chosen.mapInArrow(_shingles, f"id {kind}, shingles array<bigint>").distinct(), "shingles")
    flat = sets.select(F.col("id").alias("node"), F.explode("shingles").alias("shingle"))
    rarity = written(flat.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "rarity")
    # A text's own shingles, one per row and bounded by the text, rarest first.
    ranked = flat.join(rarity, "shingle", "left").groupBy("node").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("df").isNull()).alias("alone"),
        F.sort_array(F.collect_list(F.when(F.col("df").isNotNull(), F.struct("df", "shingle")))).alias("shared"),
    )
    s = percent / 100
    front = F.greatest(F.col("n") - F.ceil(s * F.col("n") - 1e-9) + 1 - F.col("alone"), F.lit(0)).cast("int")
    posted = ranked.select("node", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), front)).alias("at", "e"))
    posted = posted.select("node", "n", (F.col("alone") + F.col("at")).alias("at"), F.col("e.shingle").alias("shingle"))
    posted = written(posted.join(crowd, "node"), "posted")
    # A pair across components has one side at least outside the largest one.
    sizes = posted.groupBy("shingle", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("shingle").agg(F.max(F.struct("size", "component")).alias("m"), F.count("*").alias("k"))
    largest = written(largest.where("k > 1").select("shingle", F.col("m.component").alias("largest")), "largest")
    one = posted.join(largest, "shingle").where(F.col("component") != F.col("largest"))
    one = written(one, "outside").select("shingle", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("at").alias("at_x"), F.col("component").alias("c_x"))
    two = posted.select("shingle", F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("at").alias("at_y"), F.col("component").alias("c_y"))
    low, high = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
    reach = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    likely = (low * 100 >= high * percent) & (reach * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent)
    pairs = one.join(two, (one["shingle"] == two["shingle"]) & (F.col("c_x") != F.col("c_y")) & likely)
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return written(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
