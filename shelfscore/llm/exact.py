"""Exact deduplication against immutable snapshots.

A snapshot keeps its distinct digests in buckets (a prefix of the digest) and,
per bucket, a static binary-fuse filter of 8-bit fingerprints. The digests of
a new batch are first grouped among themselves, then screened by the filters of
every snapshot. Only positives join the exact buckets. Groups of more than one
row are checked on the bytes of their texts; should two texts share a digest,
the group is split by text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shelfscore.llm.hashing import mix
from shelfscore.llm.storage import bounded_batches, spaced, written

# Digests that one filter should hold. A filter is built and read in one task.
KEYS_PER_FILTER = 1 << 15
_FILTER = "bucket int, snapshot string, seed long, segment int, segments int, prints binary"
_HIT = "digest binary, snapshot string"


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _key(digest: Column) -> Column:
    """64 bits of the digest as a number."""
    return F.xxhash64(digest)


def _bucket(digest: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), digest), F.lit(buckets)).cast("int")


# --- the filter, inside a task -------------------------------------------------


def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in neighbouring segments per key, and its fingerprint."""
    h = mix(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    inner = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & inner)
    third = (first + np.uint64(2 * segment)) ^ (h & inner)
    return np.stack([first, second, third]).astype(np.int64), (mix(h + np.uint64(1)) & np.uint64(255)).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) over 64-bit keys.

    Keys are peeled in waves: those that are alone in a slot leave together,
    and are assigned in the opposite order."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 1)
    segment = 1 << max(2, min(18, int(np.floor(np.log(n) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, -(-int(n * factor) // segment) - 2)
    for seed in range(1, 200):
        slots, prints = _places(keys, seed, segment, segments)
        size = segment * (segments + 2)
        count = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        order = np.arange(len(keys))
        for row in slots:
            np.bitwise_xor.at(owner, row, order)
        left, waves = len(keys), []
        lone = np.flatnonzero(count == 1)
        while left and len(lone):
            peeled, at = np.unique(owner[lone], return_index=True)
            waves.append((peeled, lone[at]))
            left -= len(peeled)
            touched = slots[:, peeled]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, peeled)
            touched = np.unique(touched)
            lone = touched[count[touched] == 1]
        if left == 0:
            table = np.zeros(size, dtype=np.uint8)
            for peeled, slot in reversed(waves):
                others = table[slots[0, peeled]] ^ table[slots[1, peeled]] ^ table[slots[2, peeled]] ^ table[slot]
                table[slot] = prints[peeled] ^ others
            return seed, segment, segments, table.tobytes()
        if seed % 20 == 0:
            segments += max(1, segments // 8)
    raise ValueError("no seed peels these keys")


def probe_fuse(keys: np.ndarray, seed: int, segment: int, segments: int, prints: bytes) -> np.ndarray:
    """Which keys may be in the filter; every key it was built from is."""
    table = np.frombuffer(prints, dtype=np.uint8)
    slots, wanted = _places(keys.astype(np.uint64), seed, segment, segments)
    return (table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == wanted


# --- snapshots and batches -----------------------------------------------------


def digests(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), digest(spaced(F.col(text_col))).alias("digest"), *more)


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, size): rows of one digest, the smallest id stays."""
    return rows.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("size"))


def snapshot(rows: DataFrame, name: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(exact buckets, filters) of the digests of a batch that is closed."""
    exact = grouped(rows).withColumn("bucket", _bucket(F.col("digest"), buckets))
    exact = written(exact.withColumn("snapshot", F.lit(name)), "snapshot")

    def build(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy().view(np.uint64)
        seed, segment, segments, prints = build_fuse(keys)
        row = [table["bucket"][0].as_py(), name, seed, segment, segments, prints]
        return pa.table({f: [v] for f, v in zip(names, row, strict=True)}, schema=shape)

    names = ["bucket", "snapshot", "seed", "segment", "segments", "prints"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    shape = pa.schema(list(zip(names, types, strict=True)))
    keys = exact.select("bucket", _key(F.col("digest")).alias("key"))
    return exact, written(keys.groupBy("bucket").applyInArrow(build, _FILTER), "filters")


def screen(batch: DataFrame, filters: DataFrame, buckets: int, slices: int) -> DataFrame:
    """(digest, snapshot) for every digest of a batch that a filter lets pass.

    batch has distinct digests. A bucket is read in `slices` parts, each with
    its own copy of the filters, so that a large batch stays in small tasks."""

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left["key"].to_numpy().view(np.uint64)
        found, names = [], []
        for f in right.to_pylist() if len(keys) else []:
            passed = probe_fuse(keys, f["seed"], f["segment"], f["segments"], f["prints"])
            found.append(left["digest"].filter(pa.array(passed)))
            names += [f["snapshot"]] * int(passed.sum())
        hits = pa.concat_arrays([c for col in found for c in col.chunks] or [pa.array([], pa.binary())])
        return pa.table({"digest": hits.cast(pa.binary()), "snapshot": pa.array(names, pa.string())})

    part = F.pmod(F.xxhash64(F.lit("slice"), F.col("digest")), F.lit(slices)).cast("int")
    keyed = batch.select(
        _bucket(F.col("digest"), buckets).alias("bucket"),
        part.alias("part"),
        "digest",
        _key(F.col("digest")).alias("key"),
    )
    copies = filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return keyed.groupBy("bucket", "part").cogroup(copies.groupBy("bucket", "part")).applyInArrow(probe, _HIT)


def merge_batch(batch: DataFrame, snapshots: list[tuple[DataFrame, DataFrame]], buckets: int, slices: int) -> DataFrame:
    """(digest, keep_id, size) over all snapshots and a new batch of (id, digest)."""
    own = written(grouped(batch), "batch")
    filters = reduce(DataFrame.unionAll, [f for _, f in snapshots])
    exact = reduce(DataFrame.unionAll, [e.select("snapshot", "digest", "keep_id", "size") for e, _ in snapshots])
    hits = written(screen(own, filters, buckets, slices), "positives")
    known = exact.join(hits, ["snapshot", "digest"], "left_semi").select("digest", "keep_id", "size")
    known = written(known, "confirmed")
    fresh = own.join(known.select("digest"), "digest", "left_anti")
    # Confirmed digests get the batch's rows added; snapshots keep all others.
    met = own.join(known.select("digest").distinct(), "digest", "left_semi").unionAll(known)
    met = met.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size"))
    rest = exact.select("digest", "keep_id", "size").join(known.select("digest").distinct(), "digest", "left_anti")
    rest = rest.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size"))
    return written(fresh.unionAll(met).unionAll(rest), "groups")


# --- byte checks ---------------------------------------------------------------


def byte_check(
    docs: DataFrame, groups: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]
) -> DataFrame:
    """Digests whose rows do not all hold the same bytes.

    Texts of one group meet in parts first, where the smallest and the largest
    text say whether all are equal, so that a hot group spreads."""
    text = spaced(F.col(text_col))
    rows = docs.select(digest(text).alias("digest"), text.alias("text"), F.xxhash64(id_col).alias("part"))
    shared = written(groups.where(F.col("size") > 1).select("digest"), "repeated")
    rows = rows.join(shared.hint("merge"), "digest", "left_semi")
    spread = rows.repartition("digest", F.pmod("part", F.lit(64)))
    ends = spread.groupBy("digest", F.pmod("part", F.lit(64)).alias("part")).agg(
        F.min("text").alias("low"), F.max("text").alias("high")
    )
    parts = ends.select("digest", (F.col("low") != F.col("high")).alias("differs"), F.col("low").alias("text"))
    whole = parts.groupBy("digest").agg(
        F.max("differs").alias("differs"), F.min("text").alias("low"), F.max("text").alias("high")
    )
    return written(whole.where(F.col("differs") | (F.col("low") != F.col("high"))).select("digest"), "collisions")


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    closed: Column | None = None,
    keys_per_filter: int = KEYS_PER_FILTER,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    `closed` tells which rows form the snapshot; the others are the new batch.
    Without it the lower half of the id range is the snapshot, or, for ids
    that are not numbers, the ids of even hash. The choice changes the work
    of each part, never the result.

    Defined cases: a null text counts as empty, and all blank texts equal one
    space or nothing, by the normalisation. Rows with the same id and text are
    one document and share its verdict. A row without an id joins its group but
    never stays unless no row of the group has an id. An empty table gives an
    empty result. Other columns of the input are not read."""
    bounded_batches(docs.sparkSession)
    if closed is not None:
        flag = F.coalesce(closed, F.lit(False)).alias("closed")
        rows = written(digests(docs, id_col, text_col, digest, flag), "digests")
    else:
        rows = written(digests(docs, id_col, text_col, digest), "digests")
        if isinstance(rows.schema["id"].dataType, NumericType):
            ends = rows.agg((F.min("id") + (F.max("id") - F.min("id")) / 2).alias("pivot"))
            rows = rows.withColumn("closed", F.coalesce(F.col("id") < ends.scalar(), F.lit(False)))
        else:
            # Ids without a range (text, binary): half of them by a hash.
            rows = rows.withColumn("closed", F.coalesce(F.pmod(F.xxhash64("id"), F.lit(2)) == 0, F.lit(False)))
    sizes = rows.agg(F.count_if("closed").alias("old"), F.count("*").alias("all")).first()
    buckets = max(1, -(-sizes["old"] // keys_per_filter))
    slices = max(1, -(-(sizes["all"] - sizes["old"]) // (buckets * 4 * keys_per_filter)))
    old = snapshot(rows.where("closed"), "base", buckets)
    groups = merge_batch(rows.where(~F.col("closed")).select("id", "digest"), [old], buckets, slices)
    clashes = byte_check(docs, groups, id_col, text_col, digest)
    plain = rows.select("id", "digest").join(groups, "digest")
    if not clashes.isEmpty():
        plain = plain.join(clashes, "digest", "left_anti").unionByName(_by_text(docs, clashes, id_col, text_col, digest))
    stays = F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull())
    return plain.select("id", "keep_id", F.col("size").alias("group_size"), stays.alias("kept"), "digest")


def _by_text(
    docs: DataFrame, clashes: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]
) -> DataFrame:
    """Groups of digests that several texts share, told apart by the text."""
    text = spaced(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), digest(text).alias("digest"), text.alias("text"))
    rows = written(rows.join(clashes, "digest", "left_semi"), "clashing")
    sets = rows.groupBy("digest", "text").agg(F.min("id").alias("keep_id"), F.count("*").alias("size"))
    return rows.join(written(sets, "texts"), ["digest", "text"]).select("digest", "id", "keep_id", "size")
