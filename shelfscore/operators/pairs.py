"""Similarity self-joins over token sets and count vectors.

Two measures keep the joins from growing with every pair of rows. Rows with
equal content are collapsed first and carry their number, so a group of copies
is one row whatever its size. Candidates of the Euclidean joins share one of
their rarest elements (prefix filtering), those of the Jaccard joins have near
sketches; neither loses a pair."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, pi

import pyarrow as pa
from pyspark.ml.feature import MinHashLSH
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfscore.functions.sampling import RANGE, key_hash
from shelfscore.functions.vectors import vector_entries, vector_indices
from shelfscore.operators import parity
from shelfscore.operators.features import BUCKETS, attach_vector, fold
from shelfscore.sources.scratch import lookup, written

# Fixed values of the approximate joins.
HASH_TABLES = 3
BUCKET_LENGTH = 2.0
THRESHOLD = 1.5  # Euclidean; above every Jaccard distance
SEED = 1234

# Sets of a bucket that are compared in one task. A larger bucket is cut into
# FEW_PARTS parts at most, or so many that none is larger than the other bounds.
TILE_ROWS, FEW_PARTS = 8_192, 8
MOST_ROWS, MOST_BYTES = 65_536, 2**24

# Tasks that share the work on rows of one or two words.
SALTS = 64

# Numbers of the sketch of a count vector, and the highest that each reaches.
SKETCH = 32
SKETCH_TOP = 127


# ---- collapsed rows -------------------------------------------------------


def rarity_ordered(elements: DataFrame) -> DataFrame:
    """(id, element) to one row per id: its elements, rarest first. A row's
    elements are those of one text, so the gathered list is bounded by it."""
    freq = lookup(elements.groupBy("element").agg(F.count("*").alias("df")), "element-df")
    ranked = elements.join(freq, "element")
    lists = ranked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("e"))
    return lists.select("id", F.col("e.element").alias("elements"))


def with_digest(rows: DataFrame, content: Column) -> DataFrame:
    """Adds a digest of the content; equal rows have equal digests."""
    return rows.withColumn("digest", F.sha2(F.to_json(F.struct(content)), 256))


def collapse(digested: DataFrame, *payload: str) -> DataFrame:
    """One row (set_id, copies, payload) per group of equal content.

    The group is named after its lowest id and keeps that row's payload. Names
    and numbers combine on the map side, and only the named rows, found by their
    id, move their payload."""
    groups = digested.groupBy("digest").agg(F.min("id").alias("set_id"), F.count("*").alias("copies"))
    named = lookup(groups.select("set_id", "copies"), "groups")
    return named.join(digested.select(F.col("id").alias("set_id"), *payload), "set_id")


def members(digested: DataFrame) -> DataFrame:
    """(id, set_id): which group each row belongs to."""
    groups = lookup(digested.groupBy("digest").agg(F.min("id").alias("set_id")), "groups")
    return digested.select("id", "digest").join(groups, "digest").select("id", "set_id")


def as_pairs(left: DataFrame, right: DataFrame, on: list[str], condition: Column) -> DataFrame:
    """Self-join of collapsed rows, each unordered pair once."""
    ahead = F.col("a.set_id") < F.col("b.set_id")
    joined = left.alias("a").join(right.alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on])
    return joined.where(ahead & condition)


def spread_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) are few bytes but a set comparison each, so they are dealt
    out evenly over a fixed number of tasks: neither a row with many partners
    nor a crowded bucket stays in one task."""
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(tasks, "a", "b")


def with_payload(pairs: DataFrame, sets: DataFrame, payload: str) -> DataFrame:
    """Attach both sides' content and sizes to pairs (a, b)."""
    left = sets.select(F.col("set_id").alias("a"), F.col("copies").alias("copies_a"), F.col(payload).alias("left"))
    right = sets.select(F.col("set_id").alias("b"), F.col("copies").alias("copies_b"), F.col(payload).alias("right"))
    return pairs.join(left, "a").join(right, "b")


def self_pairs(sets: DataFrame) -> DataFrame:
    """Rows with themselves and their copies, at distance 0."""
    return sets.select(
        F.col("set_id").alias("a"),
        F.col("set_id").alias("b"),
        F.col("copies").alias("copies_a"),
        F.col("copies").alias("copies_b"),
        F.lit(0.0).alias("distance"),
    )


def _pair_ids(met: DataFrame) -> DataFrame:
    pairs = met.select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b"))
    return spread_pairs(pairs).distinct()


# ---- Jaccard ---------------------------------------------------------------


def jaccard_distance(left: Column, right: Column) -> Column:
    both = F.size(F.array_intersect(left, right))
    return 1 - both / (F.size(left) + F.size(right) - both)


def parity_sketches(sets: DataFrame) -> DataFrame:
    """(set_id, hashes, n, sketch) of sets that are not empty, see `parity`."""
    marks = F.transform(F.array_distinct("elements"), lambda e: F.xxhash64(e))
    rows = sets.where((F.size("elements") > 0) & F.col("set_id").isNotNull())
    rows = rows.select("set_id", "hashes", F.size("elements").alias("n"), marks.alias("marks"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(parity.sketch_bytes, f"{kinds}, sketch binary")


def compared_tiles(opened: DataFrame) -> DataFrame:
    """Adds i and j, the tile, and side to rows (table, hash, sketch): all rows
    of a bucket meet in one tile, or those of a large bucket in tiles for every
    two of its parts. A tile is bounded, and a row comes once per part."""
    sizes = opened.groupBy("table", "hash").agg(F.count("*").alias("rows"), F.sum(F.length("sketch")).alias("bytes"))
    few = F.least(F.ceil(F.col("rows") / TILE_ROWS), F.lit(FEW_PARTS))
    parts = F.greatest(few, F.ceil(F.col("rows") / MOST_ROWS), F.ceil(F.col("bytes") / MOST_BYTES))
    large = lookup(sizes.select("table", "hash", parts.cast("int").alias("parts")).where("parts > 1"), "large-buckets")
    # At most one in TILE_ROWS of the rows is here.
    if large.isEmpty():
        return opened.withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(0)})
    parted = opened.join(F.broadcast(large), ["table", "hash"], "left").fillna(1, ["parts"])
    own = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = parted.withColumn("own", own).withColumn("other", other)
    side = (F.col("own") > F.col("other")).cast("int")
    met = met.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": side})
    return met.drop("parts", "own", "other")


def jaccard_candidates(sets: DataFrame, threshold: float, bucketed: bool = False) -> DataFrame:
    """All pairs (a, b) that can lie below a distance threshold < 1, and few
    others.

    With s = 1 - threshold, a near pair shares more than s / (1 + s) of both
    sizes together, so at most (1 - s) / (1 + s) of them are elements of one
    side only, and the sketches differ in no more places. Sizes that differ by
    more than the factor s never meet.

    Sketches are compared where they are, in tiles of a bounded number of rows,
    so what is shuffled are sketches, once per part of a large bucket, and not
    the pairs that meet. The number of comparisons is quadratic in a bucket,
    which has no other bound.

    With bucketed, only pairs that share a value of `hashes` in its place are
    compared."""
    if not 0 < threshold < 1:
        raise ValueError("an exact Jaccard join needs 0 < threshold < 1; distances never exceed 1")
    if not bucketed:
        sets = sets.withColumn("hashes", F.array(F.lit(0.0)))
    sketched = written(parity_sketches(sets.select("set_id", "elements", "hashes")), "parity-sketches")
    opened = sketched.select("set_id", "n", "sketch", F.posexplode("hashes").alias("table", "hash"))
    keys = ["table", "hash", "i", "j"]
    # Few bytes but many comparisons, so tiles are not gathered by their size.
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = compared_tiles(opened).repartition(tasks, *keys).groupBy(*keys)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return parity.near_pairs(batches, threshold)

    kind = sets.schema["set_id"].dataType
    met = tiles.applyInArrow(near, StructType([StructField("a", kind), StructField("b", kind)]))
    ordered = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct() if bucketed else ordered


def _near_sets(sets: DataFrame, elements: str, threshold: float, bucketed: bool = False) -> DataFrame:
    named = sets.withColumnRenamed(elements, "elements")
    pairs = with_payload(jaccard_candidates(named, threshold, bucketed), sets, elements)
    scored = pairs.withColumn("distance", jaccard_distance(F.col("left"), F.col("right")))
    return scored.where(F.col("distance") < threshold).drop("left", "right")


def jaccard_pairs_exact(bag: DataFrame, threshold: float) -> DataFrame:
    """(a, b, copies_a, copies_b, distance) for all sets nearer than threshold.

    a and b are the lowest ids of groups with equal token sets; a row with
    a = b stands for a row with itself and its copies."""
    # A row's elements are those of one text, so the gathered list is bounded by it.
    known = bag.where(F.col("term").isNotNull())
    rows = known.groupBy("id").agg(F.sort_array(F.collect_list("term")).alias("elements"))
    digested = written(with_digest(rows, F.col("elements")), "jaccard-rows")
    sets = written(collapse(digested, "elements"), "jaccard-sets")
    return _near_sets(sets, "elements", threshold).unionByName(self_pairs(sets))


# ---- Euclidean -------------------------------------------------------------


def counted_elements(bag: DataFrame) -> DataFrame:
    """One element per unit of count: term#1, term#2, ... Two count vectors
    differ in as many elements as their counts differ in total."""
    numbered = F.explode(F.sequence(F.lit(1), F.col("tf").cast("int")))
    units = bag.select("id", "term", numbered.alias("k"))
    return units.select("id", F.concat_ws("#", "term", "k").alias("element"))


def euclidean_candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """All pairs that can lie below the threshold on whole counts.

    The squared distance is then at most m = ceil(threshold^2) - 1, and so is
    the number of elements that only one side has. All elements ahead of the
    first that both have are such elements, so its places (0, 1, ...) in the two
    lists sum to m at most. Each place is joined with the places it may meet, in
    sets of the sizes it may meet: a common word at the end of many short texts
    meets nothing in vain, nor does it in texts of other lengths. Two
    sets without a common element have m elements together at most, and those
    are joined by size."""
    m = ceil(threshold * threshold) - 1
    size = F.size("elements")
    short = sets.select("set_id", size.alias("n"), F.slice("elements", 1, m + 1).alias("p"))
    posted = short.select("set_id", "n", F.posexplode("p").alias("pos", "element"))
    facing = posted.withColumn("other", F.explode(F.sequence(F.lit(0), m - F.col("pos"))))
    sizes = F.explode(F.sequence(F.col("n") - m, F.col("n") + m)).alias("n")
    turned = facing.select("set_id", sizes, F.col("other").alias("pos"), "element", F.col("pos").alias("other"))
    met = as_pairs(facing, turned, ["element", "pos", "other", "n"], F.lit(True))
    tiny = sets.where(size <= m).select("set_id", size.alias("n"))
    salted = tiny.withColumn("salt", F.pmod(F.xxhash64("set_id"), F.lit(SALTS)))
    repeated = tiny.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    small = as_pairs(salted, repeated, ["salt"], F.col("a.n") + F.col("b.n") <= m)
    return _pair_ids(met).unionByName(_pair_ids(small)).distinct()


def squared_distance(left: Column, right: Column) -> Column:
    """Sum of squared count differences from the elements of one side only: a
    term that differs by c has c of them, each meeting c."""
    odd = F.concat(F.array_except(left, right), F.array_except(right, left))
    terms = F.transform(odd, lambda e: F.substring_index(e, "#", 1))
    return F.aggregate(terms, F.lit(0), lambda acc, t: acc + F.size(F.filter(terms, lambda u: u == t)))


def euclidean_sets(bag: DataFrame, rows: DataFrame) -> DataFrame:
    """Collapsed count vectors, rows without any token included."""
    lists = rarity_ordered(counted_elements(bag))
    filled = rows.select("id").join(lists, "id", "left")
    filled = filled.withColumn("elements", F.coalesce("elements", F.array().cast("array<string>")))
    return collapse(written(with_digest(filled, F.col("elements")), "euclidean-rows"), "elements")


def sketches(sets: DataFrame) -> DataFrame:
    """(set_id, copies, sketch): how many elements fall to each of SKETCH places
    by their hash, SKETCH_TOP at most. An element that only one side has moves
    one of the numbers by one, so two sketches differ by no more in total than
    their sets have such elements."""
    placed = sets.select("set_id", "copies", F.transform("elements", lambda e: F.pmod(F.xxhash64(e), F.lit(SKETCH))).alias("places"))

    def number(k: int) -> Column:
        return F.least(F.size(F.filter("places", lambda p: p == k)), F.lit(SKETCH_TOP)).cast("byte")

    return placed.select("set_id", "copies", F.array(*[number(k) for k in range(SKETCH)]).alias("sketch"))


def sketch_distance(left: Column, right: Column) -> Column:
    steps = F.zip_with(left, right, lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)


def _near_counts(sets: DataFrame, threshold: float) -> DataFrame:
    """Candidates are many times the near pairs, and contents many times the
    sketches, so contents are fetched for pairs of near sketches only."""
    m = ceil(threshold * threshold) - 1
    sketched = with_payload(euclidean_candidates(sets, threshold), lookup(sketches(sets), "sketches"), "sketch")
    likely = sketched.where(sketch_distance(F.col("left"), F.col("right")) <= m).select("a", "b")
    # A repeated id names several sets, and its pairs come once for each.
    pairs = with_payload(likely.distinct(), sets, "elements")
    only_left = F.size(F.array_except("left", "right"))
    only_right = F.size(F.array_except("right", "left"))
    close = pairs.where(only_left + only_right <= m)
    scored = close.withColumn("distance", F.sqrt(squared_distance(F.col("left"), F.col("right"))))
    return scored.where(F.col("distance") < threshold).drop("left", "right")


def euclidean_pairs_exact(bag: DataFrame, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, copies_a, copies_b, distance) on term counts, as for Jaccard."""
    sets = written(euclidean_sets(bag, rows), "euclidean-sets")
    return _near_counts(sets, threshold).unionByName(self_pairs(sets))


# ---- approximate joins -----------------------------------------------------


def collide(left: Column, right: Column) -> Column:
    """True where any hash table puts both sides into one bucket."""
    return F.exists(F.zip_with(left, right, lambda x, y: x == y), lambda same: same)


def _signatures(vectors: DataFrame, model, output: str) -> DataFrame:
    """The model's hashes as array<double>, one per table."""
    hashed = model.transform(vectors)
    first = F.transform(output, lambda v: F.unwrap_udt(v)["values"][0])
    return hashed.withColumn("hashes", first).drop(output)


def minhash_sets(counts: DataFrame, tables: int = HASH_TABLES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Collapsed bucket sets with their MinHash values: (set_id, copies,
    buckets, hashes) and (id, set_id). Rows without any bucket have no MinHash
    and take no part."""
    vectors = fold(counts, "id", BUCKETS).withColumn("buckets", vector_indices(F.col("features")))
    digested = written(with_digest(vectors, F.col("buckets")), "minhash-rows")
    lsh = MinHashLSH(inputCol="features", outputCol="lsh", numHashTables=tables, seed=seed)
    signed = _signatures(collapse(digested, "features", "buckets"), lsh.fit(digested), "lsh")
    return written(signed.drop("features"), "minhash-sets"), members(digested)


def jaccard_lsh_join(sets: DataFrame, threshold: float, whole: bool = False) -> DataFrame:
    """Pairs that share a MinHash bucket in any table and lie below threshold.
    With whole, and a threshold below 1, near pairs that share no bucket are
    there as well.

    Below 1 the sketches of a bucket's rows are compared. That gives the same
    pairs as opening the buckets, without the pairs of a crowded bucket that
    are too far apart.

    No distance exceeds 1, so a threshold above it excludes nothing and asks
    for every pair of every bucket. That result itself grows with the square
    of a bucket; choose a threshold below 1 on large tables. Each pair is then
    taken in its first common table, so none is shuffled for duplicates."""
    if threshold < 1:
        return _near_sets(sets, "buckets", threshold, bucketed=not whole).unionByName(self_pairs(sets))
    if whole:
        raise ValueError("all pairs are found below a threshold < 1 only; distances never exceed 1")
    opened = sets.select("set_id", "hashes", F.posexplode("hashes").alias("table", "hash"))
    earlier = collide(F.slice("a.hashes", F.lit(1), F.col("a.table")), F.slice("b.hashes", F.lit(1), F.col("b.table")))
    met = as_pairs(opened, opened, ["table", "hash"], ~earlier)
    met = met.select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b"))
    scored = with_payload(spread_pairs(met), sets, "buckets").withColumn("distance", jaccard_distance(F.col("left"), F.col("right")))
    if threshold <= 1:
        scored = scored.where(F.col("distance") < threshold)
    return scored.drop("left", "right").unionByName(self_pairs(sets))


def gaussian(table: Column, index: Column, seed: int = SEED) -> Column:
    """A standard normal number that depends on (seed, table, index) alone:
    Box-Muller on two uniform numbers from the md5 of the key. Any task, and
    SQL, computes the same projection vectors without storing them."""
    first = (key_hash(F.lit(seed), table, index, F.lit(1)) + F.lit(0.5)) / F.lit(float(RANGE))
    second = key_hash(F.lit(seed), table, index, F.lit(2)) / F.lit(float(RANGE))
    return F.sqrt(F.lit(-2.0) * F.log(first)) * F.cos(F.lit(2 * pi) * second)


def projection_norms(spark, size: int, tables: int = HASH_TABLES, seed: int = SEED) -> list[float]:
    """Length of each table's projection vector over `size` indices; one
    number per table reaches the driver."""
    cells = spark.range(size).select(F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("t"), F.col("id").alias("i"))
    g = gaussian(F.col("t"), F.col("i"), seed)
    found = cells.groupBy("t").agg(F.sqrt(F.sum(g * g)).alias("norm")).collect()
    return [r["norm"] for r in sorted(found, key=lambda r: r["t"])]


def projection_hashes(entries: Column, norms: list[float], bucket_length: float = BUCKET_LENGTH, seed: int = SEED) -> Column:
    """Bucket of a vector (array of (indices, values)) in each table:
    floor(projection on the unit vector / bucket length), rounded to 9 places
    first so that the order of the sum cannot move a bucket."""

    def dot(t: int) -> Column:
        return F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + e["values"] * gaussian(F.lit(t), e["indices"], seed))

    return F.array(*[F.floor(F.round(dot(t) / F.lit(norm) / F.lit(bucket_length), 9)) for t, norm in enumerate(norms)])


def projection_sets(
    counts: DataFrame, rows: DataFrame, seed: int = SEED, tables: int = HASH_TABLES, bucket_length: float = BUCKET_LENGTH
) -> tuple[DataFrame, DataFrame]:
    """Collapsed count vectors with their random-projection buckets: (set_id,
    copies, entries, hashes) and (id, set_id). The projection vectors are
    counter-based Gaussian numbers, so the buckets do not depend on a
    generator's state, on partitioning or on the engine."""
    vectors = attach_vector(rows.select("id"), fold(counts, "id", BUCKETS), "features")
    vectors = vectors.withColumn("entries", vector_entries(F.col("features"))).drop("features")
    digested = written(with_digest(vectors, F.col("entries")), "projection-rows")
    norms = projection_norms(rows.sparkSession, BUCKETS, tables, seed)
    signed = collapse(digested, "entries").withColumn("hashes", projection_hashes(F.col("entries"), norms, bucket_length, seed))
    return written(signed, "projection-sets"), members(digested)


def euclidean_lsh_join(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs that share a projection bucket in any table and lie below
    threshold. A bucket of raw counts holds rows far apart, so candidates come
    from the exact filter and are kept if they share a bucket."""
    entry = sets.select(F.col("set_id").alias("id"), F.explode("entries").alias("e"))
    counts = entry.select("id", F.col("e.indices").cast("string").alias("term"), F.col("e.values").alias("tf"))
    lists = rarity_ordered(counted_elements(counts)).withColumnRenamed("id", "set_id")
    ordered = sets.select("set_id", "copies", "hashes").join(lists, "set_id", "left")
    ordered = ordered.withColumn("elements", F.coalesce("elements", F.array().cast("array<string>")))
    ordered = written(ordered, "projection-sets")
    near = _near_counts(ordered, threshold)
    hashes = ordered.select("set_id", "hashes")
    near = near.join(hashes.toDF("a", "hashes_a"), "a").join(hashes.toDF("b", "hashes_b"), "b")
    near = near.where(collide(F.col("hashes_a"), F.col("hashes_b"))).drop("hashes_a", "hashes_b")
    return near.unionByName(self_pairs(ordered))


# ---- pairs as training examples --------------------------------------------


def labelled_distances(pairs: DataFrame, members: DataFrame, rows: DataFrame, *labels: str) -> DataFrame:
    """(labels of the first row, distance, pairs): what a model sees of the row
    pairs, in both orders, counted instead of listed."""
    there = F.struct(F.col("a").alias("set_id"), F.col("copies_b").alias("partners"))
    back = F.struct(F.col("b").alias("set_id"), F.col("copies_a").alias("partners"))
    sides = F.when(F.col("a") == F.col("b"), F.array(there)).otherwise(F.array(there, back))
    oriented = pairs.select("distance", F.explode(sides).alias("o")).select("distance", "o.*")
    partners = oriented.groupBy("set_id", "distance").agg(F.sum("partners").alias("partners"))
    owners = members.join(rows.select("id", *labels), "id").groupBy("set_id", *labels).agg(F.count("*").alias("owners"))
    counted = partners.join(owners, "set_id").groupBy(*labels, "distance")
    return counted.agg(F.sum(F.col("partners") * F.col("owners")).alias("pairs"))
