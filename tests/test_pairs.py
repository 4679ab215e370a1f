"""Pair joins against brute force and against Spark's own LSH joins."""

import hashlib
import random
from collections import Counter
from itertools import combinations_with_replacement
from math import cos, floor, log, pi, sqrt

import pytest
from pyspark.ml.feature import MinHashLSH
from pyspark.sql import functions as F

from shelfscore.operators import features, pairs


def random_bags(seed, n=60, words=12, longest=9):
    rng = random.Random(seed)
    bags = {}
    for i in range(n):
        size = rng.choice([0, 1, 1, 2, 3, rng.randint(4, longest)])
        bags[i] = Counter(rng.choice("abcdefghijklmnopqrst"[:words]) for _ in range(size))
    # A third of the rows are copies of one text and near copies of another.
    for i in range(0, n, 3):
        bags[i] = Counter("aabbcdefgh")
    for i in range(1, n, 6):
        bags[i] = Counter("aabbcdefgh") + Counter(rng.choice("abx"))
    return bags


def frames(spark, bags):
    rows = spark.createDataFrame([(i,) for i in bags], "id long")
    counts = [(i, t, n) for i, bag in bags.items() for t, n in bag.items()]
    return spark.createDataFrame(counts, "id long, term string, tf long"), rows


def jaccard(a, b):
    return 1 - len(set(a) & set(b)) / len(set(a) | set(b))


def euclidean(a, b):
    return sqrt(sum((a[t] - b[t]) ** 2 for t in set(a) | set(b)))


def expected(bags, content, distance, threshold):
    groups = {}
    for i, bag in bags.items():
        groups.setdefault(content(bag), []).append(i)
    sets = sorted((min(ids), len(ids)) for ids in groups.values())
    found = {}
    for (a, n), (b, m) in combinations_with_replacement(sets, 2):
        d = 0.0 if a == b else distance(bags[a], bags[b])
        if d < threshold:
            found[(a, b)] = (n, m, round(d, 9))
    return found


def collected(df):
    rows = df.collect()
    found = {(r["a"], r["b"]): (r["copies_a"], r["copies_b"], round(r["distance"], 9)) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("threshold", [0.1, 0.34, 0.5, 0.75, 0.95])
def test_exact_jaccard_misses_no_pair(spark, threshold):
    bags = random_bags(7)
    terms, _ = frames(spark, bags)
    filled = {i: b for i, b in bags.items() if b}
    want = expected(filled, lambda b: frozenset(b), jaccard, threshold)
    assert collected(pairs.jaccard_pairs_exact(terms, threshold)) == want


def test_contents_are_fetched_for_near_sketches_only(spark, monkeypatch):
    """The contents of every candidate pair were shuffled."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    # Sets of one size that meet in the rarest word and share little else.
    bags = {i: Counter(["rare", *rng.choices(words, k=30)]) for i in range(60)} | {i: Counter({"far": 200 + i, "z": 1}) for i in range(60, 64)}
    bags |= {100 + i: bags[i] + Counter(["w1"]) for i in range(5)}
    fetched, fetch = [], pairs.with_payload
    monkeypatch.setattr(pairs, "with_payload", lambda p, sets, name: fetched.append((name, p.count())) or fetch(p, sets, name))
    want = expected(bags, lambda b: frozenset(b.items()), euclidean, pairs.THRESHOLD)
    assert collected(pairs.euclidean_pairs_exact(*frames(spark, bags))) == want
    count = dict(fetched)
    near = sum(1 for k in want if k[0] != k[1])
    assert near <= count["elements"] < count["sketch"] / 4


@pytest.mark.parametrize("threshold", [0.5, 1.0, 1.5, 2.5])
def test_exact_euclidean_misses_no_pair(spark, threshold):
    bags = random_bags(11)
    want = expected(bags, lambda b: frozenset(b.items()), euclidean, threshold)
    assert collected(pairs.euclidean_pairs_exact(*frames(spark, bags), threshold)) == want


def test_exact_jaccard_rejects_thresholds_that_exclude_nothing(spark):
    terms, _ = frames(spark, random_bags(1, n=6))
    with pytest.raises(ValueError):
        pairs.jaccard_pairs_exact(terms, 1.5)


def hashed(spark, bags):
    tokens = [(i, sorted(bag.elements())) for i, bag in bags.items()]
    rows = spark.createDataFrame(tokens, "id long, tokens array<string>")
    return rows, features.unfold(features.tf_hashed(rows), "tf_vector", "id")


def library_pairs(model, vectors, threshold):
    joined = model.approxSimilarityJoin(vectors, vectors, threshold, "distance")
    found = joined.select(F.col("datasetA.id").alias("a"), F.col("datasetB.id").alias("b"), "distance").collect()
    return {(r["a"], r["b"]): round(r["distance"], 9) for r in found}


def expanded(spark, sets, members, found):
    """Row pairs in both orders from pairs of groups."""
    group = {}
    for r in members.collect():
        group.setdefault(r["set_id"], []).append(r["id"])
    result = {}
    for r in found.collect():
        for x in group[r["a"]]:
            for y in group[r["b"]]:
                result[(x, y)] = result[(y, x)] = round(r["distance"], 9)
    return result


@pytest.mark.parametrize("threshold", [0.4, 1.5])
def test_minhash_join_equals_library_join(spark, threshold):
    bags = {i: b for i, b in random_bags(3).items() if b}
    rows, counts = hashed(spark, bags)
    vectors = features.tf_hashed(rows)
    lsh = MinHashLSH(inputCol="tf_vector", outputCol="h", numHashTables=pairs.HASH_TABLES, seed=pairs.SEED)
    sets, members = pairs.minhash_sets(counts)
    ours = expanded(spark, sets, members, pairs.jaccard_lsh_join(sets, threshold))
    assert ours == library_pairs(lsh.fit(vectors), vectors, threshold)


def counter_gaussian(t, i, k=None):
    def uniform(k):
        return int(hashlib.md5(f"{pairs.SEED}:{t}:{i}:{k}".encode()).hexdigest()[:8], 16)

    return sqrt(-2 * log((uniform(1) + 0.5) / 2**32)) * cos(2 * pi * uniform(2) / 2**32)


def test_projection_join_equals_brute_force(spark):
    """Pairs below the threshold that share a bucket of the counter-based
    projections in one table, all computed here in plain Python."""
    bags = random_bags(5)
    rows, counts = hashed(spark, bags)
    vectors = {r["id"]: dict(zip(r["index"], r["value"])) for r in counts.groupBy("id").agg(
        F.collect_list("index").alias("index"), F.collect_list("value").alias("value")).collect()}
    norms = [sqrt(sum(counter_gaussian(t, i) ** 2 for i in range(features.BUCKETS))) for t in range(pairs.HASH_TABLES)]
    used = {i for v in vectors.values() for i in v}
    g = {(t, i): counter_gaussian(t, i) for t in range(pairs.HASH_TABLES) for i in used}

    def buckets(v):
        return [floor(round(sum(x * g[(t, i)] for i, x in sorted(v.items())) / norms[t] / pairs.BUCKET_LENGTH, 9)) for t in range(pairs.HASH_TABLES)]

    sig = {i: buckets(vectors.get(i, {})) for i in bags}
    want = {}
    for a in bags:
        for b in bags:
            va, vb = vectors.get(a, {}), vectors.get(b, {})
            d = sqrt(sum((va.get(k, 0) - vb.get(k, 0)) ** 2 for k in set(va) | set(vb)))
            if d < pairs.THRESHOLD and any(x == y for x, y in zip(sig[a], sig[b])):
                want[(a, b)] = round(d, 9)
    assert pairs.projection_norms(spark, features.BUCKETS) == pytest.approx(norms, rel=1e-12)
    sets, members = pairs.projection_sets(counts, rows)
    assert expanded(spark, sets, members, pairs.euclidean_lsh_join(sets)) == want


def test_counted_examples_stand_for_all_row_pairs(spark):
    bags = {i: b for i, b in random_bags(13).items() if b}
    rows, counts = hashed(spark, bags)
    labelled = rows.withColumn("label", F.col("id") % 4)
    sets, members = pairs.minhash_sets(counts)
    found = pairs.jaccard_lsh_join(sets, 0.8)
    listed = Counter((x % 4, d) for (x, _), d in expanded(spark, sets, members, found).items())
    counted = pairs.labelled_distances(found, members, labelled, "label").collect()
    totals = Counter()
    for r in counted:
        totals[(r["label"], round(r["distance"], 9))] += r["pairs"]
    assert totals == listed


def test_tiled_pairs_do_not_depend_on_the_block(spark):
    """Products cut into blocks of 2 rows give the same pairs as whole ones;
    every row meets every search of its product once."""
    from shelfscore.operators import cosine
    from shelfscore.plans import inputs

    folder = "/root/testdata/sf0.001"
    sides = (inputs.training(spark, folder), inputs.search(spark, folder), inputs.shared(spark, folder))
    rounded = lambda df: sorted((r["id"], r["search_id"], round(r["cosine"], 9)) for r in df.collect())
    small = rounded(cosine.row_pair_cosines(*sides, block=2))
    assert small == rounded(cosine.row_pair_cosines(*sides))
    sizes = Counter(r["product_uid"] for r in sides[0].select("product_uid").collect())
    assert len(small) == sum(m * m for m in sizes.values()) == len(set((a, b) for a, b, _ in small))


def test_sets_with_one_common_rare_element_are_not_fetched(spark):
    """Two sets of 40 that share one rare element only lie far apart; they were
    a candidate pair, for which both contents were shuffled."""
    sets = {i: [f"shared{i // 2}"] + [f"own{i}-{k:02d}" for k in range(39)] for i in range(20)}
    sets[20], sets[21] = ["both%02d" % k for k in range(40)], ["both%02d" % k for k in range(36)]
    rows = spark.createDataFrame(list(sets.items()), "set_id long, elements array<string>")
    found = pairs.jaccard_candidates(rows, 0.5).collect()
    assert [(r["a"], r["b"]) for r in found] == [(20, 21)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_opened_fronts_are_not_broadcast(spark, tmp_path):
    """Written sets are small files, their opened fronts are not."""
    rows = spark.createDataFrame([(i, [f"w{i}", "x", "y"], [1.0, 2.0]) for i in range(9)], "set_id long, elements array<string>, hashes array<double>")
    rows.write.parquet(str(tmp_path / "sets"))
    sets = spark.read.parquet(str(tmp_path / "sets"))
    for bucketed in (False, True):
        assert "BroadcastHashJoin" not in plan_of(pairs.jaccard_candidates(sets, 0.5, bucketed))


def test_large_buckets_are_compared_in_tiles(spark, monkeypatch):
    """Pairs that met in an element were shuffled, once for each. Sketches are,
    and a large bucket is cut so that no task compares all of it."""
    monkeypatch.setattr(pairs, "TILE_ROWS", 10)
    monkeypatch.setattr(pairs, "MOST_ROWS", 12)
    bags = random_bags(17, n=90)
    bags = {i: b + Counter(f"t{i % 40}-{k}" for k in range(i % 7)) for i, b in bags.items()}
    terms, _ = frames(spark, bags)
    filled = {i: b for i, b in bags.items() if b}
    assert collected(pairs.jaccard_pairs_exact(terms, 0.5)) == expected(filled, lambda b: frozenset(b), jaccard, 0.5)
    sets = spark.createDataFrame([(i, list(b), [float(i % 2)]) for i, b in filled.items()], "set_id long, elements array<string>, hashes array<double>")
    opened = pairs.parity_sketches(sets).select("set_id", "n", "sketch", F.posexplode("hashes").alias("table", "hash"))
    tiles = pairs.compared_tiles(opened).groupBy("table", "hash", "i", "j").agg(F.count("*").alias("n")).collect()
    assert len(tiles) > 12 and max(r["n"] for r in tiles) < 40
    found = {(r["a"], r["b"]) for r in pairs.jaccard_candidates(sets, 0.5, bucketed=True).collect()}
    near = {(a, b) for a in filled for b in filled if a < b and (a - b) % 2 == 0 and jaccard(filled[a], filled[b]) < 0.5}
    assert near <= found and all((a - b) % 2 == 0 and a < b for a, b in found)
    assert "SortMergeJoin" not in plan_of(pairs.jaccard_candidates(sets, 0.5))


def test_sketches_differ_no_more_than_their_sets(spark):
    rng = random.Random(23)
    rows = [(i, rng.sample(range(5_000), n)) for i, n in enumerate([1, 40, 90, 300, 700, 1_500, 3_000])]
    rows += [(10 + i, held[: len(held) * 9 // 10] + [9_000 + i]) for i, held in rows]
    sets = spark.createDataFrame([(i, e, [0.0]) for i, e in rows], "set_id long, elements array<int>, hashes array<double>")
    held = {r["set_id"]: int.from_bytes(r["sketch"], "little") for r in pairs.parity_sketches(sets).collect()}
    size = {r["set_id"]: 8 * len(r["sketch"]) for r in pairs.parity_sketches(sets).collect()}
    assert size[0] == 256 and size[4] == 4_096
    for a, x in rows:
        for b, y in rows:
            folded = {}
            for i in (a, b):
                folded[i] = 0
                width = min(size[a], size[b])
                for k in range(0, size[i], width):
                    folded[i] ^= held[i] >> k & (1 << width) - 1
            assert (folded[a] ^ folded[b]).bit_count() <= len(set(x) ^ set(y))


def test_written_steps_leave_no_shuffle_files(spark):
    """They stayed on disk until the driver collected its garbage."""
    from shelfscore.sources.scratch import written

    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    step = written(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count(), "step")
    assert tracker.shuffleStatuses().size() == before
    assert step.count() == 7
