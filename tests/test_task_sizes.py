"""What one task takes in does not grow with the tables."""

import itertools
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfscore.operators import bags, cosine, features, models, pairs, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frames(spark, n=40):
    train = spark.createDataFrame(
        [(f"r{i}", i % 4, f"title {i}", f"search {i % 3}", 1.0) for i in range(n)],
        "id string, product_uid long, title string, search_term string, relevance double",
    )
    attributes = spark.createDataFrame([(i, "brand", "new") for i in range(4)], "product_uid long, name string, value string")
    texts = spark.createDataFrame([(i, f"word{i} word word") for i in range(4)], "product_uid long, description string")
    return train, attributes, texts


def test_tasks_grow_with_the_rows(spark):
    df = spark.range(10)
    assert rows.dealt(df, 10, "id").rdd.getNumPartitions() == 8
    assert rows.dealt(df, 20 * rows.ROWS_PER_TASK, "id").rdd.getNumPartitions() == 20


def test_joined_rows_are_counted_by_group(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (4,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    assert rows.joined_rows(left, right, "k") == left.join(right, "k").count() == 7
    assert rows.joined_rows(left, right.where("k = 9"), "k") == 0


def test_bundle_rows_are_dealt_out_before_they_are_summed(spark):
    """A hash table of whole join partitions was built ahead of the shuffle."""
    train, attributes, texts = frames(spark)
    bundle = bags.product_bundle(train, attributes, texts, [])
    assert "REPARTITION_BY_NUM" in plan_of(bundle)
    assert bundle.where("term = 'word'").agg(F.count("*"), F.sum("tf")).first()[:] == (40, 80)
    counts = features.hashed_bag(bags.product_texts(train, attributes, texts, []), "product_uid")
    hashed = features.hashed_bundle(bags.training_tokens(train, []), counts)
    assert "REPARTITION_BY_NUM" in plan_of(hashed)
    assert hashed.agg(F.sum("value")).first()[0] == bundle.agg(F.sum("tf")).first()[0]


def test_texts_of_one_file_are_dealt_out(spark):
    train, attributes, texts = frames(spark)
    assert "REPARTITION_BY_NUM" in plan_of(bags.product_texts(train, attributes, texts.coalesce(1), []))


def test_trees_are_fitted_on_a_bounded_number_of_partitions(spark):
    data = models.scalar_features(spark.range(400).selectExpr("id * 1.0D as x", "id % 7 * 1.0D as label"), "x").repartition(100)
    kept = models.tree_rows(data)
    assert kept.rdd.getNumPartitions() == models.TREE_PARTITIONS and kept.count() == 400


def test_content_is_listed_once(spark):
    """Both sides of the collapse were made from the text anew."""
    bag = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 2)], "id long, term string, tf long")
    sets = pairs.euclidean_sets(bag, bag.select("id").distinct())
    assert "collect_list" not in plan_of(sets)
    assert {(r["set_id"], r["copies"]) for r in sets.collect()} == {(1, 2), (3, 1)}


def test_column_products_are_summed_where_they_are_made(spark):
    """Every product of two entries of a row was shuffled. Three ranges of
    columns, a row with an entry that comes twice, and a null entry."""
    rng = np.random.default_rng(2)
    listed = [(int(i), int(j), float(v)) for i in range(12) for j, v in zip(rng.choice(5_000, 60, False) // 40 * 40, rng.random(60))]
    listed = list({(i, j): (i, j, v) for i, j, v in listed}.values()) + [(0, 40, 0.5), (1, 80, None)]
    norms, want = Counter(), Counter()
    for _, j, v in listed:
        norms[j] += (v or 0.0) ** 2
    for (i, a, u), (k, b, v) in itertools.product(listed, listed):
        if i == k and a < b and None not in (u, v):
            want[a, b] += u * v / math.sqrt(norms[a] * norms[b])
    entries = spark.createDataFrame(listed, "id long, index int, value double")
    merged = cosine._merge_single_row_columns(cosine._unit_columns(entries))
    assert merged.where("columns > 1").count() == 0
    sums = cosine._row_products(merged, F.lit(1.0))
    above, below = plan_of(sums).split("MapInArrow")
    assert "Exchange" not in above and "Exchange" in below
    found = {(r["i"], r["j"]): r["sim"] for r in sums.collect()}
    assert sums.schema["i"].dataType.simpleString() == "int"
    assert {k for k in found if k[0] < k[1]} == set(want)
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_row_terms_are_dealt_out_before_they_are_counted(spark):
    """A hash table of all terms of a file's rows was built ahead of the shuffle."""
    train, _, _ = frames(spark)
    shared = spark.createDataFrame([(0, "search", 3), (9, "title", 1)], "product_uid long, term string, tf long")
    counts = cosine._term_counts(bags.training_tokens(train, []), bags.search_tokens(train), shared)
    assert "partial_count" not in plan_of(counts) and "REPARTITION_BY_NUM" in plan_of(counts)
    assert "SortMergeJoin" in plan_of(counts)
    found = {(r["id"], r["term"]): (r["own"], r["asked"], r["inherited"]) for r in counts.collect()}
    assert found["r0", "search"] == (1, 1, 3) and found["r1", "search"] == (1, 1, 0) and found["r5", "5"] == (1, 0, 0)


def test_column_products_are_summed_in_passes(spark, monkeypatch):
    """A row's lists were sent to all pairs of ranges at once."""
    rng = np.random.default_rng(5)
    listed = [(i, int(j), float(v)) for i in range(30) for j, v in zip(rng.choice(9_000, 50, False) // 90 * 90, rng.random(50))]
    entries = spark.createDataFrame(list({(i, j): (i, j, v) for i, j, v in listed}.values()), "id long, index int, value double")

    def found(df):
        return {(r["i"], r["columns_i"], r["j"], r["columns_j"], round(r["sim"], 9)) for r in df.collect()}

    once = found(cosine.column_cosine_exact(entries, 0.1)), found(cosine.column_cosine_dimsum(entries, 9_000, 0.1, 0.1))
    monkeypatch.setattr(cosine, "_PASS", 300)
    monkeypatch.setattr(cosine, "_CELLS", 1)
    exact, sampled = cosine.column_cosine_exact(entries, 0.1), cosine.column_cosine_dimsum(entries, 9_000, 0.1, 0.1)
    assert "MapInArrow" not in plan_of(exact) and plan_of(exact).count("column-sums") >= 4
    assert (found(exact), found(sampled)) == once and len(once[0]) > 1_000
