"""One key that holds a large share of all rows: results stay whole and the
joins split the hot partition."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfscore.operators import bags, features, pairs
from shelfscore.plans import QUERIES
from shelfscore.sources import tables
from shelfscore.sources.scratch import scratch_dir

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture()
def tiny_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    """The adapted plan after the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n, value, rest):
    """n rows; two thirds share one value."""
    spread = F.concat(F.lit(rest), F.col("id").cast("string"))
    return spark.range(n, numPartitions=16).select("id", F.when(F.col("id") % 3 > 0, F.lit(value)).otherwise(spread).alias("v"))


def test_hot_term_is_split_for_its_idf(spark, tiny_partitions):
    bag = hot(spark, 20_000, "common", "t").select("id", F.col("v").alias("term"), F.lit(1).cast("long").alias("tf"))
    weights = features.tfidf_terms(bag, F.lit(20_000))
    assert "SortMergeJoin(skew=true)" in final_plan(weights)
    assert weights.count() == 20_000
    assert weights.where("term = 'common'").select("df").distinct().collect()[0]["df"] == 13_333


def test_hot_product_is_split_when_texts_are_pruned(spark, tiny_partitions):
    texts = hot(spark, 20_000, "7", "").select(F.col("v").alias("product_uid"), F.col("id").alias("name"))
    rows = spark.range(100).select(F.col("id").cast("string").alias("product_uid"))
    kept = bags.only_products(texts, bags.products_of(rows))
    assert "SortMergeJoin(skew=true)" in final_plan(kept)
    assert kept.count() == 13_333 + sum(1 for i in range(0, 100, 3))


def test_hot_product_is_split_when_texts_unite(spark, tiny_partitions):
    rows = hot(spark, 9_000, "7", "p").select(
        "id",
        F.col("v").alias("product_uid"),
        F.array(F.lit("own")).alias("tokens"),
        F.col("id").cast("double").alias("relevance"),
    )
    shared = spark.createDataFrame([("7", "x", 2), ("7", "own", 1)], "product_uid string, term string, tf long")
    united = bags.unite_texts(rows, shared)
    assert "SortMergeJoin(skew=true)" in final_plan(united)
    counts = {r["term"]: (r["n"], r["s"]) for r in united.groupBy("term").agg(F.count("*").alias("n"), F.sum("tf").alias("s")).collect()}
    assert counts == {"own": (9_000, 15_000), "x": (6_000, 12_000), None: (3_000, 0)}


def test_group_of_copies_is_one_row(spark, tiny_partitions):
    rows = hot(spark, 9_000, "same", "other").withColumn("elements", F.array("v"))
    digested = pairs.with_digest(rows.select("id", "elements"), F.col("elements"))
    sets = pairs.collapse(digested, "elements")
    assert sets.count() == 3_001
    assert sets.agg(F.sum("copies"), F.max("copies")).collect()[0] == (9_000, 6_000)
    found = pairs.members(digested)
    assert "SortMergeJoin(skew=true)" in final_plan(found)
    sizes = Counter(r["set_id"] for r in found.collect())
    assert sizes[1] == 6_000 and len(sizes) == 3_001


def test_copies_meet_as_groups(spark):
    """6,000 copies and 3,000 near copies of them: two groups, one pair."""
    kind = F.when(F.col("id") % 3 > 0, F.array(*[F.lit(w) for w in "abcdef"])).otherwise(F.array(*[F.lit(w) for w in "abcdeg"]))
    bag = bags.count_terms(spark.range(9_000).select("id", kind.alias("tokens")), "id")
    found = {(r["a"], r["b"]): (r["copies_a"], r["copies_b"]) for r in pairs.jaccard_pairs_exact(bag, 0.5).collect()}
    assert found == {(0, 0): (3_000, 3_000), (1, 1): (6_000, 6_000), (0, 1): (3_000, 6_000)}
    rows = spark.range(9_000)
    near = {(r["a"], r["b"]) for r in pairs.euclidean_pairs_exact(bag, rows).collect()}
    assert near == {(0, 0), (0, 1), (1, 1)}


def test_common_last_word_meets_nothing_in_vain(spark):
    """Short texts that share only their most frequent word are no candidates."""
    words = F.array(F.lit("z"), F.concat(F.lit("a"), "id"), F.concat(F.lit("b"), "id"))
    bag = bags.count_terms(spark.range(500).select("id", words.alias("tokens")), "id")
    sets = pairs.euclidean_sets(bag, spark.range(500))
    assert pairs.euclidean_candidates(sets, pairs.THRESHOLD).count() == 0
    lists = pairs.rarity_ordered(bag.select("id", F.col("term").alias("element")))
    sets = pairs.collapse(pairs.with_digest(lists, F.col("elements")), "elements")
    assert pairs.jaccard_candidates(sets, 0.5).count() == 0


# ---- one long conversation, from the tables on ------------------------------


@pytest.fixture(scope="module")
def long_conversation(spark):
    """3,000 turns of one conversation in each of many files, and few others."""
    root = scratch_dir(spark, "long")
    hot = spark.range(3_000, numPartitions=32).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    rest = spark.range(300, numPartitions=32).select((F.col("id") % 60).alias("conv_id"), (F.col("id") + 10_000).alias("turn"))
    text = F.concat(F.lit("red lamp number "), F.col("turn").cast("string"))
    both = hot.unionAll(rest).withColumns({"role": F.lit("user"), "text": text})
    both.repartition(32, "turn").write.parquet(f"{root}/conversations.parquet")
    parts = spark.range(60).select(
        F.col("id").alias("p_partkey"),
        F.lit("blue lamp").alias("p_name"),
        F.lit("b").alias("p_brand"),
        F.lit("t").alias("p_type"),
        F.lit(3).alias("p_size"),
    )
    parts.write.parquet(f"{root}/part.parquet")
    ids = spark.range(60).select(F.col("id").alias("doc_id"))
    ids.withColumn("quality", F.lit(1)).write.parquet(f"{root}/labels.parquet")
    ids.withColumns({"text": F.lit("a sturdy lamp of steel"), "lang": F.lit("en")}).write.parquet(f"{root}/documents.parquet")
    return root


def plans_of_run(spark, run):
    """The adapted plans of all queries that a call starts, written ones too.
    Executions are told apart by id, as the store keeps only the latest ones."""
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():
        found = store.executionsList()
        return [found.apply(k) for k in range(found.size())]

    before = max((e.executionId() for e in executions()), default=-1)
    out = run()
    out.write.format("noop").mode("overwrite").save()
    return [e.physicalPlanDescription() for e in executions() if e.executionId() > before], out


def test_hot_product_is_split_in_the_training_view(spark, tiny_partitions, long_conversation):
    rows = tables.train(spark, long_conversation)
    assert "SortMergeJoin(skew=true)" in final_plan(rows)
    assert rows.count() == 3_300 == rows.select("id").distinct().count()


@pytest.mark.parametrize("name", ["product_bundle", "tf_hashed", "left_join_uid", "query_product_cosine"])
def test_hot_product_is_split_in_queries_over_it(spark, tiny_partitions, long_conversation, name):
    plans, _ = plans_of_run(spark, lambda: QUERIES[name](spark, long_conversation))
    assert sum("skew=true" in p for p in plans) >= 2, name


def test_bundle_is_summed_by_row_and_term(spark, tiny_partitions, long_conversation):
    found = QUERIES["product_bundle"](spark, long_conversation)
    assert "hashpartitioning(id" in final_plan(found)
    counts = found.where("product_uid = 7").groupBy("term").agg(F.sum("tf").alias("n")).collect()
    # Each of its 3,005 rows has one lamp in title, search and description.
    assert {r["term"]: r["n"] for r in counts}["lamp"] == 3_005 * 3
