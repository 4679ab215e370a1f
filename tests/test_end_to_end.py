"""From catalogue files to model errors, with text ids as files give them."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from shelfscore.operators import bags, cosine, features, models, pairs, rows
from shelfscore.plans import feature_queries as Q
from shelfscore.plans import inputs
from shelfscore.sources import files, tables

COLOURS = ["red", "blue", "green", "grey"]
THINGS = ["lamp", "chair", "table", "shelf", "door"]


def write(path, header, lines):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *lines])
    return str(path)


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("catalogue")
    products = [(str(100 + i), COLOURS[i % 4], THINGS[i % 5]) for i in range(20)]
    searches = [
        (str(10 * i + k), uid, f"{colour} {thing}", f"{COLOURS[(i + k) % 4]} {thing}", 3.0 if k == 0 else 1.5)
        for i, (uid, colour, thing) in enumerate(products)
        for k in range(3)
    ]
    values = [(uid, "colour", colour) for uid, colour, _ in products] + [("", "", "")]
    prose = [(uid, f"A {colour}, sturdy {thing}. Some say it\'s 6.5\" wide") for uid, colour, thing in products]
    inputs = {
        "train": (tables.TRAIN, ["id", "product_uid", "title", "search_term", "relevance"], searches),
        "attributes": (tables.ATTRIBUTES, ["product_uid", "name", "value"], values),
        "descriptions": (tables.DESCRIPTIONS, ["product_uid", "product_description"], prose),
    }
    return {
        name: files.scan_csv(spark, write(folder / f"{name}.csv", header, lines), schema)
        for name, (schema, header, lines) in inputs.items()
    }


def test_catalogue_to_scores(spark, catalogue, tmp_path):
    table = files.load_stopwords(spark, write(tmp_path / "stop.csv", ["a"], [["it"], ["don't"], ["say"]]))
    train = catalogue["train"]
    bundle = bags.product_bundle(train, catalogue["attributes"], catalogue["descriptions"], table)
    row = {r["term"]: r["tf"] for r in bundle.where("id = '0'").collect()}
    # "Some " goes with its space; the inch mark and the apostrophe glue.
    assert row == {"red": 4, "lamp": 3, "colour": 1, "sturdy": 1, "its": 1, "6": 1, "5": 1, "wide": 1}

    words = [r["word"] for r in table.collect()]
    constant = bags.product_bundle(train, catalogue["attributes"], catalogue["descriptions"], words)
    assert sorted(map(tuple, constant.collect())) == sorted(map(tuple, bundle.collect()))
    training, search = bags.training_tokens(train, words), bags.search_tokens(train)
    shared = bags.shared_bag(train, catalogue["attributes"], catalogue["descriptions"], words)
    scored = cosine.query_product_cosine(training, search, shared)
    assert scored.count() == 60
    fits = {r["m"]: r["c"] for r in scored.groupBy(F.col("relevance").alias("m")).agg(F.avg("cosine").alias("c")).collect()}
    assert fits[3.0] > fits[1.5]

    data = models.scalar_features(scored.withColumnRenamed("relevance", "label"), "cosine")
    grid = models.model_grid([("cosine", rows.train_test_split(data, "id"), None, [("tree", models.decision_tree())])])
    assert grid.first()["mse"] < 0.5

    counts = features.hashed_bundle(training, features.hashed_bag(bags.product_texts(
        train, catalogue["attributes"], catalogue["descriptions"], words), "product_uid"))
    sets, members = pairs.minhash_sets(counts)
    found = pairs.labelled_distances(pairs.jaccard_lsh_join(sets, 0.5), members, train, "relevance")
    assert found.where("distance = 0").agg(F.sum("pairs")).first()[0] >= 60


def test_near_pairs_without_a_common_bucket_are_counted(spark, tmp_path):
    """Pairs below the threshold were left out where no MinHash value was equal."""
    rng = random.Random(4)
    words = [f"word{k}" for k in range(400)]
    base = rng.sample(words, 40)
    texts = [" ".join(rng.sample(base, 30) + rng.sample(words, 6)) for _ in range(24)]
    n = range(len(texts))
    data = {
        "documents": ([(i, texts[i]) for i in n], "doc_id long, text string"),
        "conversations": ([(i, 0, "user", f"ask{i % 3}") for i in n], "conv_id long, turn long, role string, text string"),
        "part": ([(i, "thing", "brand", "kind", 1) for i in n], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "labels": ([(i, 1) for i in n], "doc_id long, quality int"),
    }
    for name, (rows, schema) in data.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    counts = inputs.bundle_counts(spark, str(tmp_path)).groupBy("id").agg(F.collect_set("index").alias("s")).collect()
    sets = [set(r["s"]) for r in counts]
    near = [1 - len(a & b) / len(a | b) for a in sets for b in sets]
    want = sum(1 for d in near if d < 0.5)
    found = Q.jaccard_pairs(spark, str(tmp_path)).agg(F.sum("pairs")).first()[0]
    collapsed, members = pairs.minhash_sets(inputs.bundle_counts(spark, str(tmp_path)))
    rows = tables.train(spark, str(tmp_path))
    bucketed = pairs.labelled_distances(pairs.jaccard_lsh_join(collapsed, 0.5), members, rows, "relevance")
    assert bucketed.agg(F.sum("pairs")).first()[0] < found == want
