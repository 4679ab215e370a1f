import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import functions as F

from shelfscore.functions.vectors import as_vectors, sparse_struct
from shelfscore.operators import bags, cosine, features


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["b"]), (4, [])]
    return spark.createDataFrame(rows, "id long, tokens array<string>")


def test_term_weights_follow_the_library_idf(spark, docs):
    weights = features.tfidf_terms(bags.count_terms(docs, "id"), features.row_count(docs))
    found = {(r["id"], r["term"]): r["weight"] for r in weights.collect()}
    hashed = HashingTF(inputCol="tokens", outputCol="tf").transform(docs)
    model = IDF(inputCol="tf", outputCol="w").fit(hashed)
    for row in model.transform(hashed).collect():
        ours = sorted(w for (i, _), w in found.items() if i == row["id"])
        assert ours == pytest.approx(sorted(row["w"].values))


def test_long_hashed_form_equals_vectors(spark, docs):
    shared = spark.createDataFrame([(10, ["a", "z"]), (10, ["z"]), (20, ["q"])], "product_uid long, tokens array<string>")
    rows = docs.withColumn("product_uid", F.when(F.col("id") < 3, 10).otherwise(30).cast("long"))
    counts = features.hashed_bundle(rows, features.hashed_bag(shared, "product_uid"))
    folded = features.attach_vector(rows, features.fold(counts, "id", features.BUCKETS), "features")
    added = F.when(F.col("product_uid") == 10, F.array(F.lit("a"), F.lit("z"), F.lit("z"))).otherwise(F.array())
    whole = rows.withColumn("tokens", F.concat("tokens", added.cast("array<string>")))
    expected = {r["id"]: r["tf_vector"] for r in features.tf_hashed(whole).collect()}
    found = {r["id"]: r["features"] for r in folded.collect()}
    assert found == expected
    assert found[1].size == 20_000 and sum(found[1].values) == 6
    assert found[4].numNonzeros() == 0


def test_vectors_survive_unfolding(spark):
    entries = spark.createDataFrame([(1, 7, 0.1), (1, 3, 1e-17), (2, 0, -1e300)], "id long, index int, value double")
    folded = features.fold(entries, "id", 10)
    back = features.unfold(folded, "features", "id")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, entries.collect()))
    Normalizer(inputCol="features", outputCol="unit").transform(folded).collect()


def test_empty_sparse_vector(spark):
    empty = sparse_struct(5, F.array().cast("array<int>"), F.array().cast("array<double>"))
    assert as_vectors(spark.range(1).select(empty.alias("v")), "v", "empty").first()["v"].size == 5


def test_normalised_rows_have_length_one(spark):
    weights = spark.createDataFrame([(1, "a", 3.0), (1, "b", 4.0), (2, "a", 0.0)], "id long, term string, weight double")
    units = {(r["id"], r["term"]): r["unit"] for r in features.l2_normalize(weights, "id").collect()}
    assert units == {(1, "a"): 0.6, (1, "b"): 0.8, (2, "a"): 0.0}


def matrix(spark, seed=3, n_rows=40, n_columns=15):
    rng = np.random.default_rng(seed)
    dense = np.where(rng.random((n_rows, n_columns)) < 0.3, rng.random((n_rows, n_columns)), 0.0)
    dense[:, 10] = dense[:, 11] = dense[:, 12] = 0.0
    dense[4, 10], dense[4, 11], dense[5, 12] = 2.0, 0.5, 1.0
    entries = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    return dense, spark.createDataFrame(entries, "id long, index int, value double")


def column_cosines(dense):
    norms = np.linalg.norm(dense, axis=0)
    return (dense.T @ dense) / np.outer(norms, norms)


def test_exact_column_cosine(spark):
    dense, entries = matrix(spark)
    want = column_cosines(dense)
    found = cosine.column_cosine_exact(entries).collect()
    lone = next(r for r in found if r["i"] == r["j"])
    assert (lone["i"], lone["columns_i"], lone["sim"]) == (10, 2, 1.0)
    seen = {(r["i"], r["j"]): r["sim"] for r in found if r["i"] != r["j"]}
    columns = [j for j in range(dense.shape[1]) if j != 11]
    for a, i in enumerate(columns):
        for j in columns[a + 1 :]:
            assert seen.get((i, j), 0.0) == pytest.approx(want[i, j])


def test_sampled_column_cosine_is_close_and_repeats(spark):
    rng = random.Random(1)
    rows = 4000
    entries = [(i, j, 1.0) for i in range(rows) for j in range(6) if rng.random() < (0.5 if j < 3 else 0.2)]
    frame = spark.createDataFrame(entries, "id long, index int, value double")
    dense = np.zeros((rows, 6))
    for i, j, v in entries:
        dense[i, j] = v
    want = column_cosines(dense)
    # gamma = 10 ln(6) / 0.05 = 358 thins columns of norm 28 to 45.
    sampled = cosine.column_cosine_dimsum(frame, 6, 0.05)
    first = {(r["i"], r["j"]): r["sim"] for r in sampled.collect()}
    again = {(r["i"], r["j"]): r["sim"] for r in cosine.column_cosine_dimsum(frame.repartition(5), 6, 0.05).collect()}
    assert first.keys() == again.keys()
    for (i, j), sim in first.items():
        assert sim == pytest.approx(want[i, j], rel=0.35)
        assert sim != pytest.approx(want[i, j], rel=1e-9)
        assert again[(i, j)] == pytest.approx(sim)


def test_registered_threshold_is_a_cosine_and_thins_heavy_columns(spark):
    from shelfscore.plans.feature_queries import DIMSUM_THRESHOLD

    assert DIMSUM_THRESHOLD == cosine.SAMPLING_THRESHOLD == 0.1
    rng = np.random.default_rng(7)
    dense = (rng.random((4000, 6)) < 0.5).astype(float)
    entries = [(int(i), int(j), 1.0) for i, j in zip(*np.nonzero(dense))]
    frame = spark.createDataFrame(entries, "id long, index int, value double")
    want = column_cosines(dense)
    # gamma = 10 ln(6) / 0.1 = 179 thins columns of norm 45.
    found = {(r["i"], r["j"]): r["sim"] for r in cosine.column_cosine_dimsum(frame, 6, DIMSUM_THRESHOLD).collect()}
    assert len(found) == 15
    for (i, j), sim in found.items():
        assert sim == pytest.approx(want[i, j], rel=0.5) and sim != pytest.approx(want[i, j], rel=1e-9)


def test_sampling_keeps_light_columns_whole(spark):
    _, entries = matrix(spark)
    exact = {(r["i"], r["j"]): r["sim"] for r in cosine.column_cosine_exact(entries).collect()}
    sampled = {(r["i"], r["j"]): r["sim"] for r in cosine.column_cosine_dimsum(entries, 15).collect()}
    assert sampled == pytest.approx(exact)


def brute_cosines(texts, searches, shared):
    """Per row cosine with every row's search, from whole bundles."""
    bundles = {i: tokens + shared.get(uid, []) for i, (uid, tokens) in texts.items()}

    def weights(docs):
        n = len(docs)
        df = {}
        for tokens in docs.values():
            for t in set(tokens):
                df[t] = df.get(t, 0) + 1
        return {i: {t: d.count(t) * math.log((n + 1) / (df[t] + 1)) for t in set(d)} for i, d in docs.items()}

    def norm(w):
        return math.sqrt(sum(v * v for v in w.values()))

    left, right = weights(bundles), weights(searches)
    return {
        (i, j): (
            sum(v * right[j].get(t, 0.0) for t, v in left[i].items()) / (norm(left[i]) * norm(right[j]))
            if norm(left[i]) * norm(right[j]) > 0
            else 0.0
        )
        for i in left
        for j in right
    }


def test_query_product_cosine_without_and_with_pairing(spark):
    rng = random.Random(5)
    texts, searches = {}, {}
    for i in range(30):
        uid = 1 if i % 3 == 0 else rng.randint(2, 6)
        texts[i] = (uid, [rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))])
        searches[i] = [rng.choice("abcdxyz") for _ in range(rng.randint(0, 3))]
    shared = {uid: [rng.choice("cdefghijx") for _ in range(uid)] for uid in range(1, 5)}
    training = spark.createDataFrame(
        [(i, uid, tokens, 1.0) for i, (uid, tokens) in texts.items()],
        "id long, product_uid long, tokens array<string>, relevance double",
    )
    search = spark.createDataFrame(
        [(i, texts[i][0], s) for i, s in searches.items()], "id long, product_uid long, tokens array<string>"
    )
    products = spark.createDataFrame(list(shared.items()), "product_uid long, tokens array<string>")
    bag = bags.count_terms(products, "product_uid")
    want = brute_cosines(texts, searches, shared)
    own = {r["id"]: r["cosine"] for r in cosine.query_product_cosine(training, search, bag).collect()}
    assert own == pytest.approx({i: want[(i, i)] for i in texts})
    mean = cosine.query_product_cosine(training, search, bag, on="product_uid").collect()
    assert len(mean) == len(texts)
    for r in mean:
        partners = [j for j in texts if texts[j][0] == texts[r["id"]][0]]
        assert r["partners"] == len(partners)
        assert r["mean_cosine"] == pytest.approx(sum(want[(r["id"], j)] for j in partners) / len(partners), abs=1e-12)
