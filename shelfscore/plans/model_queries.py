"""Regression queries."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.operators import features, models, rows
from shelfscore.plans import sql as S
from shelfscore.plans.feature_queries import COSINE, bundle_features, euclidean_examples, jaccard_examples, row_cosine
from shelfscore.plans.registry import registered
from shelfscore.sources import files, tables
from shelfscore.sources.scratch import scratch_dir, written

_PART = """
case when ('0x' || substr(md5(cast(id as varchar)), 1, 8))::bigint / 4294967296.0 < 0.7 then 'train' else 'test' end"""

# A line through the origin has the slope sum(xy) / sum(xx).
_SLOPE = "(select sum(x * label) / sum(x * x) from examples where part = 'train')"


def _split(df: DataFrame) -> DataFrame:
    return rows.train_test_split(df, "id")


def _linear(training: DataFrame):
    return Pipeline(stages=[models.linear_regression("normal")]).fit(training)


# ---- the row's cosine ----------------------------------------------------


def cosine_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, part, label, features): the cosine of search and product."""
    found = row_cosine(spark, sf_dir).select("id", F.col("relevance").alias("label"), F.col("cosine").alias("x"))
    return written(_split(models.scalar_features(found, "x")), "cosine-examples")


def _scores(scored: DataFrame) -> DataFrame:
    return scored.select("id", "label", F.round("prediction", 6).alias("prediction"))


_EXAMPLES = [*COSINE, f"examples as (select id, relevance as label, cosine as x, {_PART} as part from cosines)"]


@registered(
    "linear_regression",
    S.query(
        _EXAMPLES,
        f"select id, label, round(x * {_SLOPE}, 6) as prediction from examples where part = 'test'",
    ),
)
def linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance from the cosine of search and product."""
    data = cosine_examples(spark, sf_dir)
    model = _linear(data.where(F.col("part") == "train"))
    return _scores(models.predict(model, data.where(F.col("part") == "test")))


_SGD = f"""
sgd(it, w, stop) as (
  select 0, 0.0::double, false
  union all
  select it + 1, nw, it + 1 > 1 and abs(nw - w) < {models.SGD_TOLERANCE} * greatest(abs(nw), 1.0)
  from (
    select it, w, w - {models.SGD_STEP} / sqrt(it + 1)
      * (select sum((e.x * s.w - e.label) * e.x) / count(*) from examples e where e.part = 'train') as nw
    from sgd s where not stop and it < {models.SGD_ROUNDS}))"""


@registered(
    "linear_regression_sgd",
    "with recursive"
    + S.query(
        [*_EXAMPLES, _SGD],
        "select id, label, round(x * (select w from sgd order by it desc limit 1), 6) as prediction from examples where part = 'test'",
    ).removeprefix("with"),
)
def linear_regression_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance from the cosine by the reference's solver: gradient descent,
    100 rounds, step 1 / sqrt(round), no intercept."""
    data = cosine_examples(spark, sf_dir)
    (w,) = models.gradient_descent(data.where(F.col("part") == "train"), 1)
    return data.where(F.col("part") == "test").select("id", "label", F.round(F.col("x") * F.lit(w), 6).alias("prediction"))


@registered(
    "predict",
    S.query(_EXAMPLES, f"select id, label, part, round(x * {_SLOPE}, 6) as prediction from examples"),
)
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores for the seen and the unseen part."""
    data = cosine_examples(spark, sf_dir)
    scored = models.predict(_linear(data.where(F.col("part") == "train")), data)
    return scored.select("id", "label", "part", F.round("prediction", 6).alias("prediction"))


@registered(
    "model_roundtrip",
    S.query(_EXAMPLES, f"select id, label, round(x * {_SLOPE}, 6) as prediction from examples where part = 'test'"),
)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and save, then load what was saved; the second call trains nothing."""
    data = cosine_examples(spark, sf_dir)
    path = scratch_dir(spark, "model")
    estimator = Pipeline(stages=[models.linear_regression("normal")])
    files.fit_or_load(estimator, data.where(F.col("part") == "train"), path)
    stored = files.fit_or_load(estimator, data.where(F.lit(False)), path)
    return _scores(models.predict(stored, data.where(F.col("part") == "test")))


@registered(
    "model_by_content",
    S.query(_EXAMPLES, f"select id, label, round(x * {_SLOPE}, 6) as prediction from examples where part = 'test'"),
)
def model_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and save under the content of the training rows and the
    estimator's parameters; the second call loads it."""
    data = cosine_examples(spark, sf_dir)
    root = scratch_dir(spark, "models")
    estimator = Pipeline(stages=[models.linear_regression("normal")])
    training = data.where(F.col("part") == "train")
    files.fit_or_load_by_content(estimator, training, root, "cosine-line")
    stored = files.fit_or_load_by_content(estimator, training, root, "cosine-line")
    return _scores(models.predict(stored, data.where(F.col("part") == "test")))


# ---- hashed TF-IDF vectors -------------------------------------------------


def vector_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, part, label, features): hashed TF-IDF of the bundle."""
    return written(_split(bundle_features(spark, sf_dir)), "vector-examples")


def _fit_and_score(estimator, data: DataFrame) -> DataFrame:
    model = models.fit(estimator, data.where(F.col("part") == "train"))
    return _scores(models.predict(model, data.where(F.col("part") == "test")))


@registered("decision_tree")
def decision_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(models.decision_tree(), vector_examples(spark, sf_dir))


@registered("random_forest")
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(models.random_forest(), vector_examples(spark, sf_dir))


@registered("random_forest_hashed")
def random_forest_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest with bootstrap and feature subsets drawn by hashes, so that
    its trees do not depend on how the rows lie in files or partitions."""
    data = vector_examples(spark, sf_dir)
    size = features.BUCKETS
    forest = models.hashed_forest(data.where(F.col("part") == "train"), size)
    return _scores(forest.transform(data.where(F.col("part") == "test")))


@registered("explain_model")
def explain_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned tree as text, one row per line, with its test error. A tree of
    depth 5 has 63 nodes at most."""
    data = cosine_examples(spark, sf_dir)
    model = models.decision_tree().fit(models.tree_rows(data.where(F.col("part") == "train")))
    error = models.mse(models.predict(model, data.where(F.col("part") == "test")))
    lines = F.split(F.lit(model.toDebugString), "\n")
    described = error.select(F.round("mse", 6).alias("mse"), F.posexplode(lines).alias("line", "text"))
    # The first line carries the model's random name.
    return described.where(F.col("line") > 0).select(F.lit("decision_tree").alias("model"), "mse", "line", "text")


@registered("explain_model_nodes")
def explain_model_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the tree and of the forest fitted on the cosine, with the
    training and the test rows that reach it: rows, mean and variance of the
    relevance, one row per (model, part, tree, node)."""
    data = cosine_examples(spark, sf_dir)
    training = data.where(F.col("part") == "train")
    fitted = [("decision_tree", models.decision_tree().fit(models.tree_rows(training))), ("random_forest", models.random_forest().fit(models.tree_rows(training)))]
    described = [
        models.node_statistics(models.node_table(spark, model), data.where(F.col("part") == part)).select(
            F.lit(name).alias("model"), F.lit(part).alias("part"), "*"
        )
        for name, model in fitted
        for part in ("train", "test")
    ]
    return reduce(DataFrame.unionByName, described)


# ---- every feature set with every model ------------------------------------


def pair_examples(counted: DataFrame) -> DataFrame:
    """Pair counts as weighted examples: all pairs instead of a sample."""
    named = counted.withColumnRenamed("relevance", "label")
    weighted = models.scalar_features(named, "distance").withColumn("weight", F.col("pairs").cast("double"))
    return written(weighted.select("part", "label", "features", "weight"), "pair-examples")


@registered("model_grid")
def model_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test error of each feature set and model. Pairs follow their first row
    into the train or the test part."""
    owners = _split(tables.train(spark, sf_dir).select("id", "relevance"))
    labels = ("part", "relevance")
    jaccard = pair_examples(jaccard_examples(spark, sf_dir, *labels, rows=owners))
    euclidean = pair_examples(euclidean_examples(spark, sf_dir, *labels, rows=owners))

    def trees(weight: str | None) -> list[tuple[str, object]]:
        columns = {"weightCol": weight} if weight else {}
        return [
            ("decision_tree", models.decision_tree(**columns)),
            ("random_forest", models.random_forest(**columns)),
        ]

    def line(solver: str, weight: str | None) -> tuple[str, object]:
        columns = {"weightCol": weight} if weight else {}
        return ("linear_regression", models.linear_regression(solver, **columns))

    grid = models.model_grid(
        [
            ("tfidf", vector_examples(spark, sf_dir), None, [*trees(None), line("l-bfgs", None)]),
            ("jaccard", jaccard, "weight", [*trees("weight"), line("normal", "weight")]),
            ("cosine", cosine_examples(spark, sf_dir), None, trees(None)),
            ("euclidean", euclidean, "weight", trees("weight")),
        ]
    )
    return grid.withColumn("mse", F.round("mse", 6))
