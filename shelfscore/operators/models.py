"""Regression of relevance on features: fit, score, compare."""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from math import exp, factorial, sqrt

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.functions.sampling import unit_hash


# Fixed values of the models.
DEPTH = 5
BINS = 32
TREES = 5
ITERATIONS = 100
SEED = 1234


def decision_tree(depth: int = DEPTH, **columns: str) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=depth, maxBins=BINS, impurity="variance", seed=SEED, **columns)


def random_forest(trees: int = TREES, **columns: str) -> RandomForestRegressor:
    return RandomForestRegressor(
        numTrees=trees, maxDepth=DEPTH, maxBins=BINS, impurity="variance", featureSubsetStrategy="auto", seed=SEED, **columns
    )


# Largest number of copies of a row in one bootstrap: Poisson(1) exceeds it
# with a probability of about 1e-19.
MOST_COPIES = 20


def poisson_copies(u: Column, most: int = MOST_COPIES) -> Column:
    """Copies of a row in a bootstrap, Poisson(1) by its inverse distribution
    at u in [0, 1)."""
    bounds, total = [], 0.0
    for k in range(most):
        total += exp(-1.0) / factorial(k)
        bounds.append((total, k))
    found = F.lit(most)
    for bound, k in reversed(bounds):
        found = F.when(u < F.lit(bound), F.lit(k)).otherwise(found)
    return found.cast("double")


class HashedForest:
    """Trees of a forest whose bootstrap and feature subsets are drawn by
    hashes: row copies from (seed, tree, id), features from (seed, tree,
    index). The same rows in any order or layout give the same trees."""

    def __init__(self, trees: list, subsets: list[list[int]], features: str) -> None:
        self.trees, self.subsets, self.features = trees, subsets, features

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        names = []
        for k, (tree, subset) in enumerate(zip(self.trees, self.subsets, strict=True)):
            sliced = VectorSlicer(inputCol=self.features, outputCol=f"_f{k}", indices=subset).transform(df)
            df = tree.copy().setFeaturesCol(f"_f{k}").setPredictionCol(f"_p{k}").transform(sliced).drop(f"_f{k}")
            names.append(f"_p{k}")
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / F.lit(float(len(names)))
        return df.withColumn(output, mean).drop(*names)


def _drawn(seed: int, tree: int, index: int, share: float) -> bool:
    digest = hashlib.md5(f"{seed}:{tree}:{index}".encode()).hexdigest()
    return int(digest[:8], 16) / 2**32 < share


def hashed_forest(
    training: DataFrame,
    size: int,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    share: float = 1 / 3,
    id_col: str = "id",
    features: str = "features",
    label: str = "label",
) -> HashedForest:
    """A forest of regression trees: each tree sees every row as often as a
    Poisson(1) number drawn from the row's id says (as a weight) and a third
    of the features drawn by index. Split candidates are Spark's own; up to
    10,000 training rows they come from all rows, above that from a sample
    that Spark draws per partition."""
    fitted, subsets = [], []
    for t in range(trees):
        subset = [i for i in range(size) if _drawn(seed, t, i, share)] or [0]
        copies = poisson_copies(unit_hash(F.lit(seed), F.lit(t), F.col(id_col)))
        rows = training.withColumn("_copies", copies).where(F.col("_copies") > 0)
        rows = VectorSlicer(inputCol=features, outputCol="_f", indices=subset).transform(rows)
        tree = DecisionTreeRegressor(
            maxDepth=depth, maxBins=BINS, impurity="variance", seed=seed, featuresCol="_f", labelCol=label, weightCol="_copies"
        )
        fitted.append(tree.fit(tree_rows(rows)))
        subsets.append(subset)
    return HashedForest(fitted, subsets, features)


def linear_regression(solver: str = "l-bfgs", **columns: str) -> LinearRegression:
    """Least squares without intercept or penalty. "normal" solves the normal
    equations exactly, for up to 4,096 features."""
    return LinearRegression(
        fitIntercept=False, regParam=0.0, maxIter=ITERATIONS, standardization=False, solver=solver, **columns
    )


# Fixed values of the published solver that row 50 uses: rounds, step size
# (divided by the square root of the round) and the relative change of the
# weights below which it stops.
SGD_ROUNDS = 100
SGD_STEP = 1.0
SGD_TOLERANCE = 0.001


def gradient_descent(
    examples: DataFrame,
    size: int,
    label: str = "label",
    features: str = "features",
    rounds: int = SGD_ROUNDS,
    step: float = SGD_STEP,
    tolerance: float = SGD_TOLERANCE,
) -> list[float]:
    """Weights of least squares without intercept by full-batch gradient
    descent: in round t, w -= step / sqrt(t) * mean((w.x - y) x). From the
    second round on it stops once the weights moved by less than tolerance
    times max(|w|, 1). Each round is one aggregate over the examples; the
    weights (`size` numbers, the length of the feature vectors) are the only
    state, sent to the tasks as one constant and summed back per index. No
    examples give zero weights."""
    plain = F.unwrap_udt(F.col(features))
    # A dense vector stores no indices: its places are 0, 1, ...
    places = F.coalesce(plain["indices"], F.sequence(F.lit(0), F.greatest(F.size(plain["values"]) - 1, F.lit(0))))
    entries = F.arrays_zip(places.alias("indices"), plain["values"].alias("values"))
    entries = F.filter(entries, lambda x: x["values"].isNotNull())
    data = examples.select(F.col(label).cast("double").alias("y"), entries.alias("e"))
    n = data.count()
    weights = [0.0] * size
    if n == 0:
        return weights
    for t in range(1, rounds + 1):
        known = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
        dot = F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x["values"] * F.element_at(known, x["indices"] + 1))
        diff = (dot - F.col("y")).alias("diff")
        parts = data.select("e", diff).select(
            F.explode(F.transform("e", lambda x: F.struct(x["indices"].alias("i"), (x["values"] * F.col("diff")).alias("g")))).alias("p")
        )
        sums = {r["i"]: r["g"] for r in parts.groupBy(F.col("p.i").alias("i")).agg(F.sum("p.g").alias("g")).collect()}
        rate = step / sqrt(t)
        moved = [w - rate * sums.get(k, 0.0) / n for k, w in enumerate(weights)]
        change = sqrt(sum((a - b) ** 2 for a, b in zip(moved, weights)))
        size_now = sqrt(sum(a * a for a in moved))
        weights = moved
        if t > 1 and change < tolerance * max(size_now, 1.0):
            break
    return weights


# Partitions of the rows that a tree is fitted on. Each of them sends the
# statistics of every open node (features x bins, 15 MB at 20,000 features) to
# the one task that splits the node, so that task reads as many times that.
TREE_PARTITIONS = 32


def tree_rows(training: DataFrame) -> DataFrame:
    """All training rows in a bounded number of partitions; more rows make
    longer partitions but no more statistics."""
    return training.coalesce(TREE_PARTITIONS)


def fit(estimator, training: DataFrame):
    if isinstance(estimator, (DecisionTreeRegressor, RandomForestRegressor)):
        training = tree_rows(training)
    return Pipeline(stages=[estimator]).fit(training)


def scalar_features(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers as a feature vector."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def mse(scored: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean squared error of (label, prediction), each row counted once or as
    often as its weight says."""
    error = (F.col("label") - F.col("prediction")) ** 2
    if weight is None:
        return scored.agg(F.avg(error).alias("mse"))
    return scored.agg((F.sum(error * F.col(weight)) / F.sum(weight)).alias("mse"))


def predict(model, test: DataFrame) -> DataFrame:
    return model.transform(test)


def evaluate(estimator, data: DataFrame, model: str, feature_set: str, weight: str | None = None) -> DataFrame:
    """Fit on part = train, score on part = test: one row of metrics."""
    fitted = fit(estimator, data.where(F.col("part") == "train"))
    scored = predict(fitted, data.where(F.col("part") == "test"))
    rows = F.col(weight) if weight else F.lit(1)
    counted = lambda part: F.sum(F.when(F.col("part") == part, rows).otherwise(0)).cast("long")
    sizes = data.agg(counted("train").alias("n_train"), counted("test").alias("n_test"))
    named = mse(scored, weight).select(F.lit(model).alias("model"), F.lit(feature_set).alias("feature_set"), "mse")
    return named.withColumn("n_train", sizes.select("n_train").scalar()).withColumn(
        "n_test", sizes.select("n_test").scalar()
    )


def model_grid(cells: list[tuple[str, DataFrame, str | None, list[tuple[str, object]]]]) -> DataFrame:
    """One metrics row per feature set and model. A cell names its data with
    part, label and features, its weight column and the estimators to run."""
    rows = [
        evaluate(estimator, data, model, feature_set, weight)
        for feature_set, data, weight, estimators in cells
        for model, estimator in estimators
    ]
    return reduce(DataFrame.unionByName, rows)


# ---- the fitted model as a table of nodes --------------------------------

# Largest number of nodes a model may have to be sent whole to every task:
# a tree of depth 5 has at most 63, a forest of 5 such trees 315.
MOST_NODES = 1 << 16

_SPLIT = re.compile(r"^(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)$")
_LEAF = re.compile(r"^Predict: (\S+)$")


def _tree_nodes(lines: list[str], tree: int) -> list[tuple]:
    """Pre-order lines of one tree as (tree, node, depth, feature, threshold,
    prediction); nodes are numbered as in a heap: root 1, children 2n, 2n+1."""
    nodes: list[tuple] = []

    def walk(i: int, node: int, depth: int) -> int:
        text = lines[i].strip()
        leaf = _LEAF.match(text)
        if leaf:
            nodes.append((tree, node, depth, None, None, float(leaf.group(1))))
            return i + 1
        split = _SPLIT.match(text)
        if not split or split.group(1) != "If" or split.group(3) != "<=":
            raise ValueError(f"only splits of continuous features are read, not {text!r}")
        nodes.append((tree, node, depth, int(split.group(2)), float(split.group(4)), None))
        i = walk(i + 1, 2 * node, depth + 1)
        if not lines[i].strip().startswith("Else"):
            raise ValueError(f"expected the other branch at {lines[i]!r}")
        return walk(i + 1, 2 * node + 1, depth + 1)

    walk(0, 1, 0)
    return nodes


def node_table(spark, model) -> DataFrame:
    """A fitted tree or forest of Spark ML as rows (tree, node, depth, feature,
    threshold, prediction, leaf): rows with x[feature] <= threshold go to the
    child 2 * node, the others to 2 * node + 1; a leaf has no feature and
    predicts. A tree is tree 0. Read from the model's own description, whose
    numbers print exactly; a model over MOST_NODES nodes is refused, since
    the table is sent to every task."""
    size = getattr(model, "totalNumNodes", None) or model.numNodes
    if size > MOST_NODES:
        raise ValueError(f"{size} nodes exceed MOST_NODES = {MOST_NODES}")
    lines = [line for line in model.toDebugString.split("\n")[1:] if line.strip()]
    starts = [i for i, line in enumerate(lines) if line.strip().startswith("Tree ")]
    if not starts:
        rows = _tree_nodes(lines, 0)
    else:
        bounds = [*starts, len(lines)]
        rows = [n for t, (a, b) in enumerate(zip(bounds, bounds[1:])) for n in _tree_nodes(lines[a + 1 : b], t)]
    schema = "tree int, node long, depth int, feature int, threshold double, prediction double"
    return spark.createDataFrame(rows, schema).withColumn("leaf", F.col("feature").isNull())


def node_statistics(nodes: DataFrame, data: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """For every node of every tree the rows of ``data`` that reach it: rows,
    mean and population variance of the label (null for a node no row
    reaches, rows 0). Rows are routed one level per step by a join with the
    nodes of that level, every row through every tree; each row then counts
    once at each node on its path, in one aggregate with map-side
    combination. Rows with a null label count in rows but not in mean or
    variance; a null feature vector is not routed and counts nowhere."""
    from pyspark.ml.functions import vector_to_array

    depth = nodes.agg(F.max("depth")).first()[0]
    trees = nodes.agg(F.max("tree")).first()[0]
    splits = F.broadcast(
        nodes.where(~F.col("leaf")).select("tree", F.col("node").alias("at"), "feature", "threshold")
    )
    routed = data.where(F.col(features).isNotNull()).select(
        F.col(label).cast("double").alias("y"),
        vector_to_array(features).alias("x"),
        F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree"),
        F.lit(1).cast("long").alias("at"),
    ).withColumn("path", F.array("at"))
    for _ in range(depth):
        stepped = routed.join(splits, ["tree", "at"], "left")
        right = (F.element_at("x", F.col("feature") + 1) > F.col("threshold")).cast("long")
        child = F.when(F.col("feature").isNull(), F.col("at")).otherwise(2 * F.col("at") + right)
        routed = stepped.select("y", "x", "tree", child.alias("at"), "path").withColumn(
            "path", F.array_union("path", F.array("at"))
        )
    visits = routed.select("tree", F.explode("path").alias("node"), "y")
    counted = visits.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("y").alias("mean"), F.var_pop("y").alias("variance")
    )
    return (
        nodes.join(counted, ["tree", "node"], "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
        .select("tree", "node", "depth", "feature", "threshold", "prediction", "leaf", "rows", "mean", "variance")
    )
