"""The fitted model as a table of nodes, with the rows that reach each node."""

import duckdb
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from shelfscore.operators import models

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
DATA = [(i, float((i * 7) % 5) + (0.5 if i % 3 == 0 else 0.0), float(i % 11), float((i * 13) % 17)) for i in range(120)]


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(i, y, Vectors.dense([a, b])) for i, y, a, b in DATA]
    return spark.createDataFrame(rows, SCHEMA)


def _stats(frame):
    return {(r["tree"], r["node"]): (r["rows"], r["mean"], r["variance"]) for r in frame.collect()}


def _close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_leaves_predict_the_mean_of_their_training_rows(spark, examples):
    model = models.decision_tree(depth=3).fit(examples)
    nodes = models.node_table(spark, model)
    assert nodes.count() == model.numNodes
    stats = models.node_statistics(nodes, examples)
    by_node = {r["node"]: r for r in stats.collect()}
    assert by_node[1]["rows"] == len(DATA)
    for node, r in by_node.items():
        if r["leaf"]:
            assert _close(r["mean"], r["prediction"])
        else:
            assert by_node[2 * node]["rows"] + by_node[2 * node + 1]["rows"] == r["rows"]


def test_routing_equals_a_recursive_query_given_the_splits(spark, examples):
    model = models.decision_tree(depth=4).fit(examples)
    nodes = models.node_table(spark, model)
    stats = _stats(models.node_statistics(nodes, examples))
    con = duckdb.connect()
    con.execute("create table ex as select * from (values " + ",".join(f"({i},{y},[{a},{b}])" for i, y, a, b in DATA) + ") t(id, y, x)")
    splits = [(r["node"], r["feature"], r["threshold"]) for r in nodes.collect() if not r["leaf"]]
    con.execute("create table splits(node bigint, feature int, threshold double)")
    con.executemany("insert into splits values (?, ?, ?)", splits)
    twin = con.execute(
        """with recursive walk(id, y, x, node) as (
             select id, y, x, 1::bigint from ex
             union all
             select w.id, w.y, w.x, 2 * w.node + case when w.x[s.feature + 1] > s.threshold then 1 else 0 end
             from walk w join splits s on s.node = w.node)
           select node, count(*), avg(y), var_pop(y) from walk group by node"""
    ).fetchall()
    assert len(twin) == model.numNodes
    for node, n, mean, variance in twin:
        rows, m, v = stats[(0, node)]
        assert rows == n and _close(m, mean) and _close(v, variance)


def test_every_tree_of_a_forest_sees_every_row(spark, examples):
    model = models.random_forest(trees=3).fit(examples)
    nodes = models.node_table(spark, model)
    assert nodes.count() == model.totalNumNodes
    stats = _stats(models.node_statistics(nodes, examples))
    assert {t for t, _ in stats} == {0, 1, 2}
    assert all(stats[(t, 1)][0] == len(DATA) for t in range(3))


def test_empty_rows_null_labels_and_null_vectors(spark, examples):
    model = models.decision_tree(depth=2).fit(examples)
    nodes = models.node_table(spark, model)
    empty = models.node_statistics(nodes, examples.limit(0))
    assert {r["rows"] for r in empty.collect()} == {0} and {r["mean"] for r in empty.collect()} == {None}
    odd = spark.createDataFrame(
        [(1, None, Vectors.dense([1.0, 1.0])), (2, 3.0, Vectors.dense([1.0, 1.0])), (3, 1.0, None)],
        SCHEMA,
    )
    root = _stats(models.node_statistics(nodes, odd))[(0, 1)]
    assert root == (2, 3.0, 0.0)


def test_categorical_splits_are_refused():
    with pytest.raises(ValueError):
        models._tree_nodes(["If (feature 0 in {1.0,2.0})", "Predict: 1.0", "Else (feature 0 not in {1.0,2.0})", "Predict: 2.0"], 0)
