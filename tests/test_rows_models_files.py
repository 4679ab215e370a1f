import os

import pytest
from pyspark.sql import types as T
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfscore.functions.sampling import RANGE, key_hash
from shelfscore.operators import models, rows
from shelfscore.sources import files, tables
from shelfscore.sources.scratch import scratch_dir, written

# ---- rows ------------------------------------------------------------------


def test_row_numbers_are_dense_and_follow_the_keys(spark):
    # One key owns most rows.
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "7").otherwise(F.col("id").cast("string")).alias("k"), "id")
    found = [(r["k"], r["id"], r["row_id"]) for r in rows.row_id(df, "k", "id").collect()]
    found.sort(key=lambda r: r[2])
    assert [r[2] for r in found] == list(range(1, 1001))
    assert [r[:2] for r in found] == sorted(r[:2] for r in found)


@pytest.mark.parametrize("n", [0, 1, 17, 500, 1000, 2000])
def test_limit_keeps_the_lowest_hashes(spark, n):
    df = spark.range(1000)
    ordered = [r["id"] for r in df.orderBy(key_hash(F.col("id")), "id").collect()]
    assert sorted(r["id"] for r in rows.limit_rows(df, n, "id").collect()) == sorted(ordered[:n])


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_split_does_not_depend_on_partitions(spark, partitions):
    split = rows.train_test_split(spark.range(2000).repartition(partitions), "id")
    train = {r["id"] for r in split.where("part = 'train'").collect()}
    test = {r["id"] for r in split.where("part = 'test'").collect()}
    assert not train & test and len(train | test) == 2000
    assert 1330 < len(train) < 1470
    again = rows.train_test_split(spark.range(2000), "id").where("part = 'train'")
    assert {r["id"] for r in again.collect()} == train


def test_sort_is_lexicographic_on_text_keys(spark):
    df = spark.createDataFrame([("10", 1), ("9", 2), ("100", 3)], "k string, id int")
    assert [r["k"] for r in rows.sort_by_key(df, F.col("k"), F.col("id")).collect()] == ["10", "100", "9"]


# ---- models ----------------------------------------------------------------


def examples(spark, values):
    data = [(i, float(y), Vectors.dense([float(x)])) for i, (x, y) in enumerate(values)]
    return spark.createDataFrame(data, ["id", "label", "features"])


def test_tree_finds_the_best_variance_split(spark):
    values = [(x, 1.0 if x < 6 else 3.0 + 0.1 * (x % 2)) for x in range(12)]
    model = models.decision_tree(depth=1).fit(examples(spark, values))
    predicted = {p["prediction"] for p in model.transform(examples(spark, values)).collect()}

    def spread(part):
        mean = sum(part) / len(part)
        return sum((y - mean) ** 2 for y in part)

    best = min(range(1, 12), key=lambda c: spread([y for x, y in values if x < c]) + spread([y for x, y in values if x >= c]))
    sides = [[y for x, y in values if x < best], [y for x, y in values if x >= best]]
    assert sorted(predicted) == pytest.approx(sorted(sum(s) / len(s) for s in sides))


def test_weights_equal_repeated_rows(spark):
    values = [(1.0, 2.0), (2.0, 3.0), (3.0, 7.0), (4.0, 1.0)]
    times = [1, 3, 2, 5]
    repeated = examples(spark, [v for v, t in zip(values, times) for _ in range(t)])
    counted = examples(spark, values).withColumn("weight", F.element_at(F.lit(times), (F.col("id") + 1).cast("int")).cast("double"))
    for plain, weighted in [
        (models.linear_regression("normal"), models.linear_regression("normal", weightCol="weight")),
        (models.decision_tree(), models.decision_tree(weightCol="weight")),
    ]:
        a = models.mse(plain.fit(repeated).transform(repeated)).first()["mse"]
        b = models.mse(weighted.fit(counted).transform(counted), "weight").first()["mse"]
        assert a == pytest.approx(b, rel=1e-6)


def test_line_goes_through_the_origin(spark):
    values = [(1.0, 2.0), (2.0, 3.0), (5.0, 4.0)]
    model = models.linear_regression("normal").fit(examples(spark, values))
    assert model.intercept == 0.0
    assert model.coefficients[0] == pytest.approx(sum(x * y for x, y in values) / sum(x * x for x, _ in values))


def test_grid_names_every_cell(spark):
    data = rows.train_test_split(examples(spark, [(i, i % 5) for i in range(60)]), "id")
    grid = models.model_grid(
        [
            ("x", data, None, [("tree", models.decision_tree()), ("line", models.linear_regression("normal"))]),
            ("y", data.withColumn("w", F.lit(2.0)), "w", [("forest", models.random_forest(weightCol="w"))]),
        ]
    ).collect()
    assert {(r["feature_set"], r["model"]) for r in grid} == {("x", "tree"), ("x", "line"), ("y", "forest")}
    assert all(r["mse"] >= 0 for r in grid)
    by_set = {r["feature_set"]: r["n_train"] + r["n_test"] for r in grid}
    assert by_set == {"x": 60, "y": 120}


# ---- files -----------------------------------------------------------------


def test_csv_round_trip_with_quotes_and_line_breaks(spark):
    data = [("1", 'a "quoted", text'), ("2", "two\nlines"), ("3", None)]
    df = spark.createDataFrame(data, tables.DESCRIPTIONS)
    path = files.write_csv(df, scratch_dir(spark, "csv"))
    back = files.scan_csv(spark, path, tables.DESCRIPTIONS, line_breaks=True)
    assert sorted(map(tuple, back.collect())) == sorted(data)


def test_junk_labels_fail_unless_lenient(spark, tmp_path):
    (tmp_path / "train.csv").write_text("id,uid,title,search,relevance\n1,2,lamp,red lamp,2.5\n2,2,lamp,lamp,high\n")
    path = str(tmp_path / "train.csv")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.scan_csv(spark, path, tables.TRAIN).collect()
    lenient = files.scan_csv(spark, path, tables.TRAIN, strict=False)
    assert [r["relevance"] for r in lenient.orderBy("id").collect()] == [2.5, None]


def test_rejected_lines_come_out_beside_the_good_rows(spark, tmp_path):
    lines = ["1,x,2.5", '2,"y ""q"", z",3.5', "z,w,1.0", "4,v", "5,u,6.0,7", '6,"open,1.0', "7,t,nan", "8,,"]
    (tmp_path / "t.csv").write_text("a,b,c\n" + "\n".join(lines) + "\n")
    schema = T.StructType.fromDDL("a int, b string, c double")
    good, rejected = files.scan_csv_with_rejects(spark, str(tmp_path / "t.csv"), schema)
    assert sorted(map(tuple, good.collect()), key=lambda r: r[0]) == [(1, "x", 2.5), (2, 'y "q", z', 3.5), (8, None, None)]
    found = {r["line"]: r["reason"] for r in rejected.collect()}
    assert found == {
        "z,w,1.0": "not a int: a",
        "4,v": "too few fields",
        "5,u,6.0,7": "too many fields",
        '6,"open,1.0': "unclosed quote",
        "7,t,nan": "not a double: c",
    }
    assert {r["file"] for r in rejected.collect()} == {(tmp_path / "t.csv").as_uri().replace("file:///", "file:/")}
    assert good.count() + rejected.count() == len(lines)


def test_rejected_lines_of_an_empty_file_and_a_reserved_name(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n")
    good, rejected = files.scan_csv_with_rejects(spark, str(tmp_path / "e.csv"), T.StructType.fromDDL("a int, b string"))
    assert good.count() == 0 and rejected.count() == 0
    with pytest.raises(ValueError):
        files.scan_csv_with_rejects(spark, str(tmp_path / "e.csv"), T.StructType.fromDDL("_rejected string"))


def test_stopword_file_is_split_on_non_word_characters(spark, tmp_path):
    (tmp_path / "words.csv").write_bytes(b"a,\r\ndon't,\r\nThe,\r\na,\r\n\r\n")
    words = files.load_stopwords(spark, str(tmp_path / "words.csv"))
    assert sorted(r["word"] for r in words.collect()) == ["a", "don", "t", "the"]


def test_solvers_agree(spark):
    values = [(float(x), 2.0 * x + (x % 3)) for x in range(1, 40)]
    lines = [models.linear_regression(solver).fit(examples(spark, values)).coefficients[0] for solver in ("normal", "l-bfgs")]
    assert lines[0] == pytest.approx(lines[1], abs=1e-6)


@pytest.mark.parametrize("n", [0, 10, 3_000])
def test_limit_orders_a_few_times_n_rows_only(spark, n):
    wanted = rows.likely_rows(n)
    assert wanted <= 2 * n + 200
    low = spark.range(200_000).where(key_hash(F.col("id")) < int(RANGE * wanted / 200_000)).count()
    assert n <= low < 2 * wanted


def test_appended_files_are_seen(spark):
    root = scratch_dir(spark, "grows")
    spark.range(5).write.parquet(f"{root}/part.parquet")
    assert tables.table(spark, root, "part").count() == 5
    spark.range(5).write.mode("append").parquet(f"{root}/part.parquet")
    assert tables.table(spark, root, "part").count() == 10


def test_half_written_sets_and_models_are_made_anew(spark):
    root = scratch_dir(spark, "half").removeprefix("file://")
    files.materialize_once(spark.range(3), root, "set")
    os.remove(f"{root}/set/_SUCCESS")
    assert files.materialize_once(spark.range(9), root, "set").count() == 9
    estimator = Pipeline(stages=[models.linear_regression("normal")])
    files.fit_or_load(estimator, examples(spark, [(1.0, 2.0), (2.0, 4.0)]), f"{root}/model")
    os.remove(f"{root}/model/finished/_SUCCESS")
    again = files.fit_or_load(estimator, examples(spark, [(1.0, 9.0), (2.0, 18.0)]), f"{root}/model")
    assert again.stages[0].coefficients[0] == pytest.approx(9.0)


class _Cluster:
    """As much of a session as the folder is chosen by."""

    def __init__(self, master, named=None, context=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master, self._context = master, context

    def getCheckpointDir(self):
        return self._context


def test_scratch_needs_a_shared_folder_off_one_machine():
    assert scratch_dir(_Cluster("spark://x", "hdfs://s/"), "t").startswith("hdfs://s/t-")
    assert scratch_dir(_Cluster("spark://x", context="hdfs://c"), "t").startswith("hdfs://c/t-")
    assert "/t-" in scratch_dir(_Cluster("local[4]"), "t")
    for master in ("spark://x", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(_Cluster(master), "t")


def test_ids_of_long_conversations_differ(spark):
    root = scratch_dir(spark, "long")
    turns = spark.range(1_500).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    turns = turns.unionAll(spark.range(3).select(F.lit(8).cast("long"), "id"))
    turns.withColumns({"role": F.lit("user"), "text": F.lit("red lamp")}).write.parquet(f"{root}/conversations.parquet")
    spark.range(10).select(F.col("id").alias("p_partkey"), F.lit("lamp").alias("p_name")).write.parquet(f"{root}/part.parquet")
    labels = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    labels.write.parquet(f"{root}/labels.parquet")
    train = tables.train(spark, root)
    assert train.count() == 1_503 == train.select("id").distinct().count()


def test_libsvm_round_trip(spark):
    data = [(1.5, Vectors.sparse(6, [0, 4], [1.0, 2.5])), (2.0, Vectors.sparse(6, [], []))]
    df = spark.createDataFrame(data, ["label", "features"])
    back = files.read_libsvm(spark, files.write_libsvm(df, scratch_dir(spark, "libsvm")), 6)
    assert sorted((r["label"], r["features"]) for r in back.collect()) == data


def test_feature_sets_do_not_replace_each_other(spark):
    root = scratch_dir(spark, "sets")
    files.materialize_once(spark.range(3), root, "first")
    assert files.materialize_once(spark.range(9), root, "first").count() == 3
    assert files.materialize_once(spark.range(9), root, "second").count() == 9


def test_stored_model_is_loaded_instead_of_trained(spark):
    path = scratch_dir(spark, "model")
    estimator = Pipeline(stages=[models.linear_regression("normal")])
    first = files.fit_or_load(estimator, examples(spark, [(1.0, 2.0), (2.0, 4.0)]), path)
    again = files.fit_or_load(estimator, examples(spark, [(1.0, 9.0)]), path)
    assert again.stages[0].coefficients == first.stages[0].coefficients


def test_scratch_lies_in_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_dir(spark, "x").startswith(root)
    assert written(spark.range(5), "numbers").count() == 5
