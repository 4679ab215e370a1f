"""The hashed forest does not depend on the layout of its rows."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfscore.operators import models


def rows(spark):
    data = [(f"r{k}", float((k * 7) % 11), Vectors.sparse(8, {k % 8: 1.0 + k % 3, (k * 3) % 8: 2.0})) for k in range(400)]
    return spark.createDataFrame(data, ["id", "label", "features"])


def test_equal_trees_for_two_layouts(spark):
    df = rows(spark)
    one = models.hashed_forest(df.repartition(1), 8)
    other = models.hashed_forest(df.orderBy(F.desc("id")).repartition(7), 8)
    assert [t.toDebugString.split("\n", 1)[1] for t in one.trees] == [t.toDebugString.split("\n", 1)[1] for t in other.trees]
    a = {r["id"]: r["prediction"] for r in one.transform(df).collect()}
    b = {r["id"]: r["prediction"] for r in other.transform(df).collect()}
    assert a == b and len(a) == 400


def test_copies_follow_poisson_one(spark):
    # Evenly spread numbers in [0, 1), as the hashes of ids are.
    drawn = spark.range(200_000).select(((F.col("id") * 2654435761) % 1000003 / 1000003.0).alias("u"))
    u = drawn.select(models.poisson_copies(F.col("u")).alias("c"))
    counts = {r["c"]: r["n"] for r in u.groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert counts[0.0] / 200_000 == pytest.approx(0.3679, abs=0.005)
    assert counts[1.0] / 200_000 == pytest.approx(0.3679, abs=0.005)
    assert counts[2.0] / 200_000 == pytest.approx(0.1839, abs=0.005)
