"""Every registered query against its SQL twin on the whole small tables."""

import math

import pytest
from pyspark.sql import functions as F
from compare import connect, differences

import __spark_entry__ as entry
from shelfscore import plans

QUERIES = plans.QUERIES
SF_DIR = "/root/testdata/sf0.001"
SQL = plans.SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_twin(spark, con, name):
    expected = con.sql(SQL[name]).df()
    assert len(expected) > 0
    assert differences(QUERIES[name](spark, SF_DIR), expected) is None


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL and n != "model_grid"])
def test_query_without_twin_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["id", "product_uid", "relevance", "term", "tf"]
    assert result.count() > 0


def test_sampling_thins_heavy_columns(spark):
    """At the registered threshold heavy columns are thinned and a pair of
    equal heavy columns still comes out near 1. The made columns are heavier
    than those of the small tables, whose norms stay below the bound."""
    from shelfscore.operators import cosine
    from shelfscore.plans import feature_queries as Q

    root = (10 * math.log(40_000) / Q.DIMSUM_THRESHOLD) ** 0.5
    rows = 8_000
    entries = spark.range(rows).select(
        "id", F.explode(F.array(F.lit(0), F.lit(1), (F.col("id") % 50) + 2)).alias("index"), F.lit(1.0).alias("value")
    )
    assert rows**0.5 > 2 * root
    found = cosine.column_cosine_dimsum(entries, 40_000, Q.DIMSUM_THRESHOLD, Q.DIMSUM_THRESHOLD)
    sims = {(r["i"], r["j"]): r["sim"] for r in found.where("i = 0 and j = 1").collect()}
    assert abs(sims[(0, 1)] - 1.0) < 0.25
