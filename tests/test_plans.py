"""What the plans must not contain, and what must reach the scans."""

import re

import pytest

from shelfscore import plans

QUERIES = plans.QUERIES
SF_DIR = "/root/testdata/sf0.001"
# Their plans are covered by the queries they are made of.
SLOW = {"model_grid", "random_forest", "explain_model"}


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_plan_is_free_of_cross_joins_and_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text, operator


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["product_bundle"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    view = plan(QUERIES["project"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "EqualTo(role,user)" in view and "struct<conv_id:bigint,turn:bigint,role:string,text:string>" in view
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", text))
    assert "struct<doc_id:bigint,text:string>" in schemas
    assert not any("p_retailprice" in s or "lang" in s for s in schemas)


def test_texts_are_tokenised_once(spark):
    """No size filter that would run the tokeniser ahead of the explode."""
    text = plan(QUERIES["product_bundle"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "size(filter(" not in text
    assert "size(regexp_extract_all(" not in text


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_same_result_for_any_number_of_partitions(spark, partitions):
    names = ["product_bundle", "query_product_cosine", "jaccard_pairs_exact"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        base = {n: sorted(map(repr, QUERIES[n](spark, SF_DIR).collect())) for n in names}
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert base == {n: sorted(map(repr, QUERIES[n](spark, SF_DIR).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
