"""The registered queries against their SQL twins, and what native ones run."""

import duckdb
import pytest
from compare import connect, differences
SF_DIR = "/root/testdata/sf0.001"

import __spark_entry__ as entry
from shelfscore.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_equals_twin(spark, name, folder):
    expected = connect(folder).sql(SQL[name]).df()
    assert len(expected) > 0
    assert differences(QUERIES[name](spark, folder), expected) is None


@pytest.mark.parametrize("name", ["op1_warc", "op10_exact"])
def test_twins_of_odd_rows(spark, name, cases, tmp_path):
    cases.where("doc_id is not null").drop("words").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "x"), (4, "u", "x")], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert differences(QUERIES[name](spark, str(tmp_path)), con.sql(SQL[name]).df()) is None


@pytest.mark.parametrize("name", ["op3_quality", "op5_urls"])
def test_native_queries_run_no_python(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_all_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
