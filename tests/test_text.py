import pytest
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from shelfscore.functions import text
from shelfscore.operators import bags


def tokens_of(spark, column, value):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(column(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, prose, title",
    [
        ("foo-bar", ["foobar"], ["foo", "bar"]),
        ("foo_bar", ["foobar"], ["foo", "bar"]),
        ("90°F", ["90degreesf"], ["90", "f"]),
        ("6.5 in", ["6", "5", "in"], ["6", "5", "in"]),
        ("don't", ["dont"], ["don", "t"]),
        ("Some people", ["people"], ["some", "people"]),
        ("Handsome Someone", ["handsome", "someone"], ["handsome", "someone"]),
        ("A a  A", ["a", "a", "a"], ["a", "a", "a"]),
        ("größe", ["gr", "e"], ["gr", "e"]),
        ("", [], []),
        (None, [], []),
        ("...", [], []),
    ],
)
def test_two_ways_to_tokenise(spark, value, prose, title):
    assert tokens_of(spark, lambda c: text.prose_tokens(c, ["zzz"]), value) == prose
    assert tokens_of(spark, lambda c: text.title_tokens(c, ["zzz"]), value) == title


def test_cleaning_keeps_full_stops_only(spark):
    value = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
    assert tokens_of(spark, text.clean_special, value) == "."


def test_same_tokens_as_ml_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    words = text.default_stopwords()
    split = RegexTokenizer(inputCol="text", outputCol="raw", pattern=r"[\W_]+").transform(docs)
    kept = StopWordsRemover(inputCol="raw", outputCol="kept", stopWords=words).transform(split)
    ours = kept.withColumn("ours", text.title_tokens(F.col("text"), words))
    assert ours.where(F.col("ours") != F.col("kept")).count() == 0


def test_stopwords_ignore_case_and_keep_duplicates(spark):
    assert tokens_of(spark, lambda c: text.remove_stopwords(text.regex_tokenize(c), ["THE"]), "the b a b") == ["b", "a", "b"]


WORDS = ["the"]


def train(spark, rows):
    return spark.createDataFrame(rows, "id long, product_uid long, title string, search_term string, relevance double")


def bag(df, *keys):
    return {tuple(r[k] for k in (*keys, "term")): r["tf"] for r in df.collect()}


def test_bundle_of_products_with_and_without_texts(spark):
    rows = train(
        spark,
        [
            (1, 10, "Blue-ray the lamp", "lamp", 2.0),
            (2, 10, "Blue-ray the lamp", "ray", 3.0),
            (3, 20, "Chair", None, 1.0),
            (4, 30, None, None, 1.5),
        ],
    )
    attributes = spark.createDataFrame(
        [(10, "watt-age", "40"), (10, "made", None), (None, "lost", "row"), (40, "other", "product")],
        "product_uid long, name string, value string",
    )
    described = spark.createDataFrame([(10, "Blue-ray lamp lamp"), (20, "the")], "product_uid long, description string")
    found = bags.product_bundle(rows, attributes, described, WORDS)
    assert bag(found.where("id = 1"), "id") == {
        (1, "blue"): 1,
        (1, "ray"): 1,
        (1, "lamp"): 4,
        (1, "wattage"): 1,
        (1, "40"): 1,
        (1, "made"): 1,
        (1, "blueray"): 1,
    }
    assert bag(found.where("id = 2"), "id")[(2, "ray")] == 2
    # No shared text: own terms and a null term; relevance stays with the row.
    assert bag(found.where("id = 3"), "id") == {(3, "chair"): 1, (3, None): 0}
    assert bag(found.where("id = 4"), "id") == {(4, None): 0}
    kept = {r["id"]: r["relevance"] for r in found.select("id", "relevance").distinct().collect()}
    assert kept == {1: 2.0, 2: 3.0, 3: 1.0, 4: 1.5}


def test_attributes_fold_into_one_bag(spark):
    attributes = spark.createDataFrame(
        [(1, "size", "6.5"), (1, "size", "6-5"), (None, "a", "b")], "product_uid long, name string, value string"
    )
    assert bag(bags.attribute_tokens(attributes, WORDS), "product_uid") == {
        (1, "size"): 2,
        (1, "6"): 1,
        (1, "5"): 1,
        (1, "65"): 1,
    }


def test_group_keeps_repeated_texts(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x")], "k long, t string")
    found = {(r["k"], r["text"]): r["copies"] for r in bags.collect_text_by_key(df, "k", F.col("t")).collect()}
    assert found == {(1, "x"): 2, (1, "y"): 1, (2, "x"): 1}


def test_search_terms_of_a_product_meet_in_one_bag(spark):
    rows = train(spark, [(1, 5, "", "red the lamp", 1.0), (2, 5, "", "lamp-shade lamp", 1.0)]).drop("relevance")
    assert bag(bags.test_search_bundle(rows, WORDS), "product_uid") == {
        (5, "red"): 1,
        (5, "lamp"): 2,
        (5, "lampshade"): 1,
    }


def test_long_stopword_list_as_a_table(spark):
    docs = spark.createDataFrame([(1, ["the", "lamp", "lamp"])], "id long, tokens array<string>")
    words = spark.createDataFrame([("The",), ("a",)], "word string")
    kept = bags.without_stopwords(bags.count_terms(docs, "id"), words)
    assert bag(kept, "id") == {(1, "lamp"): 2}
