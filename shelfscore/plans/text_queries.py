"""Sources, projections, text functions and token bags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscore.functions import text
from shelfscore.operators import bags, features, models, rows
from shelfscore.plans import inputs
from shelfscore.plans import sql as S
from shelfscore.plans.feature_queries import HASHED_BUNDLE, N_BUNDLE, bundle_features, idf
from shelfscore.plans.registry import registered
from shelfscore.sources import files, tables
from shelfscore.sources.scratch import lookup, scratch_dir, written


def _words(column: str) -> F.Column:
    return F.array_join(column, " ").alias(column)


# ---- sources and sinks -----------------------------------------------------


@registered("scan_csv", "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.table(spark, sf_dir, "part")
    return files.scan_csv(spark, files.write_csv(part, scratch_dir(spark, "csv")), part.schema)


_NARROW_KEY = "tinyint"


@registered(
    "scan_csv_rejects",
    f"""select p_partkey, p_partkey > 127 as rejected,
    case when p_partkey > 127 then 'not a {_NARROW_KEY}: p_partkey' end as reason from part""",
)
def scan_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` written as CSV and read back with a key type too narrow for keys
    above 127: one row per line, good or rejected, with the reason of a
    rejection. The key of a rejected line is its first field."""
    part = tables.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    path = files.write_csv(part, scratch_dir(spark, "csv-rejects"))
    declared = T.StructType.fromDDL(f"p_partkey {_NARROW_KEY}, p_name string, p_retailprice double")
    good, rejected = files.scan_csv_with_rejects(spark, path, declared)
    kept = good.select(
        F.col("p_partkey").cast("int").alias("p_partkey"),
        F.lit(False).alias("rejected"),
        F.lit(None).cast("string").alias("reason"),
    )
    key = F.split("line", ",")[0].cast("int").alias("p_partkey")
    return kept.unionByName(rejected.select(key, F.lit(True).alias("rejected"), "reason"))


@registered(
    "rename_columns",
    S.query([S.ATTRIBUTES], "select product_uid as item, name as property, value as content from attributes"),
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.rename_columns(tables.attributes(spark, sf_dir), "item", "property", "content")


@registered(
    "stopwords",
    r"""
select distinct word
from (select unnest(regexp_split_to_array(lower(p_name || ','), '\W+')) as word from part) where word <> ''""",
)
def stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word file made from the part names, loaded like a stop-word file."""
    path = scratch_dir(spark, "stopwords")
    tables.table(spark, sf_dir, "part").select(F.concat("p_name", F.lit(","))).write.text(path)
    return files.load_stopwords(spark, path)


def _stored_vectors(place: str, kept: str = "true") -> str:
    """Twin of the bundle's TF-IDF vectors as a file holds them, without ids."""
    return S.query(
        [*HASHED_BUNDLE, f"weighted as ({idf('hashed', 'index', N_BUNDLE)})"],
        f"""
select t.relevance as label, {place} as index, round(w.weight, 6) as value, count(*) as entries
from training_tokens t join weighted w using (id) where {kept} group by all""",
    )


def _entries(df: DataFrame) -> DataFrame:
    rounded = df.select("label", "index", F.round("value", 6).alias("value"))
    return rounded.groupBy("label", "index", "value").agg(F.count("*").alias("entries"))


@registered("write_libsvm", _stored_vectors("w.index + 1"))
def write_libsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written lines, taken apart as text: places count from 1."""
    path = files.write_libsvm(bundle_features(spark, sf_dir), scratch_dir(spark, "libsvm"))
    parts = spark.read.text(path).select(F.split(F.trim("value"), " ").alias("p"))
    flat = parts.select(F.get("p", F.lit(0)).cast("double").alias("label"), F.explode(F.slice("p", F.lit(2), F.size("p"))).alias("e"))
    place, value = (F.get(F.split("e", ":"), F.lit(k)) for k in (0, 1))
    return _entries(flat.select("label", place.cast("int").alias("index"), value.cast("double").alias("value")))


@registered("read_libsvm", _stored_vectors("w.index", "w.weight <> 0"))
def read_libsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader keeps no zeros."""
    path = files.write_libsvm(bundle_features(spark, sf_dir), scratch_dir(spark, "libsvm"))
    return _entries(features.unfold(files.read_libsvm(spark, path, features.BUCKETS), "features", "label"))


@registered(
    "materialize_once", S.query([S.TRAIN, S.SEARCH, S.SEARCH_BAG], "select id, term, tf from search_bag")
)
def materialize_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second call finds the set in place and leaves it as it is."""
    root = scratch_dir(spark, "features")
    bag = bags.count_terms(inputs.search(spark, sf_dir), "id")
    files.materialize_once(bag, root, "search-terms")
    return files.materialize_once(bag.where(F.lit(False)), root, "search-terms")


@registered(
    "materialize_by_content", S.query([S.TRAIN, S.SEARCH, S.SEARCH_BAG], "select id, term, tf from search_bag")
)
def materialize_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set is stored under the content of the table it is made of; the
    second call, with the same table, finds it and computes nothing."""
    root = scratch_dir(spark, "features")
    search = inputs.search(spark, sf_dir)
    bag = bags.count_terms(search, "id")
    files.stored_by_content(bag, root, "search-terms", [search])
    return files.stored_by_content(bag.where(F.lit(False)), root, "search-terms", [search])


# ---- projection, filter, limit ---------------------------------------------


@registered("project", S.query([S.TRAIN], "select id, product_uid, search_term from train"))
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.train(spark, sf_dir).select("id", "product_uid", "search_term")


@registered(
    "rename_one", S.query([S.TRAIN], "select id, product_uid, title, search_term, relevance as label from train")
)
def rename_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.train(spark, sf_dir).withColumnRenamed("relevance", "label")


@registered(
    "filter_not_null",
    S.query([S.ATTRIBUTES], "select product_uid, name, value from attributes where product_uid is not null"),
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.attributes(spark, sf_dir).where(F.col("product_uid").isNotNull())


@registered("concat_text", S.query([S.TRAIN], "select id, title || ' ' || search_term as text from train"))
def concat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.train(spark, sf_dir).select("id", F.concat_ws(" ", "title", "search_term").alias("text"))


@registered(
    "cast_label",
    S.query([S.TRAIN], "select id, cast(cast(relevance as varchar) as double) as label from train"),
)
def cast_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_text = tables.train(spark, sf_dir).select("id", F.col("relevance").cast("string").alias("relevance"))
    return as_text.select("id", F.col("relevance").cast("double").alias("label"))


@registered(
    "limit_rows",
    S.query(
        S.FULL_BUNDLE,
        """
select id, term, tf from bundle where term is not null
order by ('0x' || substr(md5(id || ':' || term), 1, 8))::bigint, id, term limit 50000""",
    ),
)
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bag = written(inputs.bundle_bag(spark, sf_dir), "bundle-bag")
    return rows.limit_rows(bag, 50_000, "id", "term")


# ---- text functions --------------------------------------------------------


@registered("regex_tokenize", f"select doc_id, {S.joined(S.tokens('text'))} as tokens from documents")
def regex_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.product_descriptions(spark, sf_dir)
    tokens = texts.select(F.col("product_uid").alias("doc_id"), text.regex_tokenize(F.col("description")).alias("tokens"))
    return tokens.select("doc_id", _words("tokens"))


@registered("clean_special", f"select doc_id, {S.clean('text')} as text from documents")
def clean_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.product_descriptions(spark, sf_dir)
    return texts.select(F.col("product_uid").alias("doc_id"), text.clean_special(F.col("description")).alias("text"))


@registered("remove_stopwords", f"select doc_id, {S.joined(S.keep(S.tokens('text')))} as tokens from documents")
def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tables.product_descriptions(spark, sf_dir)
    kept = text.remove_stopwords(text.regex_tokenize(F.col("description")), S.STOPWORDS)
    return texts.select(F.col("product_uid").alias("doc_id"), kept.alias("tokens")).select("doc_id", _words("tokens"))


@registered(
    "flatten_tokens",
    f"""
select lang, term, count(*) as tf
from (select lang, unnest({S.tokens("text")}) as term from documents) group by all""",
)
def flatten_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token lists of each language flattened into one bag."""
    texts = tables.table(spark, sf_dir, "documents").select("lang", "text")
    return bags.count_terms(texts, "lang", tokens=text.regex_tokenize(F.col("text")))


@registered(
    "flatten_tokens_ordered",
    f"""
with t as (
  select lang, doc_id, coalesce({S.tokens("text")}, []) as tokens from documents
), c as (
  select *, sha256(array_to_string(tokens, chr(1))) as tie,
    row_number() over (partition by lang, doc_id, sha256(array_to_string(tokens, chr(1)))) as copy
  from t
), k as (
  select lang, doc_id, tie, copy, unnest(tokens) as token, generate_subscripts(tokens, 1) as pos from c
)
select lang, cast(row_number() over (partition by lang order by doc_id, tie, copy, pos) - 1 as bigint) as place, token
from k""",
)
def flatten_tokens_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token lists of each language flattened into one list in doc_id
    order: (lang, place, token), places from 0."""
    texts = tables.table(spark, sf_dir, "documents").select("lang", "doc_id", "text")
    found = rows.flatten_in_order(texts, "lang", ["doc_id"], text.regex_tokenize(F.col("text")))
    return found.withColumnRenamed("item", "token")


# ---- composite text pipelines ----------------------------------------------


@registered(
    "description_tokens",
    S.query([S.DESCRIPTION], f"select product_uid, {S.joined('tokens')} as tokens from description_tokens"),
)
def description_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.descriptions(spark, sf_dir).select("product_uid", _words("tokens"))


@registered(
    "training_tokens",
    S.query(
        [S.TRAIN, S.TRAINING],
        f"select id, product_uid, {S.joined('tokens')} as tokens, relevance from training_tokens",
    ),
)
def training_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.training(spark, sf_dir).select("id", "product_uid", _words("tokens"), "relevance")


@registered(
    "search_tokens",
    S.query(
        [S.TRAIN, S.SEARCH],
        f"select id, product_uid, search_term, {S.joined('tokens')} as tokens from search_tokens",
    ),
)
def search_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.search(spark, sf_dir).select("id", "product_uid", "search_term", _words("tokens"))


@registered(
    "test_search_bundle",
    S.query(
        [S.TRAIN],
        f"""
select product_uid, term, count(*) as tf
from (select product_uid, unnest({S.keep(S.tokens(S.clean("search_term")))}) as term from train) group by all""",
    ),
)
def test_search_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.test_search_bundle(tables.test(spark, sf_dir), S.STOPWORDS)


@registered(
    "attribute_tokens",
    S.query([S.ATTRIBUTES, S.ATTRIBUTE_BAG], "select product_uid, term, tf from attribute_bag"),
)
def attribute_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.attribute_tokens(tables.attributes(spark, sf_dir), S.STOPWORDS)


@registered(
    "unite_texts",
    S.query(
        [S.TRAIN, S.ATTRIBUTES, S.TRAINING, S.ATTRIBUTE_BAG, S.BUNDLE.replace("shared s", "attribute_bag s")],
        "select id, product_uid, relevance, term, tf from bundle",
    ),
)
def unite_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = tables.train(spark, sf_dir)
    known = bags.only_products(tables.attributes(spark, sf_dir), bags.products_of(train))
    return bags.unite_texts(inputs.training(spark, sf_dir), bags.attribute_tokens(known, S.STOPWORDS), S.STOPWORDS)


@registered("product_bundle", S.query(S.FULL_BUNDLE, "select id, product_uid, relevance, term, tf from bundle"))
def product_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.bundle(spark, sf_dir)


# ---- aggregation -----------------------------------------------------------


@registered(
    "collect_text_by_key",
    S.query(
        [S.ATTRIBUTES],
        "select product_uid, name || ' ' || value as text, count(*) as copies from attributes group by all",
    ),
)
def collect_text_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.collect_text_by_key(tables.attributes(spark, sf_dir), "product_uid", F.concat_ws(" ", "name", "value"))


@registered(
    "collect_text_by_key_ordered",
    """
with a as (
  select p_partkey as product_uid, 0 as attr, 'brand ' || p_brand as text from part
  union all select p_partkey, 1, 'type ' || p_type from part
  union all select p_partkey, 2, 'size ' || cast(p_size as varchar) from part
), c as (
  select *, sha256(coalesce(text, '')) as tie, row_number() over (partition by product_uid, attr, text) as copy from a
)
select product_uid, cast(row_number() over (partition by product_uid order by attr, tie, copy) - 1 as bigint) as place, text
from c""",
)
def collect_text_by_key_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of a product as one list in attribute order (brand, type,
    size): (product_uid, place, text), places from 0."""
    attributes = tables.attributes(spark, sf_dir)
    attr = F.when(F.col("name") == "brand", 0).when(F.col("name") == "type", 1).otherwise(2)
    texts = attributes.select("product_uid", attr.alias("attr"), F.concat_ws(" ", "name", "value").alias("text"))
    found = rows.flatten_in_order(texts, "product_uid", ["attr"], F.array("text"))
    return found.withColumnRenamed("item", "text")


@registered(
    "count_rows",
    S.query(S.FULL_BUNDLE, "select count(*) as n_rows, count(distinct id) as n_ids from bundle"),
)
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the united table, and how many training rows they belong to."""
    per_id = inputs.bundle(spark, sf_dir).groupBy("id").agg(F.count("*").alias("n"))
    return per_id.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_ids"))


@registered(
    "mse",
    S.query(
        [S.TRAIN, S.TRAINING],
        "select round(avg((relevance - len(tokens) / 100.0) * (relevance - len(tokens) / 100.0)), 6) as mse "
        "from training_tokens",
    ),
)
def mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = inputs.training(spark, sf_dir).select(
        F.col("relevance").alias("label"), (F.size("tokens") / F.lit(100.0)).alias("prediction")
    )
    return models.mse(scored).select(F.round("mse", 6).alias("mse"))


@registered(
    "doc_freq",
    S.query([S.DESCRIPTION, S.DOC_BAG], "select term, count(*) as df from doc_bag group by term"),
)
def doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.doc_freq(inputs.descriptions(spark, sf_dir))


# ---- joins and sort --------------------------------------------------------


@registered(
    "left_join_uid",
    S.query(
        [S.TRAIN, S.ATTRIBUTES, S.ATTRIBUTE_BAG],
        """
select t.id, t.product_uid, a.terms, a.tokens
from train t left join (
  select product_uid, count(*) as terms, cast(sum(tf) as bigint) as tokens from attribute_bag group by product_uid) a
on a.product_uid = t.product_uid""",
    ),
)
def left_join_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their product's attribute totals: many to one, as the right side
    is grouped by product first."""
    bag = bags.attribute_tokens(tables.attributes(spark, sf_dir), S.STOPWORDS)
    totals = bag.groupBy("product_uid").agg(F.count("*").alias("terms"), F.sum("tf").alias("tokens"))
    totals = lookup(totals, "attribute-totals")
    # Written, so that this join too can split a hot product.
    named = written(tables.train(spark, sf_dir).select("id", "product_uid"), "rows")
    return named.join(totals, "product_uid", "left")


@registered(
    "inner_join_id",
    S.query(
        [S.TRAIN, S.TRAINING, S.SEARCH],
        f"""
select t.id, t.product_uid, t.relevance, {S.joined("t.tokens")} as tokens, {S.joined("s.tokens")} as search_tokens
from training_tokens t join search_tokens s on s.id = t.id""",
    ),
)
def inner_join_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = inputs.search(spark, sf_dir).select("id", F.col("tokens").alias("search_tokens"))
    joined = inputs.training(spark, sf_dir).join(asked, "id")
    return joined.select("id", "product_uid", "relevance", _words("tokens"), _words("search_tokens"))


@registered(
    "sort_by_key",
    S.query([S.TRAIN], "select id, cast(product_uid as varchar) as product_uid, title from train order by 2, 1"),
)
def sort_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the product's number as text, then by id."""
    named = tables.train(spark, sf_dir).select("id", F.col("product_uid").cast("string"), "title")
    return rows.sort_by_key(named, F.col("product_uid"), F.col("id"))


@registered(
    "row_id",
    S.query(
        [S.TRAIN],
        """
select id, cast(product_uid as varchar) as product_uid,
  row_number() over (order by cast(product_uid as varchar), id) as row_id from train""",
    ),
)
def row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = tables.train(spark, sf_dir).select("id", F.col("product_uid").cast("string"))
    return rows.row_id(named, "product_uid", "id")


@registered(
    "train_test_split",
    S.query(
        [S.TRAIN],
        """
select id, case when ('0x' || substr(md5(cast(id as varchar)), 1, 8))::bigint / 4294967296.0 < 0.7
  then 'train' else 'test' end as part from train""",
    ),
)
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.train_test_split(tables.train(spark, sf_dir).select("id"), "id")
