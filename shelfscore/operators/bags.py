"""Token bags in long form: one row per key and term with its count.

A product's texts are never gathered into one row. Counting terms combines on
the map side, and the rows of a product that owns a large share of the data
spread over the cluster by (key, term)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.functions.arrays import explode_rows
from shelfscore.functions.text import is_stopword, prose_tokens, regex_tokenize, title_tokens
from shelfscore.operators.rows import TEXTS_PER_TASK, dealt, joined_rows
from shelfscore.sources.scratch import lookup, written

# Stop words are constants, which become part of expressions, or a table with a
# column `word` of any length, which is taken off by an anti join.
Words = Iterable[str] | DataFrame


def _constants(words: Words) -> Iterable[str]:
    return [] if isinstance(words, DataFrame) else words


def description_tokens(descriptions: DataFrame, words: Iterable[str]) -> DataFrame:
    return descriptions.select("product_uid", prose_tokens(F.col("description"), words).alias("tokens"))


def training_tokens(train: DataFrame, words: Words) -> DataFrame:
    text = F.concat_ws(" ", "title", "search_term")
    rows = train.select("id", "product_uid", title_tokens(text, _constants(words)).alias("tokens"), "relevance")
    return _strike(rows, words) if isinstance(words, DataFrame) else rows


def _strike(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Drop listed words from the token lists of rows with an id; the others
    keep their order. A row's list comes from one text and is bounded by it."""
    rows = written(rows, "rows")
    flat = rows.select("id", F.posexplode("tokens").alias("place", "term"))
    kept = without_stopwords(flat, words).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "term"))).alias("t"))
    tokens = F.coalesce("t.term", F.array().cast("array<string>"))
    return rows.join(kept, "id", "left").withColumn("tokens", tokens).select(*rows.columns)


def search_tokens(train: DataFrame) -> DataFrame:
    """Search terms keep their stop words."""
    tokens = regex_tokenize(F.col("search_term")).alias("tokens")
    return train.select("id", "product_uid", "search_term", tokens)


def count_terms(df: DataFrame, *keys: str, tokens: str | Column = "tokens") -> DataFrame:
    """Flatten token lists into (keys, term, tf)."""
    flat = explode_rows(df, tokens, "term", *keys)
    return flat.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def add_bags(*bags: DataFrame) -> DataFrame:
    """Sum several bags with the same keys."""
    keys = [c for c in bags[0].columns if c != "tf"]
    both = reduce(DataFrame.unionByName, bags)
    return both.groupBy(*keys).agg(F.sum("tf").alias("tf"))


def without_stopwords(bag: DataFrame, words: DataFrame) -> DataFrame:
    """Drop terms that are in a word table; the way for lists too long to be
    part of an expression."""
    listed = lookup(words.select(F.lower("word").alias("term")).distinct(), "stopwords")
    return bag.join(listed, "term", "left_anti")


def collect_text_by_key(df: DataFrame, key: str, text: Column) -> DataFrame:
    """All texts of a key as a multiset (key, text, copies); the order within a
    group carries no meaning."""
    return df.select(key, text.alias("text")).groupBy(key, "text").agg(F.count("*").alias("copies"))


def attribute_texts(attributes: DataFrame, words: Iterable[str]) -> DataFrame:
    """(product_uid, tokens) of every attribute row's name and value; rows
    without a product are dropped."""
    known = attributes.where(F.col("product_uid").isNotNull())
    return known.select("product_uid", prose_tokens(F.concat_ws(" ", "name", "value"), words).alias("tokens"))


def _unlisted(bag: DataFrame, words: Words) -> DataFrame:
    return without_stopwords(bag, words) if isinstance(words, DataFrame) else bag


def attribute_tokens(attributes: DataFrame, words: Words) -> DataFrame:
    """All attribute rows of a product folded into one bag."""
    return _unlisted(count_terms(attribute_texts(attributes, _constants(words)), "product_uid"), words)


def test_search_bundle(test: DataFrame, words: Words) -> DataFrame:
    """The search terms of a product folded into one bag."""
    bag = count_terms(test, "product_uid", tokens=prose_tokens(F.col("search_term"), _constants(words)))
    return _unlisted(bag, words)


def unite_texts(left: DataFrame, shared: DataFrame, words: Words | None = None) -> DataFrame:
    """Left outer join of training rows with the bag of their product.

    left is (id, product_uid, tokens, relevance) with one row per id, shared
    (product_uid, term, tf). The result is (id, product_uid, relevance, term,
    tf). A row whose product has no shared text stays, with a null term counted
    0 times. Listed words are taken off the shared bag.

    A hot product spreads: the rows are written, so that both sides of the join
    come straight from a shuffle, and the sum is by id and term, for which the
    joined rows are dealt out anew. Each joined term is nearly always the only
    one of its row, so they are dealt out before they are summed, over so many
    tasks that each sums about ROWS_PER_TASK."""
    row = ["id", "product_uid", "relevance"]
    if words is not None:
        listed = F.lit(False) if isinstance(words, DataFrame) else is_stopword(F.col("term"), words)
        shared = _unlisted(shared.where(~listed), words)
    left = written(left.select(*row, "tokens"), "rows")
    shared = written(shared, "product-bag")
    inherited = left.select(*row).join(shared, "product_uid", "left")
    inherited = inherited.select(*row, "term", F.coalesce("tf", F.lit(0)).cast("long").alias("tf"))
    own = explode_rows(left, "tokens", "term", *row).withColumn("tf", F.lit(1).cast("long"))
    both = dealt(own.unionByName(inherited), joined_rows(left, shared, "product_uid"), "id", "term").groupBy("id", "term")
    sums = both.agg(*[F.first(c).alias(c) for c in row[1:]], F.sum("tf").alias("tf"))
    return sums.select(*row, "term", "tf")


def products_of(rows: DataFrame) -> DataFrame:
    return lookup(rows.select("product_uid").distinct(), "products")


def only_products(texts: DataFrame, products: DataFrame) -> DataFrame:
    """Drop texts of products that no row refers to before tokenising them."""
    return texts.join(products, "product_uid", "left_semi")


def product_texts(rows: DataFrame, attributes: DataFrame, descriptions: DataFrame, words: Iterable[str]) -> DataFrame:
    """(product_uid, tokens) of all texts of the products that have rows."""
    products = products_of(rows)
    values = attribute_texts(only_products(attributes, products), words)
    kept = only_products(descriptions, products)
    # The texts of a few products may lie in one file; many terms follow from each.
    kept = dealt(kept, kept.count(), *kept.columns, most=TEXTS_PER_TASK)
    return values.unionByName(description_tokens(kept, words))


def shared_bag(rows: DataFrame, attributes: DataFrame, descriptions: DataFrame, words: Words) -> DataFrame:
    """Attribute and description terms per product, counted in one pass."""
    texts = product_texts(rows, attributes, descriptions, _constants(words))
    return _unlisted(count_terms(texts, "product_uid"), words)


def product_bundle(train: DataFrame, attributes: DataFrame, descriptions: DataFrame, words: Words) -> DataFrame:
    """Training text with its product's attributes and description. The two
    product bags are summed first, so the rows are joined only once."""
    shared = shared_bag(train, attributes, descriptions, words)
    return unite_texts(training_tokens(train, words), shared)
