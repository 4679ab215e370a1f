"""Term and hashed features of token bags, in long form and as ml vectors."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.functions.arrays import explode_rows
from shelfscore.functions.vectors import as_vectors, sparse_struct, vector_entries
from shelfscore.operators.rows import dealt, joined_rows
from shelfscore.sources.scratch import lookup, written

# Fixed value: number of hash buckets of every hashed feature vector.
BUCKETS = 20_000


def doc_freq(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Number of rows whose token list holds each term."""
    terms = explode_rows(df, F.array_distinct(tokens), "term")
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def bag_doc_freq(bag: DataFrame, term: str = "term") -> DataFrame:
    """The same from a bag, which has one row per document and term."""
    return bag.groupBy(term).agg(F.count("*").alias("df"))


def smoothed_idf(n_rows: Column, df: Column) -> Column:
    return F.log((n_rows + 1) / (df + 1))


def term_idf(bag: DataFrame, n_rows: Column, term: str = "term") -> DataFrame:
    """(term, df, idf) of a bag."""
    return bag_doc_freq(bag, term).withColumn("idf", smoothed_idf(n_rows, F.col("df")))


def tfidf_terms(bag: DataFrame, n_rows: Column) -> DataFrame:
    """Adds df, idf and weight = tf * ln((N + 1) / (df + 1)) to a bag."""
    idf = lookup(term_idf(bag, n_rows), "term-idf")
    return bag.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery, part of the same plan."""
    return df.agg(F.count("*").alias("n")).scalar()


def l2_normalize(weights: DataFrame, key: str, weight: str = "weight") -> DataFrame:
    """Divide each row's weights by their Euclidean norm; zero rows stay zero."""
    norms = weights.groupBy(key).agg(F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias("norm"))
    scaled = F.when(F.col("norm") > 0, F.col(weight) / F.col("norm")).otherwise(F.lit(0.0))
    return weights.join(norms, key).withColumn("unit", scaled).drop("norm")


def hashing_tf(tokens: str = "tokens", output: str = "tf_vector") -> HashingTF:
    return HashingTF(numFeatures=BUCKETS, inputCol=tokens, outputCol=output)


def tf_hashed(df: DataFrame, tokens: str = "tokens", output: str = "tf_vector") -> DataFrame:
    """Counts per hash bucket as a sparse vector."""
    return hashing_tf(tokens, output).transform(df)


def tfidf_hashed(df: DataFrame, tokens: str = "tokens", output: str = "features") -> DataFrame:
    """Hashed TF-IDF of one token list per row. Fitting brings one document
    frequency per bucket to the driver, 20,000 numbers at any data size."""
    stages = [hashing_tf(tokens, "tf_vector"), IDF(inputCol="tf_vector", outputCol=output)]
    return Pipeline(stages=stages).fit(df).transform(df).drop("tf_vector")


def unfold(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Long form (keys, index, value) of a sparse vector column."""
    entry = explode_rows(df, vector_entries(F.col(vector)), "e", *keys)
    return entry.select(*keys, F.col("e.indices").alias("index"), F.col("e.values").alias("value"))


def hashed_bag(df: DataFrame, *keys: str, tokens: str = "tokens") -> DataFrame:
    """(keys, index, value) with the bucket counts summed over a key's rows.
    Each row is counted where it lies; at most 20,000 buckets follow per key."""
    entries = unfold(tf_hashed(df.select(*keys, tokens), tokens), "tf_vector", *keys)
    return entries.groupBy(*keys, "index").agg(F.sum("value").alias("value"))


def fold(entries: DataFrame, key: str, size: int, output: str = "features") -> DataFrame:
    """Long form back to one sparse vector per key. A key has at most `size`
    entries, so the gathered group is bounded."""
    lists = entries.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("index", "value"))).alias("e"))
    folded = lists.select(key, sparse_struct(size, F.col("e.index"), F.col("e.value")).alias(output))
    return as_vectors(folded, output, "vectors")


def hashed_bundle(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Bucket counts (id, index, value) of each row's own tokens and those of
    its product. rows is (id, product_uid, tokens), shared is the product's
    (product_uid, index, value). The rows are written, so that the join can
    split a hot product, and summed by id and bucket after it, dealt out first
    over so many tasks that each sums about ROWS_PER_TASK."""
    rows = written(rows.select("id", "product_uid", "tokens"), "rows")
    shared = written(shared, "product-counts")
    own = unfold(tf_hashed(rows.select("id", "tokens")), "tf_vector", "id")
    inherited = rows.select("id", "product_uid").join(shared, "product_uid").select("id", "index", "value")
    both = dealt(own.unionByName(inherited), joined_rows(rows, shared, "product_uid"), "id", "index")
    return both.groupBy("id", "index").agg(F.sum("value").alias("value"))


def attach_vector(rows: DataFrame, vectors: DataFrame, output: str, size: int = BUCKETS) -> DataFrame:
    """Left join of vectors by id; a row without entries gets the zero vector."""
    empty = sparse_struct(size, F.array().cast("array<int>"), F.array().cast("array<double>"))
    joined = rows.join(vectors, "id", "left")
    stored = F.coalesce(F.unwrap_udt(output), empty)
    return as_vectors(joined.withColumn(output, stored), output, "attached")


def idf_weights(counts: DataFrame, n_rows: Column) -> DataFrame:
    """IDF over the long hashed form: (id, index, value) with tf-idf values.
    There is one idf per bucket, 20,000 at most, so they are broadcast."""
    idf = F.broadcast(term_idf(counts, n_rows, "index").select("index", "idf"))
    return counts.join(idf, "index").select("id", "index", (F.col("value") * F.col("idf")).alias("value"))
