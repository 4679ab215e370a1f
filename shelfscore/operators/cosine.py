"""Cosine between searches and products, and between feature columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from shelfscore.functions.arrays import explode_rows
from shelfscore.functions.sampling import unit_hash
from shelfscore.operators.features import l2_normalize, row_count, smoothed_idf
from shelfscore.operators.rows import dealt
from shelfscore.sources.scratch import lookup, written

# Fixed value: similarity from which the sampled column cosine is to be exact
# to within its error bound.
SAMPLING_THRESHOLD = 0.1


# ---- searches against products ---------------------------------------------


def _term_counts(training: DataFrame, search: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, product_uid, term, own, asked, inherited): what a row says itself,
    what its search asks, and what its product adds to these terms."""
    keys = ["id", "product_uid", "term"]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    own = training.select("id", "product_uid", "tokens", one.alias("own"), none.alias("asked"))
    asked = search.select("id", "product_uid", "tokens", none.alias("own"), one.alias("asked"))
    texts = written(own.unionByName(asked), "row-texts")
    n = texts.agg(F.sum(F.size(F.coalesce("tokens", F.array())))).first()[0] or 0
    # A row's terms are nearly all different, so they are dealt out before they are counted.
    terms = dealt(explode_rows(texts, "tokens", "term", "id", "product_uid", "own", "asked"), n, "id", "term")
    counts = terms.groupBy(*keys).agg(F.sum("own").alias("own"), F.sum("asked").alias("asked"))
    inherited = shared.select("product_uid", "term", F.col("tf").alias("inherited"))
    # A bag is far larger in memory than its file, so it is never broadcast by the file's size.
    return counts.join(inherited.hint("merge"), ["product_uid", "term"], "left").fillna(0, ["inherited"])


def _term_idf(counts: DataFrame, shared: DataFrame, training: DataFrame) -> DataFrame:
    """(term, product_idf, search_idf). A product's term counts once for each of
    the product's rows, a row's own term where the product lacks it."""
    sizes = lookup(training.groupBy("product_uid").agg(F.count("*").alias("rows")), "product-rows")
    zero = F.lit(0).cast("long")
    from_products = shared.join(sizes, "product_uid").select("term", F.col("rows").alias("p"), zero.alias("s"))
    from_rows = counts.select(
        "term",
        F.when((F.col("own") > 0) & (F.col("inherited") == 0), 1).otherwise(0).cast("long").alias("p"),
        F.when(F.col("asked") > 0, 1).otherwise(0).cast("long").alias("s"),
    )
    freq = from_products.unionByName(from_rows).groupBy("term").agg(F.sum("p").alias("p"), F.sum("s").alias("s"))
    n = row_count(training)
    return freq.select(
        "term", smoothed_idf(n, F.col("p")).alias("product_idf"), smoothed_idf(n, F.col("s")).alias("search_idf")
    )


def query_product_cosine(training: DataFrame, search: DataFrame, shared: DataFrame, on: str = "id") -> DataFrame:
    """Cosine of the TF-IDF weights of search and product text per training row.

    training and search hold (id, product_uid, tokens), training also relevance;
    shared is the product's bag. With on="id" a row meets its own search, with
    on="product_uid" all searches of its product, of which it gets the number
    and the mean cosine.

    The text that the rows of a product share is never copied to each row: its
    part of a norm or product is summed once per product, and a row adds what
    its own terms change. Nor are the row pairs of a product listed: the mean
    over its searches is the cosine with their mean direction."""
    if on not in ("id", "product_uid"):
        raise ValueError("on must be id or product_uid")
    shared = written(shared, "product-bag")
    counts = written(_term_counts(training, search, shared), "term-counts")
    idf = lookup(_term_idf(counts, shared, training), "term-idf")
    weighed = counts.join(idf, "term")
    whole = (F.col("own") + F.col("inherited")) * F.col("product_idf")
    base = F.col("inherited") * F.col("product_idf")
    asked = F.col("asked") * F.col("search_idf")
    base_norms = shared.join(idf, "term").groupBy("product_uid")
    base_norms = lookup(base_norms.agg(F.sum((F.col("tf") * F.col("product_idf")) ** 2).alias("base_norm")), "base-norms")
    rows = training.select("id", "product_uid", "relevance")
    norm = F.sqrt(F.coalesce("base_norm", F.lit(0.0)) + F.coalesce("added_norm", F.lit(0.0)))
    added_norm = F.sum(whole * whole - base * base).alias("added_norm")
    if on == "id":
        sums = weighed.groupBy("id").agg(
            added_norm, F.sum(whole * asked).alias("dot"), F.sqrt(F.sum(asked * asked)).alias("asked_norm")
        )
        scale = norm * F.col("asked_norm")
        cosine = F.when(scale > 0, F.col("dot") / scale).otherwise(F.lit(0.0)).alias("cosine")
        joined = rows.join(sums, "id", "left").join(base_norms, "product_uid", "left")
        return joined.select("id", "product_uid", "relevance", cosine)

    units = l2_normalize(weighed.where(F.col("asked") > 0).select("id", "product_uid", "term", asked.alias("weight")), "id")
    centre = lookup(units.groupBy("product_uid", "term").agg(F.sum("unit").alias("unit")), "search-centres")
    by_term = ["product_uid", "term"]
    base_dots = shared.join(centre, by_term).join(idf, "term").groupBy("product_uid")
    base_dots = lookup(base_dots.agg(F.sum(F.col("tf") * F.col("product_idf") * F.col("unit")).alias("base_dot")), "base-dots")
    added_dot = F.sum((whole - base) * F.coalesce("unit", F.lit(0.0))).alias("added_dot")
    sums = weighed.join(centre, by_term, "left").groupBy("id").agg(added_norm, added_dot)
    # What a product adds is one row per product and joined once.
    products = search.groupBy("product_uid").agg(F.count("*").alias("partners"))
    products = products.join(base_norms, "product_uid", "left").join(base_dots, "product_uid", "left")
    joined = rows.join(sums, "id", "left").join(lookup(products, "product-sums"), "product_uid")
    dot = F.coalesce("base_dot", F.lit(0.0)) + F.coalesce("added_dot", F.lit(0.0))
    mean = F.when(norm > 0, dot / norm / F.col("partners")).otherwise(F.lit(0.0)).alias("mean_cosine")
    return joined.select("id", "product_uid", "relevance", "partners", mean)


# Rows of a product in one block of the pair tiles.
PAIR_BLOCK = 256


def row_pair_cosines(training: DataFrame, search: DataFrame, shared: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """(id, search_id, product_uid, cosine) for every pair of a training row
    and a search of the same product, the row with itself included: the
    pairs that joining the rows on product_uid gives.

    A row's weights are its product's shared weights plus its own terms, so
    the dot with a search's unit vector is the product's part (once per
    search) plus the row's own terms (a short map). The rows of a product are
    numbered without gathering them and cut into blocks of `block`; each pair
    of blocks is one join key, so a product of m rows makes (m / block)^2 keys
    of at most block^2 pairs and no task holds all m^2."""
    from shelfscore.operators import rows as ordering

    shared = written(shared, "product-bag")
    counts = written(_term_counts(training, search, shared), "term-counts")
    idf = lookup(_term_idf(counts, shared, training), "term-idf")
    weighed = counts.join(idf, "term")
    whole = (F.col("own") + F.col("inherited")) * F.col("product_idf")
    base = F.col("inherited") * F.col("product_idf")
    base_norms = shared.join(idf, "term").groupBy("product_uid")
    base_norms = lookup(base_norms.agg(F.sum((F.col("tf") * F.col("product_idf")) ** 2).alias("base_norm")), "base-norms")
    own = F.col("own") * F.col("product_idf")
    sides = weighed.groupBy("id").agg(
        F.sum(whole * whole - base * base).alias("added_norm"),
        F.map_from_entries(F.collect_list(F.when(F.col("own") > 0, F.struct("term", own)))).alias("added"),
    )
    asked = F.col("asked") * F.col("search_idf")
    units = l2_normalize(weighed.where(F.col("asked") > 0).select("id", "product_uid", "term", asked.alias("weight")), "id")
    base_dots = units.join(shared.select("product_uid", "term", "tf"), ["product_uid", "term"]).join(idf, "term")
    base_dots = base_dots.groupBy("id").agg(F.sum(F.col("tf") * F.col("product_idf") * F.col("unit")).alias("base_dot"))
    unit_maps = units.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("term", "unit"))).alias("units"))

    keys = training.select("product_uid", "id")
    placed = ordering.flatten_in_order(keys, "product_uid", ["id"], F.array(F.col("id").cast("string")))
    placed = written(placed.select("product_uid", F.floor(F.col("place") / block).alias("blk"), F.col("item").alias("sid")), "pair-blocks")
    blocks = lookup(placed.groupBy("product_uid").agg(F.max("blk").alias("last")), "pair-block-counts")
    norm = F.sqrt(F.coalesce("base_norm", F.lit(0.0)) + F.coalesce("added_norm", F.lit(0.0)))
    left = placed.join(blocks, "product_uid").join(
        training.select(F.col("id").cast("string").alias("sid"), "id"), "sid"
    ).join(sides, "id", "left").join(base_norms, "product_uid", "left")
    left = left.select(
        "product_uid", F.col("blk").alias("bl"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("br"),
        "id", norm.alias("norm"), F.coalesce("added", F.create_map().cast("map<string,double>")).alias("added"),
    )
    right = placed.join(blocks, "product_uid").join(
        search.select(F.col("id").cast("string").alias("sid"), F.col("id").alias("search_id")), "sid"
    ).join(unit_maps.withColumnRenamed("id", "search_id"), "search_id", "left").join(
        base_dots.withColumnRenamed("id", "search_id"), "search_id", "left"
    )
    right = right.select(
        "product_uid", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("bl"), F.col("blk").alias("br"),
        "search_id", "units", F.coalesce("base_dot", F.lit(0.0)).alias("base_dot"),
    )
    tiles = left.join(right, ["product_uid", "bl", "br"])
    added_dot = F.aggregate(
        F.map_entries("added"), F.lit(0.0), lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at("units", e["key"]), F.lit(0.0))
    )
    has = (F.col("norm") > 0) & F.col("units").isNotNull()
    cosine = F.when(has, (F.col("base_dot") + added_dot) / F.col("norm")).otherwise(F.lit(0.0))
    return tiles.select("id", "search_id", "product_uid", cosine.alias("cosine"))


# ---- feature columns against each other ------------------------------------


def assemble(left: DataFrame, right: DataFrame, left_size: int) -> DataFrame:
    """Long form of two vectors side by side: right indices move up."""
    return left.unionByName(right.withColumn("index", F.col("index") + left_size))


def _unit_columns(entries: DataFrame) -> DataFrame:
    """Entries with their column's norm and length-1 value. There are as many
    norms as columns, 40,000 for the hashed matrices."""
    norms = entries.groupBy("index").agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"), F.count("*").alias("rows")
    )
    norms = lookup(norms.where(F.col("norm") > 0), "column-norms")
    present = entries.join(norms, "index")
    return present.withColumn("unit", F.col("value") / F.col("norm"))


# Columns of one range. The sums of two ranges are a table of at most so many
# squared, 38 MB, whatever the number of rows.
_RANGE = 2_048
# Tasks over which a matrix of few columns is spread at most.
_SPREAD = 200
# Entries of a matrix whose lists are sent to all pairs of ranges in one pass,
# and the pairs of ranges that a pass has at least, each a task.
_PASS, _CELLS = 2_000_000, 12


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the products of each two columns over the rows of a task, per
    pair of ranges. Only the tables of sums are held, no rows."""
    tables: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
    for batch in batches:
        places = zip(batch.column("p").to_numpy(), batch.column("q").to_numpy())
        lists = [batch.column(c) for c in ("index_p", "columns_p", "unit_p", "index_q", "columns_q", "unit_q")]
        ends = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in lists]
        for at, (p, q) in enumerate(places):
            index_p, columns_p, unit_p, index_q, columns_q, unit_q = (values[o[at] : o[at + 1]] for o, values in ends)
            if (p, q) not in tables:
                both = np.zeros(_RANGE * _RANGE), np.zeros(_RANGE * _RANGE, bool)
                tables[p, q] = *both, np.zeros(_RANGE, np.int64), np.zeros(_RANGE, np.int64)
            sums, seen, many_p, many_q = tables[p, q]
            index_p, index_q = index_p - p * _RANGE, index_q - q * _RANGE
            many_p[index_p], many_q[index_q] = columns_p, columns_q
            codes, products = index_p[:, None] * _RANGE + index_q, unit_p[:, None] * unit_q
            if p == q:  # lists are in order, so only later positions follow
                later = np.triu_indices(len(index_p), 1)
                codes, products = codes[later], products[later]
            codes = codes.ravel()
            np.add.at(sums, codes, products.ravel())
            seen[codes] = True
    for (p, q), (sums, seen, many_p, many_q) in tables.items():
        (codes,) = np.nonzero(seen)
        for k in range(0, len(codes), 50_000):
            some = codes[k : k + 50_000]
            i, j = np.divmod(some, _RANGE)
            found = i + p * _RANGE, many_p[i], j + q * _RANGE, many_q[j], sums[some]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["i", "columns_i", "j", "columns_j", "sim"])


def _row_products(entries: DataFrame, share: Column, least: float | None = None) -> DataFrame:
    """Sum over rows of unit_i * unit_j / (share_i * share_j) for columns i < j.

    entries is (id, index, columns, unit, share), index from 0. Columns are cut
    into ranges; a row sends its entries in two ranges to the task that sums all
    products of these ranges. So what is shuffled is a row's entries once per
    range and not their products, which are summed where they are made. Where
    there are few ranges, a pair of ranges is dealt out by rows as well and its
    sums are added once more. A row has at most as many entries as there are
    columns, so its list is bounded.

    Many entries are summed in passes, each over a share of the pairs of ranges.
    A pass writes the sums of at least `least`, whereupon its shuffle files go,
    so disk holds the lists and one pass."""
    kind = entries.schema["index"].dataType
    held = entries.select(
        "id",
        F.floor(F.col("index") / _RANGE).cast("long").alias("range"),
        F.col("index").cast("long").alias("index"),
        F.col("columns").cast("long").alias("columns"),
        (F.col("unit") / share).alias("unit"),
    ).where(F.col("unit").isNotNull())
    last = entries.agg(F.max("index")).first()[0] or 0
    cells = (last // _RANGE + 1) * (last // _RANGE + 2) // 2
    slices = max(1, min(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), _SPREAD) // cells)
    lists = held.repartition("id").groupBy("id", "range")
    lists = lists.agg(F.sort_array(F.collect_list(F.struct("index", "columns", "unit"))).alias("e"))
    part = F.struct("range", *[F.col("e")[c].alias(c) for c in ("index", "columns", "unit")])
    parts = lists.select("id", part.alias("part")).groupBy("id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    passes = max(1, min(cells // _CELLS, ceil(entries.count() / _PASS)))
    if passes == 1:
        return _cell_sums(parts, cells, slices, kind)
    parts = written(parts, "row-lists")
    # Pairs of ranges are numbered by their later range, so that those among the
    # first, which may hold most of the entries, are dealt out as well.
    found = []
    for k in range(passes):
        sums = _cell_sums(parts, cells, slices, kind, lambda p, q, k=k: (q * (q + 1) / 2 + p) % passes == k)
        found.append(written(sums if least is None else sums.where(F.round("sim", 9) >= least), "column-sums"))
    return reduce(DataFrame.unionByName, found)


def _cell_sums(parts: DataFrame, cells: int, slices: int, kind: DataType, chosen: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """The sums of all pairs of ranges, or of those that are chosen."""

    def later(p: Column, at: Column) -> Column:
        others = F.slice("parts", at + 1, F.size("parts"))
        if chosen is not None:
            others = F.filter(others, lambda q: chosen(p["range"], q["range"]))
        return F.transform(others, lambda q: F.struct(p.alias("p"), q.alias("q")))

    opened = parts.select("id", F.explode(F.flatten(F.transform("parts", later))).alias("c")).select("id", "c.p", "c.q")
    flat = [F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "pq" for c in ("index", "columns", "unit")]
    cut = opened.select(
        F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice"), F.col("p.range").alias("p"), F.col("q.range").alias("q"), *flat
    )
    placed = cut.repartition(cells * slices, "p", "q", "slice").drop("slice")
    sums = placed.mapInArrow(_pair_sums, "i long, columns_i long, j long, columns_j long, sim double")
    if slices > 1:
        sums = sums.groupBy("i", "columns_i", "j", "columns_j").agg(F.sum("sim").alias("sim"))
    return sums.withColumns({"i": F.col("i").cast(kind), "j": F.col("j").cast(kind)})


def _merge_single_row_columns(columns: DataFrame) -> DataFrame:
    """Columns with their only entry in the same row point in one direction.
    They become one column under the lowest index, with their number."""
    lone = columns.where(F.col("rows") == 1).groupBy("id")
    lone = lone.agg(F.min("index").alias("index"), F.count("*").alias("columns"), F.max("norm").alias("norm"))
    rest = columns.where(F.col("rows") > 1).select("id", "index", F.lit(1).cast("long").alias("columns"), "norm", "unit")
    return rest.unionByName(lone.withColumn("unit", F.lit(1.0)).select(rest.columns))


def _within(merged: DataFrame) -> DataFrame:
    """Merged columns among each other: similarity 1, listed under i = j."""
    several = merged.where(F.col("columns") > 1)
    return several.select(
        F.col("index").alias("i"),
        F.col("columns").alias("columns_i"),
        F.col("index").alias("j"),
        F.col("columns").alias("columns_j"),
        F.lit(1.0).alias("sim"),
    )


def column_cosine_exact(entries: DataFrame, least: float = 0.0) -> DataFrame:
    """(i, columns_i, j, columns_j, sim) for all columns that share a row and
    are at least so similar, from a matrix in long form (id, index, value)."""
    merged = written(_merge_single_row_columns(_unit_columns(entries)), "unit-columns")
    return _row_products(merged, F.lit(1.0), least).unionByName(_within(merged)).where(F.round("sim", 9) >= least)


def column_cosine_dimsum(
    entries: DataFrame, n_columns: int, threshold: float = SAMPLING_THRESHOLD, least: float = 0.0
) -> DataFrame:
    """The same by the published DIMSUM sampling (Zadeh and Carlsson): an entry
    of column c is kept with probability min(1, sqrt(gamma) / |c|), gamma = 10
    ln(columns) / threshold, and kept products are scaled up. Heavy columns are
    thinned, so the number of products does not grow with the rows.

    Entries are drawn by key hash: a recomputed task keeps the same ones."""
    root = sqrt(10 * log(n_columns) / threshold)
    merged = written(_merge_single_row_columns(_unit_columns(entries)), "unit-columns")
    share = F.least(F.lit(1.0), F.lit(root) / F.col("norm"))
    drawn = merged.where(unit_hash(F.col("id"), F.col("index")) < share)
    return _row_products(drawn, share, least).unionByName(_within(merged)).where(F.round("sim", 9) >= least)
