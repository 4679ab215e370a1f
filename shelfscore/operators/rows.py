"""Sorting, row numbers, repeatable limits and splits."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscore.functions.sampling import RANGE, key_hash, unit_hash
from shelfscore.sources.scratch import written


# Rows, and whole texts, that one task takes into its aggregates, whatever the
# size of the tables.
ROWS_PER_TASK = 500_000
TEXTS_PER_TASK = 1_000


def dealt(df: DataFrame, n: int, *keys: str, most: int = ROWS_PER_TASK) -> DataFrame:
    """Deal n rows out by their keys, about `most` to a task. The number of
    tasks grows with the rows, so a task's share does not."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, ceil(n / most)), *keys)


def joined_rows(left: DataFrame, right: DataFrame, key: str) -> int:
    """Number of rows that an inner join on the key gives, from the sizes of
    its groups."""
    sizes = left.groupBy(key).agg(F.count("*").alias("l"))
    sizes = sizes.join(right.groupBy(key).agg(F.count("*").alias("r")), key)
    return sizes.agg(F.sum(F.col("l") * F.col("r"))).first()[0] or 0


def sort_by_key(df: DataFrame, *keys: Column) -> DataFrame:
    return df.orderBy(*keys)


def row_id(df: DataFrame, *keys: str, output: str = "row_id") -> DataFrame:
    """Dense 1-based row number in key order without one global window.

    Rows are range-partitioned by the keys and written once, as sampling again
    could draw other ranges. Each range then adds the sizes of the earlier ones;
    there are only as many sizes as shuffle partitions."""
    ranged = df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    stored = written(ranged, "row-id")
    sizes = stored.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*keys)
    numbered = stored.withColumn("_place", F.row_number().over(inside)).join(offsets, "_range")
    return numbered.withColumn(output, F.col("_place") + F.col("_offset")).drop("_range", "_place", "_offset")


def likely_rows(n: int) -> int:
    """So many rows are ordered for the n lowest, nearly always."""
    return n + 10 * int(n**0.5) + 100


def limit_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n rows with the lowest key hash: a sample that repeats.

    Sorting everything is not needed: the hash is even, so the rows count says
    below which hash about n + margin rows lie. Only those are ordered; should
    they be too few after all, the next larger share is taken."""
    hashed = df.withColumn("_hash", key_hash(*[F.col(k) for k in keys]))
    total = df.count()
    wanted = likely_rows(n)
    while wanted < total:
        low = hashed.where(F.col("_hash") < int(RANGE * wanted / total))
        if low.count() >= n:
            return low.orderBy("_hash", *keys).limit(n).drop("_hash")
        wanted *= 4
    return hashed.orderBy("_hash", *keys).limit(n).drop("_hash")


def train_test_split(df: DataFrame, *keys: str, share: float = 0.7) -> DataFrame:
    """Adds part = train or test by key hash, whatever the partitioning."""
    drawn = unit_hash(*[F.col(k) for k in keys])
    return df.withColumn("part", F.when(drawn < share, "train").otherwise("test"))


def flatten_in_order(df: DataFrame, key: str, order: list[str], items: Column) -> DataFrame:
    """(key, place, item): the item lists of each key's rows one after the
    other, rows in `order`, places from 0, without gathering a key's rows.

    Rows are range-partitioned by (key, order) and written once. Each range
    sums its rows' list sizes per key; a key's ranges add the sums of its
    earlier ranges (there are as many sums as ranges and keys in them), and a
    row adds the sizes of the earlier rows of its range. A key as large as a
    third of the table spreads over a third of the ranges. Rows equal in key
    and order are ordered by a digest of their items; equal rows give the same
    items whichever comes first. A null list counts as empty."""
    listed = F.coalesce(items, F.array().cast("array<string>"))
    rows = df.select(F.col(key).alias("_key"), *order, listed.alias("_items"))
    rows = rows.withColumns({"_n": F.size("_items"), "_tie": F.sha2(F.concat_ws("\u0001", "_items"), 256)})
    ranged = rows.repartitionByRange("_key", *order, "_tie").withColumn("_range", F.spark_partition_id())
    stored = written(ranged, "ordered-rows")
    sums = stored.groupBy("_range", "_key").agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_range").alias("_r"), F.col("_key").alias("_k"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_range", "_key").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    started = stored.withColumn("_start", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    # A null key is a key of its own.
    same = (F.col("_range") == F.col("_r")) & F.col("_key").eqNullSafe(F.col("_k"))
    started = started.join(offsets, same, "left")
    placed = started.select("_key", "_offset", "_start", F.posexplode("_items").alias("_pos", "item"))
    return placed.select(
        F.col("_key").alias(key), (F.col("_offset") + F.col("_start") + F.col("_pos")).cast("long").alias("place"), "item"
    )
