"""Ordered flattening by prefix sums over ranges, against brute force."""

import hashlib

from pyspark.sql import functions as F

from shelfscore.operators import rows


def brute(data):
    out, places = [], {}
    for key, order, items in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1], hashlib.sha256("\x01".join(r[2] or []).encode()).hexdigest())):
        for item in items or []:
            place = places.get(key, 0)
            out.append((key, place, item))
            places[key] = place + 1
    return sorted(out, key=repr)


def test_hot_key_is_ordered_over_many_ranges(spark):
    data = [("hot" if k % 3 == 0 else f"k{k % 7}", k // 2, [f"w{k}", f"v{k % 5}"] if k % 11 else []) for k in range(3_000)]
    data += [(None, 5, ["n1", "n2"]), ("hot", 4, None), ("hot", 4, ["same"]), ("hot", 4, ["same"])]
    df = spark.createDataFrame(data, "key string, o long, items array<string>").repartition(16)
    # Adaptive execution joins small ranges by size; at scale ranges are
    # sized by bytes, here they are held apart to show the spread.
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows.flatten_in_order(df, "key", ["o"], F.col("items"))
        got = sorted((tuple(r) for r in found.collect()), key=repr)
        ranges = written_ranges(spark, df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(data)
    assert ranges > 3


def written_ranges(spark, df):
    """How many ranges hold rows of the hot key."""
    ranged = df.repartitionByRange("key", "o").withColumn("r", F.spark_partition_id())
    return ranged.where("key = 'hot'").select("r").distinct().count()


def test_empty_table(spark):
    df = spark.createDataFrame([], "key string, o long, items array<string>")
    assert rows.flatten_in_order(df, "key", ["o"], F.col("items")).count() == 0
