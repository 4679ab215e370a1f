"""Connected components of a link table, by alternating star contractions.

Each round hangs the neighbours of every node on the smallest node around it,
larger neighbours first, smaller ones next. The links shrink to stars whose
centres are the smallest nodes. Every round is a grouping with map-side
combination and a join whose hot keys can be split; each result is written, so
the plan does not grow and a lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.storage import written


def _around(pairs: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours in (u, v)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return written(least.select("u", F.least("u", "least").alias("least")), "stars")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("b").alias("u"), F.col("a").alias("v")).unionAll(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    hung = both.join(_around(both), "u").where(F.col("v") > F.col("u"))
    return hung.select(F.col("least").alias("a"), F.col("v").alias("b")).where("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = _around(down)
    moved = down.join(least, "u").select(F.col("least").alias("a"), F.col("v").alias("b"))
    return moved.unionAll(least.select(F.col("least").alias("a"), F.col("u").alias("b"))).where("a < b").distinct()


def _is_forest(links: DataFrame) -> bool:
    """Whether every node hangs on one centre, or is one."""
    ends = links.select(F.col("b").alias("n"), F.lit(1).alias("hung"), F.lit(0).alias("centre")).unionAll(
        links.select(F.col("a").alias("n"), F.lit(0).alias("hung"), F.lit(1).alias("centre"))
    )
    roles = ends.groupBy("n").agg(F.sum("hung").alias("hung"), F.max("centre").alias("centre"))
    return roles.where(F.col("hung") + F.col("centre") > 1).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link in (a, b); a component
    is named by its smallest node. Null ends and loops are ignored."""
    known = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    stars = written(known.where(F.col("a") < F.col("b")).distinct(), "links")
    while not _is_forest(stars):
        stars = written(_small_star(written(_large_star(stars), "links")), "links")
    centres = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return centres.unionAll(stars.select(F.col("b").alias("node"), F.col("a").alias("component")))
