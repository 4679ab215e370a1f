"""Array columns to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: str | Column, output: str, *keys: str) -> DataFrame:
    """One row per array element; empty arrays give none.

    The plain explode makes the optimizer filter on the array's size first, and
    with a computed array that filter runs the tokeniser once more, ahead of
    everything that would have pruned rows. The outer form has no such filter."""
    rows = df.select(*keys, F.explode_outer(array).alias(output))
    return rows.where(F.col(output).isNotNull())
