"""Repeatable sampling by key: a lost and recomputed task draws the same rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE = 2**32


def key_hash(*keys: Column) -> Column:
    """Whole number in [0, 2^32) from the first 32 bits of the key's md5."""
    text = F.concat_ws(":", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def unit_hash(*keys: Column) -> Column:
    """Number in [0, 1) that depends on the key alone."""
    return key_hash(*keys) / F.lit(float(RANGE))
