"""Keeping rows without a key out of one another's way.

An outer join sends every null key to the same task. Such rows match nothing, so they can go anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_KEY = "\u0000"


def scattered(key: Column, *row: Column | str) -> Column:
    """``key``, or for a null key a text that equals no real key and differs from row to row."""
    return F.coalesce(key, F.concat(F.lit(_NO_KEY), F.xxhash64(*row).cast("string")))


def scatter_slot(has_key: Column, *row: Column | str) -> Column:
    """An extra join column for composite keys: 0 for rows with a key, spread out for the rest."""
    return F.when(has_key, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*row))
