"""Exact distinct counts that merge: bitmaps over dense numbers.

Every key gets a number, and a set of keys is a bitmap in pieces of 32,768 bits, one row each.
Sets over days and categories are joined by OR, so a distinct count at any coarser grouping comes from
the stored pieces, never from the rows; what is shuffled is a piece per group and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.operators.rows import number_rows
from salescompass.operators.skew import dimension_join


def numbered_keys(keys: DataFrame, key: str) -> DataFrame:
    """``key, number`` (from 0) of the distinct keys that are not null."""
    return number_rows(keys.select(key).filter(F.col(key).isNotNull()).distinct(), key, name="number").select(key, "number")


def bitmap_sets(rows: DataFrame, numbers: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``*by, piece, bits``: which keys each group has.  Rows without a key add nothing.

    Rows are reduced to the distinct keys of each group next to the scan, so a frequent key is one
    row per task; keys that have no number are left out.
    """
    present = rows.filter(F.col(key).isNotNull()).select(*by, key).distinct()
    placed = dimension_join(present, numbers, key)
    return placed.groupBy(*by, F.bitmap_bucket_number("number").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def distinct_count(sets: DataFrame, by: list[str], name: str = "distinct_keys") -> DataFrame:
    """Exact distinct keys at a grouping that the sets are at least as fine as; without ``by`` one row."""
    merged = sets.groupBy(*by, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))
