"""Sharding: a keyed permutation of global row numbers gives each row its shard and slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.permute import permuted, with_permuted
from salescompass.llm.storage import repeatable, unused
from salescompass.operators.rows import number_rows


def place(row: Column, rows: Column, shards: int, seed: int) -> tuple[Column, Column]:
    """Shard and slot of a global row number: computable for any row without the data.

    Consecutive places of the permutation go to the shards in turn, so the shards' row
    counts differ by one at most and the slots of a shard are 0, 1, 2, … without gaps.
    """
    at = permuted(row, rows, F.lit("shards"), F.lit(seed))
    return F.pmod(at, F.lit(shards)).cast("int"), F.floor(at / shards).cast("long")


def shard_rows(df: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Adds ``row`` (number in the order of ``keys``, then of the row's hash), ``shard`` and ``slot``.

    Reruns agree: the order depends on the rows alone (equal rows are interchangeable, and spread
    over tasks by their positions).  Nulls come first.  An empty table stays empty.  Input
    columns of the three names are replaced.
    """
    df = repeatable(df, "shard-input").drop(*[c for c in df.columns if c.lower() in ("row", "shard", "slot") and c not in keys])
    tie, at = unused("_tie", df), unused("_at", df)
    hashed = df.withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    numbered = number_rows(hashed, *keys, tie, name="row", position=F.monotonically_increasing_id()).drop(tie)
    rows = F.lit(numbered.count())  # of a stored table: read from its footers
    placed = with_permuted(numbered, at, F.col("row"), rows, F.lit("shards"), F.lit(seed))
    return placed.withColumns({"shard": F.pmod(at, F.lit(shards)).cast("int"), "slot": F.floor(F.col(at) / shards).cast("long")}).drop(at)


def row_sizes(text: Column) -> tuple[Column, Column]:
    """UTF-8 bytes of a text plus 16, and its unsigned CRC-32; null counts as no bytes."""
    text = F.coalesce(text, F.lit(""))
    return (F.octet_length(text) + 16).cast("long"), F.crc32(text.cast("binary"))
