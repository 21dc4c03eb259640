"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits skewed sort-merge partitions at run time, but not below an aggregate that
relies on the join's partitioning.  ``skew_join`` therefore spreads heavy keys itself:
the large side's heavy rows get a salt, the other side's matching rows are repeated once
per salt.  The number of salts follows the key's row count, so every task gets about the
same work; rows of all other keys shuffle exactly as in a plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 2_000_000  # a key below this never needs spreading
SEEN_PER_TASK = 400  # sampled rows to expect of a key that fills one task
BROADCAST_BYTES = 64_000_000

_SALT = "_salt"


def spread(df: DataFrame) -> DataFrame:
    """Spread a plain file scan that has fewer splits than the cluster has cores.

    For work that is heavy per row over a few small files.  A large scan has
    splits enough and is returned as it is, without a shuffle.  The rows are the same.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _width(df: DataFrame) -> tuple[int, list[Column]]:
    """Bytes of a row's fixed part, and the lengths of its strings."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return 16 + 8 * len(df.columns), [F.coalesce(F.octet_length(c), F.lit(0)) for c in strings]


def size_in_bytes(df: DataFrame) -> int:
    """Measured size of the rows: their number and their strings' lengths, one row to the driver."""
    fixed, strings = _width(df)
    rows, *lengths = df.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(s), F.lit(0)) for s in strings]).first()
    return rows * fixed + sum(lengths)


def broadcast_within(df: DataFrame, rows: int, limit: int = BROADCAST_BYTES, string_bytes: int = 64) -> DataFrame:
    """Broadcast hint for a side of counted ``rows`` with short strings, if that is within ``limit`` bytes."""
    fixed, strings = _width(df)
    return F.broadcast(df) if rows * (fixed + string_bytes * len(strings)) <= limit else df


def dimension_join(
    left: DataFrame, dimension: DataFrame, key: str, how: str = "inner", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a table that should be small: broadcast when its measured bytes prove it, else ``skew_join``."""
    if size_in_bytes(dimension) <= limit:
        return left.join(F.broadcast(dimension), key, how)
    return skew_join(left, dimension, key, how)


def heavy_keys(df: DataFrame, *keys: str, rows_per_task: int | None = None) -> dict[str, dict]:
    """Per key column, the values too frequent for one task, with their estimated row counts.

    The floor is absolute: a key of ``rows_per_task`` rows is heavy in any table.  Each column
    is sampled so thinly that such a key shows SEEN_PER_TASK times, and the sample is
    counted by key like any aggregate.  At most rows / rows_per_task values can be
    heavy, a few bytes per task of the table.  A key the sample misjudges is only
    spread differently; join results never depend on these counts.
    """
    floor = rows_per_task or ROWS_PER_TASK
    fraction = min(1.0, SEEN_PER_TASK / floor)
    found = {}
    for key in keys:
        seen = (df if fraction == 1.0 else df.select(key).sample(fraction, seed=1)).groupBy(key).agg(F.count(F.lit(1)).alias("seen"))
        heavy = seen.filter(F.col(key).isNotNull() & (F.col("seen") > floor * fraction))
        found[key] = {r[0]: r[1] / fraction for r in heavy.collect()}
    return found


def _salts(df: DataFrame, key: str, heavy: dict, rows_per_task: int) -> DataFrame:
    """The heavy values with the number of tasks that each needs."""
    rows = [(value, math.ceil(max(2, n / rows_per_task))) for value, n in heavy.items()]
    return df.sparkSession.createDataFrame(rows, T.StructType([df.schema[key], T.StructField("_fan", T.IntegerType())]))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: Column | None = None,
    heavy: dict | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """``left`` join ``right`` on ``key`` with left's heavy keys spread over several tasks.

    ``heavy`` maps values to row counts (default: measured on ``left``).  ``spread_by``
    must be repeatable for a row (a stored column, or a row position taken at a file scan)
    because a lost task may be computed again.  Default: hash of the row.
    """
    if how not in ("inner", "left"):
        raise ValueError("heavy rows are on the left: only inner and left joins are supported")
    heavy = heavy_keys(left, key, rows_per_task=rows_per_task)[key] if heavy is None else heavy
    if not heavy:
        return left.join(right, key, how)
    if spread_by is None:
        spread_by = F.xxhash64(*[c for c in left.columns if c != key])
    # bounded: at most one row for every ``rows_per_task`` rows of the table
    salts = F.broadcast(_salts(left, key, heavy, rows_per_task or ROWS_PER_TASK))
    fan = F.coalesce("_fan", F.lit(1))
    salted_left = left.withColumn("_by", spread_by).join(salts, key, "left").withColumn(_SALT, F.pmod("_by", fan).cast("int")).drop("_by", "_fan")
    salted_right = right.join(salts, key, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan")
    return salted_left.join(salted_right, [key, _SALT], how).drop(_SALT)
