"""Row-level operators: snapshots, numbering, repetition, shuffling."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescompass.session import run_dir


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest ``date_col``: an uncorrelated scalar subquery.

    On a table partitioned by ``date_col`` the subquery value prunes partitions.
    """
    newest = df.agg(F.max(date_col).alias("newest")).scalar()
    return df.filter(F.col(date_col) == newest)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Per-task top k, then one merge (TakeOrderedAndProject); never a full sort."""
    return df.orderBy(*order).limit(k)


def unused(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def number_rows(df: DataFrame, *keys: str, name: str = "n", position: Column | None = None) -> DataFrame:
    """Dense numbers 0, 1, 2, … in the order of ``keys``; nulls come first.

    A window without partitions would put the whole table into one task.  Instead the rows
    are range-partitioned by the keys and sorted inside each part; a row's number is its
    position in the part plus the rows of all parts before (one small row per part).  The
    sorted table is stored once, so a part keeps its content when a task is run again.

    ``position`` orders rows of equal keys, which are else in any order but all in one part.
    It must be repeatable for a row, like ``monotonically_increasing_id()`` at a table scan.
    """
    part, inside, size, start, tie = (unused(c, df) for c in ("_part", "_inside", "_size", "_start", "_position"))
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    order = list(keys)
    if position is not None:
        df, order = df.withColumn(tie, position), [*order, tie]
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).drop(tie)
    path = run_dir(df.sparkSession, "numbered", uuid.uuid4().hex[:12])
    placed = ordered.withColumns({part: F.spark_partition_id(), inside: number})
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(size))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    # one row per part: their number is the shuffle's partition count, whatever the data
    return (
        placed.join(F.broadcast(starts), part)
        .withColumn(name, (F.col(start) + F.col(inside)).cast("long"))
        .drop(part, inside, start)
    )


def repeat_rows(df: DataFrame, copies: int, name: str = "copy") -> DataFrame:
    """``copies`` rows per input row, numbered from 0, generated in place without a join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def shuffle_rows(df: DataFrame, seed: int, partitions: int | None = None) -> DataFrame:
    """Random placement and order before a load, repeatable for the same rows.

    Rows are dealt out in turn, so copies of one row spread too.  Sorting globally by a
    random number would cost a range shuffle for the same effect.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions).sortWithinPartitions(F.xxhash64(F.lit(seed), *df.columns))
