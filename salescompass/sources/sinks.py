"""Table writers: overwrite, append, snapshot and balanced layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODEC = "zstd"  # stored tables stay on the shared disk to the end of the application


def stamped(df: DataFrame, column: str = "row_timestamp") -> DataFrame:
    """Adds the load time.  The only place that reads the clock: the write boundary."""
    return df.withColumn(column, F.current_timestamp().cast("timestamp_ntz"))


def overwrite(df: DataFrame, path: str, sort_by: list[str] | None = None) -> None:
    """Replace a table.  A local sort gives narrow row-group ranges without a shuffle."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_balanced(
    df: DataFrame, path: str, group_by: list[str | Column], sort_by: list[str | Column], partition_by: list[str] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace a table, keeping rows of a group together in files of even size.

    One hash shuffle on the group columns; AQE then cuts crowded groups — even copies of a
    single row — into several files and joins small ones, so no group is too large
    for a task.  Files hold narrow key ranges, which row-group statistics use to skip reads.
    ``partition_by`` adds directories and should hold few values.  ``finish`` works out wide columns from
    a row's narrow ones, after the shuffle.
    """
    groups = {f"_g{i}": g for i, g in enumerate(group_by) if not isinstance(g, str)}
    names = [g if isinstance(g, str) else f"_g{i}" for i, g in enumerate(group_by)]
    out = df.withColumns(groups).hint("rebalance", *names).sortWithinPartitions(*sort_by).drop(*groups)
    writer = (finish(out) if finish else out).write.mode("overwrite").option("compression", CODEC)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append").option("compression", CODEC)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_snapshot(df: DataFrame, path: str, date_col: str) -> None:
    """Add one dated snapshot; running the same date again replaces only that date."""
    (
        df.write.mode("overwrite")
        .option("compression", CODEC)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A catalog table of files at ``path``, dealt by the hash of ``key`` and sorted by it.

    Tables of as many buckets join and group by the key without moving a row.  A key's rows are one
    task's, so tables with crowded keys are summed up first.
    """
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
