"""Refresh of derived tables from a stream."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salescompass.functions import dates
from salescompass.operators.attribution import flow_state, merge_flow_batch

KEEP_VERSIONS = 3
_NULL = "__HIVE_DEFAULT_PARTITION__"  # folder value that Spark writes for a null


def _folders(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    """Sub-folders ``name=value`` of a folder: value to path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    found = (re.fullmatch(rf"{name}=(.+)", s.getPath().getName()) for s in files.listStatus(folder))
    return {m[1]: f"{path}/{m[0]}" for m in found if m}


def _finished(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def finished_versions(spark: SparkSession, target: str) -> list[str]:
    """Paths of the finished rebuilds, oldest first; one that broke off has no success marker."""
    return [path for _, path in sorted(_folders(spark, target, "version").items()) if _finished(spark, path)]


def refresh_stream(
    changes: DataFrame,
    rebuild: Callable[[], DataFrame],
    target: str,
    checkpoint: str,
    lag: str | None = None,
    keep: int = KEEP_VERSIONS,
    history: str | None = None,
    as_of: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Rebuild a derived table whenever its input has changed, at most once per ``lag``.

    Each rebuild goes to a folder of its own (``version=<batch>``), so readers of the
    previous version are not disturbed and a repeated batch replaces only itself.  The newest
    ``keep`` versions stay.  ``rebuild`` finds its own "now" in what has landed.  With ``history``, each
    refresh adds a row there, in the columns of the refresh history, with the instant ``as_of`` gives.
    Without ``lag`` the query handles what is there and stops.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        rebuild().write.mode("overwrite").parquet(f"{target}/version={batch_id:09d}")
        for old in finished_versions(spark, target)[:-keep]:
            _delete(spark, old)
        if history:
            name = target.rstrip("/").rpartition("/")[2]
            row = spark.range(1).select(
                F.lit(name).alias("name"), F.lit("DISTRIBUTION").alias("schema_name"), F.lit("FULL").alias("refresh_action"),
                dates.instant(as_of()).alias("refresh_start_time"),
            )
            row.write.mode("overwrite").parquet(f"{history}/refresh={batch_id:09d}")

    trigger = {"processingTime": lag} if lag else {"availableNow": True}
    return (
        changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def latest_version(spark: SparkSession, target: str) -> DataFrame:
    """Newest finished rebuild."""
    return spark.read.parquet(finished_versions(spark, target)[-1])


def _state_months(spark: SparkSession, state: str, before: int) -> dict[str, str]:
    """Month (``_NULL`` for flows without a date) to its newest folder among finished versions below ``before``."""
    newest: dict[str, str] = {}
    for version, path in sorted(_folders(spark, state, "version").items()):
        if int(version) < before and _finished(spark, path):
            newest |= _folders(spark, path, "month")
    return newest


def merge_flows_stream(flows: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """Incremental maintenance of the additive flow state, a folder for each month.

    A batch reads the state of its own months, adds its partial sums and writes those months
    as its version; other months keep their files.  A repeated batch starts from the same
    state and gives the same result.  Months replaced by the version before last are deleted.
    """
    month = F.date_format("flow_date", "yyyy-MM")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _state_months(spark, state, batch_id)
        sums = flow_state(batch).persist()
        touched = [_NULL if r[0] is None else r[0] for r in sums.select(month).distinct().collect()]
        known = [before[m] for m in touched if m in before]
        merged = merge_flow_batch(spark.read.parquet(*known), sums, summed=True) if known else sums
        merged.withColumn("month", month).write.mode("overwrite").partitionBy("month").parquet(f"{state}/version={batch_id:09d}")
        sums.unpersist()
        current = set(_state_months(spark, state, batch_id + 1).values()) | set(before.values())
        for _, version in _folders(spark, state, "version").items():
            for path in _folders(spark, version, "month").values():
                if path not in current:
                    _delete(spark, path)

    return (
        flows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_flows(spark: SparkSession, state: str) -> DataFrame:
    """The merged state: every month's newest version."""
    return spark.read.parquet(*_state_months(spark, state, 2**62).values())
