"""Sums over a sliding window per key, kept up to date by adding and retracting.

The state of a window is a folder:

    totals/version=v/bucket=b   per key: the sums over the window, and its newest row ever
    parts/version=v/unit=d      per key and instant: what a batch brought to the window, by day or month
    now/version=v               the instant that the window ends at, and the end of the version

A batch adds the sums of its own rows.  If its newest row moves the end on, the rows that the
window's start has passed are read from the parts of just those days and subtracted; rows that come too
late for the window are never part of it.  Only buckets with a key that
changed are written, from their last totals and the changes; all others keep their files.  A batch
that is run again starts from the version before and replaces its own folders, and a
version counts once its ``now`` is written, so a broken run leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salescompass.functions import dates
from salescompass.streaming.refresh import _delete, _finished, _folders

BUCKETS = 32


@dataclass(frozen=True)
class Window:
    """What is summed: ``measures`` (name to per-row number and its type) by ``key`` over the rows
    whose ``at`` is not before ``start(now)``.  Rows without an instant are in no window.  Parts are
    kept by ``unit``, of which a window should span some dozens."""

    key: str
    at: str
    measures: dict[str, tuple[Column, str]]
    start: Callable[[object], Column]
    buckets: int = field(default=BUCKETS)
    unit: str = "day"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def sums(self) -> list[Column]:
        return [F.sum(name).cast(kind).alias(name) for name, (_, kind) in self.measures.items()]


def _versions(spark: SparkSession, state: str, before: int) -> list[int]:
    """Finished versions below ``before``, oldest first."""
    return sorted(int(v) for v, path in _folders(spark, f"{state}/now", "version").items() if int(v) < before and _finished(spark, path))


def _path(state: str, part: str, version: int) -> str:
    return f"{state}/{part}/version={version:09d}"


def _bucket_paths(spark: SparkSession, state: str, before: int) -> dict[str, str]:
    """Newest folder of each bucket among the finished versions below ``before``."""
    newest: dict[str, str] = {}
    for version in _versions(spark, state, before):
        newest |= _folders(spark, _path(state, "totals", version), "bucket")
    return newest


def now_of(spark: SparkSession, state: str, before: int = 2**62):
    """The instant of the newest finished version; None without one."""
    done = _versions(spark, state, before)
    return spark.read.parquet(_path(state, "now", done[-1])).first()["now"] if done else None


def current(spark: SparkSession, state: str) -> DataFrame:
    """Every key that ever had a row: its sums over the window, and ``last``, its newest instant."""
    paths = _bucket_paths(spark, state, 2**62)
    if not paths:
        raise ValueError(f"no row has come yet to {state}")
    return spark.read.parquet(*paths.values())


def advance(batch: DataFrame, version: int, state: str, window: Window) -> None:
    """Take one more batch into the state as ``version``."""
    spark = batch.sparkSession
    known = batch.filter(F.col(window.at).isNotNull())
    newest, earlier = known.agg(F.max(window.at)).first()[0], now_of(spark, state, version)
    if newest is None and earlier is None:
        return
    now = max(x for x in (newest, earlier) if x is not None)
    start = window.start(now)

    numbers = [c.cast(k).alias(n) for n, (c, k) in window.measures.items()]
    rows = known.select(window.key, F.col(window.at).alias("at"), *numbers)
    kind = rows.schema["at"].dataType
    parts = rows.filter(F.col("at") >= start).groupBy(window.key, "at").agg(*window.sums()).withColumn("unit", _unit(window, F.col("at")))
    parts.hint("rebalance", "unit").write.mode("overwrite").partitionBy("unit").parquet(_path(state, "parts", version))
    columns = T.StructType([*parts.schema.fields, T.StructField("version", T.IntegerType())])
    stored = spark.read.schema(columns).option("basePath", f"{state}/parts").parquet(f"{state}/parts")
    mine = stored.filter(F.col("version") == version)
    nothing = [F.lit(0).cast(k).alias(n) for n, (_, k) in window.measures.items()]
    last = rows.groupBy(window.key).agg(F.max("at").alias("last")).select(window.key, *nothing, "last")
    changes = last.union(mine.select(window.key, *window.measures, F.lit(None).cast(kind)))
    if earlier is not None and now != earlier:
        before = window.start(earlier)
        passed = (F.col("at") >= before) & (F.col("at") < start) & F.col("unit").between(_unit(window, before), _unit(window, start))
        gone = stored.filter(F.col("version").isin(_versions(spark, state, version)) & passed)
        changes = changes.union(gone.select(window.key, *[(-F.col(n)).cast(k) for n, (_, k) in window.measures.items()], F.lit(None).cast(kind)))
    changes = changes.groupBy(window.key).agg(*window.sums(), F.max("last").alias("last")).withColumn("bucket", window.bucket())
    changed = _path(state, "changes", version)
    changes.write.mode("overwrite").parquet(changed)
    changes = spark.read.schema(changes.schema).parquet(changed)

    touched = {str(r["bucket"]) for r in changes.select("bucket").distinct().collect()}  # at most as many as there are buckets
    old = [path for b, path in _bucket_paths(spark, state, version).items() if b in touched]
    if touched:
        both = changes.drop("bucket")
        both = both.union(spark.read.schema(both.schema).parquet(*old)) if old else both
        totals = both.groupBy(window.key).agg(*window.sums(), F.max("last").alias("last")).withColumn("bucket", window.bucket())
        totals.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(_path(state, "totals", version))
    spark.range(1).select(F.lit(now).alias("now")).write.mode("overwrite").parquet(_path(state, "now", version))
    _tidy(spark, state, version, window, now if earlier is None else earlier)


def _unit(window: Window, at: Column) -> Column:
    return F.to_date(F.date_trunc(window.unit, at))


def _tidy(spark: SparkSession, state: str, version: int, window: Window, earlier) -> None:
    """Delete what neither this version nor a repetition of it reads: replaced buckets, and parts that had left the window before."""
    needed = set(_bucket_paths(spark, state, version + 1).values()) | set(_bucket_paths(spark, state, version).values())
    for path in _folders(spark, f"{state}/totals", "version").values():
        for bucket in _folders(spark, path, "bucket").values():
            if bucket not in needed:
                _delete(spark, bucket)
    _delete(spark, _path(state, "changes", version))
    oldest = str(spark.range(1).select(_unit(window, window.start(earlier))).first()[0])
    for path in _folders(spark, f"{state}/parts", "version").values():
        for unit, folder in _folders(spark, path, "unit").items():
            if unit < oldest:
                _delete(spark, folder)


def sliding_stream(rows: DataFrame, state: str, checkpoint: str, window: Window) -> StreamingQuery:
    """Keep the state of a window over a stream; the query handles what is there and stops."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        advance(batch, batch_id, state, window)

    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def activity_window(days: int = 30, buckets: int = BUCKETS) -> Window:
    """Calls, meetings and emails of an advisor in the last days, as ``operators.engagement`` counts them."""
    from salescompass.operators.engagement import ACTIVITY_COLUMNS

    measures = {name: (F.col("event_type").eqNullSafe(kind).cast("long"), "long") for kind, name in ACTIVITY_COLUMNS.items()}
    return Window("advisor_id", "event_timestamp", measures, lambda now: dates.before(now, days=days), buckets)


def flow_window(months: int = 12, buckets: int = BUCKETS) -> Window:
    """Absolute flow of an advisor over the last months, and the number of flows with an amount."""
    amount = F.coalesce(F.abs("flow_amount"), F.lit(0)).cast("decimal(28,2)")
    measures = {"total_flow_12m": (amount, "decimal(28,2)"), "flows": (F.col("flow_amount").isNotNull().cast("long"), "long")}
    return Window("advisor_id", "flow_date", measures, lambda now: dates.months_before(now, months), buckets, "month")
