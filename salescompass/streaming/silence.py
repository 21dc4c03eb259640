"""An alert that fires when nothing comes.

A session of a key goes on while its events are less than the given minutes apart.  A session ends
when the event time of the whole stream passes its end without another event: that is the alert, one for
each silence.  Open sessions are the state, a row per key; events are merged into sessions before
they are shuffled, so a crowded key is a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salescompass.operators.alerts import STALE_MINUTES


def silences(events: DataFrame, key: str, at: str, minutes: int = STALE_MINUTES, delay: str = "0 seconds") -> DataFrame:
    """``key, silent_since, fired_at, events``: every silence of a key, once it has lasted ``minutes``.

    Events that are later than ``delay`` behind the newest one are not waited for.  Events without
    a time say nothing; those without a key are one key.
    """
    known = events.select(key, F.col(at).cast("timestamp").alias("at")).filter("at is not null").withWatermark("at", delay)
    sessions = known.groupBy(key, F.session_window("at", f"{minutes} minutes").alias("s")).agg(F.max("at").alias("last"), F.count(F.lit(1)).alias("events"))
    return sessions.select(
        key, F.col("last").cast("timestamp_ntz").alias("silent_since"), F.col("s.end").cast("timestamp_ntz").alias("fired_at"), "events"
    )


def silence_stream(events: DataFrame, sink: str, checkpoint: str, key: str, at: str, minutes: int = STALE_MINUTES, delay: str = "0 seconds") -> StreamingQuery:
    """Append the alerts to a table; the query handles what is there and stops.  Open silences go on with the next run."""
    writer = silences(events, key, at, minutes, delay).writeStream.outputMode("append").format("parquet")
    return writer.option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
