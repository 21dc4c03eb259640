"""Deliveries of event messages as JSON lines, made by Spark from the landing events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIVERIES = 3


def _iso(column: str):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def deliveries(events: DataFrame) -> DataFrame:
    """``value`` (one line per message) and ``delivery``, the file it comes with.

    Events of all days are dealt over the deliveries, so later files bring first messages of
    earlier days.  As on a real line, some messages are faulty, decided by the event itself:
    AUM_UPDATE messages come again with the next delivery, EVENT_ATTENDANCE messages carry
    no metadata, and each MEETING message is preceded by a cut-off copy.
    """
    kind = F.col("event_type")
    number = F.substring("event_id", 2, 18).cast("long")
    line = F.to_json(
        F.struct(
            "event_id", "advisor_id", "territory_id", "event_type",
            _iso("event_timestamp").alias("event_timestamp"),
            "fund_id",
            F.col("aum_amount").cast("double").alias("aum_amount"),
            "opportunity_id",
            F.when(kind != "EVENT_ATTENDANCE", F.try_parse_json("metadata")).alias("metadata"),
            _iso("row_timestamp").alias("row_timestamp"),
        )
    )
    own = F.pmod(number, F.lit(DELIVERIES)).cast("int")
    send = lambda value, at: F.struct(value.alias("value"), at.alias("delivery"))
    first = send(F.col("line"), F.col("own"))
    sent = (
        F.when(kind == "AUM_UPDATE", F.array(first, send(F.col("line"), F.least(F.col("own") + 1, F.lit(DELIVERIES - 1)))))
        .when(kind == "MEETING", F.array(send(F.substring("line", 1, 40), F.col("own")), first))
        .otherwise(F.array(first))
    )
    return events.withColumns({"line": line, "own": own}).select(F.explode(sent).alias("m")).select("m.*")
