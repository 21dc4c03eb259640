"""Telemetry tables: service usage, alert history and refresh history, from the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescompass.sources.landing import read

SCHEMA_NAME = "DISTRIBUTION"
ALERT_FIRED = "TRIGGERED"
ALERT_QUIET = "CONDITION_FALSE"


def usage_history(spark: SparkSession, source_dir: str) -> DataFrame:
    return read(spark, source_dir, "events").select(
        F.col("event_type").alias("service_type"),
        F.to_date("ts").alias("usage_date"),
        (F.col("value").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(3,2)")).alias("credits_used"),
    )


def alert_history(spark: SparkSession, source_dir: str) -> DataFrame:
    return (
        read(spark, source_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            F.concat(F.lit("ALERT_"), (F.col("user_id") % 5).cast("string")).alias("name"),
            F.lit(SCHEMA_NAME).alias("schema_name"),
            F.col("ts").alias("scheduled_time"),
            F.when(F.col("value") > 100, ALERT_FIRED).otherwise(ALERT_QUIET).alias("state"),
        )
    )


def refresh_history(spark: SparkSession, source_dir: str) -> DataFrame:
    return (
        read(spark, source_dir, "events")
        .filter(F.col("event_type").isin("click", "view"))
        .select(
            F.concat(F.lit("DT_"), (F.col("event_id") % 3).cast("string")).alias("name"),
            F.lit(SCHEMA_NAME).alias("schema_name"),
            F.when(F.col("event_type") == "click", "FULL").otherwise("INCREMENTAL").alias("refresh_action"),
            F.col("ts").alias("refresh_start_time"),
        )
    )
