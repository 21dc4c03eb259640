"""Data-quality measurements in long form: one row per (table, metric, column)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.functions import dates

Check = tuple[str, str | None]  # (metric, column)

# fixed values: schema, table and checks that are monitored
MONITORED: dict[str, tuple[str, list[Check]]] = {
    "advisor_events": (
        "STAGING",
        [("NULL_COUNT", "row_timestamp"), ("NULL_COUNT", "advisor_id"), ("DUPLICATE_COUNT", "event_id")],
    ),
    "advisor_engagement_score": ("DISTRIBUTION", [("ROW_COUNT", None), ("NULL_COUNT", "engagement_score")]),
    "fund_flows": ("STAGING", [("NULL_COUNT", "row_timestamp"), ("NULL_COUNT", "fund_id")]),
}
_WARN_ABOVE_ZERO = ("NULL_COUNT", "DUPLICATE_COUNT")


def _measure(metric: str, column: str | None, now) -> Column:
    if metric == "ROW_COUNT":
        return F.count(F.lit(1))
    if metric == "NULL_COUNT":
        return F.count_if(F.col(column).isNull())
    if metric == "DUPLICATE_COUNT":
        # rows beyond the first of each key; null keys are counted by NULL_COUNT
        return F.count(column) - F.countDistinct(column)
    if metric == "FRESHNESS":
        return dates.seconds_between(F.max(column), now)
    raise ValueError(f"unknown metric {metric}")


def dq_report(df: DataFrame, table: str, schema: str, checks: Sequence[Check], measured_at) -> DataFrame:
    """All checks of one table in one pass over the columns they name."""
    measures = [_measure(metric, column, measured_at).cast("long").alias(f"m{i}") for i, (metric, column) in enumerate(checks)]
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric_name"),
                F.lit(column).cast("string").alias("column_name"),
                F.col(f"m{i}").alias("value"),
            )
            for i, (metric, column) in enumerate(checks)
        ]
    )
    return (
        df.agg(*measures)
        .select(F.explode(rows).alias("r"))
        .select(
            F.lit(schema).alias("table_schema"),
            F.lit(table).alias("table_name"),
            "r.*",
            dates.instant(measured_at).alias("measurement_time"),
        )
    )


def orphan_count(df: DataFrame, known: DataFrame, key: str, table: str, schema: str, measured_at) -> DataFrame:
    """Rows whose key the dimension does not hold.

    Rows are counted per key before the anti join, so a frequent key is one row there.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(known.select(key), key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value"))
    return orphans.select(
        F.lit(schema).alias("table_schema"),
        F.lit(table).alias("table_name"),
        F.lit("ORPHAN_COUNT").alias("metric_name"),
        F.lit(key).alias("column_name"),
        F.col("value").cast("long").alias("value"),
        dates.instant(measured_at).alias("measurement_time"),
    )


def recent_results(results: DataFrame, as_of, hours: int = 24, k: int | None = None) -> DataFrame:
    """Results of the last ``hours``, newest first; ``k`` keeps that many."""
    recent = results.filter(
        F.col("table_schema").isin("STAGING", "DISTRIBUTION")
        & (F.col("measurement_time") >= dates.before(as_of, hours=hours))
    )
    newest = recent.orderBy(
        F.desc("measurement_time"), "table_schema", "table_name", "metric_name", F.asc_nulls_first("column_name")
    )
    return newest if k is None else newest.limit(k)


def with_status(results: DataFrame) -> DataFrame:
    """WARNING when a null or duplicate count, matched by exact name, is above zero."""
    bad = F.col("metric_name").isin(*_WARN_ABOVE_ZERO) & (F.col("value") > 0)
    return results.withColumn("status", F.when(bad, "WARNING").otherwise("OK"))


def with_pattern_status(results: DataFrame) -> DataFrame:
    """The same idea, matched by name pattern."""
    name = F.col("metric_name")
    bad = (name.like("%NULL%") | name.like("%DUPLICATE%")) & (F.col("value") > 0)
    return results.withColumn("health_status", F.when(bad, "WARNING").otherwise("OK"))
