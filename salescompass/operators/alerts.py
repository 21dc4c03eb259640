"""Alert conditions.

Each returns one row (alert, fired, value, message) from one global aggregate, so it
never decides on the driver; an empty input gives a null value and does not fire.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.functions import dates, scoring

# --- fixed values: thresholds ---------------------------------------------------------
STALE_MINUTES = 30
AT_RISK_PERCENT = 20
OUTFLOW_LIMIT = -1_000_000
CREDIT_BUDGET = 10
CREDIT_LIMIT = 8
FULL_REFRESH_HOURS = 1
# ----------------------------------------------------------------------------------------


def _alert(row: DataFrame, name: str, fired: Column, value: Column, *message) -> DataFrame:
    fired = F.coalesce(fired, F.lit(False))
    parts = [m if isinstance(m, Column) else F.lit(m) for m in message]
    return row.select(
        F.lit(name).alias("alert"),
        fired.alias("fired"),
        value.cast("double").alias("value"),
        F.when(fired, F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])).alias("message"),
    )


def events_stale(events: DataFrame, as_of) -> DataFrame:
    """Newest event older than 30 minutes; value is its age in seconds."""
    row = events.agg(F.max("row_timestamp").alias("newest"))
    newest = F.col("newest")
    return _alert(
        row, "EVENTS_STALE", newest < dates.before(as_of, mins=STALE_MINUTES), dates.seconds_between(newest, as_of),
        "Advisor events are stale. Last row: ", F.date_format(newest, "yyyy-MM-dd HH:mm:ss"),
    )


def events_stale_by(events: DataFrame, key: str) -> DataFrame:
    """Per key: newest event more than 30 minutes older than the newest one of all keys.

    The other keys are the clock, so one feed that stopped is seen while others go on.
    """
    newest = events.agg(F.max("row_timestamp")).scalar()
    rows = events.groupBy(key).agg(F.max("row_timestamp").alias("last_row"))
    fired = F.coalesce(F.col("last_row") < newest - F.make_dt_interval(mins=F.lit(STALE_MINUTES)), F.lit(False))
    return rows.select(key, "last_row", fired.alias("fired"), dates.seconds_between(F.col("last_row"), newest).alias("seconds_behind"))


def high_attrition(engagement: DataFrame, as_of) -> DataFrame:
    """More than 20 % of today's Platinum advisors score below the risk line."""
    platinum = engagement.filter(
        (F.col("score_date") == dates.day(as_of)) & (F.col("advisor_tier") == "PLATINUM")
    )
    row = platinum.agg(
        F.count_if(scoring.at_risk(F.col("engagement_score"))).alias("at_risk"), F.count(F.lit(1)).alias("total")
    )
    percent = F.round(F.col("at_risk") / F.nullif(F.col("total"), F.lit(0)) * 100, 1)
    return _alert(
        row, "HIGH_ATTRITION", (F.col("at_risk") > 0) & (percent > AT_RISK_PERCENT), percent,
        "High attrition risk among Platinum advisors. At risk: ", F.col("at_risk"), " of ", F.col("total"),
    )


def fund_outflows(flows: DataFrame, as_of) -> DataFrame:
    """Net flow of the day below -1,000,000."""
    row = flows.filter(F.col("flow_date") == dates.day(as_of)).agg(
        F.sum("flow_amount").cast("decimal(28,2)").alias("net")
    )
    return _alert(
        row, "FUND_OUTFLOWS", F.col("net") < OUTFLOW_LIMIT, F.col("net"),
        "Net outflow above $1M. Date: ", dates.day(as_of), ", net flow: $", F.col("net"),
    )


def usage_budget(usage: DataFrame, as_of) -> DataFrame:
    """Credits of the day above 80 % of the daily budget."""
    row = usage.filter(F.col("usage_date") == dates.day(as_of)).agg(
        F.round(F.sum("credits_used"), 2).cast("decimal(28,2)").alias("shown"), F.sum("credits_used").alias("used")
    )
    return _alert(
        row, "USAGE_BUDGET", F.col("used") > CREDIT_LIMIT, F.col("used"),
        "Credits used today: ", F.col("shown"), f" of {CREDIT_BUDGET} allowed.",
    )


def full_refresh(refreshes: DataFrame, as_of) -> DataFrame:
    """Any full refresh of a derived table in the last hour; value is their number."""
    row = refreshes.filter(
        (F.col("schema_name") == "DISTRIBUTION")
        & (F.col("refresh_action") == "FULL")
        & (F.col("refresh_start_time") > dates.before(as_of, hours=FULL_REFRESH_HOURS))
    ).agg(F.count(F.lit(1)).alias("n"))
    return _alert(row, "FULL_REFRESH", F.col("n") > 0, F.col("n"), "Full refreshes in the last hour: ", F.col("n"))


def alert_report(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def as_history(report: DataFrame, as_of) -> DataFrame:
    """Alert rows in the shape of the alert history table."""
    return report.select(
        F.concat(F.lit("ALERT_"), F.col("alert")).alias("name"),
        F.lit("DISTRIBUTION").alias("schema_name"),
        dates.instant(as_of).alias("scheduled_time"),
        F.when(F.col("fired"), "TRIGGERED").otherwise("CONDITION_FALSE").alias("state"),
    )
