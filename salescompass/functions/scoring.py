"""Scores, classes and bands of the engagement model, as plain column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the scoring model -------------------------------------------
CALL_WEIGHT = 3
MEETING_WEIGHT = 8
EMAIL_WEIGHT = 0.5
RECENCY_POINTS = [(0, 10), (7, 8), (14, 5), (30, 2)]  # (days up to, points); later: 0
NO_ACTIVITY_DAYS = 999
SCORE_RANGE = (0.0, 100.0)
AUM_SHARE_OF_FLOW = "0.15"
DEFAULT_AUM = 10_000_000
AT_RISK_BELOW = 30
HIGH_ENGAGEMENT_FROM = 70
HEAT_ENGAGEMENT_WEIGHT = 0.4
HEAT_FLOW_WEIGHT = 0.4
HEAT_FLOW_CAP = 50
HEAT_SAFE_SHARE_POINTS = 20
HEAT_BANDS = [(70, "green"), (40, "amber")]  # from score; below: red
SIGNAL_LEVELS = [(3, "HOT"), (1, "WARM")]  # more open deals than; else COLD
ATTRITION_HIGH_SCORE = 20
ATTRITION_LOW_SCORE = 40
ATTRITION_IDLE_DAYS = 21
ATTRITION_RECENT_DAYS = 14
ATTRITION_LARGE_AUM = 10_000_000
# -----------------------------------------------------------------------------------


def _first_match(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    head, *rest = cases
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(*head)).otherwise(otherwise)


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; a null stays null (least/greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def recency_points(days: Column) -> Column:
    (today, most), *later = RECENCY_POINTS
    return _first_match([(days == today, F.lit(most)), *[(days <= limit, F.lit(points)) for limit, points in later]], F.lit(0))


def engagement_score(calls: Column, meetings: Column, emails: Column, days: Column) -> Column:
    """0..100 from activity counts and days since the last activity; nulls mean none."""
    counted = [(calls, CALL_WEIGHT), (meetings, MEETING_WEIGHT), (emails, EMAIL_WEIGHT)]
    activity = reduce(Column.__add__, [F.coalesce(n, F.lit(0)) * F.lit(w) for n, w in counted])
    recency = recency_points(F.coalesce(days, F.lit(NO_ACTIVITY_DAYS)))
    return clamp((activity + recency).cast("double"), *SCORE_RANGE)


def estimated_aum(flow_12m: Column) -> Column:
    share = flow_12m * F.lit(AUM_SHARE_OF_FLOW).cast("decimal(2,2)")
    return F.coalesce(share, F.lit(DEFAULT_AUM)).cast("decimal(28,4)")


def heat_score(avg_score: Column, net_flow: Column, at_risk: Column, rows: Column) -> Column:
    """Territory health 0..100; null when the territory has no scored advisor."""
    flow_m = F.coalesce(net_flow.cast("double"), F.lit(0.0)) / 1e6
    safe_share = F.lit(1.0) - at_risk / F.nullif(rows, F.lit(0))
    total = (
        avg_score * HEAT_ENGAGEMENT_WEIGHT
        + F.least(F.lit(float(HEAT_FLOW_CAP)), flow_m) * HEAT_FLOW_WEIGHT
        + safe_share * HEAT_SAFE_SHARE_POINTS
    )
    return clamp(total, *SCORE_RANGE)


def heat_band(score: Column) -> Column:
    return _first_match([(score >= floor, F.lit(band)) for floor, band in HEAT_BANDS], F.lit("red"))


def pipeline_signal(open_deals: Column) -> Column:
    return _first_match([(open_deals > n, F.lit(level)) for n, level in SIGNAL_LEVELS], F.lit("COLD"))


def attrition_class(score: Column, idle_days: Column, aum: Column) -> Column:
    """HIGH / LOW by rule; everything the written rules leave open is MEDIUM."""
    high = (score < ATTRITION_HIGH_SCORE) | ((idle_days > ATTRITION_IDLE_DAYS) & (aum > ATTRITION_LARGE_AUM))
    low = (score > ATTRITION_LOW_SCORE) & (idle_days <= ATTRITION_RECENT_DAYS)
    return _first_match([(high, F.lit("HIGH")), (low, F.lit("LOW"))], F.lit("MEDIUM"))


def at_risk(score: Column) -> Column:
    return score < AT_RISK_BELOW


def highly_engaged(score: Column) -> Column:
    return score >= HIGH_ENGAGEMENT_FROM
