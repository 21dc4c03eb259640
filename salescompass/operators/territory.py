"""Territory health over the engagement table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import dates, scoring


def territory_heat_map(
    territories: DataFrame, engagement: DataFrame, flows: DataFrame, window_days: int | None = None, as_of=None
) -> DataFrame:
    """One row per active territory and score date.

    Engagement and flows are reduced to a row per territory before they meet.  Net flows
    cover all time although the column says 30 days; ``window_days`` with ``as_of``
    gives the true window.  A territory without scored advisors keeps one row with a
    null score.
    """
    if window_days is not None:
        if as_of is None:
            raise ValueError("window_days needs as_of")
        flows = flows.filter(F.col("flow_date") >= F.date_sub(dates.day(as_of), window_days))
    net = flows.groupBy("territory_id").agg(F.sum("flow_amount").alias("net"))
    score = F.col("engagement_score")
    scored = engagement.groupBy("territory_id", F.col("score_date").alias("as_of_date")).agg(
        F.countDistinct("advisor_id").alias("advisor_count"),
        F.sum("aum_amount").alias("total_aum"),
        F.avg(score).alias("avg_engagement_score"),
        F.sum("open_opportunity_value").alias("total_pipeline_value"),
        F.count_if(scoring.at_risk(score)).alias("at_risk_advisor_count"),
        F.count_if(scoring.highly_engaged(score)).alias("high_engagement_count"),
        F.count(F.lit(1)).alias("scored_rows"),
    )
    joined = (
        territories.filter("active")
        .select("territory_id", "territory_name", "region", "territory_mgr")
        .join(scored, "territory_id", "left")
        .join(net, "territory_id", "left")
    )
    at_risk = F.coalesce("at_risk_advisor_count", F.lit(0))
    heat = scoring.heat_score(
        F.col("avg_engagement_score"), F.col("net"), at_risk, F.coalesce("scored_rows", F.lit(1))
    )
    return joined.select(
        "territory_id",
        "territory_name",
        "region",
        "territory_mgr",
        "as_of_date",
        F.coalesce("advisor_count", F.lit(0)).alias("advisor_count"),
        F.col("total_aum").cast("decimal(38,4)").alias("total_aum"),
        "avg_engagement_score",
        F.coalesce("net", F.lit(0)).cast("decimal(28,2)").alias("net_flows_30d"),
        F.col("total_pipeline_value").cast("decimal(38,2)").alias("total_pipeline_value"),
        at_risk.alias("at_risk_advisor_count"),
        F.coalesce("high_engagement_count", F.lit(0)).alias("high_engagement_count"),
        heat.alias("territory_heat_score"),
    )
