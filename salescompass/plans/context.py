"""One-row JSON contexts and per-row texts assembled from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import money, scoring
from salescompass.operators.rows import top_k


def brief_context(advisors: DataFrame, territories: DataFrame) -> DataFrame:
    """Headline numbers and the territory with the highest net flow, as one JSON text."""
    leader = top_k(territories, [F.desc_nulls_last("net_flows_30d"), F.asc("territory_name")], 1)
    totals = advisors.agg(
        F.countDistinct("advisor_id").alias("total_advisors"),
        F.round(F.avg("engagement_score"), 1).alias("avg_engagement"),
        F.count_if(scoring.at_risk(F.col("engagement_score"))).alias("at_risk_count"),
        money.millions(F.sum("open_opportunity_value"), 1).cast("decimal(28,1)").alias("total_pipeline_m"),
    ).withColumn("top_territory", leader.select("territory_name").scalar())
    fields = ["total_advisors", "avg_engagement", "at_risk_count", "top_territory", "total_pipeline_m"]
    return totals.select(F.to_json(F.struct(*fields)).alias("context"))


def territory_brief_context(territories: DataFrame) -> DataFrame:
    """The healthiest territory as one JSON text."""
    best = top_k(territories, [F.desc_nulls_last("territory_heat_score"), F.asc("territory_name")], 1)
    return best.select(
        F.to_json(
            F.struct(
                F.col("territory_name").alias("territory"),
                money.millions(F.col("total_aum"), 1).cast("decimal(28,1)").alias("aum_m"),
                F.col("advisor_count").alias("advisors"),
                F.round("avg_engagement_score", 1).alias("engagement"),
                money.millions(F.col("net_flows_30d"), 2).cast("decimal(28,2)").alias("flows_30d_m"),
                F.col("at_risk_advisor_count").alias("at_risk"),
            )
        ).alias("context")
    )


# fixed value: labels of the assembled text
PROMPT_PARTS = [
    ("Score: ", "engagement_score", "/100  "),
    ("Calls: ", "call_count_30d", "  "),
    ("Meetings: ", "meeting_count_30d", "  "),
    ("Days inactive: ", "days_since_last_activity", "."),
]


def attrition_text(advisors: DataFrame, tier: str = "PLATINUM") -> DataFrame:
    pieces = [
        piece for head, column, tail in PROMPT_PARTS for piece in (F.lit(head), F.col(column).cast("string"), F.lit(tail))
    ]
    return advisors.filter(F.col("advisor_tier") == tier).select(
        "advisor_id",
        "advisor_name",
        "advisor_tier",
        F.round("engagement_score", 1).alias("engagement"),
        money.millions(F.col("aum_amount"), 2).alias("aum_m"),
        F.concat(*pieces).alias("prompt"),
    )
