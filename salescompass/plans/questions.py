"""Business questions asked of the tables, each an ordinary report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescompass.functions import dates
from salescompass.operators.engagement import open_only
from salescompass.operators.rows import top_k
from salescompass.operators.skew import dimension_join, heavy_keys, skew_join
from salescompass.plans.verified import amount_of


# -- pipeline ---------------------------------------------------------------------------
def top_pipeline_advisors(advisors: DataFrame, k: int = 10) -> DataFrame:
    return top_k(advisors, [F.desc_nulls_last("open_opportunity_value"), F.asc("advisor_id")], k).select(
        "advisor_id", "advisor_name", "territory_name", "open_opportunity_count", "open_opportunity_value"
    )


def pipeline_this_quarter(opps: DataFrame, advisors: DataFrame, territories: DataFrame, as_of) -> DataFrame:
    """Open deals closing in the quarter of ``as_of``, per territory of the advisor."""
    due = open_only(opps).filter(
        (F.col("close_date") >= dates.period_start(as_of, "quarter"))
        & (F.col("close_date") < dates.period_start(as_of, "quarter", back=-1))
    )
    per_advisor = due.groupBy("advisor_id").agg(
        F.count(F.lit(1)).alias("deals"), F.sum(F.coalesce("amount", F.lit(0).cast("decimal(18,2)"))).alias("value")
    )
    placed = per_advisor.join(advisors.select("advisor_id", "territory_id"), "advisor_id")
    return (
        dimension_join(placed, territories.select("territory_id", "territory_name"), "territory_id")
        .groupBy("territory_name")
        .agg(F.sum("deals").alias("open_deals"), F.sum("value").alias("pipeline_value"))
        .orderBy(F.desc_nulls_last("pipeline_value"), "territory_name")
    )


def stale_opportunities(opps: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        open_only(opps)
        .filter(F.col("last_modified") < F.date_sub(dates.day(as_of), days))
        .select(
            "opportunity_id", "advisor_id", "stage", "amount", "last_modified",
            dates.days_between(F.col("last_modified"), as_of).alias("days_unchanged"),
        )
    )


def win_rate(opps: DataFrame, advisors: DataFrame, funds: DataFrame, territories: DataFrame) -> DataFrame:
    """Won / (won + lost) per territory and fund category."""
    closed = opps.filter(F.col("stage").isin("Closed Won", "Closed Lost"))
    heavy = heavy_keys(closed, "advisor_id", "fund_id")
    counts = closed.groupBy("advisor_id", "fund_id").agg(
        F.count_if(F.col("stage") == "Closed Won").alias("won"),
        F.count_if(F.col("stage") == "Closed Lost").alias("lost"),
    )
    placed = skew_join(
        counts, advisors.select("advisor_id", "territory_id"), "advisor_id", heavy=heavy["advisor_id"]
    )
    placed = skew_join(placed, funds.select("fund_id", "fund_category"), "fund_id", heavy=heavy["fund_id"])
    return (
        dimension_join(placed, territories.select("territory_id", "territory_name"), "territory_id")
        .groupBy("territory_name", "fund_category")
        .agg(F.sum("won").alias("won"), F.sum("lost").alias("lost"))
        .withColumn("win_rate", F.col("won") / F.nullif(F.col("won") + F.col("lost"), F.lit(0)))
    )


def opp_to_aum(advisors: DataFrame, k: int = 20) -> DataFrame:
    ratio = F.col("open_opportunity_value").cast("double") / F.nullif(F.col("aum_amount").cast("double"), F.lit(0.0))
    rated = advisors.withColumn("opp_to_aum", F.round(ratio, 6))
    return top_k(rated, [F.desc_nulls_last("opp_to_aum"), F.asc("advisor_id")], k).select(
        "advisor_id", "advisor_name", "open_opportunity_value", "aum_amount", "opp_to_aum"
    )


# -- engagement -------------------------------------------------------------------------
def top_engaged(advisors: DataFrame, territory: str | None = None, k: int = 20) -> DataFrame:
    if territory is not None:
        advisors = advisors.filter(F.col("territory_name") == F.lit(territory))
    return top_k(advisors, [F.desc_nulls_last("engagement_score"), F.asc("advisor_id")], k).select(
        "advisor_id", "advisor_name", "territory_name", F.col("advisor_tier").alias("tier"), "engagement_score"
    )


def no_calls_14d(advisors: DataFrame, events: DataFrame, as_of, tier: str = "PLATINUM", days: int = 14) -> DataFrame:
    """Advisors of a tier without a recent call.

    The calls are reduced to distinct advisors before the anti join, so an advisor with
    very many calls reaches the join as one row.
    """
    called = (
        events.filter((F.col("event_type") == "CALL") & (F.col("event_timestamp") >= dates.before(as_of, days=days)))
        .select("advisor_id")
        .distinct()
    )
    return (
        advisors.filter(F.col("advisor_tier") == tier)
        .join(called, "advisor_id", "left_anti")
        .select("advisor_id", "advisor_name", "territory_name", "engagement_score", "days_since_last_activity")
    )


def tier_compare(advisors: DataFrame, tiers=("GOLD", "SILVER")) -> DataFrame:
    return (
        advisors.filter(F.col("advisor_tier").isin(*tiers))
        .groupBy(F.col("advisor_tier").alias("tier"))
        .agg(
            F.count(F.lit(1)).alias("advisors"),
            F.avg("engagement_score").alias("avg_engagement"),
            F.max("engagement_score").alias("max_engagement"),
        )
    )


# -- territories ------------------------------------------------------------------------
def _net_by(flows: DataFrame, column: str) -> DataFrame:
    return flows.groupBy(column).agg(F.sum("flow_amount").alias("net_flows"))


def net_flows_prev_quarter(flows: DataFrame, as_of, k: int = 1) -> DataFrame:
    previous = flows.filter(
        (F.col("flow_date") >= dates.period_start(as_of, "quarter", back=1))
        & (F.col("flow_date") < dates.period_start(as_of, "quarter"))
    )
    return top_k(_net_by(previous, "territory_name"), [F.desc_nulls_last("net_flows"), F.asc("territory_name")], k)


def most_at_risk_territory(territories: DataFrame, k: int = 1) -> DataFrame:
    order = [F.desc_nulls_last("at_risk_advisor_count"), F.asc("territory_name")]
    return top_k(territories, order, k).select("territory_name", "at_risk_advisor_count", "advisor_count")


def territory_heat_rank(territories: DataFrame) -> DataFrame:
    """Rank over the territory rows: a handful, whatever the size of the facts."""
    by_heat = Window.orderBy(F.desc_nulls_last("territory_heat_score"))
    return territories.select("territory_name", "territory_heat_score", F.rank().over(by_heat).alias("heat_rank"))


def engagement_drop(history: DataFrame, as_of, days: int = 90, k: int = 1) -> DataFrame:
    """Territories with the largest fall in average engagement between first and last snapshot."""
    per_day = (
        history.filter(F.col("score_date") >= F.date_sub(dates.day(as_of), days))
        .groupBy("territory_name", "score_date")
        .agg(F.avg("engagement_score").alias("avg_score"))
    )
    change = per_day.groupBy("territory_name").agg(
        F.round(F.min_by("avg_score", "score_date"), 6).alias("first_score"),
        F.round(F.max_by("avg_score", "score_date"), 6).alias("last_score"),
    )
    dropped = change.withColumn("drop", F.round(F.col("first_score") - F.col("last_score"), 6))
    return top_k(dropped, [F.desc_nulls_last("drop"), F.asc("territory_name")], k)


# -- flows ------------------------------------------------------------------------------
def net_flows_ytd(flows: DataFrame, as_of) -> DataFrame:
    since = flows.filter(F.col("flow_date") >= dates.period_start(as_of, "year"))
    return _net_by(since, "fund_category").orderBy(F.desc_nulls_last("net_flows"), "fund_category")


def top_inflow_last_month(flows: DataFrame, as_of, k: int = 1) -> DataFrame:
    month = flows.filter(
        (F.col("flow_date") >= dates.period_start(as_of, "month", back=1))
        & (F.col("flow_date") < dates.period_start(as_of, "month"))
    )
    per_fund = month.groupBy("fund_id", "fund_name").agg(amount_of("INFLOW").alias("inflows"))
    return top_k(per_fund, [F.desc_nulls_last("inflows"), F.asc("fund_id")], k)


def top_outflow_advisors(flows: DataFrame, k: int = 10) -> DataFrame:
    per_advisor = (
        flows.filter(F.col("flow_type") == "OUTFLOW")
        .groupBy("advisor_id", "advisor_name")
        .agg(F.sum(F.abs("flow_amount")).alias("outflow"))
    )
    return top_k(per_advisor, [F.desc_nulls_last("outflow"), F.asc("advisor_id")], k)


def capture_by_territory(flows: DataFrame) -> DataFrame:
    return flows.groupBy("territory_name").agg(F.avg(F.col("capture_rate").cast("double")).alias("avg_capture_rate"))


def top_net_flow_advisor(flows: DataFrame, as_of, k: int = 1) -> DataFrame:
    per_advisor = (
        flows.filter(F.col("flow_date") >= dates.period_start(as_of, "quarter"))
        .groupBy("advisor_id", "advisor_name")
        .agg(F.sum("flow_amount").alias("net_flows"))
    )
    return top_k(per_advisor, [F.desc_nulls_last("net_flows"), F.asc("advisor_id")], k)
