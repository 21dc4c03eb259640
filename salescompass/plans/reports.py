"""Dashboard, notebook and administration reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import dates, money, scoring
from salescompass.operators.rows import top_k
from salescompass.plans.verified import amount_of

DAILY_CREDIT_BUDGET = 10  # fixed value


# -- engagement and territory ---------------------------------------------------------
def kpi_overview(advisors: DataFrame) -> DataFrame:
    return advisors.agg(
        F.countDistinct("advisor_id").alias("total_advisors"),
        F.sum("aum_amount").alias("total_aum"),
        F.avg("engagement_score").alias("avg_engagement"),
        F.count_if(scoring.at_risk(F.col("engagement_score"))).alias("at_risk_advisors"),
        F.sum("open_opportunity_value").alias("total_pipeline"),
    )


def territory_overview(territories: DataFrame) -> DataFrame:
    return territories.orderBy(F.desc_nulls_last("total_aum"), "territory_name").select(
        "territory_name",
        money.millions(F.col("total_aum"), 1).alias("aum_millions"),
        F.round("avg_engagement_score", 1).alias("engagement_score"),
        money.millions(F.col("net_flows_30d"), 2).alias("net_flows_m"),
        "at_risk_advisor_count",
        "advisor_count",
    )


def territory_heat_list(territories: DataFrame) -> DataFrame:
    return territories.select(
        "territory_name",
        "region",
        "territory_mgr",
        money.millions(F.col("total_aum"), 1).alias("aum_m"),
        F.round("avg_engagement_score", 1).alias("avg_engagement"),
        money.millions(F.col("net_flows_30d"), 2).alias("net_flows_m"),
        "advisor_count",
        "at_risk_advisor_count",
        F.round("territory_heat_score", 1).alias("heat_score"),
    ).orderBy(F.desc_nulls_last("heat_score"), "territory_name")


def territory_heat_band(territories: DataFrame) -> DataFrame:
    score = F.round("territory_heat_score", 1)
    return territories.select(
        "territory_name", score.alias("heat_score"), scoring.heat_band(score).alias("heat_band")
    )


def advisor_list(advisors: DataFrame, territory: str | None = None, tier: str | None = None, k: int = 100) -> DataFrame:
    """Optional filters are column predicates, never text spliced into SQL."""
    for column, wanted in (("territory_name", territory), ("advisor_tier", tier)):
        if wanted is not None:
            advisors = advisors.filter(F.col(column) == F.lit(wanted))
    return top_k(advisors, [F.desc_nulls_last("aum_amount"), F.asc("advisor_id")], k).select(
        "advisor_name",
        "territory_name",
        F.col("advisor_tier").alias("tier"),
        F.round("engagement_score", 1).alias("engagement_score"),
        money.millions(F.col("aum_amount"), 2).alias("aum_millions"),
        "call_count_30d",
        "meeting_count_30d",
        "open_opportunity_count",
        money.millions(F.col("open_opportunity_value"), 2).alias("pipeline_millions"),
        "days_since_last_activity",
    )


def distinct_territories(territories: DataFrame) -> DataFrame:
    return territories.select("territory_name").distinct().orderBy("territory_name")


def risk_candidates(advisors: DataFrame, k: int = 20) -> DataFrame:
    return top_k(advisors, [F.desc_nulls_last("aum_amount"), F.asc("advisor_id")], k).select(
        "advisor_id", "advisor_name", "advisor_tier", "engagement_score", "call_count_30d", "meeting_count_30d",
        "days_since_last_activity", "aum_amount",
    )


def engagement_board(advisors: DataFrame, k: int = 10) -> DataFrame:
    return top_k(advisors, [F.desc_nulls_last("aum_amount"), F.asc("advisor_id")], k).select(
        "advisor_name", "territory_name", F.col("advisor_tier").alias("tier"), "engagement_score", "aum_amount",
        "open_opportunity_value", "call_count_30d", "meeting_count_30d",
    )


# -- flows and opportunities ------------------------------------------------------------
def flows_last_30d(flows: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        flows.filter(F.col("flow_date") >= F.date_sub(dates.day(as_of), days))
        .groupBy("fund_name", "fund_category")
        .agg(
            (amount_of("INFLOW") / 1_000_000).alias("inflows_m"),
            (amount_of("OUTFLOW", F.abs("flow_amount")) / 1_000_000).alias("outflows_m"),
            (F.sum("flow_amount") / 1_000_000).alias("net_flows_m"),
            F.countDistinct("advisor_id").alias("contributing_advisors"),
        )
        .orderBy(F.desc_nulls_last("net_flows_m"), "fund_name", "fund_category")
    )


def flow_by_fund_type(flows: DataFrame, as_of, k: int = 10) -> DataFrame:
    per_type = (
        flows.filter(F.col("flow_date") >= dates.period_start(as_of, "quarter"))
        .groupBy("fund_name", "fund_category", "flow_type")
        .agg(F.sum("flow_amount").alias("net_flow"), F.countDistinct("advisor_id").alias("advisors"))
    )
    order = [F.abs("net_flow").desc_nulls_last(), F.asc("fund_name"), F.asc("fund_category"), F.asc("flow_type")]
    return top_k(per_type, order, k)


def top_opportunities(opps: DataFrame, k: int = 10) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return top_k(opps, [F.desc_nulls_last("amount"), F.asc("opportunity_id")], k).select(
        "opportunity_id",
        "advisor_id",
        "stage",
        money.millions(F.coalesce("amount", zero), 2).alias("amount_m"),
        "close_date",
        F.col("row_timestamp").alias("last_updated"),
    )


def ingest_freshness(events: DataFrame, as_of, hours: int = 24) -> DataFrame:
    return (
        events.filter(F.col("row_timestamp") >= dates.before(as_of, hours=hours))
        .agg(
            F.max("row_timestamp").alias("latest_event"),
            F.count(F.lit(1)).alias("total_events_24h"),
            F.countDistinct("advisor_id").alias("unique_advisors"),
        )
        .withColumn("seconds_lag", dates.seconds_between(F.col("latest_event"), as_of))
    )


# -- administration ---------------------------------------------------------------------
def table_counts(tables: dict[str, DataFrame], label: str = "tbl") -> DataFrame:
    """One row per table.  Counts need no columns, so Parquet answers from its footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(label)


def derived_table_health(tables: dict[str, DataFrame], target_lag: dict[str, str]) -> DataFrame:
    lag = F.create_map(*[F.lit(x) for pair in target_lag.items() for x in pair])
    return table_counts(tables, "table_name").withColumn(
        "target_lag", F.concat(F.lit("Target: "), F.element_at(lag, F.col("table_name")))
    )


def alert_history(alerts: DataFrame, as_of, hours: int = 24, k: int = 20) -> DataFrame:
    recent = alerts.filter(
        (F.col("schema_name") == "DISTRIBUTION") & (F.col("scheduled_time") >= dates.before(as_of, hours=hours))
    )
    return top_k(recent, [F.desc("scheduled_time"), F.asc("name")], k).select(
        F.col("name").alias("alert_name"), "schema_name", "scheduled_time", "state"
    )


def usage_by_service(usage: DataFrame, as_of, budget: int = DAILY_CREDIT_BUDGET) -> DataFrame:
    """Credits and calls of one day per service, and the share of the daily budget used."""
    per_service = (
        usage.filter(F.col("usage_date") == dates.day(as_of))
        .groupBy("service_type")
        .agg(F.sum("credits_used").alias("credits_used"), F.count(F.lit(1)).alias("api_calls"))
    )
    share = F.least(F.lit(1.0), F.col("credits_used").cast("double") / budget)
    return per_service.withColumn("budget_share", share)
