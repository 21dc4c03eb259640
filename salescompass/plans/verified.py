"""The ten approved queries over the derived tables.

Each takes the tables it reads (``advisor_eng``, ``fund_flows``, ``territory``) and, where
time matters, an explicit ``as_of``.  Top-k queries end in an id so ties are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import dates, money, scoring
from salescompass.operators.rows import latest_snapshot, top_k

Tables = Mapping[str, DataFrame]

# logical table -> workspace table; views of the same names serve SQL text
LOGICAL_TABLES = {
    "advisor_eng": "advisor_engagement_history",
    "fund_flows": "fund_flow_attribution",
    "territory": "territory_heat_map",
}
VIEWS = {f"__{logical}": table for logical, table in LOGICAL_TABLES.items()}


def current_advisors(tables: Tables) -> DataFrame:
    return latest_snapshot(tables["advisor_eng"], "score_date")


def current_territories(tables: Tables) -> DataFrame:
    return latest_snapshot(tables["territory"], "as_of_date")


def this_quarter(tables: Tables, as_of) -> DataFrame:
    return tables["fund_flows"].filter(F.col("flow_date") >= dates.period_start(as_of, "quarter"))


def _by_aum():
    return [F.desc_nulls_last("aum_amount"), F.asc("advisor_id")]


def top_advisors_by_aum(tables: Tables, as_of=None, k: int = 10) -> DataFrame:
    return top_k(current_advisors(tables), _by_aum(), k).select(
        "advisor_name", "territory_name", F.col("advisor_tier").alias("tier"), "aum_amount", "engagement_score"
    )


def territory_performance_ranking(tables: Tables, as_of=None) -> DataFrame:
    return (
        current_territories(tables)
        .select(
            "territory_name", "region", "net_flows_30d", "total_aum", "avg_engagement_score", "at_risk_advisor_count"
        )
        .orderBy(F.desc_nulls_last("net_flows_30d"), "territory_name")
    )


def at_risk_advisors(tables: Tables, as_of=None) -> DataFrame:
    return (
        current_advisors(tables)
        .filter(scoring.at_risk(F.col("engagement_score")))
        .orderBy(*_by_aum())
        .select(
            "advisor_name", "territory_name", F.col("advisor_tier").alias("tier"), "engagement_score", "aum_amount",
            "open_opportunity_value", "call_count_30d", "meeting_count_30d",
        )
    )


def fund_flows_by_category(tables: Tables, as_of) -> DataFrame:
    return (
        this_quarter(tables, as_of)
        .groupBy("fund_category", "fund_name")
        .agg(F.sum("flow_amount").alias("net_flows"), F.countDistinct("advisor_id").alias("advisor_count"))
        .orderBy(F.desc_nulls_last("net_flows"), "fund_category", "fund_name")
    )


def pipeline_by_territory(tables: Tables, as_of=None) -> DataFrame:
    return (
        current_advisors(tables)
        .groupBy("territory_name")
        .agg(
            F.sum("open_opportunity_count").alias("total_opportunities"),
            F.sum("open_opportunity_value").alias("total_pipeline_value"),
            F.avg("engagement_score").alias("avg_engagement"),
        )
        .orderBy(F.desc_nulls_last("total_pipeline_value"), "territory_name")
    )


def advisor_engagement_trend(tables: Tables, as_of, days: int = 90) -> DataFrame:
    return (
        tables["advisor_eng"]
        .filter(F.col("score_date") >= F.date_sub(dates.day(as_of), days))
        .groupBy("score_date")
        .agg(
            F.avg("engagement_score").alias("avg_score"),
            F.countDistinct("advisor_id").alias("active_advisors"),
            F.sum("aum_amount").alias("total_aum"),
        )
        .orderBy("score_date")
    )


def amount_of(flow_type: str, amount="flow_amount"):
    """Conditional sum of one flow type."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(F.when(F.col("flow_type") == flow_type, column).otherwise(F.lit(0).cast("decimal(28,2)")))


def top_funds_by_inflows(tables: Tables, as_of, k: int = 10) -> DataFrame:
    per_fund = (
        this_quarter(tables, as_of)
        .groupBy("fund_name", "fund_category")
        .agg(
            amount_of("INFLOW").alias("total_inflows"),
            amount_of("OUTFLOW").alias("total_outflows"),
            F.sum("flow_amount").alias("net_flows"),
            F.countDistinct("advisor_id").alias("contributing_advisors"),
        )
    )
    return top_k(per_fund, [F.desc_nulls_last("total_inflows"), F.asc("fund_name"), F.asc("fund_category")], k)


def platinum_advisor_summary(tables: Tables, as_of=None) -> DataFrame:
    return (
        current_advisors(tables)
        .filter(F.col("advisor_tier") == "PLATINUM")
        .groupBy("territory_name")
        .agg(
            F.count(F.lit(1)).alias("platinum_count"),
            F.sum("aum_amount").alias("total_aum"),
            F.avg("engagement_score").alias("avg_engagement"),
            F.sum("open_opportunity_value").alias("total_pipeline"),
        )
        .orderBy(F.desc_nulls_last("total_aum"), "territory_name")
    )


def low_activity_high_aum(tables: Tables, as_of=None, aum_over: int = 2_000_000, contacts_under: int = 2, k: int = 20):
    quiet = current_advisors(tables).filter(
        (F.col("aum_amount") > aum_over)
        & ((F.col("call_count_30d") + F.col("meeting_count_30d")) < contacts_under)
    )
    return top_k(quiet, _by_aum(), k).select(
        "advisor_name", "territory_name", F.col("advisor_tier").alias("tier"), "aum_amount", "engagement_score",
        "call_count_30d", "meeting_count_30d", "open_opportunity_count",
    )


def territory_comparison(tables: Tables, as_of=None, names=("AMERICA", "ASIA")) -> DataFrame:
    return (
        current_territories(tables)
        .filter(F.col("territory_name").isin(*names))
        .select(
            "territory_name", "total_aum", "advisor_count", "avg_engagement_score", "net_flows_30d",
            "at_risk_advisor_count",
            money.percent_of(F.col("net_flows_30d"), F.col("total_aum"), 2).alias("flow_rate_pct"),
        )
        .orderBy("territory_name")
    )


VERIFIED: dict[str, Callable[..., DataFrame]] = {
    fn.__name__: fn
    for fn in (
        top_advisors_by_aum, territory_performance_ranking, at_risk_advisors, fund_flows_by_category,
        pipeline_by_territory, advisor_engagement_trend, top_funds_by_inflows, platinum_advisor_summary,
        low_activity_high_aum, territory_comparison,
    )
}
