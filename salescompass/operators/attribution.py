"""Daily fund flows attributed to advisor, fund and territory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import money
from salescompass.operators.skew import dimension_join, heavy_keys, skew_join

STATE_KEY = ["fund_id", "advisor_id", "territory_id", "flow_date", "flow_type"]
FLOW_GRAIN = ["fund_id", "advisor_id", "territory_name", "flow_date", "flow_type"]


def flow_totals(flows: DataFrame, territories: DataFrame, dealt_by: str | None = None) -> DataFrame:
    """Net amount and count at the grain of the fact, before any wide dimension is joined.

    The territory of the *flow* gives the name (small table, joined at the scan), so the
    rows entering the advisor and fund joins are already as few as they can be.  ``dealt_by`` is a
    column of the grain that a later join is on: the flows are shuffled by it once, for both.
    """
    names = territories.select("territory_id", "territory_name")
    named = dimension_join(flows, names, "territory_id").select(*FLOW_GRAIN, "flow_amount")
    return (
        (named.repartition(dealt_by) if dealt_by else named)
        .groupBy(*FLOW_GRAIN)
        .agg(F.sum("flow_amount").alias("net"), F.count(F.lit(1)).alias("tx"))
    )


def flow_attribution(
    flows: DataFrame, funds: DataFrame, advisors: DataFrame, territories: DataFrame, engagement: DataFrame
) -> DataFrame:
    """Fund x advisor x day x flow type: net flow, transactions and capture rate.

    Flows without a fund, advisor or territory drop out (inner joins); an advisor without
    an engagement row keeps a null capture rate.  ``territory_id`` is the advisor's.
    """
    # advisors and their scores are both one row per advisor: join them to each other
    # first, so the facts are shuffled by advisor once
    scored = advisors.select("advisor_id", "advisor_name", "territory_id").join(
        engagement.select("advisor_id", "aum_amount"), "advisor_id", "left"
    )
    # copies of a dimension row count as often as they are there; the dimensions are counted, not the
    # joined facts, which are as many as the flows and wide
    scored = scored.groupBy(*scored.columns).agg(F.count(F.lit(1)).alias("advisor_rows"))
    named_funds = funds.select("fund_id", "fund_name", "fund_category")
    named_funds = named_funds.groupBy(*named_funds.columns).agg(F.count(F.lit(1)).alias("fund_rows"))
    heavy = heavy_keys(flows, "advisor_id", "fund_id")
    # a crowded advisor is summed up by the whole grain, and spread by the join
    joined = flow_totals(flows, territories, None if heavy["advisor_id"] else "advisor_id")
    joined = skew_join(joined, scored, "advisor_id", heavy=heavy["advisor_id"])
    joined = skew_join(joined, named_funds, "fund_id", heavy=heavy["fund_id"])
    grain = [
        "fund_id", "fund_name", "fund_category", "advisor_id", "advisor_name", "territory_id",
        "territory_name", "flow_date", "flow_type",
    ]
    copies = F.col("advisor_rows") * F.col("fund_rows")
    totals = joined.select(
        *grain, "aum_amount", (F.col("net") * copies.cast("decimal(10,0)")).cast("decimal(28,2)").alias("flow_amount"),
        (F.col("tx") * copies).alias("transaction_count"),
    )
    rate = money.percent_of(F.abs("flow_amount"), F.col("aum_amount"), 4).cast("decimal(28,4)")
    return totals.select(*grain, "flow_amount", "transaction_count", rate.alias("capture_rate"))


def flow_state(flows: DataFrame) -> DataFrame:
    """Additive state of the flow facts: one row per advisor, fund, day and type."""
    return flows.groupBy(*STATE_KEY).agg(
        F.sum("flow_amount").cast("decimal(28,2)").alias("flow_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def merge_flow_batch(state: DataFrame, batch: DataFrame, summed: bool = False) -> DataFrame:
    """State after one more batch of raw flows (or of its sums); sums and counts are additive."""
    return (
        state.unionByName(batch if summed else flow_state(batch))
        .groupBy(*STATE_KEY)
        .agg(
            F.sum("flow_amount").cast("decimal(28,2)").alias("flow_amount"),
            F.sum("transaction_count").alias("transaction_count"),
        )
    )
