"""Metric layer: facts, dimensions and metrics of three logical tables.

The registry is plain data; ``metric_query`` turns a choice of metrics, dimensions and
filters into one filter-group-aggregate plan over one table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescompass.operators.rows import latest_snapshot

_AGGREGATES = {"sum": F.sum, "avg": lambda c: F.avg(c.cast("double"))}


@dataclass(frozen=True)
class Fact:
    name: str
    default_aggregation: str


@dataclass(frozen=True)
class Dimension:
    name: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    name: str
    aggregation: str
    fact: str
    synonyms: tuple[str, ...] = ()

    def column(self) -> Column:
        return _AGGREGATES[self.aggregation](F.col(self.fact)).alias(self.name)


@dataclass(frozen=True)
class LogicalTable:
    facts: tuple[Fact, ...]
    dimensions: tuple[Dimension, ...]
    metrics: tuple[Metric, ...]
    snapshot: str | None = None  # the date of a run, in tables whose rows are a state and not a flow

    def metric(self, name: str) -> Metric:
        return next(m for m in self.metrics if m.name == name)


# --- fixed values: names, aggregations and synonyms of the metric layer ---------------
SEMANTIC: dict[str, LogicalTable] = {
    "advisor_eng": LogicalTable(
        facts=(
            Fact("aum_amount", "sum"),
            Fact("engagement_score", "avg"),
            Fact("call_count_30d", "sum"),
            Fact("meeting_count_30d", "sum"),
            Fact("open_opportunity_count", "sum"),
            Fact("open_opportunity_value", "sum"),
        ),
        dimensions=(
            Dimension("advisor_id"),
            Dimension("advisor_name", ("wholesaler", "rep", "financial advisor", "FA")),
            Dimension("territory_id"),
            Dimension("territory_name", ("region", "area", "zone", "district")),
            Dimension("advisor_tier", ("tier", "classification", "segment", "category")),
            Dimension("score_date"),
        ),
        metrics=(
            Metric("avg_engagement_score", "avg", "engagement_score",
                   ("engagement", "activity score", "interaction score", "contact score")),
            Metric("total_aum", "sum", "aum_amount",
                   ("AUM", "assets", "assets under management", "book size", "total AUM")),
            Metric("total_calls_30d", "sum", "call_count_30d", ("calls", "phone calls", "outbound calls")),
            Metric("total_meetings_30d", "sum", "meeting_count_30d",
                   ("meetings", "in-person meetings", "appointments")),
            Metric("total_open_opportunities", "sum", "open_opportunity_count",
                   ("open opportunities", "pipeline count", "deals")),
            Metric("total_pipeline_value", "sum", "open_opportunity_value",
                   ("pipeline value", "pipeline", "opportunity amount", "potential AUM")),
        ),
        snapshot="score_date",
    ),
    "fund_flows": LogicalTable(
        facts=(Fact("flow_amount", "sum"), Fact("capture_rate", "avg")),
        dimensions=(
            Dimension("fund_id"),
            Dimension("fund_name", ("fund", "product", "investment product", "vehicle")),
            Dimension("fund_category", ("asset class", "category", "type", "fund type")),
            Dimension("advisor_id"),
            Dimension("territory_id"),
            Dimension("flow_date"),
            Dimension("flow_type", ("direction", "flow direction", "in or out")),
        ),
        metrics=(
            Metric("net_flow_amount", "sum", "flow_amount",
                   ("flows", "net flows", "fund flows", "money in", "money out")),
            Metric("avg_capture_rate", "avg", "capture_rate", ("capture", "capture ratio", "market share")),
        ),
    ),
    "territory": LogicalTable(
        facts=(
            Fact("total_aum", "sum"),
            Fact("advisor_count", "sum"),
            Fact("avg_engagement_score", "avg"),
            Fact("net_flows_30d", "sum"),
            Fact("at_risk_advisor_count", "sum"),
            Fact("territory_heat_score", "avg"),
        ),
        dimensions=(
            Dimension("territory_id"),
            Dimension("territory_name", ("region", "area", "district", "territory")),
            Dimension("region", ("super-region", "geography", "geo")),
            Dimension("territory_mgr", ("manager", "wholesaler", "territory owner", "rep")),
            Dimension("as_of_date"),
        ),
        metrics=(
            Metric("total_territory_aum", "sum", "total_aum", ("territory AUM", "book", "total assets")),
            Metric("total_advisor_count", "sum", "advisor_count",
                   ("advisor count", "number of advisors", "headcount")),
            Metric("avg_territory_engagement", "avg", "avg_engagement_score",
                   ("engagement", "territory engagement", "average score")),
            Metric("total_net_flows_30d", "sum", "net_flows_30d",
                   ("net flows", "recent flows", "flows this month", "monthly flows")),
            Metric("total_at_risk_advisors", "sum", "at_risk_advisor_count",
                   ("at-risk advisors", "churning advisors", "low engagement", "risk count")),
            Metric("avg_heat_score", "avg", "territory_heat_score",
                   ("heat score", "territory score", "health score")),
        ),
        snapshot="as_of_date",
    ),
}
# ----------------------------------------------------------------------------------------


def _of_run(logical: LogicalTable, df: DataFrame, dims: Sequence[str], all_runs: bool) -> DataFrame:
    """The newest run of a state table, unless the answer is by run date or all runs are asked for.

    A book counted at several dates must not be added up.
    """
    if logical.snapshot is None or all_runs or logical.snapshot in dims:
        return df
    return latest_snapshot(df, logical.snapshot)


def semantic_rows(table: str, df: DataFrame, all_runs: bool = False) -> DataFrame:
    """Row-level view of a logical table: its dimensions and facts only."""
    logical = SEMANTIC[table]
    return _of_run(logical, df, (), all_runs).select(*[d.name for d in logical.dimensions], *[f.name for f in logical.facts])


def _names(predicate: Column, column: str) -> bool:
    """Whether a condition mentions a column, by its text."""
    return re.search(rf"\b{column}\b", str(predicate)) is not None


def metric_query(
    table: str,
    df: DataFrame,
    metrics: Sequence[str],
    dims: Sequence[str] = (),
    filters: Sequence[Column] = (),
    all_runs: bool = False,
) -> DataFrame:
    """Metrics of one logical table by some of its dimensions.

    ``all_runs`` is for a filter that picks a run itself; without it, such a filter on a table of
    which only the newest run is read raises an error instead of finding nothing.
    """
    logical = SEMANTIC[table]
    by_run = logical.snapshot is not None and not all_runs and logical.snapshot not in dims
    if by_run and any(_names(predicate, logical.snapshot) for predicate in filters):
        raise ValueError(f"a filter on {logical.snapshot} picks a run: pass all_runs")
    unknown = set(dims) - {d.name for d in logical.dimensions}
    if unknown:
        raise ValueError(f"not dimensions of {table}: {sorted(unknown)}")
    df = _of_run(logical, df, dims, all_runs)
    for predicate in filters:
        df = df.filter(predicate)
    return df.groupBy(*dims).agg(*[logical.metric(m).column() for m in metrics])


def default_measures(table: str, df: DataFrame, dims: Sequence[str] = (), all_runs: bool = False) -> DataFrame:
    """Every fact of a logical table under its default aggregation."""
    logical = SEMANTIC[table]
    aggregates = [_AGGREGATES[f.default_aggregation](F.col(f.name)).alias(f.name) for f in logical.facts]
    return _of_run(logical, df, dims, all_runs).groupBy(*dims).agg(*aggregates)


def describe(spark: SparkSession) -> DataFrame:
    """The registry as rows: (logical_table, kind, name, aggregation, fact)."""
    rows = []
    for table, logical in SEMANTIC.items():
        rows += [(table, "fact", f.name, f.default_aggregation, f.name) for f in logical.facts]
        rows += [(table, "dimension", d.name, None, None) for d in logical.dimensions]
        rows += [(table, "metric", m.name, m.aggregation, m.fact) for m in logical.metrics]
    return spark.createDataFrame(rows, "logical_table string, kind string, name string, aggregation string, fact string")


def synonym_rows() -> list[tuple[str, str, str, str]]:
    """(term, logical table, kind, canonical name); a name also stands for itself."""
    rows = []
    for table, logical in SEMANTIC.items():
        for kind, members in (("dimension", logical.dimensions), ("metric", logical.metrics)):
            for member in members:
                terms = {member.name.lower(), *(s.lower() for s in member.synonyms)}
                rows += [(term, table, kind, member.name) for term in sorted(terms)]
    return rows


def synonyms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(synonym_rows(), "term string, logical_table string, kind string, canonical string")


def synonym_resolve(terms: DataFrame, known: DataFrame, column: str = "term") -> DataFrame:
    """Canonical names for a column of terms; a term with several meanings gives several rows.

    ``known`` is the registry above, a fixed list of about a hundred rows, so broadcasting it is
    bounded; terms without a meaning keep nulls.
    """
    keyed = terms.withColumn("_key", F.lower(F.trim(F.col(column))))
    meaning = known.select(F.col("term").alias("_key"), "logical_table", "kind", "canonical")
    return keyed.join(F.broadcast(meaning), "_key", "left").drop("_key")
