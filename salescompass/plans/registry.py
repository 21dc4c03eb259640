"""Every query by name, as a function of a workspace."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures.messages import DELIVERIES, deliveries
from salescompass.functions import dates, money, scoring, text
from salescompass.operators import alerts, attribution, distinct, engagement, postings, quality, rows, search, vectors
from salescompass.operators.classify import classify
from salescompass.operators.skew import spread
from salescompass.plans import context, derived, questions, reports, rollups, semantic
from salescompass.plans.verified import LOGICAL_TABLES, VERIFIED, VIEWS, current_advisors, current_territories
from salescompass.session import digest
from salescompass.sources import sinks, telemetry
from salescompass.sources.workspace import Workspace, define
from salescompass.streaming import ingest, refresh, segments, silence, sliding

Query = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


class _Logical(Mapping):
    """Logical tables by name; a table is built when it is asked for."""

    def __init__(self, ws: Workspace):
        self.ws = ws

    def __getitem__(self, name: str) -> DataFrame:
        return self.ws.table(LOGICAL_TABLES[name])

    def __iter__(self):
        return iter(LOGICAL_TABLES)

    def __len__(self) -> int:
        return len(LOGICAL_TABLES)


def _advisors(ws: Workspace) -> DataFrame:
    return current_advisors(_Logical(ws))


def _territories(ws: Workspace) -> DataFrame:
    return current_territories(_Logical(ws))


def _attributed(ws: Workspace) -> DataFrame:
    return ws.table("fund_flow_attribution")


def _flows_now(ws: Workspace):
    return ws.as_of("fund_flows")


def _events_now(ws: Workspace):
    return ws.as_of("advisor_events")


def _checked_at(ws: Workspace):
    """When checks of freshness run: at the close of the last day with recorded usage, not at the newest event."""
    return dt.datetime.combine(ws.as_of("usage_history") + dt.timedelta(days=1), dt.time())


# -- landing tables -----------------------------------------------------------------------
_COUNTED = ["territory_dim", "fund_dim", "advisor_dim", "advisor_events", "fund_flows", "opportunity"]


@query("scan_staging_counts")
def _(ws):
    return reports.table_counts({name: ws.table(name) for name in _COUNTED})


@query("landing_layout")
def _(ws):
    """Events written clustered by territory and day, profiled from the written table."""

    def write(path):
        events = ws.table("located_events").withColumn("event_date", F.to_date("event_timestamp"))
        keys = ["territory_id", "event_date"]
        sinks.write_balanced(events, path, keys, keys, ["territory_id"])

    written = ws.stored("clustered_events", write)
    return written.groupBy("territory_id", "event_date").agg(F.count(F.lit(1)).alias("events"))


@query("load_append")
def _(ws):
    """Insert-from-query: two loads appended to one table, then read back."""

    def write(path):
        flows = ws.table("fund_flows")
        inflow = F.col("flow_type").eqNullSafe("INFLOW")
        for kept in (inflow, ~inflow):
            sinks.append(sinks.stamped(flows.filter(kept).select("flow_type", "share_class", "flow_amount")), path)

    loaded = ws.stored("appended_flows", write)
    return loaded.groupBy("flow_type", "share_class").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.sum("flow_amount").alias("amount")
    )


@query("zero_copy_opportunities")
def _(ws):
    """The opportunity table taken from an external name instead of the landing files."""
    ws.table("opportunity").createOrReplaceTempView("shared_opportunity")
    shared = Workspace(ws.spark, ws.source_dir, {"opportunity": lambda: ws.spark.table("shared_opportunity")})
    return engagement.opportunity_summary(shared.table("opportunity"))


@query("row_numbering")
def _(ws):
    numbered = rows.number_rows(ws.source("events").select("event_id", "ts"), "event_id", position=F.monotonically_increasing_id())
    return numbered.select("event_id", "n", F.concat(F.lit("Event_"), F.lpad(F.col("n").cast("string"), 9, "0")).alias("label"))


@query("row_expansion")
def _(ws):
    return rows.repeat_rows(ws.table("advisor_dim").select("advisor_id", "tier"), 15)


@query("shuffled_load")
def _(ws):
    return rows.shuffle_rows(ws.table("opportunity").select("opportunity_id", "stage"), seed=7)


# -- domain operators -----------------------------------------------------------------------
@query("activity_counts")
def _(ws):
    return engagement.activity_counts(ws.table("advisor_events"), _events_now(ws))


@query("opportunity_summary")
def _(ws):
    return engagement.opportunity_summary(ws.table("opportunity"))


@query("aum_summary")
def _(ws):
    return engagement.aum_summary(ws.table("fund_flows"), _flows_now(ws))


@query("dt_advisor_engagement_score")
def _(ws):
    return ws.table("advisor_engagement_score").drop("computed_at")


@query("dt_fund_flow_attribution")
def _(ws):
    return ws.table("fund_flow_attribution")


@query("dt_territory_heat_map")
def _(ws):
    return ws.table("territory_heat_map")


@query("territory_heat_map_30d")
def _(ws):
    """The heat map with a true 30-day flow window."""
    return derived.territory_heat_map(
        ws.table("territory_dim"), _advisors(ws), ws.table("fund_flows"), window_days=30, as_of=_flows_now(ws)
    )


@query("latest_snapshot")
def _(ws):
    return _advisors(ws).select("advisor_id", "score_date", "engagement_score")


@query("pipeline_signals")
def _(ws):
    return engagement.pipeline_signals(ws.table("advisor_dim"), ws.table("territory_dim"), ws.table("opportunity"))


_RISK_COLUMNS = ["advisor_id", "advisor_name", "advisor_tier", "engagement_score", "attrition_risk"]


@query("attrition_risk")
def _(ws):
    return engagement.attrition_risk(_advisors(ws)).select(*_RISK_COLUMNS)


@query("attrition_risk_top20")
def _(ws):
    return engagement.attrition_risk(reports.risk_candidates(_advisors(ws)))


@query("pandas_udf_classify")
def _(ws):
    high_score, low_score = scoring.ATTRITION_HIGH_SCORE, scoring.ATTRITION_LOW_SCORE
    idle_days, recent_days = scoring.ATTRITION_IDLE_DAYS, scoring.ATTRITION_RECENT_DAYS
    large_aum = scoring.ATTRITION_LARGE_AUM

    def rule(batch):
        score, days = batch["engagement_score"], batch["days_since_last_activity"]
        high = (score < high_score) | ((days > idle_days) & (batch["aum"] > large_aum))
        low = (score > low_score) & (days <= recent_days)
        return high.map({True: " high", False: None}).fillna(low.map({True: "low ", False: "medium"}))

    inputs = _advisors(ws).withColumn("aum", F.col("aum_amount").cast("double"))
    columns = ["engagement_score", "days_since_last_activity", "aum"]
    return classify(inputs, rule, columns, "attrition_risk").select(*_RISK_COLUMNS)


@query("territory_heat_band")
def _(ws):
    return reports.territory_heat_band(_territories(ws))


@query("brief_context")
def _(ws):
    return context.brief_context(_advisors(ws), _territories(ws))


@query("territory_brief_context")
def _(ws):
    return context.territory_brief_context(_territories(ws))


@query("attrition_prompt_text")
def _(ws):
    return context.attrition_text(_advisors(ws))


# -- scalar functions -------------------------------------------------------------------------
@query("scalar_dates")
def _(ws):
    now = _events_now(ws)
    ts = F.col("event_timestamp")
    return ws.table("advisor_events").select(
        "event_id",
        dates.days_between(ts, now).alias("days_ago"),
        dates.seconds_between(ts, now).alias("seconds_ago"),
        F.date_trunc("day", ts).cast("date").alias("event_day"),
        F.trunc(F.to_date(ts), "quarter").alias("quarter"),
        dates.months_before(ts, 12).alias("year_before"),
        (ts + F.make_dt_interval(mins=F.lit(30))).alias("half_hour_later"),
    )


@query("scalar_strings")
def _(ws):
    number = F.substring("advisor_id", 2, 18)
    return ws.table("advisor_dim").select(
        "advisor_id",
        F.concat(F.lit("Advisor_"), F.lpad(number, 9, "0")).alias("label"),
        text.short_label(F.concat(F.lit("  "), F.lower("tier"))).alias("short_tier"),
        F.concat_ws("@", F.lower(F.col("advisor_name")), F.lit("example.com")).alias("email"),
    )


@query("scalar_json")
def _(ws):
    value = F.try_variant_get(F.try_parse_json("metadata"), "$.k", "int")
    return ws.table("advisor_events").select(
        "event_id",
        value.alias("k"),
        F.to_json(F.struct("event_type", value.alias("k"), "fund_id")).alias("as_json"),
    )


@query("scalar_clamp")
def _(ws):
    value = F.col("value")
    return ws.source("events").select(
        "event_id",
        scoring.clamp(value, 10.0, 100.0).alias("clamped"),
        F.abs(value - 50).alias("distance"),
        F.round(value / F.nullif(F.col("event_id") % 3, F.lit(0)), 4).alias("ratio"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("error")), F.lit("N/A")).alias("kind"),
    )


@query("money_format")
def _(ws):
    return _advisors(ws).select(
        "advisor_id",
        money.money_text(F.col("aum_amount")).alias("aum"),
        money.money_text(F.col("open_opportunity_value")).alias("pipeline"),
    )


# -- metric layer -----------------------------------------------------------------------------
METRIC_DIMENSION = {"advisor_eng": "territory_name", "fund_flows": "fund_category", "territory": "region"}


def _metric(table: str, name: str) -> Query:
    """Over the current book: the layer itself takes the newest run of a state table."""
    return lambda ws: semantic.metric_query(table, _Logical(ws)[table], [name], [METRIC_DIMENSION[table]])


for _table, _definition in semantic.SEMANTIC.items():
    for _m in _definition.metrics:
        QUERIES[f"metric_{_m.name}"] = _metric(_table, _m.name)
    QUERIES[f"semantic_facts_{_table}"] = lambda ws, t=_table: semantic.semantic_rows(t, _Logical(ws)[t])
    QUERIES[f"default_measures_{_table}"] = lambda ws, t=_table: semantic.default_measures(
        t, _Logical(ws)[t], [METRIC_DIMENSION[t]]
    )


@query("metric_query_advisor_eng")
def _(ws):
    return semantic.metric_query(
        "advisor_eng", _advisors(ws), [m.name for m in semantic.SEMANTIC["advisor_eng"].metrics],
        ["territory_name", "advisor_tier"], [F.col("advisor_tier").isin("PLATINUM", "GOLD")],
    )


@query("metric_query_fund_flows")
def _(ws):
    return semantic.metric_query(
        "fund_flows", _attributed(ws), ["net_flow_amount", "avg_capture_rate"], ["fund_category", "flow_type"],
        [F.col("flow_date") >= dates.months_before(_flows_now(ws), 12)],
    )


@query("metric_query_territory")
def _(ws):
    return semantic.metric_query(
        "territory", _territories(ws), [m.name for m in semantic.SEMANTIC["territory"].metrics], ["region"]
    )


@query("synonym_resolve")
def _(ws):
    """Each event asks for a term; count the questions per meaning."""
    asked = {"click": "Calls", "purchase": " meetings", "view": "phone calls", "signup": "AUM", "error": "region"}
    terms = F.create_map(*[F.lit(x) for pair in asked.items() for x in pair])
    questions_ = ws.source("events").select(F.element_at(terms, F.col("event_type")).alias("term"))
    asked_terms = questions_.groupBy("term").agg(F.count(F.lit(1)).alias("asked"))
    resolved = semantic.synonym_resolve(asked_terms, semantic.synonyms(ws.spark))
    return resolved.select("term", "logical_table", "kind", "canonical", "asked")


@query("logical_view_sql")
def _(ws):
    """SQL text over the logical table names."""
    ws.register_views(VIEWS)
    return ws.spark.sql(
        """
        SELECT territory_name, COUNT(*) AS flows, SUM(flow_amount) AS net_flows,
               (SELECT MAX(score_date) FROM __advisor_eng) AS score_date
        FROM __fund_flows GROUP BY territory_name
        """
    )


# -- approved queries ---------------------------------------------------------------------------
_QUARTERLY = {"fund_flows_by_category", "top_funds_by_inflows"}


def _verified(name: str) -> Query:
    now = _flows_now if name in _QUARTERLY else _events_now
    return lambda ws: VERIFIED[name](_Logical(ws), as_of=now(ws))


for _name in VERIFIED:
    QUERIES[f"vq_{_name}"] = _verified(_name)


# -- reports ------------------------------------------------------------------------------------
@query("kpi_overview")
def _(ws):
    return reports.kpi_overview(_advisors(ws))


@query("territory_overview")
def _(ws):
    return reports.territory_overview(_territories(ws))


@query("territory_heat_list")
def _(ws):
    return reports.territory_heat_list(_territories(ws))


@query("advisor_list")
def _(ws):
    return reports.advisor_list(_advisors(ws), territory="ASIA", tier="GOLD")


@query("advisor_list_unfiltered")
def _(ws):
    return reports.advisor_list(_advisors(ws))


@query("distinct_territories")
def _(ws):
    return reports.distinct_territories(ws.table("territory_heat_map"))


@query("engagement_board")
def _(ws):
    return reports.engagement_board(_advisors(ws))


@query("flows_last_30d")
def _(ws):
    return reports.flows_last_30d(_attributed(ws), _flows_now(ws))


@query("flow_by_fund_type")
def _(ws):
    return reports.flow_by_fund_type(_attributed(ws), _flows_now(ws))


@query("top_opportunities")
def _(ws):
    return reports.top_opportunities(ws.table("opportunity"))


@query("ingest_freshness")
def _(ws):
    return reports.ingest_freshness(ws.table("advisor_events"), _checked_at(ws))


@query("derived_table_health")
def _(ws):
    lag = {name: short for name, short in zip(derived.TARGET_LAG, ("1h", "1d", "4h"))}
    return reports.derived_table_health({name: ws.table(name) for name in lag}, lag)


@query("alert_history")
def _(ws):
    return reports.alert_history(ws.table("alert_history"), ws.as_of("alert_history"))


@query("alert_history_6h")
def _(ws):
    return reports.alert_history(ws.table("alert_history"), ws.as_of("alert_history"), hours=6)


@query("usage_by_service")
def _(ws):
    return reports.usage_by_service(ws.table("usage_history"), ws.as_of("usage_history"))


@query("telemetry_alerts")
def _(ws):
    return ws.table("alert_history").groupBy("name", "state").agg(
        F.count(F.lit(1)).alias("runs"), F.max("scheduled_time").alias("last_run")
    )


@query("telemetry_usage")
def _(ws):
    return ws.table("usage_history").groupBy("service_type", "usage_date").agg(
        F.sum("credits_used").alias("credits_used"), F.count(F.lit(1)).alias("calls")
    )


@query("telemetry_refreshes")
def _(ws):
    return ws.table("refresh_history").groupBy("name", "refresh_action").agg(
        F.count(F.lit(1)).alias("refreshes"), F.max("refresh_start_time").alias("last_start")
    )


# -- business questions ---------------------------------------------------------------------------
@query("top_pipeline_advisors")
def _(ws):
    return questions.top_pipeline_advisors(_advisors(ws))


@query("pipeline_this_quarter")
def _(ws):
    return questions.pipeline_this_quarter(
        ws.table("opportunity"), ws.table("advisor_dim"), ws.table("territory_dim"), ws.as_of("opportunity")
    )


@query("stale_opportunities")
def _(ws):
    return questions.stale_opportunities(ws.table("opportunity"), ws.as_of("opportunity"))


@query("win_rate")
def _(ws):
    return questions.win_rate(
        ws.table("opportunity"), ws.table("advisor_dim"), ws.table("fund_dim"), ws.table("territory_dim")
    )


@query("opp_to_aum")
def _(ws):
    return questions.opp_to_aum(_advisors(ws))


@query("top_engaged_in_territory")
def _(ws):
    return questions.top_engaged(_advisors(ws), territory="EUROPE", k=10)


@query("top_engaged")
def _(ws):
    return questions.top_engaged(_advisors(ws))


@query("no_calls_14d")
def _(ws):
    return questions.no_calls_14d(_advisors(ws), ws.table("advisor_events"), _events_now(ws))


@query("tier_compare")
def _(ws):
    return questions.tier_compare(_advisors(ws))


@query("net_flows_prev_quarter")
def _(ws):
    return questions.net_flows_prev_quarter(_attributed(ws), _flows_now(ws))


@query("most_at_risk_territory")
def _(ws):
    return questions.most_at_risk_territory(_territories(ws))


@query("territory_heat_rank")
def _(ws):
    return questions.territory_heat_rank(_territories(ws))


@query("engagement_drop")
def _(ws):
    return questions.engagement_drop(ws.table("advisor_engagement_history"), _events_now(ws))


@query("net_flows_ytd")
def _(ws):
    return questions.net_flows_ytd(_attributed(ws), _flows_now(ws))


@query("top_inflow_last_month")
def _(ws):
    return questions.top_inflow_last_month(_attributed(ws), _flows_now(ws))


@query("top_outflow_advisors")
def _(ws):
    return questions.top_outflow_advisors(_attributed(ws))


@query("capture_by_territory")
def _(ws):
    return questions.capture_by_territory(_attributed(ws))


@query("top_net_flow_advisor")
def _(ws):
    return questions.top_net_flow_advisor(_attributed(ws), _flows_now(ws))


# -- data quality -----------------------------------------------------------------------------------
def _dq_of(ws: Workspace, metrics: set[str]) -> DataFrame:
    """The monitored checks of some metrics, all tables."""
    parts = []
    for table, (schema, checks) in quality.MONITORED.items():
        wanted = [c for c in checks if c[0] in metrics]
        if wanted:
            parts.append(quality.dq_report(ws.table(table), table, schema, wanted, _events_now(ws)))
    return alerts.alert_report(parts)


def _dq_results(ws: Workspace) -> DataFrame:
    """The stored results table: monitored checks plus orphaned events, written once."""

    def write(path):
        now = _events_now(ws)
        sinks.append(_dq_of(ws, {"NULL_COUNT", "DUPLICATE_COUNT", "ROW_COUNT"}), path)
        flow_keys = [("DUPLICATE_COUNT", "flow_id")]
        sinks.append(quality.dq_report(ws.table("fund_flows"), "fund_flows", "STAGING", flow_keys, now), path)
        orphans = quality.orphan_count(
            ws.table("advisor_events"), ws.table("advisor_dim"), "advisor_id", "advisor_events", "STAGING", now
        )
        sinks.append(orphans, path)

    return ws.stored("dq_results", write)


@query("dq_null_count")
def _(ws):
    return _dq_of(ws, {"NULL_COUNT"})


@query("dq_duplicate_count")
def _(ws):
    now = _events_now(ws)
    events = quality.dq_report(ws.table("advisor_events"), "advisor_events", "STAGING", [("DUPLICATE_COUNT", "event_id")], now)
    flows = quality.dq_report(ws.table("fund_flows"), "fund_flows", "STAGING", [("DUPLICATE_COUNT", "flow_id")], now)
    return events.unionByName(flows)


@query("dq_row_count")
def _(ws):
    return _dq_of(ws, {"ROW_COUNT"})


@query("dq_freshness")
def _(ws):
    checks = [("FRESHNESS", "row_timestamp"), ("FRESHNESS", "event_timestamp")]
    return quality.dq_report(ws.table("advisor_events"), "advisor_events", "STAGING", checks, _checked_at(ws))


@query("dq_report")
def _(ws):
    return _dq_results(ws)


@query("dq_status")
def _(ws):
    return quality.with_status(quality.recent_results(_dq_results(ws), _events_now(ws), k=50))


@query("dq_status_4h")
def _(ws):
    return quality.recent_results(_dq_results(ws), _events_now(ws), hours=4, k=20)


@query("dq_status_pattern")
def _(ws):
    return quality.with_pattern_status(quality.recent_results(_dq_results(ws), _events_now(ws)))


@query("dq_orphan_count")
def _(ws):
    return quality.orphan_count(
        ws.table("advisor_events"), ws.table("advisor_dim"), "advisor_id", "advisor_events", "STAGING", _events_now(ws)
    )


@query("engagement_daily_trend")
def _(ws):
    """Advisors, scores and books of every day of the last 91, by one sweep over the facts."""
    return derived.engagement_trend(ws, 91).groupBy("score_date").agg(
        F.count(F.lit(1)).alias("advisors"), F.avg("engagement_score").alias("avg_engagement"),
        F.count_if(scoring.at_risk(F.col("engagement_score"))).alias("at_risk"), F.sum("call_count_30d").alias("calls"),
        F.sum("aum_amount").cast("decimal(38,4)").alias("aum"), F.sum("open_opportunity_value").alias("pipeline"),
    )


def _rollups(ws: Workspace, table: str, pairs: list[tuple[str, str]]) -> rollups.Rollups:
    def write(name: str, summed: DataFrame) -> DataFrame:
        return ws.stored(name, lambda path: rollups.write_rollups(summed, path))

    return ws.once(f"rollups:{table}", lambda: rollups.build_rollups(table, ws.table(LOGICAL_TABLES[table]), pairs, write))


def _metric_pairs(ws: Workspace, table: str, dims: list[str], metrics: list[str]) -> DataFrame:
    """Metrics at every pair of dimensions, from the stored rollups."""
    pairs = list(combinations(dims, 2))
    stored = _rollups(ws, table, pairs)
    each = [
        rollups.rollup_query(stored, metrics, pair).select(
            F.lit("/".join(pair)).alias("dimensions"), *[F.col(d).cast("string").alias(n) for d, n in zip(pair, ("first", "second"), strict=True)],
            *[F.col(m).cast("double").alias(m) for m in metrics],
        )
        for pair in pairs
    ]
    return reduce(DataFrame.unionByName, each)


@query("metric_rollup_advisor")
def _(ws):
    dims = ["territory_name", "advisor_tier", "territory_id", "score_date"]
    return _metric_pairs(ws, "advisor_eng", dims, ["total_aum", "avg_engagement_score", "total_calls_30d"])


@query("metric_rollup_flows")
def _(ws):
    return _metric_pairs(ws, "fund_flows", ["fund_category", "flow_type", "territory_id"], ["net_flow_amount", "avg_capture_rate"])


def _advisor_sets(ws: Workspace) -> DataFrame:
    """Which advisors had events in a territory on a day, as bitmaps."""
    numbers = ws.stored("advisor_numbers", lambda path: sinks.overwrite(distinct.numbered_keys(ws.table("advisor_events"), "advisor_id"), path))
    rows = ws.table("located_events").select("territory_id", F.to_date("event_timestamp").alias("day"), "event_type", "advisor_id")
    return ws.stored("advisor_sets", lambda path: sinks.overwrite(distinct.bitmap_sets(rows, numbers, "advisor_id", ["territory_id", "day", "event_type"]), path))


@query("distinct_bitmap_advisors")
def _(ws):
    """Exact distinct advisors by territory and month, type, territory and overall, all from the same stored bitmaps."""
    sets = _advisor_sets(ws).withColumn("month", F.date_format("day", "yyyy-MM"))
    none = F.lit(None).cast("string")
    each = []
    for by in (["territory_id", "month"], ["event_type"], ["territory_id"], []):
        counts = distinct.distinct_count(sets, by, "advisors")
        each.append(counts.select(F.lit("/".join(by) or "all").alias("by"), *[F.col(c) if c in by else none.alias(c) for c in ("territory_id", "month", "event_type")], "advisors"))
    return reduce(DataFrame.unionByName, each)


def _bucketed(ws: Workspace, name: str, rows: DataFrame) -> DataFrame:
    """Rows per advisor and day as a bucketed table."""
    table = f"{name}_{digest(ws.path(name))}"
    ws.once(f"bucketed:{name}", lambda: sinks.write_bucketed(rows, table, ws.path(f"bucketed/{name}"), "advisor_id", 16))
    return ws.spark.table(table)


def _advisor_days(ws: Workspace) -> tuple[DataFrame, DataFrame]:
    events = ws.table("advisor_events").groupBy("advisor_id", F.to_date("event_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    flows = ws.table("fund_flows").groupBy("advisor_id", "flow_date").agg(F.sum("flow_amount").cast("decimal(28,2)").alias("net"))
    return _bucketed(ws, "event_days", events), _bucketed(ws, "flow_days", flows)


@query("bucketed_engagement_join")
def _(ws):
    """Events and flows of the advisors that have both, joined and summed bucket by bucket."""
    events, flows = _advisor_days(ws)
    active = events.groupBy("advisor_id").agg(F.sum("events").alias("events"), F.count(F.lit(1)).alias("active_days"))
    booked = flows.groupBy("advisor_id").agg(F.sum("net").cast("decimal(28,2)").alias("net_flow"), F.count(F.lit(1)).alias("flow_days"))
    return active.join(booked, "advisor_id")


# -- alerts -----------------------------------------------------------------------------------------
ALERTS: dict[str, Query] = {
    "alert_events_stale": lambda ws: alerts.events_stale(ws.table("advisor_events"), _checked_at(ws)),
    "alert_high_attrition": lambda ws: alerts.high_attrition(ws.table("advisor_engagement_score"), _events_now(ws)),
    "alert_fund_outflows": lambda ws: alerts.fund_outflows(ws.table("fund_flows"), _flows_now(ws)),
    "alert_usage_budget": lambda ws: alerts.usage_budget(ws.table("usage_history"), ws.as_of("usage_history")),
    "alert_full_refresh": lambda ws: alerts.full_refresh(ws.table("refresh_history"), ws.as_of("refresh_history")),
}
QUERIES.update(ALERTS)


@query("stale_territories")
def _(ws):
    return alerts.events_stale_by(ws.table("located_events"), "territory_id")


@query("alert_report")
def _(ws):
    return alerts.alert_report([condition(ws) for condition in ALERTS.values()])


def _alert_history(ws: Workspace) -> DataFrame:
    """Recorded alert runs, and the run of our own conditions appended to them."""

    def write(path):
        sinks.append(alerts.as_history(QUERIES["alert_report"](ws), _checked_at(ws)), path)

    return telemetry.alert_history(ws.spark, ws.source_dir).unionByName(ws.stored("alert_runs", write))


define("alert_history", _alert_history)


# -- streaming --------------------------------------------------------------------------------------
def _feed(ws: Workspace) -> str:
    """Message files, a folder for each delivery."""

    def write() -> str:
        path = ws.path("message_feed")
        # AQE cuts a delivery into files of even size, so no task sorts a whole one
        sent = deliveries(ws.table("located_events")).hint("rebalance", "delivery")
        sent.write.mode("overwrite").partitionBy("delivery").text(path)
        return path

    return ws.once("message_feed", write)


def _ingest(ws: Workspace, name: str) -> tuple[dict[str, str], Callable[[str], None]]:
    """Where the outputs of an ingest query are, and how it takes what is new in a folder of message files."""
    paths = {part: ws.path(f"{name}/{part}") for part in ("events", "dead_letters", "stats")}

    def take(feed: str) -> None:
        raw = ingest.read_files(ws.spark, feed).select("value")
        ingest.ingest_stream(
            raw, paths["events"], paths["dead_letters"], paths["stats"], ws.path(f"{name}/checkpoint")
        ).awaitTermination()

    return paths, take


def _ingested(ws: Workspace) -> dict[str, str]:
    """All deliveries taken at once."""

    def run() -> dict[str, str]:
        paths, take = _ingest(ws, "ingest")
        take(_feed(ws))
        return paths

    return ws.once("ingest", run)


def _ingested_by_delivery(ws: Workspace) -> dict[str, str]:
    """The deliveries taken one after the other, as they come into a growing folder."""

    def run() -> dict[str, str]:
        paths, take = _ingest(ws, "ingest_by_delivery")
        for delivery in range(DELIVERIES):
            sent = ws.spark.read.schema("value string, delivery int").text(_feed(ws)).filter(F.coalesce("delivery", F.lit(0)) == delivery)
            sent.select("value").write.mode("append").text(ws.path("growing_feed"))
            take(ws.path("growing_feed"))
        return paths

    return ws.once("ingest_by_delivery", run)


@query("stream_ingest")
def _(ws):
    landed = ingest.landed_events(ws.spark, _ingested(ws)["events"])
    return landed.withColumn("metadata", F.to_json("metadata"))


@query("stream_bad_records")
def _(ws):
    return ws.spark.read.parquet(_ingested(ws)["dead_letters"]).select("value", "error")


@query("stream_stats")
def _(ws):
    stats = ws.spark.read.parquet(_ingested(ws)["stats"])
    return stats.agg(*[F.sum(c).alias(c) for c in ("received", "inserted", "errors")])


@query("stream_dedup")
def _(ws):
    """One delivery per batch: repeats come in a later batch than their first, and first messages of earlier days come late."""
    landed = ingest.landed_events(ws.spark, _ingested_by_delivery(ws)["events"])
    return landed.select("event_id", "advisor_id", "territory_id", "event_type", "event_timestamp", "aum_amount")


def _refreshed(ws: Workspace) -> list[str]:
    """The engagement table rebuilt after each of two deliveries; the second brings the newest day.

    Each rebuild takes its "now" from the events landed by then.  Paths of the rebuilds, oldest first.
    """

    def run() -> list[str]:
        target, source = ws.path("refresh/engagement"), ws.path("refresh/events")
        events = ingest.landed_events(ws.spark, _ingested(ws)["events"])
        newest_day = F.date_trunc("day", events.agg(F.max("event_timestamp")).scalar())
        late = F.col("event_timestamp") >= newest_day

        def landed() -> DataFrame:
            return ws.spark.read.schema(events.schema).parquet(source)

        def now():
            return landed().agg(F.max("event_timestamp")).first()[0]

        def rebuild() -> DataFrame:
            return engagement.advisor_engagement(
                ws.table("advisor_dim"), ws.table("territory_dim"), landed(), ws.table("opportunity"), ws.table("fund_flows"),
                now(), _flows_now(ws),
            )

        for kept in (~late, late):
            sinks.append(events.filter(kept), source)
            changes = ws.spark.readStream.schema(events.schema).parquet(source)
            refresh.refresh_stream(
                changes, rebuild, target, ws.path("refresh/checkpoint"), history=ws.path("refresh/history"), as_of=now
            ).awaitTermination()
        return refresh.finished_versions(ws.spark, target)

    return ws.once("refresh", run)


@query("stream_refresh")
def _(ws):
    tables = [ws.spark.read.parquet(path).withColumn("delivery", F.lit(i + 1)) for i, path in enumerate(_refreshed(ws))]
    return reduce(DataFrame.unionByName, tables)


def _refresh_history(ws: Workspace) -> DataFrame:
    """Recorded refreshes, and those of our own stream."""
    _refreshed(ws)
    recorded = telemetry.refresh_history(ws.spark, ws.source_dir)
    return recorded.unionByName(ws.spark.read.parquet(ws.path("refresh/history")).select(*recorded.columns))


define("refresh_history", _refresh_history)


@query("stream_alert_stale")
def _(ws):
    """Every silence of a territory's events of 30 minutes; the events come in two deliveries."""

    def run() -> str:
        root = ws.path("silence")
        events = ws.table("located_events").select("territory_id", "event_timestamp")
        newest_day = F.date_trunc("day", events.agg(F.max("event_timestamp")).scalar())
        late = F.col("event_timestamp") >= newest_day
        for kept in (~late, late):
            sinks.append(events.filter(kept), f"{root}/feed")
            stream = ws.spark.readStream.schema(events.schema).parquet(f"{root}/feed")
            silence.silence_stream(stream, f"{root}/alerts", f"{root}/checkpoint", "territory_id", "event_timestamp").awaitTermination()
        return f"{root}/alerts"

    return ws.spark.read.parquet(ws.once("silence", run)).select("territory_id", "silent_since", "fired_at")


@query("incremental_engagement")
def _(ws):
    """The engagement table kept by adding and retracting: its rows after each of three deliveries.

    Events of every tenth id come one delivery late; flows come in the same three steps.
    """

    def run() -> list[tuple[str, object]]:
        root = ws.path("incremental_engagement")
        events, flows = ws.table("advisor_events"), ws.table("fund_flows")
        late = F.substring("event_id", 2, 18).cast("long") % 10 == 0
        event_days = [F.date_sub(dates.day(_events_now(ws)), back) for back in (20, 5)]
        flow_days = [F.date_sub(dates.day(_flows_now(ws)), back) for back in (400, 60)]
        day, sources = F.to_date("event_timestamp"), {}
        come = F.when(day < event_days[0], 0).when(day < event_days[1], 1).otherwise(2) + F.when(late, 1).otherwise(0)
        sources["activity"] = (events.select("advisor_id", "event_type", "event_timestamp", F.least(come, F.lit(2)).alias("delivery")), sliding.activity_window())
        come = F.when(F.col("flow_date") < flow_days[0], 0).when(F.col("flow_date") < flow_days[1], 1).otherwise(2)
        sources["flows"] = (flows.select("advisor_id", "flow_date", "flow_amount", come.alias("delivery")), sliding.flow_window())
        snapshots = []
        for delivery in range(3):
            for name, (rows, window) in sources.items():
                feed = f"{root}/{name}/feed"
                sinks.append(rows.filter(F.col("delivery") == delivery).drop("delivery"), feed)
                stream = ws.spark.readStream.schema(rows.drop("delivery").schema).parquet(feed)
                sliding.sliding_stream(stream, f"{root}/{name}/state", f"{root}/{name}/checkpoint", window).awaitTermination()
            activity, aum = (sliding.current(ws.spark, f"{root}/{name}/state") for name in sources)
            table = engagement.engagement_of(
                ws.table("advisor_dim"), ws.table("territory_dim"), activity.withColumnRenamed("last", "last_activity_timestamp"),
                engagement.opportunity_summary(ws.table("opportunity")), aum.filter("flows > 0").select("advisor_id", "total_flow_12m"),
                sliding.now_of(ws.spark, f"{root}/activity/state"),
            )
            snapshots.append(f"{root}/table/delivery={delivery}")
            sinks.overwrite(table, snapshots[-1])
        return snapshots

    paths = ws.once("incremental_engagement", run)
    tables = [ws.spark.read.parquet(path).withColumn("delivery", F.lit(i)) for i, path in enumerate(paths)]
    return reduce(DataFrame.unionByName, tables)


@query("stream_quality")
def _(ws):
    """Checks of the landed events, measured whenever new rows have landed."""

    def run() -> str:
        target, sink = ws.path("quality/results"), _ingested(ws)["events"]
        changes = ws.spark.readStream.schema(ws.spark.read.parquet(sink).schema).parquet(sink)
        schema, checks = quality.MONITORED["advisor_events"]

        def measure() -> DataFrame:
            landed = ingest.landed_events(ws.spark, sink)
            return quality.dq_report(landed, "advisor_events", schema, checks, _events_now(ws))

        refresh.refresh_stream(changes, measure, target, ws.path("quality/checkpoint")).awaitTermination()
        return target

    return refresh.latest_version(ws.spark, ws.once("quality", run))


@query("incremental_flow_merge")
def _(ws):
    """State of the older flows merged with the last 90 days as one new batch."""
    cutoff = F.date_sub(dates.day(_flows_now(ws)), 90)
    flows = ws.table("fund_flows")
    state = ws.stored(
        "flow_state", lambda path: sinks.overwrite(attribution.flow_state(flows.filter(F.col("flow_date") < cutoff)), path)
    )
    return attribution.merge_flow_batch(state, flows.filter(F.col("flow_date") >= cutoff))


@query("stream_flow_merge")
def _(ws):
    """The same state kept by a stream that takes the flows in several batches."""

    def run() -> str:
        state, source = ws.path("flow_merge/state"), ws.path("flow_merge/flows")
        flows = ws.table("fund_flows")
        newest = F.date_sub(dates.day(_flows_now(ws)), 90)
        for kept in (F.col("flow_date") < newest, F.col("flow_date") >= newest):
            sinks.append(flows.filter(kept), source)
            changes = ws.spark.readStream.schema(flows.schema).parquet(source)
            refresh.merge_flows_stream(changes, state, ws.path("flow_merge/checkpoint")).awaitTermination()
        return state

    return refresh.current_flows(ws.spark, ws.once("flow_merge", run)).drop("month")


# -- retrieval --------------------------------------------------------------------------------------
def _fund_documents(ws: Workspace) -> DataFrame:
    body = text.fund_text(F.col("fund_name"), F.col("fund_category"), F.col("benchmark"), F.col("asset_class"))
    return ws.table("fund_dim").filter(F.col("fund_id").isNotNull()).select(
        "fund_id", "fund_name", "fund_category", "benchmark", body.alias("search_text")
    )


def _index(ws: Workspace, name: str, docs: DataFrame) -> search.Index:
    """Search index of (doc_id, text, attributes), stored with a row per document."""
    documents = ws.stored(f"{name}_index", lambda path: sinks.overwrite(search.index_documents(spread(docs)), path))
    terms = ws.stored(f"{name}_terms", lambda path: sinks.overwrite(search.term_stats(documents), path))
    corpus = ws.stored(f"{name}_corpus", lambda path: sinks.overwrite(search.corpus_stats(documents), path))
    return search.Index(documents, terms, corpus)


def _fund_index(ws: Workspace) -> search.Index:
    docs = _fund_documents(ws).select(F.col("fund_id").alias("doc_id"), "fund_name", "fund_category", F.col("search_text").alias("text"))
    return _index(ws, "funds", docs)


@query("search_documents")
def _(ws):
    return _fund_documents(ws)


@query("search_topk")
def _(ws):
    """The five best documents for every benchmark text."""
    index = _index(ws, "documents", ws.source("documents").select("doc_id", "text"))
    return search.search_topk(search.query_terms(ws.source("benchmark"), "item_id"), index)


def _document_postings(ws: Workspace) -> DataFrame:
    index = _index(ws, "documents", ws.source("documents").select("doc_id", "text"))
    return ws.stored("documents_postings", lambda path: postings.write_blocks(postings.posting_blocks(index), path))


@query("search_postings_topk")
def _(ws):
    """The same five documents from an inverted index, without the ranges that cannot hold one of them."""
    index = _index(ws, "documents", ws.source("documents").select("doc_id", "text"))

    def keep(name: str, df: DataFrame) -> DataFrame:
        return ws.stored(f"postings_{name}", lambda path: sinks.overwrite(df, path))

    return postings.search_postings(search.query_terms(ws.source("benchmark"), "item_id"), index, _document_postings(ws), keep).best


def _document_changes(ws: Workspace) -> DataFrame:
    """Changes of the documents in three deliveries: drafts that are replaced, late and withdrawn documents."""
    n = F.col("doc_id")
    docs = ws.source("documents").select("doc_id", "text")
    change = lambda when, delivery, text, deleted=False: F.when(
        when, F.struct(F.lit(delivery).alias("delivery"), text.alias("text"), F.lit(deleted).alias("deleted"))
    )
    late, draft, gone, back = n % 3 == 2, (n % 5 == 0) & (n % 3 != 2), n % 7 == 3, (n % 11 == 4) & (n % 7 != 3)
    none = F.lit(None).cast("string")
    each = F.array(
        change(~late, 0, F.when(draft, F.concat(F.lit("draft draft "), F.reverse("text"))).otherwise(F.col("text"))),
        change(late, 1, F.col("text")), change(draft, 1, F.col("text")), change(back, 1, none, True),
        change(back, 2, F.col("text")), change(gone, 2, none, True),
    )
    rows = docs.select("doc_id", F.posexplode(F.array_compact(each)).alias("at", "c"))
    return rows.select("doc_id", "c.text", "c.deleted", "at", "c.delivery")


@query("search_index_refresh")
def _(ws):
    """The five best documents from an index that has followed three deliveries of changes, merged once on the way."""

    def run() -> str:
        root, changes = ws.path("search_segments"), _document_changes(ws)
        index = segments.SegmentedIndex(ws.spark, f"{root}/index", changes.drop("delivery").schema, most=2)
        for delivery in range(3):
            sinks.append(changes.filter(F.col("delivery") == delivery).drop("delivery"), f"{root}/feed")
            stream = ws.spark.readStream.schema(changes.drop("delivery").schema).parquet(f"{root}/feed")
            segments.index_stream(stream, index, f"{root}/checkpoint").awaitTermination()
        return f"{root}/index"

    root = ws.once("search_segments", run)
    index = segments.SegmentedIndex(ws.spark, root, _document_changes(ws).drop("delivery").schema)
    return search.search_topk(search.query_terms(ws.source("benchmark"), "item_id"), index.view())


def _fund_queries(ws: Workspace) -> DataFrame:
    """One question per fund category and asset class."""
    question = F.concat_ws(" ", F.lit("fund"), "fund_category", F.regexp_replace("asset_class", "#", " "))
    kinds = ws.table("fund_dim").select("fund_category", "asset_class").distinct()
    return kinds.select(F.concat_ws("/", "fund_category", "asset_class").alias("query_id"), question.alias("text"))


@query("fund_search_topk")
def _(ws):
    """Fund id, name and category of the five best funds for every question."""
    return search.search_topk(search.query_terms(_fund_queries(ws)), _fund_index(ws))


@query("fund_search_filtered")
def _(ws):
    """The same questions answered with ECONOMY funds only, by the category kept in the index."""
    return search.search_topk(search.query_terms(_fund_queries(ws)), _fund_index(ws), where=F.col("fund_category") == "ECONOMY")


@query("vector_topk")
def _(ws):
    """The five vectors nearest to each label's mean vector."""
    embeddings = ws.source("embeddings")
    return vectors.vector_topk(vectors.label_centroids(embeddings), embeddings)
