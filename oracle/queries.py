"""One SQL text per query name."""

from __future__ import annotations

import re

from oracle.ctes import bm25, d, mil, with_ctes

_SQL: dict[str, str] = {}

_QUARTER = "flow_date >= date_trunc('quarter', today)"

# -- landing tables -------------------------------------------------------------------------
_SQL["scan_staging_counts"] = " union all ".join(
    f"select '{t}' as tbl, count(*) as row_count from {t}"
    for t in ("territory_dim", "fund_dim", "advisor_dim", "advisor_events", "fund_flows", "opportunity")
)
_SQL["landing_layout"] = """
    select territory_id, cast(event_timestamp as date) as event_date, count(*) as events
    from located_events group by territory_id, cast(event_timestamp as date)"""
_SQL["load_append"] = f"""
    select flow_type, share_class, count(*) as loaded_rows, {d("sum(flow_amount)")} as amount
    from fund_flows group by flow_type, share_class"""
_SQL["zero_copy_opportunities"] = _SQL["opportunity_summary"] = f"""
    select advisor_id, n as open_opportunity_count, {d("v")} as open_opportunity_value from open_opps where back = 0"""
_SQL["row_numbering"] = """
    select event_id, n, 'Event_' || lpad(cast(n as varchar), 9, '0') as label
    from (select event_id, row_number() over (order by event_id) - 1 as n from events)"""
_SQL["row_expansion"] = "select advisor_id, tier, cast(i as integer) as copy from advisor_dim, range(15) g(i)"
_SQL["shuffled_load"] = "select opportunity_id, stage from opportunity"

# -- domain operators -------------------------------------------------------------------------
_SQL["activity_counts"] = """
    select advisor_id, calls as call_count_30d, meetings as meeting_count_30d, emails as email_count_30d,
           last_ts as last_activity_timestamp, cast(idle as integer) as days_since_last_activity
    from activity where back = 0"""
_SQL["aum_summary"] = f"select advisor_id, {d('flow')} as total_flow_12m from aum_12m where back = 0"
_ENGAGEMENT = f"""
    select advisor_id, advisor_name, territory_id, territory_name, advisor_tier, score_date,
           {d("engagement_score")} as engagement_score, call_count_30d, meeting_count_30d, email_count_30d,
           last_activity_timestamp, cast(days_since_last_activity as integer) as days_since_last_activity,
           {d("aum_amount")} as aum_amount, open_opportunity_count, {d("open_opportunity_value")} as open_opportunity_value
    from adv"""
_SQL["dt_advisor_engagement_score"] = _ENGAGEMENT
_SQL["dt_fund_flow_attribution"] = f"""
    select fund_id, fund_name, fund_category, advisor_id, advisor_name, territory_id, territory_name, flow_date,
           flow_type, {d("flow_amount")} as flow_amount, transaction_count, {d("capture_rate")} as capture_rate
    from ffa"""


def _heat_rows(source: str, where: str = "") -> str:
    return f"""
    select territory_id, territory_name, region, territory_mgr, as_of_date, advisor_count,
           {d("total_aum")} as total_aum, {d("avg_engagement_score")} as avg_engagement_score,
           {d("net_flows_30d")} as net_flows_30d, {d("total_pipeline_value")} as total_pipeline_value,
           at_risk_advisor_count, high_engagement_count, {d("territory_heat_score")} as territory_heat_score
    from {source} {where}"""


_SQL["dt_territory_heat_map"] = _heat_rows("thm")
_SQL["territory_heat_map_30d"] = _heat_rows("thm_30d")
_SQL["latest_snapshot"] = f"""
    select advisor_id, score_date, {d("engagement_score")} as engagement_score from adv_hist
    where score_date = (select max(score_date) from adv_hist)"""
_SQL["pipeline_signals"] = f"""
    select a.advisor_id, a.advisor_name, t.territory_name, a.tier, open_opps, {mil("pipeline", 2)} as pipeline_m,
           case when open_opps > 3 then 'HOT' when open_opps > 1 then 'WARM' else 'COLD' end as signal
    from (select advisor_id, count(distinct opportunity_id) as open_opps, sum(coalesce(amount, 0)) as pipeline
          from opportunity where stage not in ('Closed Won', 'Closed Lost') group by advisor_id) deals
         join advisor_dim a using (advisor_id) join territory_dim t using (territory_id)
    order by pipeline_m desc nulls last, a.advisor_id limit 15"""
_RISK = """case when engagement_score < 20 or (days_since_last_activity > 21 and aum_amount > 10000000) then 'HIGH'
                when engagement_score > 40 and days_since_last_activity <= 14 then 'LOW' else 'MEDIUM' end"""
_SQL["attrition_risk"] = _SQL["pandas_udf_classify"] = f"""
    select advisor_id, advisor_name, advisor_tier, {d("engagement_score")} as engagement_score,
           {_RISK} as attrition_risk from adv"""
_SQL["attrition_risk_top20"] = f"""
    select advisor_id, advisor_name, advisor_tier, {d("a.engagement_score")} as engagement_score, call_count_30d,
           meeting_count_30d, cast(days_since_last_activity as integer) as days_since_last_activity,
           {d("a.aum_amount")} as aum_amount, {_RISK} as attrition_risk
    from adv a order by a.aum_amount desc nulls last, advisor_id limit 20"""
_SQL["territory_heat_band"] = """
    select territory_name, round(territory_heat_score, 1) as heat_score,
           case when round(territory_heat_score, 1) >= 70 then 'green'
                when round(territory_heat_score, 1) >= 40 then 'amber' else 'red' end as heat_band from thm"""
_SQL["brief_context"] = f"""
    select to_json(struct_pack(total_advisors := count(distinct advisor_id),
             avg_engagement := round(avg(engagement_score), 1),
             at_risk_count := count(*) filter (where engagement_score < 30),
             top_territory := (select territory_name from thm order by net_flows_30d desc, territory_name limit 1),
             total_pipeline_m := {mil("sum(open_opportunity_value)", 1)}))::varchar as context
    from adv"""
_SQL["territory_brief_context"] = f"""
    select to_json(struct_pack(territory := territory_name, aum_m := {mil("total_aum", 1)}, advisors := advisor_count,
             engagement := round(avg_engagement_score, 1), flows_30d_m := {mil("net_flows_30d", 2)},
             at_risk := at_risk_advisor_count))::varchar as context
    from thm order by territory_heat_score desc nulls last, territory_name limit 1"""
_SQL["attrition_prompt_text"] = f"""
    select advisor_id, advisor_name, advisor_tier, round(engagement_score, 1) as engagement,
           {mil("aum_amount", 2)} as aum_m,
           'Score: ' || cast(engagement_score as varchar) || '/100  Calls: ' || call_count_30d || '  Meetings: '
           || meeting_count_30d || '  Days inactive: ' || days_since_last_activity || '.' as prompt
    from adv where advisor_tier = 'PLATINUM'"""

# -- scalar functions -----------------------------------------------------------------------
_SQL["scalar_dates"] = """
    select event_id, cast(date_diff('day', event_timestamp, now) as integer) as days_ago,
           date_diff('second', event_timestamp, now) as seconds_ago, cast(event_timestamp as date) as event_day,
           cast(date_trunc('quarter', event_timestamp) as date) as quarter,
           cast(cast(event_timestamp as date) - interval 12 month as date) as year_before,
           event_timestamp + interval 30 minute as half_hour_later
    from advisor_events, ev_now"""
_SQL["scalar_strings"] = """
    select advisor_id, 'Advisor_' || lpad(substr(advisor_id, 2), 9, '0') as label,
           left(upper(trim('  ' || lower(tier))), 6) as short_tier, lower(advisor_name) || '@example.com' as email
    from advisor_dim"""
_SQL["scalar_json"] = """
    select event_id, try_cast(json_extract_string(metadata, '$.k') as integer) as k,
           case when json_extract_string(metadata, '$.k') is null then '{"event_type":"' || event_type || '"}'
                else '{"event_type":"' || event_type || '","k":' || json_extract_string(metadata, '$.k') || '}' end as as_json
    from advisor_events"""
_SQL["scalar_clamp"] = """
    select event_id, least(100.0, greatest(10.0, value))::double as clamped, round(abs(value - 50), 6) as distance,
           round(value / nullif(event_id % 3, 0), 4) as ratio, coalesce(nullif(event_type, 'error'), 'N/A') as kind
    from events"""


def _money(x: str) -> str:
    billions = f"cast(round(cast({x} as decimal(24,4)) * cast(0.000000001 as decimal(10,9)), 1) as decimal(20,1))"
    millions = f"cast(round(cast({x} as decimal(24,4)) * cast(0.000001 as decimal(7,6)), 1) as decimal(20,1))"
    return f"case when abs({x}) >= 1000000000 then '$' || {billions} || 'B' else '$' || {millions} || 'M' end"


_SQL["money_format"] = f"""
    select advisor_id, {_money("aum_amount")} as aum, {_money("open_opportunity_value")} as pipeline from adv"""

# -- metric layer -------------------------------------------------------------------------------
_LOGICAL = {"advisor_eng": "adv", "fund_flows": "ffa", "territory": "thm"}
_DIMENSION = {"advisor_eng": "territory_name", "fund_flows": "fund_category", "territory": "region"}
_METRICS = {
    "advisor_eng": {
        "avg_engagement_score": "avg(engagement_score)", "total_aum": "sum(aum_amount)",
        "total_calls_30d": "sum(call_count_30d)", "total_meetings_30d": "sum(meeting_count_30d)",
        "total_open_opportunities": "sum(open_opportunity_count)", "total_pipeline_value": "sum(open_opportunity_value)",
    },
    "fund_flows": {"net_flow_amount": "sum(flow_amount)", "avg_capture_rate": "avg(cast(capture_rate as double))"},
    "territory": {
        "total_territory_aum": "sum(total_aum)", "total_advisor_count": "sum(advisor_count)",
        "avg_territory_engagement": "avg(avg_engagement_score)", "total_net_flows_30d": "sum(net_flows_30d)",
        "total_at_risk_advisors": "sum(at_risk_advisor_count)", "avg_heat_score": "avg(territory_heat_score)",
    },
}
_COUNTS = {"total_calls_30d", "total_meetings_30d", "total_open_opportunities", "total_advisor_count", "total_at_risk_advisors"}


def _out(name: str, expr: str) -> str:
    return f"cast({expr} as bigint) as {name}" if name in _COUNTS else f"{d(expr)} as {name}"


for _t, _metrics in _METRICS.items():
    for _m, _e in _metrics.items():
        _SQL[f"metric_{_m}"] = f"select {_DIMENSION[_t]}, {_out(_m, _e)} from {_LOGICAL[_t]} group by {_DIMENSION[_t]}"

_SQL["metric_query_advisor_eng"] = f"""
    select territory_name, advisor_tier, {", ".join(_out(m, e) for m, e in _METRICS["advisor_eng"].items())}
    from adv where advisor_tier in ('PLATINUM', 'GOLD') group by territory_name, advisor_tier"""
_SQL["metric_query_fund_flows"] = f"""
    select fund_category, flow_type, {", ".join(_out(m, e) for m, e in _METRICS["fund_flows"].items())}
    from ffa, fl_now where flow_date >= cast(today - interval 12 month as date) group by fund_category, flow_type"""
_SQL["metric_query_territory"] = f"""
    select region, {", ".join(_out(m, e) for m, e in _METRICS["territory"].items())} from thm group by region"""
_SQL["semantic_facts_advisor_eng"] = f"""
    select advisor_id, advisor_name, territory_id, territory_name, advisor_tier, score_date,
           {d("aum_amount")} as aum_amount, {d("engagement_score")} as engagement_score, call_count_30d,
           meeting_count_30d, open_opportunity_count, {d("open_opportunity_value")} as open_opportunity_value
    from adv"""
_SQL["semantic_facts_fund_flows"] = f"""
    select fund_id, fund_name, fund_category, advisor_id, territory_id, flow_date, flow_type,
           {d("flow_amount")} as flow_amount, {d("capture_rate")} as capture_rate from ffa"""
_SQL["semantic_facts_territory"] = f"""
    select territory_id, territory_name, region, territory_mgr, as_of_date, {d("total_aum")} as total_aum,
           advisor_count, {d("avg_engagement_score")} as avg_engagement_score, {d("net_flows_30d")} as net_flows_30d,
           at_risk_advisor_count, {d("territory_heat_score")} as territory_heat_score from thm"""
_SQL["default_measures_advisor_eng"] = f"""
    select territory_name, {d("sum(aum_amount)")} as aum_amount, {d("avg(engagement_score)")} as engagement_score,
           cast(sum(call_count_30d) as bigint) as call_count_30d, cast(sum(meeting_count_30d) as bigint) as meeting_count_30d,
           cast(sum(open_opportunity_count) as bigint) as open_opportunity_count,
           {d("sum(open_opportunity_value)")} as open_opportunity_value
    from adv group by territory_name"""
_SQL["default_measures_fund_flows"] = f"""
    select fund_category, {d("sum(flow_amount)")} as flow_amount,
           {d("avg(cast(capture_rate as double))")} as capture_rate from ffa group by fund_category"""
_SQL["default_measures_territory"] = f"""
    select region, {d("sum(total_aum)")} as total_aum, cast(sum(advisor_count) as bigint) as advisor_count,
           {d("avg(avg_engagement_score)")} as avg_engagement_score, {d("sum(net_flows_30d)")} as net_flows_30d,
           cast(sum(at_risk_advisor_count) as bigint) as at_risk_advisor_count,
           {d("avg(territory_heat_score)")} as territory_heat_score from thm group by region"""
_SQL["synonym_resolve"] = """
    with asked as (
      select case event_type when 'click' then 'Calls' when 'purchase' then ' meetings' when 'view' then 'phone calls'
                  when 'signup' then 'AUM' when 'error' then 'region' end as term from events),
    known(term, logical_table, kind, canonical) as (values
      ('calls', 'advisor_eng', 'metric', 'total_calls_30d'),
      ('phone calls', 'advisor_eng', 'metric', 'total_calls_30d'),
      ('meetings', 'advisor_eng', 'metric', 'total_meetings_30d'),
      ('aum', 'advisor_eng', 'metric', 'total_aum'),
      ('region', 'advisor_eng', 'dimension', 'territory_name'),
      ('region', 'territory', 'dimension', 'territory_name'),
      ('region', 'territory', 'dimension', 'region'))
    select a.term, k.logical_table, k.kind, k.canonical, count(*) as asked
    from asked a left join known k on lower(trim(a.term)) = k.term group by all"""
_SQL["logical_view_sql"] = f"""
    select territory_name, count(*) as flows, {d("sum(flow_amount)")} as net_flows,
           (select max(score_date) from adv) as score_date from ffa group by territory_name"""

# -- approved queries -----------------------------------------------------------------------------
_SQL["vq_top_advisors_by_aum"] = f"""
    select advisor_name, territory_name, advisor_tier as tier, {d("a.aum_amount")} as aum_amount,
           {d("a.engagement_score")} as engagement_score
    from adv a order by a.aum_amount desc nulls last, advisor_id limit 10"""
_SQL["vq_territory_performance_ranking"] = f"""
    select territory_name, region, {d("net_flows_30d")} as net_flows_30d, {d("total_aum")} as total_aum,
           {d("avg_engagement_score")} as avg_engagement_score, at_risk_advisor_count from thm"""
_SQL["vq_at_risk_advisors"] = f"""
    select advisor_name, territory_name, advisor_tier as tier, {d("engagement_score")} as engagement_score,
           {d("aum_amount")} as aum_amount, {d("open_opportunity_value")} as open_opportunity_value,
           call_count_30d, meeting_count_30d from adv where adv.engagement_score < 30"""
_SQL["vq_fund_flows_by_category"] = f"""
    select fund_category, fund_name, {d("sum(flow_amount)")} as net_flows, count(distinct advisor_id) as advisor_count
    from ffa, fl_now where {_QUARTER} group by fund_category, fund_name"""
_SQL["vq_pipeline_by_territory"] = f"""
    select territory_name, cast(sum(open_opportunity_count) as bigint) as total_opportunities,
           {d("sum(open_opportunity_value)")} as total_pipeline_value, {d("avg(engagement_score)")} as avg_engagement
    from adv group by territory_name"""
_SQL["vq_advisor_engagement_trend"] = f"""
    select score_date, {d("avg(engagement_score)")} as avg_score, count(distinct advisor_id) as active_advisors,
           {d("sum(aum_amount)")} as total_aum
    from adv_hist, ev_now where score_date >= cast(now as date) - 90 group by score_date"""
_SQL["vq_top_funds_by_inflows"] = f"""
    select fund_name, fund_category, {d("i")} as total_inflows, {d("o")} as total_outflows, {d("n")} as net_flows,
           contributing_advisors
    from (select fund_name, fund_category, sum(case when flow_type = 'INFLOW' then flow_amount else 0 end) as i,
                 sum(case when flow_type = 'OUTFLOW' then flow_amount else 0 end) as o, sum(flow_amount) as n,
                 count(distinct advisor_id) as contributing_advisors
          from ffa, fl_now where {_QUARTER} group by fund_name, fund_category)
    order by i desc nulls last, fund_name, fund_category limit 10"""
_SQL["vq_platinum_advisor_summary"] = f"""
    select territory_name, count(*) as platinum_count, {d("sum(aum_amount)")} as total_aum,
           {d("avg(engagement_score)")} as avg_engagement, {d("sum(open_opportunity_value)")} as total_pipeline
    from adv where advisor_tier = 'PLATINUM' group by territory_name"""
_SQL["vq_low_activity_high_aum"] = f"""
    select advisor_name, territory_name, advisor_tier as tier, {d("a.aum_amount")} as aum_amount,
           {d("a.engagement_score")} as engagement_score, call_count_30d, meeting_count_30d, open_opportunity_count
    from adv a where a.aum_amount > 2000000 and call_count_30d + meeting_count_30d < 2
    order by a.aum_amount desc nulls last, advisor_id limit 20"""
_SQL["vq_territory_comparison"] = f"""
    select territory_name, {d("total_aum")} as total_aum, advisor_count, {d("avg_engagement_score")} as avg_engagement_score,
           {d("net_flows_30d")} as net_flows_30d, at_risk_advisor_count,
           cast(round(cast(cast(net_flows_30d as double) / nullif(cast(total_aum as double), 0) * 100 as decimal(24,10)), 2)
                as double) as flow_rate_pct
    from thm where territory_name in ('AMERICA', 'ASIA')"""

# -- reports --------------------------------------------------------------------------------------
_SQL["kpi_overview"] = f"""
    select count(distinct advisor_id) as total_advisors, {d("sum(aum_amount)")} as total_aum,
           {d("avg(engagement_score)")} as avg_engagement, count(*) filter (where engagement_score < 30) as at_risk_advisors,
           {d("sum(open_opportunity_value)")} as total_pipeline from adv"""
_SQL["territory_overview"] = f"""
    select territory_name, {mil("total_aum", 1)} as aum_millions, round(avg_engagement_score, 1) as engagement_score,
           {mil("net_flows_30d", 2)} as net_flows_m, at_risk_advisor_count, advisor_count from thm"""
_SQL["territory_heat_list"] = f"""
    select territory_name, region, territory_mgr, {mil("total_aum", 1)} as aum_m,
           round(avg_engagement_score, 1) as avg_engagement, {mil("net_flows_30d", 2)} as net_flows_m, advisor_count,
           at_risk_advisor_count, round(territory_heat_score, 1) as heat_score from thm"""


def _advisor_list(where: str) -> str:
    return f"""
    select advisor_name, territory_name, advisor_tier as tier, round(a.engagement_score, 1) as engagement_score,
           {mil("aum_amount", 2)} as aum_millions, call_count_30d, meeting_count_30d, open_opportunity_count,
           {mil("open_opportunity_value", 2)} as pipeline_millions,
           cast(days_since_last_activity as integer) as days_since_last_activity
    from adv a {where} order by aum_amount desc nulls last, advisor_id limit 100"""


_SQL["advisor_list"] = _advisor_list("where territory_name = 'ASIA' and advisor_tier = 'GOLD'")
_SQL["advisor_list_unfiltered"] = _advisor_list("")
_SQL["distinct_territories"] = "select distinct territory_name from thm"
_SQL["engagement_board"] = f"""
    select advisor_name, territory_name, advisor_tier as tier, {d("a.engagement_score")} as engagement_score,
           {d("a.aum_amount")} as aum_amount, {d("a.open_opportunity_value")} as open_opportunity_value, call_count_30d,
           meeting_count_30d
    from adv a order by a.aum_amount desc nulls last, advisor_id limit 10"""
_SQL["flows_last_30d"] = f"""
    select fund_name, fund_category, {mil("sum(case when flow_type = 'INFLOW' then flow_amount else 0 end)", 6)} as inflows_m,
           {mil("sum(case when flow_type = 'OUTFLOW' then abs(flow_amount) else 0 end)", 6)} as outflows_m,
           {mil("sum(flow_amount)", 6)} as net_flows_m, count(distinct advisor_id) as contributing_advisors
    from ffa, fl_now where flow_date >= today - 30 group by fund_name, fund_category"""
_SQL["flow_by_fund_type"] = f"""
    select fund_name, fund_category, flow_type, {d("net")} as net_flow, advisors from (
      select fund_name, fund_category, flow_type, sum(flow_amount) as net, count(distinct advisor_id) as advisors
      from ffa, fl_now where {_QUARTER} group by fund_name, fund_category, flow_type)
    order by abs(net) desc, fund_name, fund_category, flow_type limit 10"""
_SQL["top_opportunities"] = f"""
    select opportunity_id, advisor_id, stage, {mil("coalesce(amount, 0)", 2)} as amount_m, close_date,
           row_timestamp as last_updated
    from opportunity order by amount desc nulls last, opportunity_id limit 10"""
_SQL["ingest_freshness"] = """
    select max(row_timestamp) as latest_event, count(*) as total_events_24h, count(distinct advisor_id) as unique_advisors,
           date_diff('second', max(row_timestamp), max(checked_at)) as seconds_lag
    from advisor_events, check_time where row_timestamp >= checked_at - interval 24 hour"""
_SQL["derived_table_health"] = """
    select 'advisor_engagement_score' as table_name, count(*) as row_count, 'Target: 1h' as target_lag from adv
    union all select 'fund_flow_attribution', count(*), 'Target: 1d' from ffa
    union all select 'territory_heat_map', count(*), 'Target: 4h' from thm"""
for _key, _hours in (("alert_history", 24), ("alert_history_6h", 6)):
    _SQL[_key] = f"""
    select name as alert_name, schema_name, scheduled_time, state from alert_log
    where schema_name = 'DISTRIBUTION'
      and scheduled_time >= (select max(scheduled_time) from alert_log) - interval {_hours} hour
    order by scheduled_time desc, name limit 20"""
_SQL["usage_by_service"] = f"""
    select service_type, {d("sum(credits_used)")} as credits_used, count(*) as api_calls,
           round(least(1.0::double, cast(sum(credits_used) as double) / 10), 6) as budget_share
    from usage_history where usage_date = (select max(usage_date) from usage_history) group by service_type"""
_SQL["telemetry_alerts"] = """
    select name, state, count(*) as runs, max(scheduled_time) as last_run from alert_log group by name, state"""
_SQL["telemetry_usage"] = f"""
    select service_type, usage_date, {d("sum(credits_used)")} as credits_used, count(*) as calls
    from usage_history group by service_type, usage_date"""
_SQL["telemetry_refreshes"] = """
    select name, refresh_action, count(*) as refreshes, max(refresh_start_time) as last_start
    from refresh_log group by name, refresh_action"""

# -- business questions ---------------------------------------------------------------------------
_SQL["top_pipeline_advisors"] = f"""
    select advisor_id, advisor_name, territory_name, open_opportunity_count,
           {d("a.open_opportunity_value")} as open_opportunity_value
    from adv a order by a.open_opportunity_value desc nulls last, advisor_id limit 10"""
_SQL["pipeline_this_quarter"] = f"""
    select territory_name, count(*) as open_deals, {d("sum(coalesce(amount, 0))")} as pipeline_value
    from opportunity o join advisor_dim a on o.advisor_id = a.advisor_id
         join territory_dim t on a.territory_id = t.territory_id, op_now
    where stage not in ('Closed Won', 'Closed Lost') and close_date >= date_trunc('quarter', today)
      and close_date < date_trunc('quarter', today) + interval 3 month
    group by territory_name"""
_SQL["stale_opportunities"] = f"""
    select opportunity_id, advisor_id, stage, {d("amount")} as amount, last_modified,
           cast(today - last_modified as integer) as days_unchanged
    from opportunity, op_now where stage not in ('Closed Won', 'Closed Lost') and last_modified < today - 30"""
_SQL["win_rate"] = """
    select territory_name, fund_category, count(*) filter (where stage = 'Closed Won') as won,
           count(*) filter (where stage = 'Closed Lost') as lost,
           round(count(*) filter (where stage = 'Closed Won') / count(*), 6) as win_rate
    from opportunity o join advisor_dim a on o.advisor_id = a.advisor_id join fund_dim f on o.fund_id = f.fund_id
         join territory_dim t on a.territory_id = t.territory_id
    where stage in ('Closed Won', 'Closed Lost') group by territory_name, fund_category"""
_SQL["opp_to_aum"] = f"""
    select advisor_id, advisor_name, {d("a.open_opportunity_value")} as open_opportunity_value,
           {d("a.aum_amount")} as aum_amount,
           round(cast(a.open_opportunity_value as double) / nullif(cast(a.aum_amount as double), 0), 6) as opp_to_aum
    from adv a order by opp_to_aum desc nulls last, advisor_id limit 20"""


def _top_engaged(where: str, k: int) -> str:
    return f"""
    select advisor_id, advisor_name, territory_name, advisor_tier as tier, {d("a.engagement_score")} as engagement_score
    from adv a {where} order by a.engagement_score desc nulls last, advisor_id limit {k}"""


_SQL["top_engaged_in_territory"] = _top_engaged("where territory_name = 'EUROPE'", 10)
_SQL["top_engaged"] = _top_engaged("", 20)
_SQL["no_calls_14d"] = f"""
    select advisor_id, advisor_name, territory_name, {d("engagement_score")} as engagement_score,
           cast(days_since_last_activity as integer) as days_since_last_activity
    from adv where advisor_tier = 'PLATINUM' and not exists (
      select 1 from advisor_events e, ev_now where e.advisor_id = adv.advisor_id and e.event_type = 'CALL'
        and e.event_timestamp >= now - interval 14 day)"""
_SQL["tier_compare"] = f"""
    select advisor_tier as tier, count(*) as advisors, {d("avg(engagement_score)")} as avg_engagement,
           {d("max(engagement_score)")} as max_engagement
    from adv where advisor_tier in ('GOLD', 'SILVER') group by advisor_tier"""
_SQL["net_flows_prev_quarter"] = f"""
    select territory_name, {d("sum(flow_amount)")} as net_flows from ffa, fl_now
    where flow_date >= date_trunc('quarter', today) - interval 3 month and flow_date < date_trunc('quarter', today)
    group by territory_name order by sum(flow_amount) desc, territory_name limit 1"""
_SQL["most_at_risk_territory"] = """
    select territory_name, at_risk_advisor_count, advisor_count from thm
    order by at_risk_advisor_count desc, territory_name limit 1"""
_SQL["territory_heat_rank"] = f"""
    select territory_name, {d("t.territory_heat_score")} as territory_heat_score,
           cast(rank() over (order by t.territory_heat_score desc nulls last) as integer) as heat_rank from thm t"""
_SQL["engagement_drop"] = """
    select territory_name, round(min_by(s, score_date), 6) as first_score, round(max_by(s, score_date), 6) as last_score,
           round(round(min_by(s, score_date), 6) - round(max_by(s, score_date), 6), 6) as drop
    from (select territory_name, score_date, avg(engagement_score) as s from adv_hist, ev_now
          where score_date >= cast(now as date) - 90 group by territory_name, score_date)
    group by territory_name order by 4 desc, territory_name limit 1"""
_SQL["net_flows_ytd"] = f"""
    select fund_category, {d("sum(flow_amount)")} as net_flows from ffa, fl_now
    where flow_date >= date_trunc('year', today) group by fund_category"""
_SQL["top_inflow_last_month"] = f"""
    select fund_id, fund_name, {d("sum(case when flow_type = 'INFLOW' then flow_amount else 0 end)")} as inflows
    from ffa, fl_now
    where flow_date >= date_trunc('month', today) - interval 1 month and flow_date < date_trunc('month', today)
    group by fund_id, fund_name
    order by sum(case when flow_type = 'INFLOW' then flow_amount else 0 end) desc, fund_id limit 1"""
_SQL["top_outflow_advisors"] = f"""
    select advisor_id, advisor_name, {d("sum(abs(flow_amount))")} as outflow from ffa where flow_type = 'OUTFLOW'
    group by advisor_id, advisor_name order by sum(abs(flow_amount)) desc, advisor_id limit 10"""
_SQL["capture_by_territory"] = f"""
    select territory_name, {d("avg(cast(capture_rate as double))")} as avg_capture_rate from ffa group by territory_name"""
_SQL["top_net_flow_advisor"] = f"""
    select advisor_id, advisor_name, {d("sum(flow_amount)")} as net_flows from ffa, fl_now where {_QUARTER}
    group by advisor_id, advisor_name order by sum(flow_amount) desc, advisor_id limit 1"""

# -- data quality ---------------------------------------------------------------------------------
_SQL["dq_null_count"] = "select * from dq_rows where metric_name = 'NULL_COUNT'"
_SQL["dq_duplicate_count"] = "select * from dq_rows where metric_name = 'DUPLICATE_COUNT'"
_SQL["dq_row_count"] = "select * from dq_rows where metric_name = 'ROW_COUNT'"
_SQL["dq_orphan_count"] = "select * from dq_rows where metric_name = 'ORPHAN_COUNT'"
_SQL["dq_freshness"] = """
    select 'STAGING' as table_schema, 'advisor_events' as table_name, 'FRESHNESS' as metric_name, c as column_name,
           date_diff('second', max(row_timestamp), max(checked_at)) as value, max(checked_at) as measurement_time
    from advisor_events, check_time, (values ('row_timestamp'), ('event_timestamp')) v(c) group by c"""
_SQL["dq_report"] = _SQL["dq_status_4h"] = "select * from dq_rows"
_SQL["dq_status"] = """
    select *, case when metric_name in ('NULL_COUNT', 'DUPLICATE_COUNT') and value > 0 then 'WARNING' else 'OK' end as status
    from dq_rows"""
_SQL["dq_status_pattern"] = """
    select *, case when (metric_name like '%NULL%' or metric_name like '%DUPLICATE%') and value > 0 then 'WARNING'
                   else 'OK' end as health_status from dq_rows"""

# -- alerts ---------------------------------------------------------------------------------------
_ALERTS = {
    "alert_events_stale": "a_stale", "alert_high_attrition": "a_attrition", "alert_fund_outflows": "a_outflow",
    "alert_usage_budget": "a_usage", "alert_full_refresh": "a_refresh",
}
for _key, _cte in _ALERTS.items():
    _SQL[_key] = f"select alert, fired, {d('value')} as value, message from {_cte}"
_SQL["alert_report"] = " union all ".join(_SQL[k] for k in _ALERTS)

_SQL["stale_territories"] = """
    select territory_id, last_row, coalesce(last_row < newest - interval 30 minute, false) as fired,
           date_diff('second', last_row, newest) as seconds_behind
    from (select territory_id, max(row_timestamp) as last_row from located_events group by territory_id),
         (select max(row_timestamp) as newest from located_events)"""

# -- states, rollups and sets that are kept -------------------------------------------------------
_SQL["engagement_daily_trend"] = f"""
    select score_date, count(*) as advisors, {d("avg(engagement_score)")} as avg_engagement,
           count(*) filter (where engagement_score < 30) as at_risk, sum(call_count_30d)::bigint as calls,
           {d("sum(aum_amount)")} as aum, {d("sum(open_opportunity_value)")} as pipeline
    from adv_hist group by score_date"""


def _pairs(source: str, dims: list[str], metrics: str) -> str:
    return " union all ".join(
        f"select '{a}/{b}' as dimensions, {a}::varchar as first, {b}::varchar as second, {metrics} from {source} group by {a}, {b}"
        for i, a in enumerate(dims) for b in dims[i + 1 :]
    )


_ADVISOR_METRICS = f"{d('sum(aum_amount)')} as total_aum, {d('avg(engagement_score)')} as avg_engagement_score, {d('sum(call_count_30d)')} as total_calls_30d"
_SQL["metric_rollup_advisor"] = " union all ".join([
    _pairs("adv", ["territory_name", "advisor_tier", "territory_id"], _ADVISOR_METRICS),
    *[
        f"select '{a}/score_date' as dimensions, {a}::varchar as first, score_date::varchar as second, {_ADVISOR_METRICS} from adv_hist group by {a}, score_date"
        for a in ("territory_name", "advisor_tier", "territory_id")
    ],
])
_SQL["metric_rollup_flows"] = _pairs(
    "ffa", ["fund_category", "flow_type", "territory_id"], f"{d('sum(flow_amount)')} as net_flow_amount, {d('avg(capture_rate)')} as avg_capture_rate"
)
_MONTH = "strftime(event_timestamp, '%Y-%m')"
_SQL["distinct_bitmap_advisors"] = f"""
    select 'territory_id/month' as by, territory_id, {_MONTH} as month, null as event_type, count(distinct advisor_id) as advisors
    from located_events group by territory_id, {_MONTH}
    union all select 'event_type', null, null, event_type, count(distinct advisor_id) from located_events group by event_type
    union all select 'territory_id', territory_id, null, null, count(distinct advisor_id) from located_events group by territory_id
    union all select 'all', null, null, null, count(distinct advisor_id) from located_events"""
_SQL["bucketed_engagement_join"] = f"""
    select advisor_id, events, active_days, {d("net_flow")} as net_flow, flow_days
    from (select advisor_id, count(*) as events, count(distinct cast(event_timestamp as date)) as active_days from advisor_events group by advisor_id)
         join (select advisor_id, sum(flow_amount) as net_flow, count(distinct flow_date) as flow_days from fund_flows group by advisor_id) using (advisor_id)"""

# -- streaming ------------------------------------------------------------------------------------
_SQL["stream_ingest"] = f"""
    select event_id, advisor_id, territory_id, event_type, event_timestamp, fund_id, {d("aum_amount")} as aum_amount,
           opportunity_id, case when event_type = 'EVENT_ATTENDANCE' then '{{}}' else replace(metadata, ': ', ':') end as metadata, row_timestamp
    from located_events where territory_id is not null"""
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_SQL["stream_bad_records"] = """
    select left('{"event_id":"' || event_id || '","advisor_id":"' || advisor_id || '","territory_id":"' || territory_id
                || '","event_type":"' || event_type || '"', 40) as value, 'malformed' as error
    from located_events where event_type = 'MEETING'"""
_SQL["stream_stats"] = """
    select count(*) + count(*) filter (where event_type in ('AUM_UPDATE', 'MEETING')) as received,
           count(*) as inserted, count(*) filter (where event_type = 'MEETING') as errors
    from located_events"""
_SQL["stream_dedup"] = f"""
    select event_id, advisor_id, territory_id, event_type, event_timestamp, {d("aum_amount")} as aum_amount
    from located_events"""
_SQL["stream_alert_stale"] = """
    select territory_id, event_timestamp as silent_since, event_timestamp + interval 30 minute as fired_at
    from (select territory_id, event_timestamp, lead(event_timestamp) over (partition by territory_id order by event_timestamp) as next from located_events),
         (select max(event_timestamp) as now from located_events)
    where coalesce(next, now) >= event_timestamp + interval 30 minute"""
_BEFORE = "(select * from events where ts < (select date_trunc('day', max(ts)) from events))"
_FIRST = re.sub(r"\bfrom events\b", f"from {_BEFORE}", with_ctes(_ENGAGEMENT))
_SQL["stream_refresh"] = f"select *, 1 as delivery from ({_FIRST}) union all select *, 2 as delivery from ({with_ctes(_ENGAGEMENT)})"


def _delivered(delivery: int) -> str:
    """The engagement table over what has come by a delivery; every tenth event comes one later."""
    sql = with_ctes(_ENGAGEMENT)
    if delivery == 2:
        return sql
    days, late_days, flow_days = {0: (20, 10**4, 400), 1: (5, 20, 60)}[delivery]
    newest = "(select cast(max(ts) as date) from events)"
    events = f"(select * from events where cast(ts as date) < {newest} - {days} and (event_id % 10 <> 0 or cast(ts as date) < {newest} - {late_days}))"
    flows = f"(select * from lineitem where cast(l_shipdate as date) < (select cast(max(l_shipdate) as date) from lineitem) - {flow_days})"
    return re.sub(r"\bfrom lineitem\b", f"from {flows}", re.sub(r"\bfrom events\b", f"from {events}", sql))


_SQL["incremental_engagement"] = " union all ".join(f"select *, {k} as delivery from ({_delivered(k)})" for k in range(3))
_SQL["stream_quality"] = "select * from dq_rows where table_name = 'advisor_events' and metric_name <> 'ORPHAN_COUNT'"
_SQL["incremental_flow_merge"] = _SQL["stream_flow_merge"] = f"""
    select fund_id, advisor_id, territory_id, flow_date, flow_type, {d("sum(flow_amount)")} as flow_amount,
           count(*) as transaction_count
    from fund_flows group by fund_id, advisor_id, territory_id, flow_date, flow_type"""

# -- retrieval ------------------------------------------------------------------------------------
_SQL["search_documents"] = "select * from sdocs"
_SQL["search_topk"] = bm25("(select doc_id, text as body from documents)", "(select item_id as query_id, text as body from benchmark)")
_SQL["search_postings_topk"] = _SQL["search_topk"]
_SQL["search_index_refresh"] = bm25(
    "(select doc_id, text as body from documents where doc_id % 7 <> 3)", "(select item_id as query_id, text as body from benchmark)"
)
_FUND_BODIES = "(select fund_id as doc_id, search_text as body from sdocs)"
def _with_fund(sql: str) -> str:
    return f"select b.*, fund_name, fund_category from ({sql}) b join fund_dim on b.doc_id = fund_id"


_SQL["fund_search_topk"] = _with_fund(bm25(_FUND_BODIES, "(select query_id, body from fqueries)"))
_SQL["fund_search_filtered"] = _with_fund(
    bm25(
        _FUND_BODIES, "(select query_id, body from fqueries)",
        "where p.doc_id in (select fund_id from fund_dim where fund_category = 'ECONOMY')",
    )
)
_SQL["vector_topk"] = """
    select query_id, vec_id, score, rank from (
      select query_id, vec_id, score,
             cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
      from (select c.label as query_id, u.vec_id,
                   round(sum(c.x * u.x) / (sqrt(sum(c.x * c.x)) * sqrt(sum(u.x * u.x))), 6) as score
            from centroids c join units u on c.pos = u.pos group by c.label, u.vec_id))
    where rank <= 5"""

_WHOLE = ("stream_refresh", "incremental_engagement")  # their expressions differ by delivery
_SQL["engagement_daily_trend"] = with_ctes(_SQL["engagement_daily_trend"]).replace("range(0, 91, 7)", "range(0, 91)")
_WHOLE += ("engagement_daily_trend",)
ORACLE: dict[str, str] = {name: sql if name in _WHOLE else with_ctes(sql) for name, sql in _SQL.items()}
