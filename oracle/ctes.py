"""Common table expressions shared by the check queries, and their assembly."""

from __future__ import annotations

import re


def mil(x: str, digits: int) -> str:
    """Exact x / 1,000,000 rounded half up."""
    return f"cast(round(cast({x} as decimal(24,4)) * cast(0.000001 as decimal(7,6)), {digits}) as double)"


def d(x: str) -> str:
    """Decimal or double as a double with six decimals."""
    return f"round(cast({x} as double), 6)"


CTES: dict[str, str] = {
    "territory_dim": """
        select 'T' || lpad(cast(r_regionkey + 1 as varchar), 3, '0') as territory_id, r_name as territory_name,
               case r_regionkey % 3 when 0 then 'East' when 1 then 'Central' else 'West' end as region,
               'Manager_' || r_regionkey as territory_mgr, true as active
        from region""",
    "fund_dim": """
        select 'F' || p_partkey as fund_id, p_name as fund_name, p_type as fund_category, p_brand as asset_class,
               case when p_size % 5 = 0 then null else 'BM_' || p_size end as benchmark
        from part""",
    "advisor_dim": """
        select 'A' || c_custkey as advisor_id, c_name as advisor_name,
               'T' || lpad(cast(n_regionkey + 1 as varchar), 3, '0') as territory_id,
               case when c_custkey % 10 < 2 then 'PLATINUM' when c_custkey % 10 < 5 then 'GOLD'
                    when c_custkey % 10 < 8 then 'SILVER' else 'BRONZE' end as tier,
               c_acctbal >= 0 as active
        from customer join nation on c_nationkey = n_nationkey""",
    "advisor_events": """
        select 'E' || event_id as event_id,
               'A' || (case when event_id % 2 = 0 then user_id
                            else event_id % (select count(*) from customer) end) as advisor_id,
               case event_type when 'click' then 'CALL' when 'purchase' then 'MEETING' when 'view' then 'EMAIL'
                    when 'signup' then 'EVENT_ATTENDANCE' when 'error' then 'AUM_UPDATE' end as event_type,
               ts as event_timestamp, cast(null as varchar) as fund_id,
               cast(cast(value as decimal(18,2)) * 100000 as decimal(18,2)) as aum_amount,
               cast(null as varchar) as opportunity_id, props as metadata, ts as row_timestamp
        from events""",
    "located_events": """
        select e.*, a.territory_id from advisor_events e left join advisor_dim a on e.advisor_id = a.advisor_id""",
    "fund_flows": """
        select 'L' || l_orderkey || '-' || l_linenumber as flow_id, 'F' || l_partkey as fund_id,
               'A' || o_custkey as advisor_id,
               'T' || lpad(cast(n_regionkey + 1 as varchar), 3, '0') as territory_id,
               cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end
                    as decimal(18,2)) as flow_amount,
               cast(l_shipdate as date) as flow_date,
               case l_returnflag when 'R' then 'OUTFLOW' when 'A' then 'TRANSFER' when 'N' then 'INFLOW' end as flow_type,
               l_linestatus as share_class, l_shipdate as row_timestamp
        from lineitem join orders on l_orderkey = o_orderkey
             join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "opportunity": """
        select 'O' || o_orderkey as opportunity_id, 'A' || o_custkey as advisor_id,
               case o_orderstatus when 'F' then 'Closed Won' when 'P' then 'Closed Lost' else
                 case left(o_orderpriority, 1) when '1' then 'Negotiation' when '2' then 'Proposal/Quote'
                      when '3' then 'Qualification' else 'Prospecting' end end as stage,
               case when o_orderkey % 50 = 0 then null else cast(o_totalprice as decimal(18,2)) end as amount,
               'F' || (o_orderkey % (select count(*) from part)) as fund_id,
               cast(o_orderdate as date) as created_date,
               cast(o_orderdate as date) + 60 as close_date,
               cast(o_orderdate as date) + cast(o_orderkey % 60 as integer) as last_modified,
               o_orderdate as row_timestamp
        from orders""",
    "usage_history": """
        select event_type as service_type, cast(ts as date) as usage_date,
               cast(cast(value as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(20,4)) as credits_used
        from events""",
    "refresh_log": """
        select 'DT_' || (event_id % 3) as name, 'DISTRIBUTION' as schema_name,
               case event_type when 'click' then 'FULL' else 'INCREMENTAL' end as refresh_action, ts as refresh_start_time
        from events where event_type in ('click', 'view')
        union all select 'engagement', 'DISTRIBUTION', 'FULL', max(event_timestamp) from located_events where territory_id is not null
          and event_timestamp < (select date_trunc('day', max(event_timestamp)) from located_events where territory_id is not null)
        union all select 'engagement', 'DISTRIBUTION', 'FULL', max(event_timestamp) from located_events where territory_id is not null""",
    "check_time": "select cast(max(usage_date) + 1 as timestamp) as checked_at from usage_history",
    "ev_now": "select max(ts) as now from events",
    "fl_now": "select max(cast(l_shipdate as date)) as today from lineitem",
    "op_now": "select max(last_modified) as today from opportunity",
    "snaps": "select cast(unnest(range(0, 91, 7)) as integer) as back",
    "activity": """
        select back, advisor_id,
               count(*) filter (where event_type = 'CALL' and event_timestamp >= now - to_days(back) - interval 30 day) as calls,
               count(*) filter (where event_type = 'MEETING' and event_timestamp >= now - to_days(back) - interval 30 day) as meetings,
               count(*) filter (where event_type = 'EMAIL' and event_timestamp >= now - to_days(back) - interval 30 day) as emails,
               max(event_timestamp) as last_ts,
               date_diff('day', max(event_timestamp), max(now - to_days(back))) as idle
        from advisor_events, ev_now, snaps
        where event_timestamp <= now - to_days(back)
        group by back, advisor_id""",
    "open_opps": """
        select back, advisor_id, count(*) as n, sum(coalesce(amount, 0)) as v from opportunity, op_now, snaps
        where stage not in ('Closed Won', 'Closed Lost') and created_date <= today - back group by back, advisor_id""",
    "aum_12m": """
        select back, advisor_id, sum(abs(flow_amount)) as flow
        from fund_flows, fl_now, snaps
        where flow_date >= cast((today - back) - interval 12 month as date) and flow_date <= today - back
        group by back, advisor_id""",
    "adv_hist": """
        select a.advisor_id, a.advisor_name, a.territory_id, t.territory_name, a.tier as advisor_tier,
               cast(now as date) - s.back as score_date,
               least(100.0, greatest(0.0, coalesce(c.calls, 0) * 3 + coalesce(c.meetings, 0) * 8
                 + coalesce(c.emails, 0) * cast(0.5 as double)
                 + case when coalesce(c.idle, 999) = 0 then 10 when c.idle <= 7 then 8 when c.idle <= 14 then 5
                        when c.idle <= 30 then 2 else 0 end)) as engagement_score,
               coalesce(c.calls, 0) as call_count_30d, coalesce(c.meetings, 0) as meeting_count_30d,
               coalesce(c.emails, 0) as email_count_30d, c.last_ts as last_activity_timestamp,
               coalesce(c.idle, 999) as days_since_last_activity,
               cast(coalesce(cast(m.flow as decimal(28,2)) * cast(0.15 as decimal(3,2)), 10000000) as decimal(28,4)) as aum_amount,
               coalesce(o.n, 0) as open_opportunity_count,
               cast(coalesce(o.v, 0) as decimal(28,2)) as open_opportunity_value, s.back
        from advisor_dim a cross join snaps s cross join ev_now
             left join territory_dim t on a.territory_id = t.territory_id
             left join activity c on a.advisor_id = c.advisor_id and c.back = s.back
             left join open_opps o on a.advisor_id = o.advisor_id and o.back = s.back
             left join aum_12m m on a.advisor_id = m.advisor_id and m.back = s.back
        where a.active""",
    "adv": "select * from adv_hist where back = 0",
    "ffa": """
        select f.fund_id, fd.fund_name, fd.fund_category, f.advisor_id, a.advisor_name, a.territory_id,
               t.territory_name, f.flow_date, f.flow_type, sum(f.flow_amount) as flow_amount,
               count(*) as transaction_count,
               round(cast(cast(abs(sum(f.flow_amount)) as double) / nullif(cast(s.aum_amount as double), 0) * 100
                     as decimal(24,10)), 4) as capture_rate
        from fund_flows f join fund_dim fd on f.fund_id = fd.fund_id join advisor_dim a on f.advisor_id = a.advisor_id
             join territory_dim t on f.territory_id = t.territory_id left join adv s on f.advisor_id = s.advisor_id
        group by f.fund_id, fd.fund_name, fd.fund_category, f.advisor_id, a.advisor_name, a.territory_id,
                 t.territory_name, f.flow_date, f.flow_type, s.aum_amount""",
    "net_all": "select territory_id, sum(flow_amount) as net from fund_flows group by territory_id",
    "net_30d": """
        select territory_id, sum(flow_amount) as net from fund_flows, fl_now where flow_date >= today - 30
        group by territory_id""",
    "thm": "{heat:net_all}",
    "thm_30d": "{heat:net_30d}",
    "dq": """
        select 'STAGING' as table_schema, 'advisor_events' as table_name, 'NULL_COUNT' as metric_name,
               'row_timestamp' as column_name, count(*) filter (where row_timestamp is null) as value from advisor_events
        union all select 'STAGING', 'advisor_events', 'NULL_COUNT', 'advisor_id',
               count(*) filter (where advisor_id is null) from advisor_events
        union all select 'STAGING', 'advisor_events', 'DUPLICATE_COUNT', 'event_id',
               count(event_id) - count(distinct event_id) from advisor_events
        union all select 'DISTRIBUTION', 'advisor_engagement_score', 'ROW_COUNT', null, count(*) from adv
        union all select 'DISTRIBUTION', 'advisor_engagement_score', 'NULL_COUNT', 'engagement_score',
               count(*) filter (where engagement_score is null) from adv
        union all select 'STAGING', 'fund_flows', 'NULL_COUNT', 'row_timestamp',
               count(*) filter (where row_timestamp is null) from fund_flows
        union all select 'STAGING', 'fund_flows', 'NULL_COUNT', 'fund_id',
               count(*) filter (where fund_id is null) from fund_flows
        union all select 'STAGING', 'fund_flows', 'DUPLICATE_COUNT', 'flow_id',
               count(flow_id) - count(distinct flow_id) from fund_flows
        union all select 'STAGING', 'advisor_events', 'ORPHAN_COUNT', 'advisor_id', count(*) from advisor_events e
               where not exists (select 1 from advisor_dim a where a.advisor_id = e.advisor_id)""",
    "dq_rows": "select dq.*, now as measurement_time from dq, ev_now",
    "a_stale": """
        select 'EVENTS_STALE' as alert, coalesce(max(row_timestamp) < max(checked_at) - interval 30 minute, false) as fired,
               cast(date_diff('second', max(row_timestamp), max(checked_at)) as double) as value,
               case when max(row_timestamp) < max(checked_at) - interval 30 minute
                    then 'Advisor events are stale. Last row: ' || strftime(max(row_timestamp), '%Y-%m-%d %H:%M:%S') end as message
        from advisor_events, check_time""",
    "plat": """
        select count(*) filter (where engagement_score < 30) as r, count(*) as n from adv
        where advisor_tier = 'PLATINUM'""",
    "a_attrition": """
        select 'HIGH_ATTRITION' as alert, coalesce(r > 0 and round(r / nullif(n, 0) * 100, 1) > 20, false) as fired,
               round(r / nullif(n, 0) * 100, 1) as value,
               case when r > 0 and round(r / nullif(n, 0) * 100, 1) > 20
                    then 'High attrition risk among Platinum advisors. At risk: ' || r || ' of ' || n end as message
        from plat""",
    "day_net": "select sum(flow_amount) as net, max(today) as today from fund_flows, fl_now where flow_date = today",
    "a_outflow": """
        select 'FUND_OUTFLOWS' as alert, coalesce(net < -1000000, false) as fired, cast(net as double) as value,
               case when net < -1000000 then 'Net outflow above $1M. Date: ' || today || ', net flow: $' || net end as message
        from day_net""",
    "day_use": """
        select sum(credits_used) as used from usage_history where usage_date = (select max(usage_date) from usage_history)""",
    "a_usage": """
        select 'USAGE_BUDGET' as alert, coalesce(used > 8, false) as fired, cast(used as double) as value,
               case when used > 8 then 'Credits used today: ' || cast(round(used, 2) as decimal(28,2)) || ' of 10 allowed.' end as message
        from day_use""",
    "full_runs": """
        select count(*) as n from refresh_log where schema_name = 'DISTRIBUTION' and refresh_action = 'FULL'
          and refresh_start_time > (select max(refresh_start_time) from refresh_log) - interval 1 hour""",
    "a_refresh": """
        select 'FULL_REFRESH' as alert, n > 0 as fired, cast(n as double) as value,
               case when n > 0 then 'Full refreshes in the last hour: ' || n end as message
        from full_runs""",
    "own_alerts": """
        select alert, fired from a_stale union all select alert, fired from a_attrition union all select alert, fired from a_outflow
        union all select alert, fired from a_usage union all select alert, fired from a_refresh""",
    "alert_log": """
        select 'ALERT_' || (user_id % 5) as name, 'DISTRIBUTION' as schema_name, ts as scheduled_time,
               case when value > 100 then 'TRIGGERED' else 'CONDITION_FALSE' end as state
        from events where event_type = 'error'
        union all select 'ALERT_' || alert, 'DISTRIBUTION', checked_at, case when fired then 'TRIGGERED' else 'CONDITION_FALSE' end
        from own_alerts, check_time""",
    "sdocs": """
        select fund_id, fund_name, fund_category, benchmark,
               fund_name || ' is a ' || fund_category || ' fund benchmarked against ' || coalesce(benchmark, 'N/A')
               || '. Asset class: ' || coalesce(asset_class, 'Unknown') || '.' as search_text
        from fund_dim where fund_id is not null""",
    "fqueries": """
        select distinct fund_category || '/' || asset_class as query_id,
               'fund ' || fund_category || ' ' || replace(asset_class, '#', ' ') as body from fund_dim""",
    "units": """
        select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as pos from embeddings""",
    "centroids": "select label, pos, avg(x) as x from units group by label, pos",
}

_HEAT = """
        select t.territory_id, t.territory_name, t.region, t.territory_mgr, a.score_date as as_of_date,
               count(distinct a.advisor_id) as advisor_count, sum(a.aum_amount) as total_aum,
               avg(a.engagement_score) as avg_engagement_score, coalesce(n.net, 0) as net_flows_30d,
               sum(a.open_opportunity_value) as total_pipeline_value,
               count(*) filter (where a.engagement_score < 30) as at_risk_advisor_count,
               count(*) filter (where a.engagement_score >= 70) as high_engagement_count,
               case when avg(a.engagement_score) is not null then least(100.0, greatest(0.0,
                 avg(a.engagement_score) * cast(0.4 as double)
                 + least(cast(50 as double), cast(coalesce(n.net, 0) as double) / 1e6) * cast(0.4 as double)
                 + (1 - count(*) filter (where a.engagement_score < 30)::double / count(*)) * 20)) end as territory_heat_score
        from territory_dim t left join adv a on t.territory_id = a.territory_id
             left join {net} n on t.territory_id = n.territory_id
        where t.active
        group by t.territory_id, t.territory_name, t.region, t.territory_mgr, n.net, a.score_date"""

CTES = {name: re.sub(r"^\{heat:(\w+)\}$", lambda m: _HEAT.replace("{net}", m[1]), sql) for name, sql in CTES.items()}
_NAMES = list(CTES)


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the expressions it uses, directly or not, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _NAMES:
            if name not in needed and re.search(rf"(?:from|join|,)\s+{name}\b", text, re.IGNORECASE):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} as ({CTES[name]})" for name in _NAMES if name in needed)
    return f"with {parts},\n{sql[4:]}" if sql.startswith("with") else f"with {parts}\n{sql}"


def bm25(docs: str, queries: str, allowed: str = "") -> str:
    """Five best of ``docs`` (doc_id, body) for each of ``queries`` (query_id, body)."""
    words = r"regexp_extract_all(lower(body), '[\p{L}\p{N}]+')"
    return f"""with
        words as materialized (select doc_id, {words} as w from {docs}),
        lens as materialized (select doc_id, len(w) as doc_len from words),
        post as materialized (
          select term, doc_id, count(*)::double as tf from (select doc_id, unnest(w) as term from words)
          group by term, doc_id),
        dfs as materialized (select term, count(*)::double as df from post group by term),
        stat as materialized (select count(*)::double as docs, avg(doc_len) as avg_len from lens),
        ask as materialized (select distinct query_id, unnest({words}) as term from {queries}),
        scored as materialized (
          select a.query_id, p.doc_id,
                 round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2
                   / (tf + 1.2 * (0.25 + 0.75 * doc_len / avg_len))), 6) as score
          from ask a join dfs on a.term = dfs.term join post p on p.term = a.term
               join lens l on l.doc_id = p.doc_id cross join stat
          {allowed}
          group by a.query_id, p.doc_id)
        select query_id, doc_id, score, rank from (
          select query_id, doc_id, score,
                 cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank
          from scored)
        where rank <= 5"""
