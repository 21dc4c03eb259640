"""Sweep, rollups, bitmaps, bucketed tables and silences against a recomputation."""

import datetime as dt
import random
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from salescompass.operators import alerts, distinct
from salescompass.operators.engagement import Run, engagement_runs, engagement_sweep
from salescompass.plans import registry, rollups, semantic
from salescompass.plans.verified import LOGICAL_TABLES
from salescompass.streaming import silence

NOW = dt.datetime(2024, 2, 29, 12, 30, 0, 1)


@pytest.fixture(scope="module")
def facts(spark):
    """Advisors, territories, events, deals and flows with nulls, hot advisors, and moments at the edges of windows."""
    rng = random.Random(1)
    advisors = [(f"A{i}", f"n{i}", f"T{i % 3}", "GOLD", i != 3) for i in range(25)]
    territories = [(f"T{i}", f"t{i}") for i in range(2)]
    kinds = ["CALL", "MEETING", "EMAIL", "AUM_UPDATE", None]
    edges = [NOW - dt.timedelta(days=d, microseconds=m) for d in (0, 1, 7, 30, 31, 37, 90, 120, 121) for m in (-1, 0, 1)]
    events = [(f"A{rng.randrange(6 if i % 2 else 25)}", rng.choice(kinds), NOW - dt.timedelta(minutes=rng.randrange(200 * 1440))) for i in range(1500)]
    events += [("A1", k, at) for at in edges for k in kinds[:2]] + [(None, "CALL", NOW), ("A2", "CALL", None), ("A2", "CALL", NOW + dt.timedelta(days=1))]
    stages = ["Prospecting", "Closed Won", None, "Negotiation"]
    day = NOW.date()
    opps = [
        (f"O{i}", f"A{rng.randrange(25)}", rng.choice(stages), rng.choice([None, Decimal(i)]), rng.choice([None, day - dt.timedelta(days=rng.randrange(-3, 150))]))
        for i in range(200)
    ]
    flow_days = [day - dt.timedelta(days=rng.randrange(-5, 600)) for _ in range(300)] + [dt.date(2023, 2, 28), dt.date(2023, 3, 1), dt.date(2022, 12, 1), dt.date(2023, 2, 27), None]
    flows = [(f"A{rng.randrange(25)}", d, rng.choice([None, Decimal(rng.randrange(-900, 900))])) for d in flow_days for _ in range(2)]
    return (
        spark.createDataFrame(advisors, "advisor_id string, advisor_name string, territory_id string, tier string, active boolean"),
        spark.createDataFrame(territories, "territory_id string, territory_name string"),
        spark.createDataFrame(events, "advisor_id string, event_type string, event_timestamp timestamp_ntz"),
        spark.createDataFrame(opps, "opportunity_id string, advisor_id string, stage string, amount decimal(18,2), created_date date"),
        spark.createDataFrame(flows, "advisor_id string, flow_date date, flow_amount decimal(18,2)"),
    )


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], str(r[5])))


@pytest.mark.parametrize(("runs", "step"), [(9, 1), (5, 7), (1, 1)])
@pytest.mark.parametrize("opps_day", [None, NOW.date()])
def test_sweep_equals_single_runs(facts, runs, step, opps_day):
    newest = Run(NOW, NOW.date(), opps_day)
    back = [dt.timedelta(days=step * i) for i in range(runs)]
    single = [Run(NOW - b, NOW.date() - b, opps_day and opps_day - b) for b in back]
    swept = engagement_sweep(*facts, newest, runs, step)
    whole = engagement_runs(*facts, single)
    assert swept.columns == whole.columns and dict(swept.dtypes) == dict(whole.dtypes)
    assert ordered(swept) == ordered(whole) and swept.count() == 24 * runs


def test_sweep_of_empty_facts(facts):
    advisors, territories, events, opps, flows = facts
    rows = engagement_sweep(advisors, territories, events.limit(0), opps.limit(0), flows.limit(0), Run(NOW), 3).collect()
    assert len(rows) == 72 and {(r["engagement_score"], r["days_since_last_activity"]) for r in rows} == {(0.0, 999)}


def test_only_what_counts_is_shuffled(facts):
    """Flows outside every window are left out before the sums, and the sweep joins a row per advisor, not per run."""
    newest, plan = Run(NOW, NOW.date()), lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    single = plan(engagement_runs(*facts, [newest]))
    assert "(flow_date#" in single.split("Filter")[-1] or any("flow_date" in part.split("\n")[0] for part in single.split("Filter")[1:])
    swept = engagement_sweep(*facts, newest, 9)
    executed = swept._jdf.queryExecution().executedPlan().toString()
    assert any(line.count("hashpartitioning(advisor_id") for line in executed.splitlines())
    assert not any("hashpartitioning(advisor_id" in line and "run#" in line for line in executed.splitlines())
    assert any("leave#" in part.split("\n")[0] and "enter#" in part.split("\n")[0] or "flow_amount" in part.split("\n")[0] for part in plan(swept).split("Filter")[1:])


# -- rollups ----------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def stored(ws, spark, tmp_path_factory):
    def of(table, groupings):
        def write(name, df):
            path = str(tmp_path_factory.mktemp(name) / "rollup")
            rollups.write_rollups(df, path)
            return spark.read.parquet(path)

        return rollups.build_rollups(table, ws.table(LOGICAL_TABLES[table]), groupings, write)

    return of


def close(a, b):
    key = lambda r: tuple(str(v) for v in r[:2])
    a, b = (sorted(map(tuple, df.collect()), key=key) for df in (a, b))
    return len(a) == len(b) and all(
        x[:2] == y[:2] and all((p is None) == (q is None) and (p is None or abs(float(p) - float(q)) <= 1e-9 * max(1, abs(float(q)))) for p, q in zip(x[2:], y[2:], strict=True))
        for x, y in zip(a, b, strict=True)
    )


@pytest.mark.parametrize("table", ["advisor_eng", "fund_flows", "territory"])
def test_rollups_equal_metric_queries_for_every_pair(ws, stored, table):
    logical, df = semantic.SEMANTIC[table], ws.table(LOGICAL_TABLES[table])
    few = [d.name for d in logical.dimensions if d.name not in ("advisor_id", "advisor_name", "fund_id", "fund_name", "flow_date")]
    kept, metrics = stored(table, list(combinations(few, 2))), [m.name for m in logical.metrics]
    for pair in combinations(few, 2):
        mine = rollups.rollup_query(kept, metrics, pair)
        assert close(mine, semantic.metric_query(table, df, metrics, pair)), pair
        plan = mine._jdf.queryExecution().executedPlan().toString()
        assert "/rollup]" in plan and LOGICAL_TABLES[table] not in plan  # the table itself is not read
    one = F.col(few[0]).isNotNull()
    assert close(
        rollups.rollup_query(kept, metrics, [few[1], few[1]][:1], {few[0]: one}).select(F.lit(1).alias("a"), "*"),
        semantic.metric_query(table, df, metrics, [few[1]], [one]).select(F.lit(1).alias("a"), "*"),
    )


def test_the_smallest_grouping_answers(ws, stored):
    kept = stored("fund_flows", [["fund_category", "territory_id"], ["territory_id", "flow_type"], ["territory_id"], ["advisor_id", "fund_category", "territory_id"]])
    assert kept.smallest(["territory_id"])[0] == {"territory_id"}
    assert kept.smallest(["flow_type"])[0] == {"territory_id", "flow_type"}
    with pytest.raises(ValueError, match="no stored grouping"):
        kept.smallest(["fund_name"])
    with pytest.raises(ValueError, match="not dimensions"):
        stored("fund_flows", [["nothing"]])


def test_a_filter_on_the_run_date_is_not_silently_empty(ws, stored):
    df = ws.table(LOGICAL_TABLES["advisor_eng"])
    oldest = df.agg(F.min("score_date")).first()[0]
    picked = F.col("score_date") == F.lit(oldest)
    with pytest.raises(ValueError, match="pass all_runs"):
        semantic.metric_query("advisor_eng", df, ["total_aum"], ["territory_id"], [picked])
    whole = semantic.metric_query("advisor_eng", df, ["total_aum"], ["territory_id"], [picked], all_runs=True)
    assert whole.count() > 0
    kept = stored("advisor_eng", [["territory_id"]])
    with pytest.raises(ValueError, match="pass all_runs"):
        rollups.rollup_query(kept, ["total_aum"], ["territory_id"], {"score_date": picked})
    mine = rollups.rollup_query(kept, ["total_aum"], ["territory_id"], {"score_date": picked}, all_runs=True)
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, whole.collect()))


# -- bitmaps ----------------------------------------------------------------------------------
def test_bitmaps_count_like_distinct(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(5), f"K{rng.randrange(70_000)}") for _ in range(6000)] + [("a", 1, "K7")] * 3000 + [("b", 2, None), (None, 1, "K8")]
    df = spark.createDataFrame(rows, "kind string, day int, key string").repartition(3).cache()
    numbers = distinct.numbered_keys(df.union(spark.range(70_000).select(F.lit("x"), F.lit(0), F.concat(F.lit("K"), "id"))), "key").cache()
    assert numbers.agg(F.max("number") + 1, F.count_distinct("number")).first() == (70_000, 70_000)  # dense, over several pieces
    sets = distinct.bitmap_sets(df, numbers, "key", ["kind", "day"]).cache()
    assert sets.filter(F.octet_length("bits") != 4096).count() == 0
    for by in (["kind", "day"], ["kind"], ["day"], []):
        whole = df.groupBy(*by).agg(F.count_distinct("key").alias("n"))
        assert sorted(map(str, distinct.distinct_count(sets, by, "n").collect())) == sorted(map(str, whole.collect()))
    plan = distinct.distinct_count(sets, ["kind"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_or_agg" in plan  # pieces are merged before they are shuffled
    assert distinct.distinct_count(distinct.bitmap_sets(df.limit(0), numbers, "key", ["kind"]), []).collect()[0][0] == 0


# -- bucketed tables --------------------------------------------------------------------------
def test_bucketed_join_moves_no_row(ws):
    df = registry.QUERIES["bucketed_engagement_join"](ws)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "HashJoin" in plan
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and plan.count("Bucketed: true") == 2
    events, _ = registry._advisor_days(ws)
    assert events.count() == ws.table("advisor_events").select("advisor_id", F.to_date("event_timestamp")).distinct().count()  # a crowded advisor is a row per day


# -- silences ---------------------------------------------------------------------------------
def deliver(spark, root, events):
    rows = spark.createDataFrame([(k, None if m is None else NOW + dt.timedelta(minutes=m)) for k, m in events], "territory_id string, at timestamp_ntz")
    rows.coalesce(1).write.mode("append").parquet(f"{root}/feed")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/feed")
    silence.silence_stream(stream, f"{root}/alerts", f"{root}/checkpoint", "territory_id", "at").awaitTermination()
    found = spark.read.schema("territory_id string, silent_since timestamp_ntz, fired_at timestamp_ntz, events long").parquet(f"{root}/alerts")
    return sorted((r["territory_id"], round((r["silent_since"] - NOW).total_seconds() / 60), r["events"]) for r in found.collect())


def test_an_alert_comes_after_silence_and_not_before(spark, tmp_path):
    root = str(tmp_path)
    assert deliver(spark, root, []) == []  # nothing ever came
    assert deliver(spark, root, [("a", 0), ("b", 0), ("a", 20), ("b", None)]) == []  # 20 minutes
    assert deliver(spark, root, [("a", 29)]) == []  # b is silent for 29
    assert deliver(spark, root, [("a", 31)]) == [("b", 0, 1)]  # and for 31; the state has outlived three restarts
    assert deliver(spark, root, [("b", 40), ("a", 41)]) == [("b", 0, 1)]  # b is back, one alert for one silence
    assert deliver(spark, root, [("a", m) for m in range(50, 80)] * 20) == [("b", 0, 1), ("b", 40, 1)]  # a crowded key
    assert deliver(spark, root, [("c", 200)]) == [("a", 79, 605), ("b", 0, 1), ("b", 40, 1)]


def test_stale_by_territory_fires_for_some(spark):
    rows = [("a", NOW), ("a", NOW - dt.timedelta(days=1)), ("b", NOW - dt.timedelta(minutes=30)), ("c", NOW - dt.timedelta(minutes=31)), ("d", None)]
    df = spark.createDataFrame(rows, "territory_id string, row_timestamp timestamp_ntz")
    got = {r["territory_id"]: (r["fired"], r["seconds_behind"]) for r in alerts.events_stale_by(df, "territory_id").collect()}
    assert got == {"a": (False, 0), "b": (False, 1800), "c": (True, 1860), "d": (False, None)}
    assert alerts.events_stale_by(df.limit(0), "territory_id").collect() == []


# -- refreshes in the telemetry -----------------------------------------------------------------
def test_our_own_refreshes_are_in_the_history(ws):
    rows = [r for r in registry.QUERIES["telemetry_refreshes"](ws).collect() if r["name"] == "engagement"]
    assert [(r["refresh_action"], r["refreshes"]) for r in rows] == [("FULL", 2)]
    assert registry.QUERIES["alert_full_refresh"](ws).first()["fired"]
