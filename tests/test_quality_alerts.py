import datetime as dt
from decimal import Decimal

import pytest

from salescompass.operators import alerts, quality

EVENTS = "event_id string, advisor_id string, row_timestamp timestamp_ntz"


def test_dq_report(spark, now):
    df = spark.createDataFrame(
        [("E1", "A1", now), ("E1", None, now - dt.timedelta(seconds=90)), ("E2", "A9", None), (None, "A1", now)], EVENTS
    )
    checks = [("NULL_COUNT", "advisor_id"), ("DUPLICATE_COUNT", "event_id"), ("ROW_COUNT", None), ("FRESHNESS", "row_timestamp")]
    rows = quality.dq_report(df, "events", "STAGING", checks, now).collect()
    assert [(r["metric_name"], r["column_name"], r["value"]) for r in rows] == [
        ("NULL_COUNT", "advisor_id", 1), ("DUPLICATE_COUNT", "event_id", 1), ("ROW_COUNT", None, 4), ("FRESHNESS", "row_timestamp", 0),
    ]
    with pytest.raises(ValueError):
        quality.dq_report(df, "events", "STAGING", [("MEDIAN", "event_id")], now)


def test_status_and_window(spark, now):
    rows = [
        ("STAGING", "t", "NULL_COUNT", "c", 1, now), ("STAGING", "t", "NULL_COUNT", "c", 0, now),
        ("STAGING", "t", "MY_NULL_RATIO", "c", 1, now), ("OTHER", "t", "ROW_COUNT", None, 1, now),
        ("STAGING", "t", "ROW_COUNT", None, 9, now - dt.timedelta(hours=25)),
    ]
    results = spark.createDataFrame(
        rows, "table_schema string, table_name string, metric_name string, column_name string, value long, measurement_time timestamp_ntz"
    )
    recent = quality.recent_results(results, now)
    assert recent.count() == 3
    found = {(r["metric_name"], r["value"]): (r["status"], r["health_status"]) for r in
             quality.with_pattern_status(quality.with_status(recent)).collect()}
    assert found == {
        ("NULL_COUNT", 1): ("WARNING", "WARNING"), ("NULL_COUNT", 0): ("OK", "OK"), ("MY_NULL_RATIO", 1): ("OK", "WARNING"),
    }
    assert quality.recent_results(results, now, k=2).count() == 2


def test_orphans(spark, now):
    df = spark.createDataFrame([("A1",), ("A1",), ("A2",), (None,)], "advisor_id string")
    known = spark.createDataFrame([("A2",)], "advisor_id string")
    assert quality.orphan_count(df, known, "advisor_id", "t", "STAGING", now).first()["value"] == 3


def stale(spark, now, *ages):
    df = spark.createDataFrame([(now - dt.timedelta(minutes=a),) for a in ages], "row_timestamp timestamp_ntz")
    return alerts.events_stale(df, now).first()


def test_events_stale(spark, now):
    assert stale(spark, now)["fired"] is False
    assert stale(spark, now, 30)["fired"] is False
    fired = stale(spark, now, 31, 90)
    assert fired["fired"] is True and fired["value"] == 31 * 60
    assert "2024-01-31 11:29:00" in fired["message"]


@pytest.mark.parametrize("at_risk, total, fires", [(200, 1000, False), (201, 1000, True), (0, 10, False), (0, 0, False)])
def test_high_attrition(spark, now, at_risk, total, fires):
    rows = [(now.date(), "PLATINUM", 10.0 if i < at_risk else 90.0) for i in range(total)]
    rows += [(now.date(), "GOLD", 1.0), (now.date() - dt.timedelta(days=1), "PLATINUM", 1.0)]
    df = spark.createDataFrame(rows, "score_date date, advisor_tier string, engagement_score double")
    assert alerts.high_attrition(df, now).first()["fired"] is fires


@pytest.mark.parametrize("amount, fires", [(-1_000_000, False), (-1_000_001, True), (5, False)])
def test_fund_outflows(spark, now, amount, fires):
    rows = [(now.date(), Decimal(amount)), (now.date() - dt.timedelta(days=1), Decimal(-9_000_000))]
    df = spark.createDataFrame(rows, "flow_date date, flow_amount decimal(18,2)")
    row = alerts.fund_outflows(df, now).first()
    assert row["fired"] is fires and (row["message"] is not None) is fires


def test_usage_and_refresh(spark, now):
    usage = spark.createDataFrame([(now.date(), Decimal(8)), (now.date(), Decimal(0))], "usage_date date, credits_used decimal(18,4)")
    assert alerts.usage_budget(usage, now).first()["fired"] is False
    more = usage.union(spark.createDataFrame([(now.date(), Decimal(1))], usage.schema))
    assert alerts.usage_budget(more, now).first()["message"] == "Credits used today: 9.00 of 10 allowed."
    schema = "schema_name string, refresh_action string, refresh_start_time timestamp_ntz"
    runs = [("DISTRIBUTION", "FULL", now - dt.timedelta(hours=1)), ("DISTRIBUTION", "INCREMENTAL", now), ("OTHER", "FULL", now)]
    assert alerts.full_refresh(spark.createDataFrame(runs, schema), now).first()["fired"] is False
    runs.append(("DISTRIBUTION", "FULL", now - dt.timedelta(minutes=59)))
    assert alerts.full_refresh(spark.createDataFrame(runs, schema), now).first()["value"] == 1


def test_alert_rows_become_history(spark, now):
    df = spark.createDataFrame([(now - dt.timedelta(hours=1),)], "row_timestamp timestamp_ntz")
    history = alerts.as_history(alerts.alert_report([alerts.events_stale(df, now)]), now).first()
    assert (history["name"], history["state"]) == ("ALERT_EVENTS_STALE", "TRIGGERED")
