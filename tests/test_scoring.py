import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salescompass.functions import dates, money, scoring
from salescompass.operators.engagement import activity_counts, advisor_engagement, opportunity_summary
from salescompass.operators.territory import territory_heat_map


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("days, points", [(0, 10), (1, 8), (7, 8), (8, 5), (14, 5), (30, 2), (31, 0)])
def test_recency_points(spark, days, points):
    assert one(spark, scoring.recency_points(F.lit(days))) == points


def score(spark, calls=None, meetings=None, emails=None, days=None):
    values = [F.lit(v).cast("long") for v in (calls, meetings, emails, days)]
    return one(spark, scoring.engagement_score(*values))


def test_engagement_score(spark):
    assert score(spark, 2, 1, 3, 7) == 6 + 8 + 1.5 + 8
    assert score(spark) == 0
    assert score(spark, calls=40) == 100


def test_engagement_score_against_plain_python(spark):
    rng = random.Random(11)
    rows = [tuple(rng.choice([None, *range(60)]) for _ in range(4)) for _ in range(300)]

    def plain(calls, meetings, emails, days):
        days = 999 if days is None else days
        points = 10 if days == 0 else 8 if days <= 7 else 5 if days <= 14 else 2 if days <= 30 else 0
        return float(min(100, (calls or 0) * 3 + (meetings or 0) * 8 + (emails or 0) / 2 + points))

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c int, m int, e int, d int")
    scored = df.select("i", scoring.engagement_score(*map(F.col, "cmed")).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in scored] == [plain(*r) for r in rows]


@pytest.mark.parametrize(
    "score_, days, aum, expected",
    [
        (19.5, 0, 1, "HIGH"), (50, 22, 10_000_001, "HIGH"), (50, 22, 10_000_000, "MEDIUM"), (41, 14, 1, "LOW"),
        (40, 14, 1, "MEDIUM"), (41, 15, 1, "MEDIUM"), (20, 5, 1, "MEDIUM"),
    ],
)
def test_attrition_class(spark, score_, days, aum, expected):
    assert one(spark, scoring.attrition_class(F.lit(score_), F.lit(days), F.lit(aum))) == expected


def test_bands_and_signals(spark):
    assert [one(spark, scoring.heat_band(F.lit(v))) for v in (70, 69.9, 40, 39.9)] == ["green", "amber", "amber", "red"]
    assert [one(spark, scoring.pipeline_signal(F.lit(n))) for n in (4, 3, 2, 1)] == ["HOT", "WARM", "WARM", "COLD"]


def test_money(spark):
    amount = F.lit("1234567890.00").cast("decimal(18,2)")
    assert one(spark, money.money_text(amount)) == "$1.2B"
    assert one(spark, money.money_text(F.lit("950000").cast("decimal(18,2)"))) == "$1.0M"
    zero = F.lit(0).cast("decimal(18,2)")
    assert one(spark, money.percent_of(amount, zero, 2)) is None


def test_dates(spark, now):
    assert one(spark, dates.days_between(F.lit("2024-01-30 23:59:00"), now)) == 1
    assert one(spark, dates.period_start(dt.date(2024, 5, 31), "quarter")) == dt.date(2024, 4, 1)
    assert one(spark, dates.period_start(dt.date(2024, 5, 31), "quarter", back=1)) == dt.date(2024, 1, 1)
    assert one(spark, dates.months_before(dt.date(2024, 2, 29), 12)) == dt.date(2023, 2, 28)
    assert one(spark, dates.seconds_between(dt.datetime(2024, 1, 31, 11, 59, 59, 900000), now)) == 1


EVENTS = "event_id string, advisor_id string, event_type string, event_timestamp timestamp_ntz"
ADVISORS = "advisor_id string, advisor_name string, territory_id string, tier string, active boolean"
TERRITORIES = "territory_id string, territory_name string, region string, territory_mgr string, active boolean"
OPPS = "opportunity_id string, advisor_id string, stage string, amount decimal(18,2)"
FLOWS = "advisor_id string, territory_id string, flow_amount decimal(18,2), flow_date date"


def small_tables(spark, flows=()):
    return dict(
        advisors=spark.createDataFrame(
            [("A1", "One", "T1", "GOLD", True), ("A2", "Two", "T1", "GOLD", True), ("A3", "Off", "T1", "GOLD", False)], ADVISORS
        ),
        territories=spark.createDataFrame(
            [("T1", "North", "East", "M1", True), ("T2", "Empty", "West", "M2", True), ("T3", "Gone", "West", "M3", False)],
            TERRITORIES,
        ),
        events=spark.createDataFrame(
            [
                ("E1", "A1", "CALL", dt.datetime(2024, 1, 31, 8)),
                ("E2", "A1", "CALL", dt.datetime(2023, 12, 1, 8)),
                ("E3", "A1", "CALL", dt.datetime(2024, 2, 5, 8)),
                ("E4", "A2", "AUM_UPDATE", dt.datetime(2024, 1, 24, 8)),
            ],
            EVENTS,
        ),
        opps=spark.createDataFrame(
            [("O1", "A1", "Proposal/Quote", None), ("O2", "A1", None, Decimal(5)), ("O3", "A1", "Closed Won", Decimal(5))], OPPS
        ),
        flows=spark.createDataFrame([(a, t, Decimal(x), day) for a, t, x, day in flows], FLOWS),
    )


def test_activity_window(spark, now):
    rows = {r["advisor_id"]: r for r in activity_counts(small_tables(spark)["events"], now).collect()}
    assert (rows["A1"]["call_count_30d"], rows["A1"]["days_since_last_activity"]) == (1, 0)
    assert (rows["A2"]["call_count_30d"], rows["A2"]["days_since_last_activity"]) == (0, 7)


def test_null_stage_is_not_open(spark):
    row = opportunity_summary(small_tables(spark)["opps"]).first()
    assert (row["open_opportunity_count"], row["open_opportunity_value"]) == (1, 0)


def test_engagement_rows(spark, now):
    flows = [("A2", "T1", -200, dt.date(2023, 1, 31)), ("A2", "T1", -1000, dt.date(2023, 1, 30))]
    rows = {r["advisor_id"]: r for r in advisor_engagement(**small_tables(spark, flows), as_of=now).collect()}
    assert set(rows) == {"A1", "A2"}
    assert rows["A1"]["engagement_score"] == 13 and rows["A1"]["aum_amount"] == 10_000_000
    assert rows["A2"]["engagement_score"] == 8 and rows["A2"]["aum_amount"] == 30


def heat(spark, now, flows=(), **options):
    tables = small_tables(spark, flows)
    engagement = advisor_engagement(**tables, as_of=now)
    rows = territory_heat_map(tables["territories"], engagement, tables["flows"], **options).collect()
    return {r["territory_id"]: r for r in rows}


def test_empty_territory(spark, now):
    empty = heat(spark, now)["T2"]
    assert (empty["advisor_count"], empty["at_risk_advisor_count"], empty["net_flows_30d"]) == (0, 0, 0)
    assert empty["avg_engagement_score"] is None and empty["territory_heat_score"] is None


def test_heat_score_limits(spark, now):
    low = [("A1", "T1", -900_000_000, dt.date(2024, 1, 1))]
    high = [("A1", "T1", 900_000_000, dt.date(2024, 1, 1))]
    assert heat(spark, now, low)["T1"]["territory_heat_score"] == 0
    # average 10.5, all at risk: 0.4 * 10.5 + 0.4 * 50
    assert heat(spark, now, high)["T1"]["territory_heat_score"] == pytest.approx(24.2)


def test_heat_window(spark, now):
    flows = [("A1", "T1", 100, dt.date(2023, 1, 1)), ("A1", "T1", 7, dt.date(2024, 1, 30))]
    assert heat(spark, now, flows)["T1"]["net_flows_30d"] == 107
    assert heat(spark, now, flows, window_days=30, as_of=now)["T1"]["net_flows_30d"] == 7
