"""Derived tables: engagement score (with history), flow attribution, territory heat map.

Build order follows the inputs: engagement first, then attribution and heat map, which
both read the finished engagement table.  The heat map reads the landing flows, not the
attribution, so the slower table never delays it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import dates
from salescompass.operators.attribution import flow_attribution
from salescompass.operators.engagement import Run, engagement_runs, engagement_sweep
from salescompass.operators.territory import territory_heat_map
from salescompass.sources import sinks
from salescompass.sources.workspace import Workspace, define

# fixed values: derived tables and their target lag
TARGET_LAG = {
    "advisor_engagement_score": "1 hour",
    "fund_flow_attribution": "1 day",
    "territory_heat_map": "4 hours",
}
# runs kept in the history table, in days before the newest one: weekly over the 90 days that trends ask for
SNAPSHOT_DAYS_BACK = tuple(range(0, 91, 7))


def engagement_at(ws: Workspace, days_back: Sequence[int] = (0,)) -> DataFrame:
    """The engagement table as runs so many days before the newest data see it."""

    def run(back: int) -> Run:
        shift = dt.timedelta(days=back)
        return Run(*[ws.as_of(source) - shift for source in ("advisor_events", "fund_flows", "opportunity")])

    facts = [ws.table(t) for t in ("advisor_dim", "territory_dim", "advisor_events", "opportunity", "fund_flows")]
    return engagement_runs(*facts, [run(back) for back in days_back])


def engagement_trend(ws: Workspace, runs: int, step: int = 1) -> DataFrame:
    """The engagement table at ``runs`` moments, ``step`` days apart, by one sweep over the facts."""
    newest = Run(*[ws.as_of(source) for source in ("advisor_events", "fund_flows", "opportunity")])
    facts = [ws.table(t) for t in ("advisor_dim", "territory_dim", "advisor_events", "opportunity", "fund_flows")]
    return engagement_sweep(*facts, newest, runs, step)


def attribution(ws: Workspace) -> DataFrame:
    return flow_attribution(
        ws.table("fund_flows"),
        ws.table("fund_dim"),
        ws.table("advisor_dim"),
        ws.table("territory_dim"),
        ws.table("advisor_engagement_score"),
    )


def heat_map(ws: Workspace, engagement: DataFrame) -> DataFrame:
    return territory_heat_map(ws.table("territory_dim"), engagement, ws.table("fund_flows"))


def _engagement_score(ws: Workspace) -> DataFrame:
    return ws.stored(
        "advisor_engagement_score", lambda path: sinks.overwrite(sinks.stamped(engagement_at(ws), "computed_at"), path)
    )


def _engagement_history(ws: Workspace) -> DataFrame:
    """All runs in one pass over the facts, a partition for each score date; the newest is the current table."""

    def write(path: str) -> None:
        newest = ws.table("advisor_engagement_score")
        weekly = engagement_trend(ws, len(SNAPSHOT_DAYS_BACK), SNAPSHOT_DAYS_BACK[1])
        earlier = weekly.filter(F.col("score_date") < dates.day(ws.as_of("advisor_events")))
        runs = newest.unionByName(sinks.stamped(earlier, "computed_at"))
        sinks.write_snapshot(runs.hint("rebalance", "score_date"), path, "score_date")

    return ws.stored("advisor_engagement_history", write)


def _attribution(ws: Workspace) -> DataFrame:
    # the joins have dealt the rows out evenly, wide with names as they are: sorted by date where they are,
    # readers skip the other dates' pages, and one more shuffle to bring months together is saved
    return ws.stored("fund_flow_attribution", lambda path: sinks.overwrite(attribution(ws), path, ["flow_date"]))


def _heat_map(ws: Workspace) -> DataFrame:
    return ws.stored(
        "territory_heat_map",
        lambda path: sinks.overwrite(heat_map(ws, ws.table("advisor_engagement_score")), path),
    )


define("advisor_engagement_score", _engagement_score)
define("advisor_engagement_history", _engagement_history)
define("fund_flow_attribution", _attribution)
define("territory_heat_map", _heat_map)


def build_all(ws: Workspace) -> dict[str, DataFrame]:
    """Build every derived table in input order."""
    return {name: ws.table(name) for name in TARGET_LAG}
