"""Advisor activity, pipeline and AUM summaries, and the engagement table over them.

All three summaries aggregate before any join: partial aggregation runs next to the scan,
so what is shuffled is one row per advisor and task however unevenly rows are spread over
advisors, and the joins meet unique keys on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescompass.functions import dates, scoring
from salescompass.operators.skew import dimension_join

# fixed values: closed stages, counted activity types and the columns they fill
CLOSED_STAGES = ("Closed Won", "Closed Lost")
ACTIVITY_COLUMNS = {"CALL": "call_count_30d", "MEETING": "meeting_count_30d", "EMAIL": "email_count_30d"}


@dataclass(frozen=True)
class Run:
    """One run of the engagement table: the instant it sees as now, per source."""

    as_of: object
    flows_as_of: object = None
    opps_as_of: object = None  # none: opportunities of any date


def activity_by_run(events: DataFrame, runs: Sequence, window_days: int = 30) -> DataFrame:
    """Per advisor and run: calls, meetings and emails in the window, and the last event of any type."""
    aggregates, days = {}, []
    for i, as_of in enumerate(runs):
        seen = F.col("event_timestamp") <= dates.instant(as_of)
        recent = seen & (F.col("event_timestamp") >= dates.before(as_of, days=window_days))
        for kind, name in ACTIVITY_COLUMNS.items():
            aggregates[f"{name}_{i}"] = F.count_if((F.col("event_type") == kind) & recent)
        aggregates[f"last_{i}"] = F.max(F.when(seen, F.col("event_timestamp")))
        days.append(dates.day(as_of))
    totals = events.groupBy("advisor_id").agg(*[c.alias(n) for n, c in aggregates.items()])
    rows = F.array(*[
        F.struct(F.lit(i).alias("run"), *[F.col(f"{n}_{i}").alias(n) for n in ACTIVITY_COLUMNS.values()], F.col(f"last_{i}").alias("last_activity_timestamp"))
        for i in range(len(runs))
    ])
    each = totals.select("advisor_id", F.explode(rows).alias("r")).select("advisor_id", "r.*")
    idle = F.datediff(F.get(F.array(*days), F.col("run")), F.col("last_activity_timestamp").cast("date"))
    return each.filter(F.col("last_activity_timestamp").isNotNull()).withColumn("days_since_last_activity", idle)


def activity_counts(events: DataFrame, as_of, window_days: int = 30) -> DataFrame:
    """Per advisor: calls, meetings and emails in the window, and the last event of any type."""
    return activity_by_run(events, [as_of], window_days).drop("run")


def open_only(opps: DataFrame, closed=CLOSED_STAGES) -> DataFrame:
    """Opportunities in an open stage; an unknown (null) stage is not open."""
    return opps.filter(~F.col("stage").isin(*closed))


def opportunity_by_run(opps: DataFrame, runs: Sequence, closed=CLOSED_STAGES) -> DataFrame:
    """Per advisor and run: open opportunities created by then.  Stages are those of today; they have no history."""
    amount = F.coalesce(F.col("amount"), F.lit(0).cast("decimal(18,2)"))
    aggregates = []
    for i, as_of in enumerate(runs):
        known = F.lit(True) if as_of is None else F.col("created_date") <= dates.day(as_of)
        aggregates += [F.count_if(known).alias(f"n_{i}"), F.sum(F.when(known, amount)).alias(f"v_{i}")]
    rows = F.array(*[
        F.struct(F.lit(i).alias("run"), F.col(f"n_{i}").alias("open_opportunity_count"), F.col(f"v_{i}").alias("open_opportunity_value"))
        for i in range(len(runs))
    ])
    totals = open_only(opps, closed).groupBy("advisor_id").agg(*aggregates)
    return totals.select("advisor_id", F.explode(rows).alias("r")).select("advisor_id", "r.*").filter("open_opportunity_count > 0")


def opportunity_summary(opps: DataFrame, closed=CLOSED_STAGES) -> DataFrame:
    return opportunity_by_run(opps, [None], closed).drop("run")


def aum_by_run(flows: DataFrame, runs: Sequence, months: int = 12) -> DataFrame:
    """Absolute flow per advisor and run over the ``months`` before it."""
    within = [F.col("flow_date").between(dates.months_before(as_of, months), dates.day(as_of)) for as_of in runs]
    # a flow in no window adds to no sum: it is left out before the sums are shuffled
    counted = flows.filter(reduce(Column.__or__, within))
    totals = counted.groupBy("advisor_id").agg(*[F.sum(F.when(w, F.abs("flow_amount"))).alias(f"f_{i}") for i, w in enumerate(within)])
    rows = F.array(*[F.struct(F.lit(i).alias("run"), F.col(f"f_{i}").alias("total_flow_12m")) for i in range(len(runs))])
    each = totals.select("advisor_id", F.explode(rows).alias("r")).select("advisor_id", "r.*")
    return each.filter(F.col("total_flow_12m").isNotNull())


def aum_summary(flows: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Absolute flow per advisor over the last ``months``."""
    in_window = F.col("flow_date").between(dates.months_before(as_of, months), dates.day(as_of))
    return aum_by_run(flows.filter(in_window), [as_of], months).drop("run")


def advisor_engagement(
    advisors: DataFrame,
    territories: DataFrame,
    events: DataFrame,
    opps: DataFrame,
    flows: DataFrame,
    as_of,
    flows_as_of=None,
) -> DataFrame:
    """One scored row per active advisor."""
    return engagement_runs(advisors, territories, events, opps, flows, [Run(as_of, flows_as_of)])


def engagement_runs(
    advisors: DataFrame, territories: DataFrame, events: DataFrame, opps: DataFrame, flows: DataFrame, runs: Sequence[Run]
) -> DataFrame:
    """One scored row per active advisor and run; every fact table is read once for all runs.

    The summaries are a row per advisor and run, so the joins meet unique keys.
    """
    active = advisors.filter("active").select(
        "advisor_id", "advisor_name", "territory_id", F.col("tier").alias("advisor_tier"),
        F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))).alias("run"),
    )
    names = territories.select("territory_id", "territory_name")
    keys = ["advisor_id", "run"]
    joined = (
        active.join(activity_by_run(events, [r.as_of for r in runs]), keys, "left")
        .join(opportunity_by_run(opps, [r.opps_as_of for r in runs]), keys, "left")
        .join(aum_by_run(flows, [r.as_of if r.flows_as_of is None else r.flows_as_of for r in runs]), keys, "left")
    )
    joined = dimension_join(joined, names, "territory_id", "left")
    return _scored(joined, F.get(F.array(*[dates.day(r.as_of) for r in runs]), F.col("run")))


MICROS_PER_DAY = 86_400_000_000


def _entries(rows: DataFrame, back_most, back_least, runs: int, step: int, *columns) -> DataFrame:
    """Adds ``enter`` and ``leave``: rows count in the runs from ``enter`` up to before ``leave``.

    Run i is ``step * (runs - 1 - i)`` days back.  A row counts while a run is at most ``back_most``
    and at least ``back_least`` days back; one that does so in no run has ``leave`` not after ``enter``.
    """
    enter = runs - 1 - F.least(F.lit(runs - 1), F.floor(back_most / step))
    leave = F.when(back_least > 0, runs - F.ceil(back_least / step)).otherwise(runs)
    return rows.filter(back_most >= 0).select(*columns, enter.cast("int").alias("enter"), F.greatest(leave, F.lit(0)).cast("int").alias("leave"))


def _changes(summed: DataFrame, numbers: dict[str, str]) -> DataFrame:
    """``advisor_id, i`` and by how much each number changes with run i: up at ``enter``, down at ``leave``."""
    counts = F.col("leave") > F.col("enter")
    up = F.struct(F.col("enter").alias("i"), *[F.when(counts, F.col(n)).otherwise(F.lit(0).cast(k)).alias(n) for n, k in numbers.items()], F.col("last"))
    down = F.struct(F.col("leave").alias("i"), *[(-F.col(n)).cast(k).alias(n) for n, k in numbers.items()], F.lit(None).cast("timestamp_ntz").alias("last"))
    both = F.array_compact(F.array(up, F.when(counts & (F.col("leave") < F.lit(_RUNS_END)), down)))
    return summed.select("advisor_id", F.explode(both).alias("c")).select("advisor_id", "c.*")


_RUNS_END = 1 << 30  # ``leave`` of rows that stay in to the end
_SWEPT = {
    **dict.fromkeys(ACTIVITY_COLUMNS.values(), "long"), "total_flow_12m": "decimal(28,2)", "flows": "long",
    "open_opportunity_count": "long", "open_opportunity_value": "decimal(28,2)",
}


def engagement_sweep(
    advisors: DataFrame, territories: DataFrame, events: DataFrame, opps: DataFrame, flows: DataFrame, newest: Run, runs: int, step: int = 1
) -> DataFrame:
    """The rows of ``engagement_runs`` for ``runs`` runs, ``step`` days apart up to ``newest``, by one sweep.

    A fact row enters the windows of the runs at one run and leaves at a later one.  The facts are summed
    per advisor and these two runs, each sum becomes a change up and a change down, and the running
    total of an advisor's changes is its state at every run.  The work does not grow with the
    number of runs, except for the rows that come out.
    """
    end = F.lit(_RUNS_END)
    now, flow_day = dates.instant(newest.as_of), dates.day(newest.as_of if newest.flows_as_of is None else newest.flows_as_of)

    micros = F.timestamp_diff("MICROSECOND", F.col("event_timestamp"), now)
    whole = F.expr(f"age div {MICROS_PER_DAY}")
    upward = F.expr(f"(age + {MICROS_PER_DAY - 1}) div {MICROS_PER_DAY}")
    kinds = [F.count_if(F.col("event_type") == kind).alias(name) for kind, name in ACTIVITY_COLUMNS.items()]
    aged = events.select("advisor_id", "event_type", "event_timestamp", micros.alias("age")).filter("age >= 0")
    placed = _entries(aged, whole, upward - 30, runs, step, "advisor_id", "event_type", "event_timestamp")
    activity = placed.groupBy("advisor_id", "enter", "leave").agg(*kinds, F.max("event_timestamp").alias("last"))

    after = F.add_months("flow_date", 12)
    last_day = F.when(F.add_months(F.date_add(after, 1), -12) <= F.col("flow_date"), F.date_add(after, 1)).otherwise(after)
    dated = flows.filter(F.col("flow_date").isNotNull() & F.col("flow_amount").isNotNull())
    placed = _entries(dated, F.datediff(flow_day, F.col("flow_date")), F.datediff(flow_day, last_day), runs, step, "advisor_id", "flow_amount")
    money = placed.filter(F.col("leave") > F.col("enter")).groupBy("advisor_id", "enter", "leave").agg(
        F.sum(F.abs("flow_amount")).cast("decimal(28,2)").alias("total_flow_12m"), F.count(F.lit(1)).alias("flows"), F.lit(None).cast("timestamp_ntz").alias("last")
    )

    known = open_only(opps)
    back = F.lit(step * (runs - 1)) if newest.opps_as_of is None else F.datediff(dates.day(newest.opps_as_of), F.col("created_date"))
    placed = _entries(known, back, F.lit(0), runs, step, "advisor_id", F.coalesce("amount", F.lit(0).cast("decimal(18,2)")).alias("amount"))
    deals = placed.groupBy("advisor_id", "enter", "leave").agg(
        F.count(F.lit(1)).alias("open_opportunity_count"), F.sum("amount").cast("decimal(28,2)").alias("open_opportunity_value"),
        F.lit(None).cast("timestamp_ntz").alias("last"),
    )

    changes = None
    for summed in (activity, money, deals):
        numbers = {n: k for n, k in _SWEPT.items() if n in summed.columns}
        each = _changes(summed.withColumn("leave", F.when(F.col("leave") >= runs, end).otherwise(F.col("leave"))), numbers)
        each = each.select("advisor_id", "i", *[F.col(n) if n in numbers else F.lit(0).cast(k).alias(n) for n, k in _SWEPT.items()], "last")
        changes = each if changes is None else changes.union(each)
    at_run = changes.groupBy("advisor_id", "i").agg(*[F.sum(n).cast(k).alias(n) for n, k in _SWEPT.items()], F.max("last").alias("last"))

    so_far = Window.partitionBy("advisor_id").orderBy("i")
    total = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = at_run.select(
        "advisor_id", "i", F.lead("i", 1, runs).over(so_far).alias("next"),
        *[F.sum(n).over(total).cast(k).alias(n) for n, k in _SWEPT.items()], F.max("last").over(total).alias("last_activity_timestamp"),
    ).withColumn("total_flow_12m", F.when(F.col("flows") > 0, F.col("total_flow_12m"))).drop("flows")

    # an advisor's states as one row (at most one a run), already where the window has put them: what the join
    # moves is a row per advisor, and the runs come out after it
    state = F.struct(*[c for c in states.columns if c != "advisor_id"])
    listed = states.groupBy("advisor_id").agg(F.min("i").alias("first"), F.collect_list(state).alias("states"))
    active = advisors.filter("active").select("advisor_id", "advisor_name", "territory_id", F.col("tier").alias("advisor_tier"))
    named = active.join(listed, "advisor_id", "left")
    unknown = F.struct(*[
        F.lit(0).alias("i") if f.name == "i" else F.coalesce("first", F.lit(runs)).alias("next") if f.name == "next" else F.lit(None).cast(f.dataType).alias(f.name)
        for f in states.schema if f.name != "advisor_id"
    ])
    every = F.when(F.col("states").isNull(), F.array(unknown)).otherwise(F.concat(F.array(unknown), "states"))
    at = named.select(*active.columns, F.explode(every).alias("s")).select(*active.columns, "s.*").filter("i < next")
    score_date = F.date_sub(dates.day(newest.as_of), (F.lit(runs - 1) - F.col("run")) * step)
    idle = F.datediff(score_date, F.col("last_activity_timestamp").cast("date"))
    joined = at.withColumn("run", F.explode(F.sequence(F.col("i"), F.col("next") - 1))).withColumn("days_since_last_activity", idle)
    return _scored(dimension_join(joined, territories.select("territory_id", "territory_name"), "territory_id", "left"), score_date)


def engagement_of(advisors: DataFrame, territories: DataFrame, activity: DataFrame, opportunities: DataFrame, aum: DataFrame, as_of) -> DataFrame:
    """One scored row per active advisor from finished summaries, a row per advisor each.

    ``activity`` has the counts of the window and ``last_activity_timestamp``; days since then, and
    with them the scores, are worked out for ``as_of`` here, so a summary stays as it is while no event comes or goes.
    """
    idle = F.datediff(dates.day(as_of), F.col("last_activity_timestamp").cast("date"))
    active = advisors.filter("active").select("advisor_id", "advisor_name", "territory_id", F.col("tier").alias("advisor_tier"))
    joined = active.join(activity.withColumn("days_since_last_activity", idle), "advisor_id", "left").join(opportunities, "advisor_id", "left").join(aum, "advisor_id", "left")
    return _scored(dimension_join(joined, territories.select("territory_id", "territory_name"), "territory_id", "left"), dates.day(as_of))


def _scored(joined: DataFrame, score_date: Column) -> DataFrame:
    counted = list(ACTIVITY_COLUMNS.values())
    return joined.select(
        "advisor_id",
        "advisor_name",
        "territory_id",
        "territory_name",
        "advisor_tier",
        score_date.alias("score_date"),
        scoring.engagement_score(*[F.col(c) for c in counted], F.col("days_since_last_activity")).alias(
            "engagement_score"
        ),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counted],
        "last_activity_timestamp",
        F.coalesce("days_since_last_activity", F.lit(scoring.NO_ACTIVITY_DAYS)).alias("days_since_last_activity"),
        scoring.estimated_aum(F.col("total_flow_12m")).alias("aum_amount"),
        F.coalesce("open_opportunity_count", F.lit(0)).cast("long").alias("open_opportunity_count"),
        F.coalesce("open_opportunity_value", F.lit(0)).cast("decimal(28,2)").alias("open_opportunity_value"),
    )


def attrition_risk(engagement: DataFrame) -> DataFrame:
    """Adds the rule-based attrition class."""
    risk = scoring.attrition_class(
        F.col("engagement_score"), F.col("days_since_last_activity"), F.col("aum_amount")
    )
    return engagement.withColumn("attrition_risk", risk)


def pipeline_signals(advisors: DataFrame, territories: DataFrame, opps: DataFrame, top: int | None = 15) -> DataFrame:
    """Open deals and pipeline per advisor, with a HOT / WARM / COLD signal."""
    deals = (
        open_only(opps)
        .groupBy("advisor_id")
        .agg(
            F.countDistinct("opportunity_id").alias("open_opps"),
            F.sum(F.coalesce(F.col("amount"), F.lit(0).cast("decimal(18,2)"))).alias("pipeline"),
        )
    )
    named = dimension_join(advisors, territories.select("territory_id", "territory_name"), "territory_id")
    result = (
        named.join(deals, "advisor_id", "left")
        .withColumn("open_opps", F.coalesce("open_opps", F.lit(0)))
        .filter("open_opps > 0")
        .select(
            "advisor_id",
            "advisor_name",
            "territory_name",
            "tier",
            "open_opps",
            F.round(F.col("pipeline") / 1_000_000, 2).alias("pipeline_m"),
            scoring.pipeline_signal(F.col("open_opps")).alias("signal"),
        )
    )
    if top is None:
        return result
    return result.orderBy(F.desc_nulls_last("pipeline_m"), "advisor_id").limit(top)
