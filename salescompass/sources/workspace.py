"""Named tables over one source folder.

Landing projections are re-planned at each use (pushdown reaches the source files).
Tables that cost joins or aggregations over whole tables — fund flows and the derived
tables — are written once per application into the shared folder and read back, so later
queries scan a finished table and a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import datetime as dt
import importlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescompass.schemas import LANDING
from salescompass.session import digest, run_dir, shuffles_released, size_shuffles
from salescompass.sources import landing, sinks, telemetry

_GUARD = threading.Lock()
_BUILT: dict[tuple[str, str], dict] = {}

Builder = Callable[["Workspace"], DataFrame]


class Workspace:
    def __init__(self, spark: SparkSession, source_dir: str, external: dict[str, Callable[[], DataFrame]] | None = None):
        self.spark = spark
        self.source_dir = source_dir.rstrip("/")
        self.external = external or {}
        state_key = self.source_dir if not external else f"{self.source_dir}#{id(self)}"
        self._folder = run_dir(spark, digest(state_key))
        self._state = _BUILT.setdefault((spark.sparkContext.applicationId, state_key), {})
        self.once("shuffles", lambda: size_shuffles(spark, self.source_dir))

    # -- tables ----------------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        """A landing, telemetry or derived table by name.

        A name listed in ``external`` is read from there instead — same columns, no copy —
        which is how a shared table replaces a landing table.
        """
        if name in self.external:
            return declared(self.external[name](), name)
        if name == "account":
            raise KeyError("account has no landing files: name its table in ``external``")
        if name not in _TABLES:
            importlib.import_module("salescompass.plans.derived")  # which defines the derived tables
        return _TABLES[name](self)

    def source(self, name: str) -> DataFrame:
        """One of the given files, unchanged."""
        return landing.read(self.spark, self.source_dir, name)

    def register_views(self, names: dict[str, str]) -> None:
        """Temp view per logical name, so SQL text can use the logical names."""
        for view, table in names.items():
            self.table(table).createOrReplaceTempView(view)

    # -- values computed once --------------------------------------------------------
    def once(self, key: str, compute: Callable[[], object]):
        # one lock per value: a stream's handler thread may need other tables meanwhile
        with _GUARD:
            lock = self._state.setdefault(("lock", key), threading.RLock())
        with lock:
            if key not in self._state:
                self._state[key] = compute()
            return self._state[key]

    def rows(self, source: str) -> int:
        return self.once(f"rows:{source}", lambda: self.source(source).count())

    def as_of(self, table: str) -> dt.datetime | dt.date:
        """The reference instant of a table: its newest time value (one value, one column read)."""
        column = _TIME_COLUMNS[table]
        return self.once(f"as_of:{table}", lambda: self.table(table).agg(F.max(column)).first()[0])

    # -- tables written once ---------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self._folder}/{name}"

    def stored(self, name: str, write: Callable[[str], None]) -> DataFrame:
        """Run ``write(path)`` on first use, then read the finished table.

        Each attempt gets a folder of its own, so rows of a failed one are never read.
        """

        def build() -> tuple:
            attempt = self._state[("attempt", name)] = self._state.get(("attempt", name), 0) + 1
            path = f"{self.path(name)}/attempt={attempt}"
            with shuffles_released(self.spark):
                write(path)
            return path, self.spark.read.parquet(path).schema

        path, schema = self.once(f"table:{name}", build)
        return self.spark.read.schema(schema).parquet(path)


def declared(df: DataFrame, name: str) -> DataFrame:
    """A table from outside with the declared type of each column it shares with our schema."""
    types = {f.name: f.dataType for f in LANDING[name].fields} if name in LANDING else {}
    return df.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in df.columns])


_TIME_COLUMNS = {
    "advisor_events": "event_timestamp",
    "fund_flows": "flow_date",
    "opportunity": "last_modified",
    "usage_history": "usage_date",
    "alert_history": "scheduled_time",
    "refresh_history": "refresh_start_time",
}


def _flows(ws: Workspace) -> DataFrame:
    def write(path: str) -> None:
        items, day = landing.flow_items(ws.spark, ws.source_dir, ws.rows("supplier"), ws.rows("nation")), F.to_date("l_shipdate")
        sinks.write_balanced(items, path, ["territory_id", F.trunc(day, "month")], ["territory_id", day], finish=landing.as_flows)

    return ws.stored("fund_flows", write)


def _located(ws: Workspace) -> DataFrame:
    return landing.located_events(ws.table("advisor_events"), ws.table("advisor_dim"))


_TABLES: dict[str, Builder] = {
    "territory_dim": lambda ws: landing.territory_dim(ws.spark, ws.source_dir),
    "fund_dim": lambda ws: landing.fund_dim(ws.spark, ws.source_dir),
    "advisor_dim": lambda ws: landing.advisor_dim(ws.spark, ws.source_dir, ws.rows("nation")),
    "advisor_events": lambda ws: landing.advisor_events(ws.spark, ws.source_dir, ws.rows("customer")),
    "located_events": _located,
    "fund_flows": _flows,
    "opportunity": lambda ws: landing.opportunity(ws.spark, ws.source_dir, ws.rows("part")),
    "usage_history": lambda ws: telemetry.usage_history(ws.spark, ws.source_dir),
    "alert_history": lambda ws: telemetry.alert_history(ws.spark, ws.source_dir),
    "refresh_history": lambda ws: telemetry.refresh_history(ws.spark, ws.source_dir),
}


def define(name: str, builder: Builder) -> None:
    """Add a derived table to the workspace."""
    _TABLES[name] = builder
