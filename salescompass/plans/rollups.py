"""Stored rollups of a logical table: metric queries that do not read the table.

Sums and counts of every fact are additive, so a metric at some dimensions can be added up from any stored
grouping that holds them.  All groupings are made in one pass and stored once, a folder each;
a query reads the smallest one that has its dimensions and those of its filters.  The run date of a state table is
in every grouping, as books of several dates must not be added up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.operators.rows import latest_snapshot
from salescompass.plans.semantic import SEMANTIC, LogicalTable

Write = Callable[[str, DataFrame], DataFrame]


def _name(dims: Sequence[str]) -> str:
    return "-".join(sorted(dims)) or "all"


def _partials(logical: LogicalTable) -> list[Column]:
    """Sum, sum as double and number of values of every fact."""
    return [
        c
        for f in logical.facts
        for c in (F.sum(f.name).alias(f"{f.name}__sum"), F.sum(F.col(f.name).cast("double")).alias(f"{f.name}__double"), F.count(f.name).alias(f"{f.name}__n"))
    ]


@dataclass(frozen=True)
class Rollups:
    """Stored groupings of a logical table: their dimensions, tables and numbers of rows."""

    table: str
    groupings: dict[frozenset[str], tuple[DataFrame, int]]

    def smallest(self, dims: Sequence[str]) -> tuple[frozenset[str], DataFrame]:
        fit = [(rows, sorted(of), of, df) for of, (df, rows) in self.groupings.items() if set(dims) <= of]
        if not fit:
            raise ValueError(f"no stored grouping of {self.table} has {sorted(dims)}")
        _, _, of, df = min(fit, key=lambda x: x[:2])
        return of, df


def build_rollups(table: str, df: DataFrame, groupings: Sequence[Sequence[str]], write: Write) -> Rollups:
    """Store the given groupings.  ``write`` (name, DataFrame) stores a table once and reads it back.

    One pass: Spark repeats a row for each grouping and adds up next to the scan.
    """
    logical = SEMANTIC[table]
    always = [logical.snapshot] if logical.snapshot else []
    wanted = [sorted({*g, *always}) for g in groupings]
    unknown = {d for g in wanted for d in g} - {d.name for d in logical.dimensions}
    if unknown:
        raise ValueError(f"not dimensions of {table}: {sorted(unknown)}")
    dims = sorted({d for g in wanted for d in g})
    which = F.grouping_id(*dims).alias("which")
    summed = df.groupingSets([[F.col(d) for d in g] for g in wanted], *[F.col(d) for d in dims]).agg(which, *_partials(logical))
    stored = write(f"rollup_{table}", summed)
    sizes = {r["which"]: r["n"] for r in stored.groupBy("which").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for g in wanted:
        number = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in g)  # grouping_id: a bit for each dimension left out
        part = stored.filter(F.col("which") == number).drop("which", *[d for d in dims if d not in g])
        out[frozenset(g)] = (part, sizes.get(number, 0))
    return Rollups(table, out)


def write_rollups(summed: DataFrame, path: str) -> None:
    """A folder for each grouping."""
    summed.write.mode("overwrite").partitionBy("which").parquet(path)


def rollup_query(
    rollups: Rollups, metrics: Sequence[str], dims: Sequence[str] = (), filters: Mapping[str, Column] | None = None, all_runs: bool = False
) -> DataFrame:
    """The answer of ``metric_query`` from stored groupings; ``filters`` name the dimension that each is on."""
    logical, filters = SEMANTIC[rollups.table], filters or {}
    of, df = rollups.smallest([*dims, *filters])
    if logical.snapshot in of and not all_runs and logical.snapshot not in dims:
        if logical.snapshot in filters:
            raise ValueError(f"a filter on {logical.snapshot} picks a run: pass all_runs")
        df = latest_snapshot(df, logical.snapshot)
    for predicate in filters.values():
        df = df.filter(predicate)
    columns = []
    for name in metrics:
        metric = logical.metric(name)
        if metric.aggregation == "sum":
            columns.append(F.sum(f"{metric.fact}__sum").alias(name))
        else:
            columns.append((F.sum(f"{metric.fact}__double") / F.nullif(F.sum(f"{metric.fact}__n"), F.lit(0))).alias(name))
    return df.groupBy(*dims).agg(*columns)
