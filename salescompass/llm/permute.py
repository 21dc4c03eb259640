"""A pseudorandom permutation of 0 … n-1 as a column expression.

The numbers are laid out on a grid of about sqrt(n) by sqrt(n).  Each Feistel round shifts
one coordinate by a keyed hash of the other, which can be undone, so the rounds permute the
grid.  A result outside 0 … n-1 goes through the rounds again (cycle walking).  The grid
has fewer than ``rows`` places beyond n, so a walk meets the range within that many steps
if n is below WALK ** 2; beyond, a longer walk has a probability below WALK ** -WALK.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import unused

ROUNDS = 6
WALK = 64


def permuted(number: Column, n: Column, *key: Column) -> Column:
    """Place of ``number`` (0 … n-1) in the permutation that ``key`` selects; null if n is 0."""
    n = n.cast("long")
    rows = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    columns = F.greatest(F.ceil(n / rows).cast("long"), F.lit(1).cast("long"))
    grid = F.struct(number.cast("long").alias("x"), n.alias("n"), rows.alias("rows"), columns.alias("columns"), F.xxhash64(*key).alias("key"))

    def rounds(x: Column, of: Column) -> Column:
        def one(state: Column, step: Column) -> Column:
            row, column = state["row"], state["column"]
            to_row = F.pmod(row + F.pmod(F.xxhash64(of["key"], step, column), of["rows"]), of["rows"])
            to_column = F.pmod(column + F.pmod(F.xxhash64(of["key"], step, row), of["columns"]), of["columns"])
            even = step % 2 == 0
            return F.struct(F.when(even, to_row).otherwise(row).alias("row"), F.when(even, column).otherwise(to_column).alias("column"))

        start = F.struct(F.floor(x / of["columns"]).cast("long").alias("row"), F.pmod(x, of["columns"]).alias("column"))
        steps = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        return F.aggregate(steps, start, one, lambda s: s["row"] * of["columns"] + s["column"])

    def walk(of: Column) -> Column:
        again = F.sequence(F.lit(1), F.lit(WALK))
        return F.aggregate(again, rounds(of["x"], of), lambda x, _: F.when(x < of["n"], x).otherwise(rounds(x, of)))

    # one-element transform: the grid is worked out once per row
    return F.when(n > 0, F.element_at(F.transform(F.array(grid), walk), 1))


def with_permuted(df: DataFrame, name: str, number: Column, n: Column, *key: Column) -> DataFrame:
    """Adds ``permuted(number, n, *key)`` as column ``name``, the first walk step by step in generated code.

    Every round is a projection of its own, so nothing is worked out twice.  Only the few numbers that
    are outside the range after one walk go through the general expression, which Spark interprets.
    """
    names = {c: unused(f"_{c}", df) for c in ("x", "n", "rows", "columns", "key", "row", "column")}
    x, of, rows, columns, keyed, row, column = (F.col(names[c]) for c in names)
    steps = df.withColumns({names["x"]: number.cast("long"), names["n"]: n.cast("long"), names["key"]: F.xxhash64(*key)})
    steps = steps.withColumn(names["rows"], F.greatest(F.ceil(F.sqrt(of.cast("double"))).cast("long"), F.lit(1).cast("long")))
    steps = steps.withColumn(names["columns"], F.greatest(F.ceil(of / rows).cast("long"), F.lit(1).cast("long")))
    steps = steps.withColumns({names["row"]: F.floor(x / columns).cast("long"), names["column"]: F.pmod(x, columns)})
    for step in range(ROUNDS):
        if step % 2 == 0:
            steps = steps.withColumn(names["row"], F.pmod(row + F.pmod(F.xxhash64(keyed, F.lit(step), column), rows), rows))
        else:
            steps = steps.withColumn(names["column"], F.pmod(column + F.pmod(F.xxhash64(keyed, F.lit(step), row), columns), columns))
    steps = steps.withColumn(names["x"], row * columns + column)
    further = F.when(x < of, x).otherwise(permuted(number, n, *key))
    return steps.withColumn(name, F.when(of > 0, further)).drop(*names.values())
