"""Whitening of embeddings by shifted Cholesky QR.

The centred rows X are orthogonalised in passes over the data.  A pass sums the Gram matrix
of the rows in their present form, each task its own rows, and factors it; the next pass
solves against the new triangle as well.  The first factorisation has a shift that keeps
it positive whatever the condition of X, the second one pivots and so finds the rank, and
plain ones follow until the rows are orthonormal to rounding.  The product of the triangles
is R with X = QR, and the singular values and right vectors of the small R are those of X:
the covariance itself, which would square the condition, is never decomposed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import stored, unused

STEPS = 256  # a vector's entries are taken in steps of 1 / STEPS
COMPONENTS = 4
PASSES = 8  # three or four are needed
_ROWS = 4096  # rows that are multiplied at once
_LONG = 2**63 - 1


class Whitening(NamedTuple):
    """What was fitted on n distinct rows.  ``sums`` are exact integers, ``vectors`` has a row for each component."""

    n: int
    sums: tuple[int, ...]
    largest: int  # of the absolute entries
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace

    def scale(self, components: int) -> np.ndarray:
        """Dimensions x components: what centred rows are multiplied by."""
        k = min(components, len(self.eigenvalues))
        return (self.vectors[:k] / np.sqrt(self.eigenvalues[:k])[:, None]).T


def steps(vector: Column, per_unit: int = STEPS) -> Column:
    """Entries as whole steps, floor(per_unit * entry); null if the vector is null or empty or
    has an entry that is null or not finite.  Steps beyond 64 bits become the largest ones."""

    @F.arrow_udf("array<long>")
    def whole(column: pa.Array) -> pa.Array:
        column = column.cast(pa.list_(pa.float64()))
        offsets = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]  # nulls become NaN
        offsets = offsets - offsets[0]
        good = np.isfinite(values)
        bad = np.concatenate([[0], np.cumsum(~good)])
        keep = (bad[offsets[1:]] == bad[offsets[:-1]]) & (offsets[1:] > offsets[:-1]) & column.is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            whole = np.floor(np.where(good, values, 0.0) * per_unit)
        high, low = whole >= 2.0**63, whole < -(2.0**63)
        whole = np.where(high | low, 0, whole).astype(np.int64)
        whole[high], whole[low] = _LONG, -_LONG - 1
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whole), mask=pa.array(~keep))

    return whole(vector)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], name: str = "x") -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, len(batch), _ROWS):
            yield _matrix(batch.column(name).slice(low, _ROWS))


def _exact(x: np.ndarray, n: int, sums: tuple[int, ...], largest: int) -> np.ndarray:
    """n * x - sums without rounding; beyond 64 bits as Python integers."""
    kind = np.int64 if n * largest + max(map(abs, sums)) <= _LONG else object
    return x.astype(kind) * kind(n) - np.array(sums, kind) if kind is np.int64 else x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...], largest: int) -> np.ndarray:
    return (_exact(x, n, sums, largest) / n).astype(np.float64)


def _totals(batches):
    """Per task and dimension: sum, largest absolute entry, rows."""
    n, sums, largest = 0, None, None
    for x in _blocks(batches):
        safe = np.abs(x.astype(np.float64)).max() * len(x) < 2.0**62
        part = x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0)
        most = np.maximum(np.abs(x.max(axis=0).astype(object)), np.abs(x.min(axis=0).astype(object)))
        n, sums, largest = n + len(x), part if sums is None else sums + part, most if largest is None else np.maximum(largest, most)
    if n:
        number = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(sums)), pa.int32()), pa.array([Decimal(int(s)) for s in sums], number), pa.array([Decimal(int(m)) for m in largest], number), pa.array([n] * len(sums), pa.int64())],
            names=["i", "total", "largest", "n"],
        )


def _gram(fitted: tuple[int, tuple[int, ...], int], solves: list[tuple[np.ndarray, np.ndarray]]):
    """Upper triangle of the Gram matrix of a task's rows, after the solves so far."""

    def gram(batches):
        total = 0
        for x in _blocks(batches):
            q = orthogonalised(_centred(x, *fitted), solves)
            total = total + q.T @ q
        if not isinstance(total, int):
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    return gram


def orthogonalised(rows: np.ndarray, solves: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Rows times the inverse of each triangle in turn; ``columns`` are those that a triangle is for."""
    for columns, triangle in solves:
        rows = np.linalg.solve(triangle.T, rows[:, columns].T).T
    return rows


def pivoted_cholesky(a: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Order of the columns, and rows R (rank x columns in the given order) with a = R'R up to the tolerance."""
    a, order, rows = a.copy(), [], []
    left = np.ones(len(a), bool)
    while left.any():
        pivot = int(np.argmax(np.where(left, a.diagonal(), -np.inf)))
        if a[pivot, pivot] <= tolerance:
            break
        row = np.where(left, a[pivot], 0.0) / np.sqrt(a[pivot, pivot])
        a = a - np.outer(row, row)
        left[pivot] = False
        order.append(pivot)
        rows.append(row)
    return np.array(order, np.int64), np.array(rows).reshape(len(rows), len(a))


def _summed(fit: DataFrame, fitted, solves) -> np.ndarray:
    """The whole Gram matrix: one row per entry reaches the driver, as many as a vector has dimensions squared, halved."""
    parts = fit.mapInArrow(_gram(fitted, solves), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = parts.orderBy("i", "j").toArrow()
    i, j, v = (rows.column(c).to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((int(j.max()) + 1,) * 2)
    out[i, j] = out[j, i] = v
    return out


def distinct_steps(vectors: DataFrame, vector_col: str = "embedding", per_unit: int = STEPS) -> DataFrame:
    """``x``: each distinct vector of steps once, of those with the commonest number of dimensions
    (ties: more dimensions).  Copies are put together in each task before the shuffle."""
    x = vectors.select(steps(F.col(vector_col), per_unit).alias("x")).filter("x is not null")
    fit = stored(x.distinct(), "whitening-fit")
    commonest = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    return fit.filter(F.size("x") == (commonest["d"] if commonest else 0))


def fit_whitening(fit: DataFrame) -> Whitening | None:
    """Fit on the distinct rows ``x``; None without rows.

    A direction whose standard deviation is below about 1e-9 of the largest one (the rounding
    of a pass) counts as constant and gets no component.  Rows that are all equal have none.
    """
    totals = fit.mapInArrow(_totals, "i int, total decimal(38,0), largest decimal(38,0), n long").groupBy("i")
    totals = totals.agg(F.sum("total").alias("total"), F.max("largest").alias("largest"), F.sum("n").alias("n")).orderBy("i").collect()
    if not totals:
        return None
    n, sums, largest = totals[0]["n"], tuple(int(r["total"]) for r in totals), max(int(r["largest"]) for r in totals)
    fitted, d = (n, sums, largest), len(sums)
    unit = np.finfo(float).eps / 2

    gram = _summed(fit, fitted, [])
    norm = np.linalg.norm(gram, 2)
    none = Whitening(n, sums, largest, np.zeros((0, d)), np.zeros(0), float(gram.trace()) / n, 1)
    if not norm:
        return none
    shift = 11 * (n * d + d * (d + 1)) * unit * norm
    triangle = np.linalg.cholesky(gram + shift * np.eye(d)).T
    solves, r, passes = [(np.arange(d), triangle)], triangle, 1

    gram = _summed(fit, fitted, solves)
    columns, rows = pivoted_cholesky(gram, 64 * d * unit * gram.diagonal().max())
    solves.append((columns, np.triu(rows[:, columns])))
    r, passes = rows @ r, 2

    while passes < PASSES:
        gram = _summed(fit, fitted, solves)
        passes += 1
        triangle = np.linalg.cholesky(gram).T
        solves.append((np.arange(len(gram)), triangle))
        r = triangle @ r
        if np.abs(gram - np.eye(len(gram))).max() < 64 * d * unit:
            break
    _, singular, vectors = np.linalg.svd(r, full_matrices=False)
    return Whitening(n, sums, largest, vectors, singular**2 / n, float((r * r).sum()) / n, passes)


def identity_error(fit: DataFrame, model: Whitening, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity; 0 without components."""
    scale, fitted = model.scale(components), model[:3]
    if not scale.shape[1]:
        return 0.0

    def moments(batches):
        total = 0
        for x in _blocks(batches):
            w = _centred(x, *fitted) @ scale
            total = total + np.hstack([w.T @ w, w.sum(axis=0)[:, None]])
        if not isinstance(total, int):
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    rows = fit.mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    k = scale.shape[1]
    total = np.zeros((k, k + 1))
    for row in rows:
        total[row["i"], row["j"]] = row["v"] / model.n
    mean = total[:, k]
    return float(np.abs(total[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, model: Whitening | None, vector_col: str = "embedding", components: int = COMPONENTS, per_unit: int = STEPS) -> DataFrame:
    """Adds ``deviation`` (decimal; n squared times the squared distance from the mean, exact; null
    beyond 38 digits) and ``whitened`` (array of at most ``components`` doubles) to every row whose
    vector could be fitted; input columns of these names are replaced.

    Dropped are rows whose vector is null or empty, holds null or non-finite entries, or has
    another number of dimensions than the fitted ones.  Repeated rows stay.
    """
    out = vectors.drop(*[c for c in vectors.columns if c.lower() in ("deviation", "whitened") and c.lower() != vector_col.lower()])
    if model is None:
        return out.select("*", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")).filter(F.lit(False))
    scale, fitted = model.scale(components), model[:3]
    exact_in_64 = len(model.sums) * (model.n * model.largest + max(map(abs, model.sums))) ** 2 <= _LONG

    @F.arrow_udf("struct<deviation:decimal(38,0),whitened:array<double>>")
    def project(column: pa.Array) -> pa.Array:
        deviations, parts = [], []
        for low in range(0, len(column), _ROWS):
            x = _matrix(column.slice(low, _ROWS))
            exact = _exact(x, *fitted)
            squares = (exact * exact).sum(axis=1) if exact_in_64 else (exact.astype(object) ** 2).sum(axis=1)
            deviations += [Decimal(int(s)) if s < 10**38 else None for s in squares]
            parts.append((exact / fitted[0]).astype(np.float64) @ scale)
        rows = np.concatenate(parts) if parts else np.zeros((0, scale.shape[1]))
        offsets = pa.array(np.arange(len(rows) + 1) * scale.shape[1], pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(deviations, pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], ["deviation", "whitened"]
        )

    x, both = unused("x", out), unused("both", out)
    usable = out.withColumn(x, steps(F.col(vector_col), per_unit)).filter(F.size(x) == len(model.sums))
    kept = [c for c in out.columns if c.lower() not in ("deviation", "whitened")]
    return usable.withColumn(both, project(F.col(x))).select(*[F.col(f"`{c}`") for c in kept], f"{both}.deviation", f"{both}.whitened")


def components_of(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit and apply: a row for each usable vector and component (see ``whitened``), numbered from
    1 by falling eigenvalue, with the share of variance it explains.  ``deviation`` is null beyond
    64 bits.  Fewer components come out if the fitted rows vary in fewer directions."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    fit = distinct_steps(rows)
    model = fit_whitening(fit)
    kind = "struct<component:int,explained:double,whitened:double>"
    explained = F.array(*[F.lit(float(e)) for e in model.explained[:components]]) if model and len(model.eigenvalues) else F.array().cast("array<double>")
    each = F.expr("transform(whitened, (w, i) -> named_struct('component', i + 1, 'explained', explained[i], 'whitened', w))").cast(f"array<{kind}>")
    out = whitened(rows, model, components=components).withColumn("explained", explained).withColumn("each", F.explode(each))
    error = identity_error(fit, model, components) if model else 0.0
    return out.select(
        "vec_id", "each.component", F.lit(model.n if model else 0).cast("long").alias("n"), F.expr("try_cast(deviation as long)").alias("deviation"),
        "each.whitened", "each.explained", F.lit(error).alias("identity_error"),
    )
