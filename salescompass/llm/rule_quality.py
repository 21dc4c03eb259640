"""Quality classifier: a sparse ensemble of rules over text statistics.

A random forest of shallow trees is grown on labelled texts.  Every path from a root to a
node is a rule, a conjunction of bounds on statistics.  A logistic regression with an L1
penalty picks few rules and their weights, and the result is one column expression.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.statistics import STATISTICS, text_statistics
from salescompass.llm.storage import stored, unused

SAMPLE = 10_000  # labelled rows that a model is fitted on, those of the smallest hash of doc_id
TREES, DEPTH, PENALTY = 24, 4, 0.002

Bounds = tuple[tuple[int, float, float], ...]  # statistic, above, up to


class RuleModel(NamedTuple):
    intercept: float
    rules: tuple[tuple[Bounds, float], ...]

    def score(self, statistics: str) -> Column:
        """Probability of the good class from a struct of statistics."""
        terms = [F.when(condition(bounds, statistics), F.lit(weight)).otherwise(F.lit(0.0)) for bounds, weight in self.rules]
        while len(terms) > 1:  # a balanced sum stays shallow
            terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2 :]
        total = F.lit(self.intercept) + terms[0] if terms else F.lit(self.intercept)
        return 1 / (1 + F.exp(-total))


def condition(bounds: Bounds, statistics: str) -> Column:
    parts = F.lit(True)
    for k, above, up_to in bounds:
        value = F.col(f"{statistics}.{STATISTICS[k]}")
        if above > -math.inf:
            parts = parts & (value > above)
        if up_to < math.inf:
            parts = parts & (value <= up_to)
    return parts


def _paths(node, bounds: dict[int, tuple[float, float]], found: set[Bounds]) -> None:
    """Bounds of every node below the root of a tree."""
    if bounds:
        found.add(tuple(sorted((k, low, high) for k, (low, high) in bounds.items())))
    if node.subtreeDepth() == 0:
        return
    k, cut = node.split().featureIndex(), node.split().threshold()
    low, high = bounds.get(k, (-math.inf, math.inf))
    _paths(node.leftChild(), {**bounds, k: (low, min(high, cut))}, found)
    _paths(node.rightChild(), {**bounds, k: (max(low, cut), high)}, found)


def _fires(rules: list[Bounds]):
    """Array of 0 and 1 per rule, for the sample rows of a fit.

    Hundreds of candidate rules as one column expression would cost the driver more to
    compile than the fit; only the few rules that get a weight are compiled.
    """

    @F.arrow_udf("array<double>")
    def fires(column: pa.Array) -> pa.Array:
        values = [f.to_numpy(zero_copy_only=False) for f in column.flatten()]
        hit = np.ones((len(column), len(rules)))
        for i, bounds in enumerate(rules):
            for k, above, up_to in bounds:
                hit[:, i] *= (values[k] > above) & (values[k] <= up_to)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1) * len(rules), pa.int32()), pa.array(hit.ravel()))

    return fires


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled documents that are not held out: ``doc_id, label, text``.

    A doc_id with several labels has the smallest.  Labels without an id or value do not count.
    Of rows that repeat a doc_id the one with the smallest hash of its text stands for all.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # at most ``sample`` rows, whatever repeats a doc_id; tasks pass on one row for each
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return rows.groupBy("doc_id", "label").agg(least).select("doc_id", "label", "text")


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, seed: int = 7) -> RuleModel:
    """Fit on a bounded sample.  Without labels the score is 0.5 everywhere; with one class, that class."""
    rows = labelled_sample(docs, labels, label, sample).select("doc_id", "label", text_statistics(F.col("text")).alias("s"))
    rows = stored(rows, "labelled")
    # one partition in a fixed order, at most ``sample`` short rows: the fit is the same in every run
    fixed = rows.repartition(1).sortWithinPartitions("doc_id", *[f"s.{s}" for s in STATISTICS])
    known = fixed.select("label", "s", array_to_vector(F.array(*[F.col(f"s.{s}") for s in STATISTICS])).alias("x")).persist()
    try:
        classes = known.agg(F.min("label"), F.max("label")).first()
        if classes[0] is None:
            return RuleModel(0.0, ())
        if classes[0] == classes[1]:
            return RuleModel(math.copysign(20.0, classes[0] - 0.5), ())
        forest = RandomForestClassifier(
            featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5,
            featureSubsetStrategy="onethird", seed=seed,
        ).fit(known)
        found: set[Bounds] = set()
        for tree in forest.trees:
            _paths(tree._java_obj.rootNode(), {}, found)
        if not found:
            share = known.agg(F.avg("label")).first()[0]
            return RuleModel(math.log(share / (1 - share)), ())
        rules = sorted(found)
        lasso = LogisticRegression(featuresCol="r", labelCol="label", elasticNetParam=1.0, regParam=PENALTY)
        model = lasso.fit(known.select("label", array_to_vector(_fires(rules)(F.col("s"))).alias("r")))
        return RuleModel(float(model.intercept), tuple((r, float(w)) for r, w in zip(rules, model.coefficients) if w))
    finally:
        known.unpersist()


def scored(docs: DataFrame, model: RuleModel, name: str = "score") -> DataFrame:
    """Adds ``name`` to every row; an input column of that name is replaced.

    Null and empty texts have statistics of zero and are scored like any other.
    """
    held = unused("_statistics", docs)
    measured = docs.drop(name).withColumn(held, text_statistics(F.col("text")))
    return measured.withColumn(name, model.score(held)).drop(held)


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents with a score of at least one half, with their own columns."""
    score = unused("_score", docs)
    return scored(docs, fit_rules(docs, labels, **settings), score).filter(F.col(score) >= 0.5).drop(score)
