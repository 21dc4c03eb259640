"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import stored


def joining(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which links join two parts that the links before left apart: a spanning forest."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent, keep = list(range(len(nodes))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for k, (i, j) in enumerate(zip(index[: len(a)].tolist(), index[len(a) :].tolist(), strict=True)):
        i, j = root(i), root(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
            keep.append(k)
    return np.array(keep, np.int64)


def _forest(batches):
    """The links of a task that connect as much as all of them."""
    held = [np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()]) for b in batches if len(b)]
    if held:
        a, b = np.concatenate(held, axis=1)
        keep = joining(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links (a, b)``, long numbers: the smallest node of its component.

    Every task first reduces its own links to a forest, so what is stored is fewer links than nodes
    for each task.  Each round takes the smallest label among the neighbours and then the label of that
    label's node, which halves long paths; rounds end when nothing changes.  A node with
    very many links costs one partial minimum per task.
    """
    forest = stored(links.select("a", "b").filter("a <> b").mapInArrow(_forest, "a long, b long"), "links")
    both = forest.union(forest.select("b", "a"))
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        met = labels.join(heard, labels["node"] == heard["a"]).select("node", "label", F.least("label", "heard").alias("low"))
        jump = met.select(F.col("node").alias("at"), F.col("low").alias("further"))
        moved = met.join(jump, met["low"] == jump["at"]).select("node", F.col("label").alias("old"), F.least("low", "further").alias("label"))
        moved = stored(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("old != label").isEmpty():
            return labels


def connected(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels (node, label)`` after some more ``links (a, b)`` between their nodes, or nodes without a label.

    Only the links' components take part, as one node each, however many documents they have.
    """
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    parts = links.join(of_a, "a", "left").join(of_b, "b", "left")
    parts = parts.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).filter("a <> b").distinct()
    joined = components(parts)
    moved = joined.select(F.col("node").alias("at"), F.col("label").alias("to"))
    kept = labels.join(moved, labels["label"] == moved["at"], "left").select("node", F.coalesce("to", "label").alias("label"))
    return stored(kept.union(joined.join(labels.select("node"), "node", "left_anti")), "labels")
