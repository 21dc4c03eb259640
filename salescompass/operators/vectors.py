"""Exact nearest vectors for a batch of query vectors.

Every vector is compared with every query — that is what exact search means — but only
the k best per query leave a task: the products are blocked matrix multiplications
inside the task, never rows of a cross join.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.operators.search import SCORE_DIGITS, top_per_query

MAX_BROADCAST_VALUES = 16_000_000  # 128 MB of doubles
ROWS_PER_BLOCK = 50_000
CELLS = 8_000_000  # scores held at once in a task


def _unit_rows(column: pd.Series) -> np.ndarray:
    matrix = np.array(column.tolist(), dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The k best vectors per query, ties to the smaller id; memory is bounded by CELLS scores."""
    step = max(1, CELLS // len(ids))
    parts = [
        _best_of_chunk(query_ids[at : at + step], queries[at : at + step], ids, vectors, k)
        for at in range(0, len(query_ids), step)
    ]
    return pd.concat(parts, ignore_index=True)


def _best_of_chunk(query_ids, queries, ids, vectors, k) -> pd.DataFrame:
    scores = np.round(vectors @ queries.T, SCORE_DIGITS)
    if len(ids) > k:
        # rows that reach the k-th score; ties beyond k are cut after sorting by id
        kth = np.partition(scores, len(ids) - k, axis=0)[len(ids) - k]
        row, query = np.nonzero(scores >= kth)
    else:
        row, query = (a.ravel() for a in np.indices(scores.shape))
    found = pd.DataFrame({"q": query, "vec_id": ids[row], "score": scores[row, query]})
    found = found.sort_values(["q", "score", "vec_id"], ascending=[True, False, True]).groupby("q").head(k)
    return pd.DataFrame({"query_id": query_ids[found["q"]], "vec_id": found["vec_id"], "score": found["score"]})


def vector_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    max_broadcast: int = MAX_BROADCAST_VALUES,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """(query_id, vec_id, score, rank) by cosine similarity.

    ``queries`` (query_id, vector) travel with the task while their counted size is within
    ``max_broadcast`` values.  A larger batch is cut into blocks: each (vector block, query
    block) pair is one bounded group.
    """
    types = dict(queries.dtypes), dict(vectors.dtypes)
    schema = f"query_id {types[0]['query_id']}, vec_id {types[1]['vec_id']}, score double"
    queries = queries.select("query_id", "vector").persist()  # counted, then collected
    n_queries, width = queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if n_queries * (width or 0) <= max_broadcast:
        batch = queries.toPandas()
        queries.unpersist()
        query_ids, matrix = batch["query_id"].to_numpy(), _unit_rows(batch["vector"]) if n_queries else None

        def scan(parts):
            for part in parts:
                if n_queries and len(part):
                    yield _best(query_ids, matrix, part["vec_id"].to_numpy(), _unit_rows(part["embedding"]), k)

        candidates = vectors.select("vec_id", "embedding").mapInPandas(scan, schema)
    else:
        candidates = _blocked(queries, vectors, k, n_queries, rows_per_block, schema)
    return top_per_query(candidates, k, [F.desc("score"), F.asc("vec_id")])


def _dealt(key: str, blocks: int):
    """Block of a row by its id's hash: the same when a task is run again."""
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _blocked(queries, vectors, k, n_queries, rows_per_block, schema) -> DataFrame:
    query_blocks = max(1, math.ceil(n_queries / rows_per_block))
    vector_blocks = max(1, math.ceil(vectors.count() / rows_per_block))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # a row gets its own block first and is then repeated for every block of the other side
    left = vectors.select("vec_id", "embedding", _dealt("vec_id", vector_blocks).alias("vb")).withColumn("qb", every(query_blocks))
    right = queries.select("query_id", "vector", _dealt("query_id", query_blocks).alias("qb")).withColumn("vb", every(vector_blocks))

    def score(vector_part: pd.DataFrame, query_part: pd.DataFrame) -> pd.DataFrame:
        if vector_part.empty or query_part.empty:
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        return _best(
            query_part["query_id"].to_numpy(), _unit_rows(query_part["vector"]),
            vector_part["vec_id"].to_numpy(), _unit_rows(vector_part["embedding"]), k,
        )

    return left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(score, schema)


def label_centroids(vectors: DataFrame) -> DataFrame:
    """Mean vector per label, as queries: (query_id, vector)."""
    parts = vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    # one row per label and dimension is left, so collecting a label's list is bounded
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda e: e["mean"])
    return means.groupBy(F.col("label").alias("query_id")).agg(in_order.alias("vector"))
