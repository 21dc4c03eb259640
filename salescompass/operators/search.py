"""Ranked text retrieval: a document index and BM25 top-k for a batch of queries.

The index holds a row per document with its distinct terms and their counts, so scoring a
document needs no other row.  A task scores its documents against all queries and only the k
best per query leave it; (query, document) pairs are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescompass.functions import text

K1 = 1.2
B = 0.75
SCORE_DIGITS = 6  # ranks use rounded scores, so equal documents tie whatever the summing order
QUERY_TERMS = 200_000  # query terms that travel with a task; a larger batch of queries is worked off in blocks
CELLS = 4_000_000  # (query, document) matches held at once in a task


@dataclass
class Index:
    """``documents`` (doc_id, doc_len, terms, counts, attributes), ``terms`` (term, df), ``corpus`` (docs, avg_len)."""

    documents: DataFrame
    terms: DataFrame
    corpus: DataFrame


def index_documents(docs: DataFrame, doc_id: str = "doc_id", body: str = "text") -> DataFrame:
    """Term counts of every document over its whole text, without a shuffle; other columns stay as attributes.

    A document's words are one sorted array; each run of equal words is a term and its length the count.
    """
    words, starts = F.col("_words"), F.col("_starts")
    # an empty document has no positions; sequence would count down from 0 to -1
    places = F.when(F.col("doc_len") > 0, F.sequence(F.lit(0), F.col("doc_len") - 1)).otherwise(F.array().cast("array<int>"))
    attributes = [c for c in docs.columns if c not in (doc_id, body)]
    return (
        docs.select(F.col(doc_id).alias("doc_id"), *attributes, F.sort_array(F.coalesce(text.tokens(F.col(body)), F.array().cast("array<string>"))).alias("_words"))
        .withColumn("doc_len", F.size("_words"))
        .withColumn("_starts", F.filter(places, lambda i: ~F.get(words, i).eqNullSafe(F.get(words, i - 1))))
        .withColumn("terms", F.transform(starts, lambda i: F.get(words, i)))
        .withColumn("counts", F.transform(starts, lambda i, n: F.coalesce(F.get(starts, n + 1), F.col("doc_len")) - i))
        .drop("_words", "_starts")
    )


def term_stats(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(documents: DataFrame) -> DataFrame:
    """Number of documents, empty ones included, and their mean length."""
    words = F.coalesce(F.sum("doc_len"), F.lit(0)).cast("double")
    n = F.count(F.lit(1))
    return documents.agg(n.alias("docs"), (words / F.nullif(n, F.lit(0))).alias("avg_len"))


def query_terms(queries: DataFrame, query_id: str = "query_id", body: str = "text") -> DataFrame:
    words = F.explode(F.array_distinct(text.tokens(F.col(body))))
    return queries.select(F.col(query_id).alias("query_id"), words.alias("term"))


def top_per_query(scored: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Rank within each query; Spark keeps only k rows per query and task before shuffling."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def search_topk(
    queries: DataFrame, index: Index, k: int = 5, where: Column | None = None, max_terms: int = QUERY_TERMS
) -> DataFrame:
    """(query_id, doc_id, attributes, score, rank) of the k best documents per query.

    ``queries`` is (query_id, term).  ``where`` is a condition on the attributes, which reaches
    the scan of the index.  Weights and corpus figures are those of the whole index.
    """
    docs, avg_len = index.corpus.select(F.col("docs").cast("double"), "avg_len").first()
    weight = F.log(1 + (docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = queries.join(index.terms, "term").select("query_id", "term", weight.alias("weight"))
    documents = index.documents if where is None else index.documents.filter(where)
    attributes = [c for c in index.documents.columns if c not in ("doc_len", "terms", "counts", "doc_id")]
    blocks = max(1, math.ceil(queries.count() / max_terms))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    kinds = {f.name: f.dataType.simpleString() for f in [*documents.schema, *queries.schema]}
    out = f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, score double"
    found = None
    for i in range(blocks):
        scored = documents.select("doc_id", "doc_len", "terms", "counts").mapInArrow(
            _scan(weights.filter(block == i).toArrow(), avg_len or 1.0, k), out
        )
        found = scored if found is None else found.union(scored)
    best = top_per_query(found, k, [F.desc("score"), F.asc("doc_id")])
    if not attributes:
        return best
    # k rows per query meet the index again for their attributes
    return best.join(documents.select("doc_id", *attributes), "doc_id").select("query_id", "doc_id", *attributes, "score", "rank")


def _scan(weights: pa.Table, avg_len: float, k: int):
    """Score documents against the given weights and keep the k best per query of this task."""
    weights = weights.sort_by("term").combine_chunks()
    words = weights.column("term").to_numpy(zero_copy_only=False).astype(object)
    distinct, first = np.unique(words, return_index=True) if len(words) else (words, np.zeros(0, np.int64))
    lookup, first = pa.array(distinct, pa.string()), np.append(first, len(words))
    query_ids = weights.column("query_id").combine_chunks()
    asked = pc.unique(query_ids)
    query = pc.index_in(query_ids, asked).to_numpy(zero_copy_only=False).astype(np.int64)
    value = weights.column("weight").to_numpy(zero_copy_only=False)

    def scores(batch: pa.RecordBatch):
        """(query, row of the batch, score) of the matching pairs of a batch."""
        terms = batch.column("terms")
        row = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
        found = pc.index_in(terms.flatten(), lookup)
        at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        term = found.fill_null(0).to_numpy()[at].astype(np.int64)
        tf = batch.column("counts").flatten().to_numpy()[at].astype(np.float64)
        row = row[at]
        length = batch.column("doc_len").to_numpy()[row]
        part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_len))
        n = first[term + 1] - first[term]
        for low, high in _pieces(row, n):
            source = np.repeat(np.arange(low, high), n[low:high])
            entry = first[term[source]] + np.arange(len(source)) - np.repeat(np.cumsum(n[low:high]) - n[low:high], n[low:high])
            key, index = np.unique(query[entry] * len(terms) + row[source], return_inverse=True)
            yield key // len(terms), key % len(terms), np.round(np.bincount(index, value[entry] * part[source]), SCORE_DIGITS)

    def best(q, ids, s):
        order = np.lexsort((ids, -s, q))
        q, ids, s = q[order], ids[order], s[order]
        begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        place = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q))))
        keep = place < k
        return q[keep], ids[keep], s[keep]

    def scan(batches):
        held, kind = None, None
        for batch in batches:
            ids, kind = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.schema.field("doc_id").type
            for q, row, s in scores(batch) if len(asked) else ():
                if len(q):
                    new = (q, ids[row], s)
                    held = best(*(new if held is None else [np.concatenate(pair) for pair in zip(held, new)]))
        if held is not None:
            yield pa.RecordBatch.from_arrays([asked.take(pa.array(held[0])), pa.array(held[1], kind), pa.array(held[2])], names=["query_id", "doc_id", "score"])

    return scan


def _pieces(row: np.ndarray, n: np.ndarray):
    """Runs of whole documents with about CELLS matches."""
    if not len(row):
        return
    total = np.cumsum(n)
    ends = np.append(np.flatnonzero(row[1:] != row[:-1]) + 1, len(row))
    low = 0
    while low < len(row):
        reached = np.searchsorted(total, (total[low - 1] if low else 0) + CELLS)
        high = int(ends[np.searchsorted(ends, max(reached, low + 1))]) if reached < len(row) else len(row)
        yield low, high
        low = high
