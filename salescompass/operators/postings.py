"""Ranked text retrieval over an inverted index that reads only the ranges of documents that can matter.

Documents are numbered so that similar ones are neighbours (by their most frequent word, then
by length), and cut into ranges of RANGE numbers.  A block holds the postings of one term in
one range, with the largest contribution among them; blocks lie in folders by term bucket.  The
largest contributions alone bound what any document of a range can score for a query.  The ranges of the
highest bounds are scored first; every range whose bound stays below the k-th score found
there is skipped.  The others are scored completely, so the result is that of ``search_topk``.
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

from salescompass.operators.rows import number_rows
from salescompass.operators.search import K1, SCORE_DIGITS, B, Index, top_per_query

RANGE = 64  # documents
BUCKETS = 32  # folders that terms are dealt to
PROBES = 2  # ranges per query that are scored first
SLICE = 512  # neighbouring ranges whose blocks of a bucket are made together
SLICE_TASKS = 4  # tasks for the buckets of a slice
SEPARATOR = "\x1f"  # between the terms of a document, which are letters and digits
QUERY_BLOCK = 256  # queries that one task scores against a range
SLACK = 2 * 10.0**-SCORE_DIGITS  # ranks use rounded scores: a bound this close can still tie


def term_bucket(term: Column | str = "term") -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def posting_blocks(index: Index, range_size: int = RANGE) -> DataFrame:
    """``bucket, term, range, docs, parts, top, n``: a row per term and range that holds it.

    ``parts`` are the contributions to a score before the term's weight.  A group has at most
    ``range_size`` postings, however frequent its term.  Postings are shuffled once, packed by range and
    bucket, to the tasks that write them; a task's share depends on SLICE, not on the input.
    """
    docs, avg_len = index.corpus.select("docs", "avg_len").first()
    most_frequent = F.array_max(F.zip_with("counts", "terms", lambda n, t: F.struct(n.alias("n"), t.alias("t"))))["t"]
    # a document's terms travel as one string, half as large as an array
    documents = index.documents.select("doc_id", "doc_len", F.array_join("terms", SEPARATOR).alias("words"), "counts", most_frequent.alias("lead"))
    placed = number_rows(documents, "lead", "doc_len", "doc_id", name="place").withColumn("range", F.floor(F.col("place") / range_size).cast("int"))
    kind = dict(documents.dtypes)["doc_id"]
    placed = placed.filter(F.size("counts") > 0).withColumn("terms", F.split("words", SEPARATOR))
    packs = placed.select("range", "doc_id", "doc_len", "terms", "counts", F.transform("terms", term_bucket).alias("buckets")).mapInArrow(
        _packs, f"bucket int, range int, terms array<string>, sizes array<int>, rows array<int>, counts array<int>, doc_ids array<{kind}>, doc_lens array<int>"
    )
    slices = max(1, math.ceil(docs / range_size / SLICE))
    dealt = packs.withColumn("slice", F.floor(F.col("range") / SLICE).cast("int")).repartition(slices * SLICE_TASKS, "bucket", "slice")
    return dealt.groupBy("bucket", "slice").applyInArrow(
        _blocks(float(avg_len or 1.0)), f"bucket int, term string, range int, docs array<{kind}>, parts array<double>, top double, n int"
    )


def _packs(batches):
    """Postings of neighbouring documents: a row per range and bucket, with its terms, each one's number of postings, and (row, count) of each."""
    for batch in batches:
        ranges = batch.column("range").to_numpy()
        ends = np.append(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1, len(ranges))
        for low, high in zip(np.append(0, ends[:-1]), ends):
            docs = batch.slice(low, high - low)
            terms, bucket = docs.column("terms"), docs.column("buckets").flatten().to_numpy()
            if not len(bucket):
                continue
            row = np.repeat(np.arange(len(terms), dtype=np.int32), np.diff(terms.offsets.to_numpy()))
            coded = terms.flatten().dictionary_encode()
            code = coded.indices.to_numpy()
            order = np.lexsort((row, code, bucket))
            code, bucket, row = code[order], bucket[order], row[order]
            block = np.append(0, np.flatnonzero(code[1:] != code[:-1]) + 1)  # a term has one bucket
            pack = np.append(0, np.flatnonzero(np.diff(bucket[block])) + 1)
            first, size = np.append(pack, len(block)), np.diff(np.append(block, len(code))).astype(np.int32)
            posting = np.append(block[pack], len(code))
            whole = np.arange(len(pack) + 1) * len(docs)
            each = np.tile(np.arange(len(docs)), len(pack))
            listed = lambda offsets, values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(bucket[block[pack]], pa.int32()), "range": pa.array(np.full(len(pack), ranges[low]), pa.int32()),
                "terms": listed(first, coded.dictionary.take(pa.array(code[block]))), "sizes": listed(first, pa.array(size)),
                "rows": listed(posting, pa.array(row)), "counts": listed(posting, docs.column("counts").flatten().take(pa.array(order))),
                "doc_ids": listed(whole, docs.column("doc_id").take(pa.array(each))), "doc_lens": listed(whole, docs.column("doc_len").take(pa.array(each))),
            })


def _blocks(avg_len: float):
    """The blocks of a bucket and slice; a range that was cut between two files comes in several packs."""

    def lists(packs: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
        column = packs.column(name).combine_chunks()
        return column.flatten(), column.offsets.to_numpy().astype(np.int64)

    def blocks(key, packs):
        terms, first = lists(packs, "terms")
        rows, begin = lists(packs, "rows")
        doc_ids, start = lists(packs, "doc_ids")
        size, counts, doc_lens = (lists(packs, name)[0].to_numpy() for name in ("sizes", "counts", "doc_lens"))
        coded = terms.dictionary_encode()
        block = np.repeat(np.arange(len(terms)), size)
        doc = np.repeat(start[:-1] - start[0], np.diff(begin)) + rows.to_numpy()
        ranges = np.repeat(packs.column("range").to_numpy(), np.diff(first))[block]
        code = coded.indices.to_numpy()[block]
        order = np.lexsort((ranges, code))  # stable: documents stay in their order
        code, ranges, doc, tf = code[order], ranges[order], doc[order], counts[order].astype(np.float64)
        part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * doc_lens[doc] / avg_len))
        begin = np.append(0, np.flatnonzero((code[1:] != code[:-1]) | (ranges[1:] != ranges[:-1])) + 1)
        offsets = pa.array(np.append(begin, len(code)), pa.int32())
        return pa.table({
            "bucket": pa.array(np.full(len(begin), key[0].as_py()), pa.int32()), "term": coded.dictionary.take(pa.array(code[begin])),
            "range": pa.array(ranges[begin], pa.int32()), "docs": pa.ListArray.from_arrays(offsets, doc_ids.take(pa.array(doc))),
            "parts": pa.ListArray.from_arrays(offsets, pa.array(part)), "top": pa.array(np.maximum.reduceat(part, begin)),
            "n": pa.array(np.diff(np.append(begin, len(code))), pa.int32()),
        })

    return blocks


def write_blocks(blocks: DataFrame, path: str) -> None:
    """A folder per bucket; sorted files, so that row-group statistics tell terms and ranges apart.  Blocks come dealt by bucket."""
    blocks.sortWithinPartitions("bucket", "term", "range").write.mode("overwrite").partitionBy("bucket").parquet(path)


@dataclass
class Found:
    """``best``: the ranked rows.  ``bounds``: per query and range its bound, the postings that stand behind it, and whether it was read."""

    best: DataFrame
    bounds: DataFrame

    def blocks_read(self) -> tuple[int, int]:
        """Blocks of the queries' terms that were read, and that there are."""
        row = self.bounds.agg(F.sum(F.when(F.col("read"), F.col("blocks")).otherwise(0)), F.sum("blocks")).first()
        return row[0] or 0, row[1] or 0


def weights_of(queries: DataFrame, index: Index) -> DataFrame:
    """``query_id, term, weight`` of the query terms that the index knows."""
    docs = index.corpus.select(F.col("docs").cast("double")).first()["docs"]
    weight = F.log(1 + (docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return queries.join(index.terms, "term").select("query_id", "term", term_bucket().alias("bucket"), weight.alias("weight"))


def search_postings(queries: DataFrame, index: Index, blocks: DataFrame, keep, k: int = 5) -> Found:
    """The k best documents for every query (query_id, term), as ``search_topk`` finds them.

    ``keep`` (name, DataFrame) writes a small table once and reads it back.  Bounds need the
    blocks' largest contributions only, so the scan behind them leaves the postings out.
    """
    weights = keep("weights", weights_of(queries, index))
    n_queries = weights.select("query_id").distinct().count()
    asked = [r["bucket"] for r in weights.select("bucket").distinct().collect()]  # at most BUCKETS
    there = blocks.filter(F.col("bucket").isin(asked or [-1]))  # other folders are not listed
    tops = there.select("bucket", "term", "range", "top")
    bounds = weights.join(tops, ["bucket", "term"]).groupBy("query_id", "range").agg(
        F.sum(F.col("weight") * F.col("top")).alias("bound"), F.count(F.lit(1)).alias("blocks")
    )
    bounds = keep("bounds", bounds)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("bound"), "range")
    first = keep("first", bounds.withColumn("nth", F.row_number().over(best_first)).filter(F.col("nth") <= PROBES).select("query_id", "range"))
    order = [F.desc("score"), F.asc("doc_id")]
    probed = keep("probed", top_per_query(_scored(weights, first, there, n_queries, k), k, order))
    reached = probed.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("found"))
    reached = reached.filter(F.col("found") == k).select("query_id", (F.col("least") - SLACK).alias("least"))
    bounds = bounds.join(reached, "query_id", "left").withColumn("read", F.coalesce(F.col("bound") >= F.col("least"), F.lit(True)))
    bounds = keep("read", bounds.select("query_id", "range", "bound", "blocks", "read"))
    best = top_per_query(_scored(weights, bounds.filter("read").select("query_id", "range"), there, n_queries, k), k, order)
    return Found(best, bounds)


def _scored(weights: DataFrame, wanted: DataFrame, blocks: DataFrame, n_queries: int, k: int) -> DataFrame:
    """The k best of each wanted (query, range): a task holds the postings of a range and a block of queries.

    A block brings the queries that ask for its term, so postings of other terms are not shuffled
    and the terms of a query are not repeated for every range.
    """
    kinds = {f.name: f.dataType.simpleString() for f in [*weights.schema, *blocks.schema]}
    by = ["range", "group"]
    group = F.pmod(F.xxhash64("query_id"), F.lit(max(1, math.ceil(n_queries / QUERY_BLOCK)))).cast("int").alias("group")
    asked = weights.groupBy("bucket", "term", group).agg(F.max("weight").alias("weight"), F.collect_list("query_id").alias("queries"))
    wanted = wanted.select("range", group, "query_id")
    held = blocks.join(asked, ["bucket", "term"]).join(wanted.select(*by).distinct(), by, "left_semi").select(*by, "docs", "parts", "weight", "queries")
    held = held.toDF(*held.columns)  # names given anew, as both sides come from one table
    kind = kinds["docs"].removeprefix("array<").removesuffix(">")
    return wanted.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(
        _score(k), f"query_id {kinds['query_id']}, doc_id {kind}, score double"
    )


def _score(k: int):
    def score(key, wanted: pa.Table, held: pa.Table) -> pa.Table:
        docs, parts, queries = (held.column(c).combine_chunks() for c in ("docs", "parts", "queries"))
        names, doc = np.unique(docs.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        part, first = parts.flatten().to_numpy(), docs.offsets.to_numpy().astype(np.int64)
        first = first - first[:1]
        ids = pc.unique(wanted.column("query_id").combine_chunks())
        query = pc.index_in(queries.flatten(), ids)
        block = np.repeat(np.arange(len(queries)), np.diff(queries.offsets.to_numpy()))
        known = np.flatnonzero(query.is_valid().to_numpy(zero_copy_only=False))
        query, block = query.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64), block[known]
        weight = held.column("weight").to_numpy()[block]
        n = first[block + 1] - first[block] if len(known) else np.zeros(0, np.int64)
        source = np.repeat(np.arange(len(n)), n)
        entry = first[block][source] + np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
        cell = query[source] * len(names) + doc[entry]
        cells = len(ids) * len(names)
        total = np.round(np.bincount(cell, weight[source] * part[entry], minlength=cells), SCORE_DIGITS)
        met = np.flatnonzero(np.bincount(cell, minlength=cells))
        q, d = (met // len(names), met % len(names)) if len(names) else (met, met)
        order = np.lexsort((d, -total[met], q))
        q, d, s = q[order], d[order], total[met][order]
        begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        place = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q))))
        keep = place < k
        return pa.table({
            "query_id": ids.take(pa.array(q[keep])), "doc_id": pa.array(names[d[keep]], docs.type.value_type), "score": pa.array(s[keep], pa.float64()),
        })

    return score
