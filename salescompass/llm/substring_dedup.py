"""Substring dedup: fixed-block anchors, rolling probes, extension to exact repeats.

Any repeat of ``window`` words holds one whole block of the earlier document, if blocks
have (window + 1) / 2 words and are laid end to end.  So

1. the non-overlapping blocks of every document are indexed and probed with every rolling
   window of block length of all documents: what stays are anchors, block-long word
   sequences that are a block of one document and occur in another one;
2. every anchor is extended to the ``window``-word sequences around it; of equal ones only
   the smallest doc_id matters, so a sequence shared by thousands of documents costs each
   of them one entry and pairs of documents never arise;
3. the sequences seen in a smaller doc_id are marked; adjoining marks grow to the maximal
   repeats, whose words are removed.

Documents are dealt into chunks of bounded text once, and all three steps read that same
exchange.  Between the steps, a chunk sends each distinct hash once, in one array for each
bucket of hashes: entries are spread by hash however often a passage repeats.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import repeatable
from salescompass.llm.words import Words, byte_texts, covered, lists, mix, pieces, span_lists

CHUNK_BYTES = 4_000_000  # text of a chunk, which one task holds at a time
BUCKET_WORDS = 1_000_000  # word positions for each bucket of hashes
_KEY_BITS = 30  # of an anchor's hash, besides its bucket: an anchor only proposes, step 2 decides
_NO_ID = -(2**63)

_PROBES = "bucket int, chunk int, keys array<int>"
_WINDOWS = "bucket int, chunk int, hashes array<long>, ids array<long>"


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _anchor_key(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return _bucket(hashes, buckets) << np.uint64(_KEY_BITS) | hashes & np.uint64(2**_KEY_BITS - 1)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and where each begins (and the end)."""
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return bucket[begin], np.append(begin, len(bucket))


class _Chunk:
    """The documents of a chunk in pieces, in a fixed order."""

    def __init__(self, table: pa.Table):
        ids = table.column("id")
        self.ids = ids.fill_null(_NO_ID).to_numpy()
        self.texts = byte_texts(table.column("text"))

    def words(self):
        for low, high in pieces(self.texts):
            yield self.ids[low:high], Words(self.texts[low:high])


def _table(schema: str, columns: list) -> pa.Table:
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.Table.from_arrays(columns, names=names)


def _send_probes(block: int, buckets: int):
    def send(key, table):
        """Distinct block-long sequences of the chunk; flags: some document has it as a
        block (1), more than one document has it (2)."""
        keys, owners, aligned = [], [], []
        for ids, words in _Chunk(table).words():
            at, hashes = words.windows(block)
            text = np.searchsorted(words.first, at, side="right") - 1
            keys.append(_anchor_key(hashes, buckets))
            owners.append(ids[text])
            aligned.append((at - words.first[text]) % block == 0)
        keys, owners, aligned = (np.concatenate(x) if x else np.zeros(0, d) for x, d in ((keys, np.uint64), (owners, np.int64), (aligned, bool)))
        order = np.lexsort((owners, keys))
        keys, owners, aligned = keys[order], owners[order], aligned[order]
        distinct, edge = _by_bucket(keys)
        begin, end = edge[:-1], edge[1:]
        is_block = np.add.reduceat(aligned, begin, dtype=np.int64) > 0 if len(begin) else np.zeros(0, bool)
        flags = is_block.astype(np.uint64) | (owners[begin] != owners[end - 1]).astype(np.uint64) << np.uint64(1)
        entries = ((distinct & np.uint64(2**_KEY_BITS - 1)) << np.uint64(2) | flags).astype(np.uint32)
        bucket, offsets = _by_bucket(distinct >> np.uint64(_KEY_BITS))
        chunk = np.full(len(bucket), key[0].as_py())
        return _table(_PROBES, [pa.array(bucket, pa.int32()), pa.array(chunk, pa.int32()), lists(entries.view(np.int32), offsets, pa.int32())])

    return send


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    column = column.combine_chunks()
    counts = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(counts)), counts)


def _select(rows: np.ndarray, values: np.ndarray, keep: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """List per row of the kept values; values are grouped by row."""
    return lists(values[keep], np.searchsorted(rows[keep], np.arange(n + 1)), kind)


def _find_anchors(key, table):
    """Back to each chunk: its keys that are a block somewhere and lie in two documents."""
    values, rows = _flat(table.column("keys"))
    values = values.view(np.uint32)
    keys, flags = values >> np.uint32(2), values & np.uint32(3)
    distinct, index, counts = np.unique(keys, return_inverse=True, return_counts=True)
    flag = np.zeros(len(distinct), np.uint32)
    np.bitwise_or.at(flag, index, flags)
    anchor = (flag & 1 > 0) & ((counts > 1) | (flag & 2 > 0))
    keep = anchor[index]
    return _table(_PROBES, [table.column("bucket").combine_chunks(), table.column("chunk").combine_chunks(), _select(rows, keys.view(np.int32), keep, table.num_rows, pa.int32())])


def _extend(block: int, window: int, buckets: int):
    def send(key, chunk, answers):
        """The window-long sequences around the anchors, each with its smallest and, if there
        are more documents in the chunk, its largest doc_id."""
        values, rows = _flat(answers.column("keys"))
        bucket = answers.column("bucket").to_numpy().astype(np.uint64)
        anchors = np.sort(bucket[rows] << np.uint64(_KEY_BITS) | values.view(np.uint32).astype(np.uint64))
        hashes, owners = [], []
        for ids, words in _Chunk(chunk).words() if len(anchors) else []:
            at, of_block = words.windows(block)
            keys = _anchor_key(of_block, buckets)
            near = np.minimum(np.searchsorted(anchors, keys), len(anchors) - 1)
            hit = at[anchors[near] == keys]
            around = covered(np.maximum(hit - (window - block), 0), np.minimum(hit, window - block) + 1, len(words))
            start, of_window = words.windows(window)
            keep = around[start]
            hashes.append(of_window[keep])
            owners.append(ids[np.searchsorted(words.first, start[keep], side="right") - 1])
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        distinct, edge = _by_bucket(hashes)
        low, high = owners[edge[:-1]], owners[edge[1:] - 1]
        more = low != high
        distinct = np.concatenate([distinct, distinct[more]])
        ids = np.concatenate([low, high[more]])
        order = np.argsort(distinct, kind="stable")
        distinct, ids = distinct[order], ids[order]
        bucket, offsets = _by_bucket(_bucket(distinct, buckets))
        to = np.full(len(bucket), key[0].as_py())
        return _table(_WINDOWS, [pa.array(bucket, pa.int32()), pa.array(to, pa.int32()), lists(distinct.view(np.int64), offsets, pa.int64()), lists(ids, offsets, pa.int64())])

    return send


def _find_repeats(key, table):
    """Back to each chunk: its sequences that lie in two documents, with the smallest doc_id."""
    hashes, rows = _flat(table.column("hashes"))
    ids, _ = _flat(table.column("ids"))
    distinct, index = np.unique(hashes, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    most = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(least, index, ids)
    np.maximum.at(most, index, ids)
    keep = (least < most)[index]
    n = table.num_rows
    return _table(_WINDOWS, [
        table.column("bucket").combine_chunks(), table.column("chunk").combine_chunks(),
        _select(rows, hashes, keep, n, pa.int64()), _select(rows, least[index], keep, n, pa.int64()),
    ])


def _kept_texts(words: Words, removed: np.ndarray) -> list[bytes]:
    """Per text the words that are left, joined by one space."""
    stop = words.end + 1  # a break follows every word
    change = np.zeros(len(words.bytes) + 1, np.int8)
    np.add.at(change, words.start[~removed], 1)
    np.subtract.at(change, stop[~removed], 1)
    keep = np.cumsum(change[:-1], dtype=np.int8) > 0
    data = words.bytes.copy()
    data[words.end] = 0x20
    left = data[keep].tobytes()
    lengths = np.concatenate([[0], np.cumsum(np.where(removed, 0, stop - words.start))])
    edge = lengths[words.first]
    return [left[a : max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def _remove(window: int):
    def remove(key, chunk, answers):
        hashes, _ = _flat(answers.column("hashes"))
        least, _ = _flat(answers.column("ids"))
        repeated, first = np.unique(hashes.view(np.uint64), return_index=True)
        least = least[first]
        n_words, spans, kept = [], [], []
        for ids, words in _Chunk(chunk).words():
            removed = np.zeros(len(words), bool)
            if len(repeated):
                start, of_window = words.windows(window)
                at = np.minimum(np.searchsorted(repeated, of_window), len(repeated) - 1)
                owner = ids[np.searchsorted(words.first, start, side="right") - 1]
                hit = (repeated[at] == of_window) & (least[at] < owner)
                removed = covered(start[hit], window, len(words))
            n_words.append(words.counts)
            spans.append(span_lists(removed, words.first))
            kept.extend(_kept_texts(words, removed))
        return pa.table({
            "doc_id": chunk.column("id"), "n_words": pa.array(np.concatenate(n_words), pa.int64()),
            "removed": pa.chunked_array(spans), "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        })

    return remove


def remove_repeats(
    docs: DataFrame,
    window: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """A row per document: ``doc_id, n_words, removed`` (maximal runs of removed words, as start
    and end) and ``kept_text`` (the other words, joined by one space).

    A word is a run of bytes other than blanks.  It is removed if a window of ``window``
    words around it also starts in a document with a smaller doc_id; windows are judged on
    the input.  Repeats inside a document, and among rows of one doc_id, stay.  A null id
    is smaller than any other.  Null and empty texts have no words and an empty kept text.
    Other columns are ignored.  An empty table gives an empty one.
    """
    rows = repeatable(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "substring-input")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    buckets = max(1, math.ceil(size / 6 / bucket_words))  # a word and its blank are about 6 bytes
    block = (window + 1) // 2
    # by the row's position at the scan: equal rows go to different chunks
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(chunks)).cast("int"))
    probes = dealt.groupBy("chunk").applyInArrow(_send_probes(block, buckets), _PROBES)
    anchors = probes.groupBy("bucket").applyInArrow(_find_anchors, _PROBES).filter(F.size("keys") > 0)
    extended = dealt.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(_extend(block, window, buckets), _WINDOWS)
    repeats = extended.groupBy("bucket").applyInArrow(_find_repeats, _WINDOWS).filter(F.size("hashes") > 0)
    return dealt.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(
        _remove(window), "doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept_text string"
    )
