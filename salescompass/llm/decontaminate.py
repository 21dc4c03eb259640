"""Benchmark decontamination: prefix-filtered set join of benchmark windows and documents.

A window is ``size`` consecutive words of a benchmark item (a shorter item is one window);
as a set it holds its ``SHINGLE``-word shingles.  A place of a document can contain a share
``containment`` of them only if it holds one of the window's rarest
``n - ceil(containment x n) + 1`` shingles, so only those are looked up.  Rarity is counted
over all documents.  A shingle found fixes where the window would begin (its position in
the window); places before or beyond the text fall to the length bound; the rest is compared
word by word.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import unused
from salescompass.llm.words import NOT_ALPHANUMERIC, Words, byte_texts, covered, pieces, span_lists

SHINGLE = 3
BLOCK_BYTES = 16_000_000  # benchmark text that is held in memory at once; more makes further passes
_SIEVE_BITS = 20


class Windows(NamedTuple):
    """Distinct benchmark windows of one length and the items that hold them."""

    size: int  # words of a window
    shingle: int  # words of a shingle
    words: np.ndarray  # windows x size: word hashes
    keys: np.ndarray  # sorted distinct shingle hashes
    shingles: np.ndarray  # windows x (size - shingle + 1): index into keys
    owner: np.ndarray  # items, grouped by window
    owner_first: np.ndarray


def benchmark_windows(texts: list[bytes | None], size: int) -> list[Windows]:
    words = Words(texts, NOT_ALPHANUMERIC, lower=True)
    out = []
    counts = words.counts
    for length in np.unique(np.minimum(counts[counts > 0], size)):
        length = int(length)
        at, _ = words.windows(length)
        of = np.searchsorted(words.first, at, side="right") - 1
        keep = (counts[of] >= size) if length == size else (counts[of] == length)
        at, of = at[keep], of[keep]
        hashes = words.hash[at[:, None] + np.arange(length)]
        distinct, number = np.unique(hashes, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([number.ravel(), of], axis=1), axis=0)
        shingle = min(SHINGLE, length)
        start, shingle_hash = words.windows(shingle)
        by_start = np.zeros(len(words) + 1, np.uint64)
        by_start[start] = shingle_hash
        example = np.empty(len(distinct), np.int64)
        example[number.ravel()] = at
        of_window = by_start[example[:, None] + np.arange(length - shingle + 1)]
        keys, index = np.unique(of_window, return_inverse=True)
        first = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        out.append(Windows(length, shingle, distinct, keys, index.reshape(of_window.shape), pairs[:, 1], first))
    return out


def _sieve(keys: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << _SIEVE_BITS, bool)
    table[keys >> np.uint64(64 - _SIEVE_BITS)] = True
    return table


def _find(keys: np.ndarray, sieve: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of values that are among the sorted keys, and which key each is."""
    at = np.flatnonzero(sieve[values >> np.uint64(64 - _SIEVE_BITS)])
    which = np.searchsorted(keys, values[at])
    hit = keys[np.minimum(which, len(keys) - 1)] == values[at]
    return at[hit], which[hit]


def _expand(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``which``, all positions first[w] … first[w + 1] - 1: (index into which, position)."""
    counts = first[which + 1] - first[which]
    source = np.repeat(np.arange(len(which)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return source, first[which][source] + inside


class Matcher:
    """Windows of one length with the lookup table of their necessary shingles."""

    def __init__(self, windows: Windows, frequency: np.ndarray, containment: float):
        self.windows, self.containment = windows, containment
        n, per = windows.shingles.shape
        prefix = per - math.ceil(containment * per - 1e-9) + 1
        # rarest first; ties by hash, so that all windows agree on the order
        order = np.argsort(frequency[windows.shingles] * (len(windows.keys) + 1) + windows.shingles, axis=1, kind="stable")[:, :prefix]
        key = np.take_along_axis(windows.shingles, order, axis=1).ravel()
        by_key = np.argsort(key, kind="stable")
        used, first = np.unique(key[by_key], return_index=True)
        self.keys = windows.keys[used]
        self.first = np.append(first, len(key))
        self.window = np.repeat(np.arange(n), order.shape[1])[by_key]
        self.offset = order.ravel()[by_key]
        self.sieve = _sieve(self.keys)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every place that contains a window."""
        size, per = self.windows.size, self.windows.shingles.shape[1]
        at, hashes = words.windows(self.windows.shingle)
        place, key = _find(self.keys, self.sieve, hashes)
        source, entry = _expand(self.first, key)
        window, position = self.window[entry], at[place[source]]
        if self.containment >= 1:
            start = position - self.offset[entry]
        else:  # words may be missing in between: any beginning that still covers the shingle
            start = (position[:, None] - np.arange(per)).ravel()
            window, position = np.repeat(window, per), np.repeat(position, per)
        text = np.searchsorted(words.first, position, side="right") - 1
        fits = (start >= words.first[text]) & (start + size <= words.first[text + 1])
        start, window = start[fits], window[fits]
        if self.containment >= 1:
            same = (words.hash[start[:, None] + np.arange(size)] == self.windows.words[window]).all(axis=1)
        else:
            by_start = np.zeros(len(words) + 1, np.uint64)
            by_start[at] = hashes
            there = by_start[start[:, None] + np.arange(per)]
            wanted = self.windows.keys[self.windows.shingles[window]]
            found = (wanted[:, :, None] == there[:, None, :]).any(axis=2).sum(axis=1)
            same = found >= math.ceil(self.containment * per - 1e-9)
        return start[same], window[same]


def _shingle_counts(docs: DataFrame, text_col: str, windows: list[Windows]) -> list[np.ndarray]:
    """How often each benchmark shingle occurs in all documents: one pass, one row per shingle and task."""
    sieves = [_sieve(w.keys) for w in windows]

    def count(batches):
        totals = [np.zeros(len(w.keys), np.int64) for w in windows]
        for batch in batches:
            texts = byte_texts(batch.column(0))
            for low, high in pieces(texts):
                words = Words(texts[low:high], NOT_ALPHANUMERIC, lower=True)
                for w, sieve, total in zip(windows, sieves, totals, strict=True):
                    _, key = _find(w.keys, sieve, words.windows(w.shingle)[1])
                    total += np.bincount(key, minlength=len(total))
        for k, total in enumerate(totals):
            seen = np.flatnonzero(total)
            yield pa.record_batch({"k": pa.array(np.full(len(seen), k), pa.int32()), "key": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})

    rows = docs.select(text_col).mapInArrow(count, "k int, key int, n long").groupBy("k", "key").agg(F.sum("n").alias("n"))
    found = [np.zeros(len(w.keys), np.int64) for w in windows]
    table = rows.toArrow()  # at most one row per shingle of a bounded block of the benchmark
    k, key, n = (table.column(i).to_numpy() for i in range(3))
    for i, counts in enumerate(found):
        counts[key[k == i]] = n[k == i]
    return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark, a stated set of questions, in blocks of bounded size."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        table = items.filter(block == i).toArrow()
        yield table.column("item").to_pylist(), byte_texts(table.column("text"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    containment: float = 1.0,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds to every row ``n_words``, ``spans`` (runs of hit words as start and end) and ``items``
    (distinct ids, as strings, of items with a window in the text).

    A word is a run of letters, digits and non-ASCII characters after lower-casing A-Z.
    ``containment`` 1 asks for all words of a window in order; less for that share of its
    shingles within as many words.  Null and empty texts have no words, null and empty items
    no windows; items with a null id match under the id ``""``.  Each row is judged by itself, so repeated rows get
    the same answer.  Input columns of the three names are replaced.

    The documents are not shuffled.  Each block of the benchmark is sent to the tasks as a
    table of bounded size, and several blocks are passes over the same batch.
    """
    out = docs.drop("n_words", "spans", "items").withColumns(
        {"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<start:int,end:int>>"), "items": F.array().cast("array<string>")}
    )
    for items, texts in _blocks(benchmark, item_col, item_text_col, block_bytes):
        windows = benchmark_windows(texts, size)
        counts = _shingle_counts(docs, text_col, windows) if windows else []
        matchers = [Matcher(w, c, containment) for w, c in zip(windows, counts, strict=True)]
        out = out.mapInArrow(_matching(matchers, [i or "" for i in items], text_col), out.schema)
    merged = F.array_sort(F.array_distinct("items"))
    return out.withColumn("items", merged)


def _matching(matchers, names, text_col: str):
    def match(batches):
        for batch in batches:
            texts = byte_texts(batch.column(batch.schema.get_field_index(text_col)))
            earlier = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            before = batch.column(batch.schema.get_field_index("items")).to_pylist()
            n_words, spans, found = [], [], []
            for low, high in pieces(texts):
                words = Words(texts[low:high], NOT_ALPHANUMERIC, lower=True)
                hit = np.zeros(len(words), bool)
                pairs = []
                for m in matchers:
                    start, window = m.find(words)
                    hit |= covered(start, m.windows.size, len(words))
                    text = np.searchsorted(words.first, start, side="right") - 1
                    seen = np.unique(np.stack([text, window], axis=1), axis=0)
                    source, owner = _expand(m.windows.owner_first, seen[:, 1])
                    pairs.append(np.stack([seen[source, 0], m.windows.owner[owner]], axis=1))
                if any(earlier[low:high]):  # an earlier block of the benchmark hit here
                    for i, runs in enumerate(earlier[low:high]):
                        for run in runs:
                            hit[words.first[i] + run["start"] : words.first[i] + run["end"]] = True
                items = [list(x) for x in before[low:high]]
                for i, item in np.unique(np.concatenate(pairs), axis=0) if pairs else []:
                    items[i].append(names[item])
                n_words.append(words.counts)
                spans.append(span_lists(hit, words.first))
                found.extend(items)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            if texts:
                columns["n_words"] = pa.array(np.concatenate(n_words), pa.int64())
                columns["spans"] = pa.concat_arrays(spans)
                columns["items"] = pa.array(found, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], names=batch.schema.names)

    return match


def n_marked(spans: str = "spans"):
    """Words in a list of spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents without any hit word, with their own columns, whatever their names.

    Documents with a null or empty text stay, as do all copies of a row that stays; an empty
    table, and an empty benchmark, change nothing.
    """
    held, own = docs, {}
    for name in [c for c in docs.columns if c.lower() in ("n_words", "spans", "items")]:
        own[unused(f"_own_{name}", held)] = name
        held = held.withColumnsRenamed({name: list(own)[-1]})
    clean = contamination(held, benchmark, **settings).filter(F.size("spans") == 0).drop("n_words", "spans", "items")
    return clean.withColumnsRenamed(own).select(*[F.col(f"`{c}`") for c in docs.columns])
