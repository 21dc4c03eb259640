"""Line dedup: winnowing over line hashes finds repeated runs of lines.

Of every ``window`` consecutive line hashes of a document the smallest (the last of equal
ones) is a fingerprint.  Two documents that share ``window`` lines in a row choose the same
fingerprint there, so no shared run of that length is missed.  Runs that are too short for
that, but say enough on their own, are their own fingerprints: a line of many words, and a whole
document of fewer lines.  Fingerprints at more than one position are extended both ways: the
runs they stand for are looked up, adjoining ones grow to whole repeats, and all
but the earliest copy is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import stored
from salescompass.llm.words import BLANKS, LINE_END, Words, byte_texts, covered, lists, mix, pieces, windows

WINDOW = 3
LONG_LINE = 8  # words
_ANCHORS = "doc_id long, tie long, starts array<int>, sizes array<int>, anchors array<int>, fingerprints array<long>, runs array<long>"


class Lines:
    """Lines of a list of texts, empty ones too: ``hash``, number of ``words``, and ``first``, the
    first line of each text (and the end).

    A text ends its last line itself; an empty or null text has no lines.
    """

    def __init__(self, texts: list[bytes | None]):
        # a mark before each line makes a word of an empty line too
        lines = Words([b"\x00" + t.replace(b"\n", b"\n\x00") if t else b"" for t in texts], LINE_END)
        self.hash, self.first, self.start, self.end, self.bytes = lines.hash, lines.first, lines.start, lines.end, lines.bytes
        inside = ~BLANKS[lines.bytes]
        inside[lines.start] = False  # the mark
        begins = inside & ~np.concatenate([[False], inside[:-1]])
        self.words = np.add.reduceat(begins, lines.start, dtype=np.int64) if len(lines) else np.zeros(0, np.int64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def fingerprints(lines: Lines, window: int, long_line: int) -> tuple[np.ndarray, ...]:
    """Text, start, size and hash of every run that is judged, the line that is its fingerprint, and its mark."""
    found = []

    def add(kind: int, start: np.ndarray, size: int, run: np.ndarray, line: np.ndarray) -> None:
        text = np.searchsorted(lines.first, start, side="right") - 1
        found.append((text, start, np.full(len(start), size), mix(run, 509 + kind), line, mix(lines.hash[line], 503 + 17 * kind)))

    start, run = windows(lines.hash, lines.first, window)
    inside = lines.hash[start[:, None] + np.arange(window)] if len(start) else np.zeros((0, window), np.uint64)
    add(0, start, window, run, start + (window - 1 - np.argmin(inside[:, ::-1], axis=1) if len(start) else np.zeros(0, np.int64)))
    long = np.flatnonzero(lines.words >= long_line) if window > 1 else np.zeros(0, np.int64)
    add(1, long, 1, lines.hash[long], long)
    for size in range(1, window):
        start, run = windows(lines.hash, lines.first, size)
        whole = lines.counts[np.searchsorted(lines.first, start, side="right") - 1] == size
        add(2, start[whole], size, run[whole], start[whole])
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    return tuple(c[order] for c in columns)


def _anchors(window: int, long_line: int):
    def anchors(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for low, high in pieces(texts):
                lines = Lines(texts[low:high])
                text, start, size, run, line, mark = fingerprints(lines, window, long_line)
                offsets = np.searchsorted(text, np.arange(high - low + 1))
                begin = lines.first[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[low:high], batch.column("tie")[low:high],
                        lists(start - begin, offsets, pa.int32()), lists(size, offsets, pa.int32()), lists(line - begin, offsets, pa.int32()),
                        lists(mark.view(np.int64), offsets, pa.int64()), lists(run.view(np.int64), offsets, pa.int64()),
                    ],
                    names=[p.split()[0] for p in _ANCHORS.split(", ")],
                )

    return anchors


def _kept_texts(lines: Lines, gone: np.ndarray) -> list[bytes]:
    """Per text the lines that are left, joined by line feeds."""
    change = np.zeros(len(lines.bytes) + 1, np.int8)
    np.add.at(change, lines.start[~gone] + 1, 1)  # without the mark, with the line's end
    np.subtract.at(change, lines.end[~gone] + 1, 1)
    data = lines.bytes.copy()
    data[lines.end] = 0x0A
    left = data[np.cumsum(change[:-1], dtype=np.int8) > 0].tobytes()
    lengths = np.concatenate([[0], np.cumsum(np.where(gone, 0, lines.end - lines.start))])
    edge = lengths[lines.first]
    return [left[a : max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def _delete(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = byte_texts(batch.column("text"))
        for low, high in pieces(texts):
            lines = Lines(texts[low:high])
            runs = batch.column("runs")[low:high]
            at = np.repeat(np.arange(high - low), pc.fill_null(pc.list_value_length(runs), 0).to_numpy())
            each = runs.flatten()
            start, size = (each.field(i).to_numpy().astype(np.int64) for i in range(2))
            gone = covered(lines.first[at] + start, size, len(lines.hash))
            text = np.repeat(np.arange(high - low), lines.counts)
            removed = lists((np.arange(len(gone)) - lines.first[text])[gone], np.searchsorted(text[gone], np.arange(high - low + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[low:high], pa.array(lines.counts, pa.int64()), removed, pa.array(_kept_texts(lines, gone), pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "removed", "kept_text"],
            )


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", long_line: int = LONG_LINE) -> DataFrame:
    """A row per document: ``doc_id, n_lines, removed`` (numbers of the deleted lines) and ``kept_text``.

    Lines end with a line feed; empty lines count.  Runs that are judged: any ``window`` lines, any
    line of at least ``long_line`` words, and a whole document of fewer lines than ``window`` (among
    such documents).  A line is deleted if a run that holds it also starts earlier: in a smaller
    doc_id, or before in the same document.  Runs are judged on the input.  A null id comes
    before all others.  Rows of one doc_id are ordered by their text's hash, and equal rows are
    one copy.  Null and empty texts have no lines.  Other columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    each = rows.mapInArrow(_anchors(window, long_line), _ANCHORS)
    each = each.select("doc_id", "tie", F.explode(F.arrays_zip("starts", "sizes", "anchors", "fingerprints", "runs")).alias("r"))
    runs = each.select("doc_id", "tie", *[F.col(f"r.{c}").alias(n) for c, n in (("starts", "start"), ("sizes", "size"), ("anchors", "line"), ("fingerprints", "mark"), ("runs", "run"))])
    # fingerprints at several positions; a minimum and a maximum, so that frequent ones cost one entry per task.
    # What is joined is stored first: both sides are plain exchanges then, of which AQE can split a crowded key
    position = F.struct("doc_id", "tie", "line")
    shared = runs.groupBy("mark").agg(F.min(position).alias("low"), F.max(position).alias("high")).filter("low != high").select("mark")
    candidates = stored(runs.join(stored(shared, "line-marks"), "mark").select("doc_id", "tie", "start", "size", "run"), "line-runs")
    place = F.struct("doc_id", "tie", "start")
    first = candidates.groupBy("run").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last").select("run", "first")
    later = candidates.join(stored(first, "line-firsts"), "run").filter(place != F.col("first"))
    repeats = later.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "size")).alias("runs"))  # within one document
    repeats = stored(repeats.withColumnsRenamed({"doc_id": "id_", "tie": "tie_"}), "line-repeats")
    found = rows.join(repeats, rows["doc_id"].eqNullSafe(repeats["id_"]) & (rows["tie"] == repeats["tie_"]), "left")
    return found.select("doc_id", "text", "runs").mapInArrow(_delete, "doc_id long, n_lines long, removed array<int>, kept_text string")
