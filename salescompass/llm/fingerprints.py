"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph is hashed to a wide vector of plus and minus ones, and a document is the
sum of its paragraphs' vectors, lane by lane modulo 2**16.  The order of paragraphs does
not matter, inserting or deleting one adds or subtracts its vector, and equal multisets have
equal sums.  Lanes count differences with random signs, so the products of two sums also
estimate how much two multisets have in common.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescompass.llm.storage import repeatable

LANES = 256
LANE = np.dtype("<i2")  # sums wrap modulo 2**16
#: A paragraph ends with its line.  Whole articles often stand in one line: there a sentence is one.
PARAGRAPH_END = r"\n+|(?<=[.!?]) +"
PART_BYTES = 8_000_000
SAMPLED = 10  # rows for each part that the cuts are taken from
_RUN_BYTES = 4_000_000


def paragraphs(text: str | None, end: str = PARAGRAPH_END) -> list[str]:
    return [p for p in re.split(end, text) if p] if text else []


def vectors(items: list[str]) -> np.ndarray:
    """items x LANES of plus and minus ones."""
    digests = b"".join(hashlib.blake2b(p.encode(), digest_size=LANES // 8).digest() for p in items)
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(len(items), LANES)
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def sums(lists: list[list[str]]) -> np.ndarray:
    """Fingerprint of each list of paragraphs: lists x LANES."""
    out = np.zeros((len(lists), LANES), LANE)
    counts = np.array([len(x) for x in lists])
    full = np.flatnonzero(counts)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(vectors([p for x in lists for p in x]), begin, axis=0, dtype=LANE)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated overlap of multisets, from rows of fingerprints: their cosine, 0 at least; 1 if equal."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    norms = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.divide((a * b).sum(axis=1), norms, out=np.zeros(len(a)), where=norms > 0)
    return np.where((a == b).all(axis=1), 1.0, np.clip(cosine, 0.0, 1.0))


def as_text(fingerprints: np.ndarray) -> list[str]:
    return [base64.b64encode(row.tobytes()).decode() for row in fingerprints]


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of another (or all of it)."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _changed(before: list[str], after: list[str]) -> tuple[list[str], list[str]]:
    """Paragraphs that go and that come: what follows the common beginning."""
    same = next((i for i, (a, b) in enumerate(zip(before, after)) if a != b), min(len(before), len(after)))
    return before[same:], after[same:]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(ids: list, texts: list[str], last: str, end: str) -> pa.RecordBatch:
    """Results for ``texts``, each with the one after it; ``last`` follows the last one."""
    following = [*texts[1:], last]
    new = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    whole = [paragraphs(t, end) for t in [*texts, last]]
    now = sums(whole)
    gone, come = zip(*(_changed(p, paragraphs(t, end)) for p, t in zip(whole, new)), strict=True)
    after = now[:-1] - sums(list(gone)) + sums(list(come))  # only what changed is hashed anew
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]), pa.array(as_text(now[:-1])), pa.array(as_text(after)),
            pa.array(likeness(now[:-1], after)), pa.array(likeness(now[:-1], now[1:])),
        ],
        names=[p.split()[0] for p in RESULT.split(", ")],
    )


def _runs(rows: Iterator[tuple[int, int | None, str]]) -> Iterator[tuple[list, list[str], str]]:
    """Runs of neighbouring rows of a part, of bounded size, each with the text that follows it.

    The last row of a part is left out: what follows it is in another part.
    """
    ids, texts, held, current = [], [], 0, None
    for part, number, text in rows:
        if texts and part != current:
            if len(texts) > 1:
                yield ids[:-1], texts[:-1], texts[-1]
            ids, texts, held = [], [], 0
        elif held > _RUN_BYTES:
            yield ids, texts, text
            ids, texts, held = [], [], 0
        current = part
        ids.append(number)
        texts.append(text)
        held += len(text) + 200
    if len(texts) > 1:
        yield ids[:-1], texts[:-1], texts[-1]


def _inside(end: str):
    def compare(batches):
        columns = ("part", "doc_id", "text")
        for ids, texts, last in _runs(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in columns), strict=True)):
            yield _compare(ids, texts, last, end)

    return compare


def _across(end: str):
    def compare(batches):
        for b in batches:
            for number, text, following in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                yield _compare([number], [text], following, end)

    return compare


class Cuts:
    """Cuts of the order by id, hash of the text and position; a part is the number of cuts up to a row.

    Only rows whose id is that of a cut are compared by hash, and only those of its hash by position.
    """

    def __init__(self, rows: np.ndarray, n: int):
        """``rows`` x 3 from a sample; ``n`` parts."""
        rows = rows[np.lexsort(rows.T[::-1])]
        rows = rows[np.unique(np.arange(1, n) * len(rows) // n)] if len(rows) else rows
        self.columns = [np.ascontiguousarray(c) for c in rows.T]

    def __len__(self) -> int:
        return len(self.columns[0])

    def parts(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(columns[0]), np.int64)
        todo = [(0, 0, len(self), np.arange(len(out)))]
        while todo:
            level, low, high, rows = todo.pop()
            cuts, values = self.columns[level][low:high], columns[level][rows]
            left, right = (low + np.searchsorted(cuts, values, side) for side in ("left", "right"))
            out[rows] = left if level < 2 else right
            equal = np.flatnonzero(left < right) if level < 2 else []
            for begin in np.unique(left[equal]) if len(equal) else []:
                of = equal[left[equal] == begin]
                todo.append((level + 1, int(begin), int(right[of[0]]), rows[of]))
        return out


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end: str = PARAGRAPH_END, part_bytes: int = PART_BYTES
) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and their likeness to it and
    to the next document's (ascending id, then hash of the text; the first follows the last).

    The edited text is the document with its last quarter of code points replaced by the
    beginning of the next document.  Null texts are empty; an empty text has the zero
    fingerprint.  Null ids come first.  Equal rows follow one another.  A single document is its
    own next one.  Other columns are ignored.

    The rows are cut into parts at quantiles of a sample, also within one id and among equal
    rows; each part is sorted and read as a stream, which shuffles the texts once.  What
    follows the last row of a part is found by a small join, one row per part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = repeatable(rows, "fingerprint-input").withColumns({"tie": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    n = math.ceil(((size or 0) + 1) / part_bytes)
    first = F.lit(-(2**63)).cast("long")  # a null id
    keys = [F.coalesce("doc_id", first).alias("id"), "tie", "at"]
    share = min(1.0, SAMPLED * n / max(count, 1))
    sample = rows.select(*keys).sample(share, seed=1).toArrow() if n > 1 else pa.table({c: pa.array([], pa.int64()) for c in ("id", "tie", "at")})
    cuts = Cuts(np.stack([sample.column(c).to_numpy() for c in range(3)], axis=1), n)

    @F.arrow_udf("int")
    def part(doc_id: pa.Array, tie: pa.Array, at: pa.Array) -> pa.Array:
        return pa.array(cuts.parts([c.to_numpy(zero_copy_only=False) for c in (doc_id, tie, at)]), pa.int32())

    rows = rows.withColumn("part", part(F.coalesce("doc_id", first), "tie", "at"))
    order = ["part", "doc_id", "tie", "at"]
    inside = rows.repartition(n, "part").sortWithinPartitions(*order).select("part", "doc_id", "text").mapInArrow(_inside(end), RESULT)

    place = F.struct("doc_id", "tie", "at")
    ends = rows.groupBy("part").agg(F.min(place).alias("low"), F.max(place).alias("high"))  # a row per part
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.withColumn("next", F.coalesce(F.lead("low").over(by_part), F.first("low").over(whole)))

    def texts(of: str, name: str) -> DataFrame:
        keys = F.broadcast(ends.select(F.col("part").alias("of"), F.col(f"{of}.at").alias("row")))  # positions are unique
        return rows.join(keys, rows["at"] == keys["row"]).select("of", F.col("doc_id").alias(f"{name}_id"), F.col("text").alias(name))

    across = texts("high", "text").join(texts("next", "following"), "of").select(F.col("text_id").alias("doc_id"), "text", "following")
    return inside.union(across.mapInArrow(_across(end), RESULT))
