"""Spelling variants: frequent words that differ by one letter, found by blocked Gram matrices.

One replaced letter moves a word's vector of letter counts by a squared distance of two, one
inserted or deleted letter by one.  So words are compared in blocks: a product of two blocks of
count vectors gives all their squared distances at once, pairs of at most two are kept, and
only these few are compared letter by letter.

Blocks hold words of one length.  They are cut further by the counts of CLASSES classes of
letters, of which one edit changes one by one (another length) or two by one each (the same
length, or none within a class): a block meets its few neighbours only.  A word is a member of its own block
and visits half of the neighbours, so every pair of neighbours meets once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.storage import stored

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5  # times as frequent as a word is its form, at least
CLASSES = 8
BLOCK = 2048  # members that are multiplied at once; larger blocks are dealt out by hash
_HELD_WORDS = 500_000  # distinct words that a task counts before it passes them on
_CANDIDATES = 4_000_000  # letters that are compared at once

# fixed values: the letters of a word, of which only A-Z are lower-cased
_LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_RUN = re.compile("[a-zÀ-ÿ]+")
_INDEX = np.zeros(256, np.int64)
_INDEX[_LETTERS] = np.arange(len(_LETTERS))


def words_of(text: str | None) -> Counter:
    """Runs of letters of a whole text and how often each occurs."""
    return Counter(_RUN.findall(text.encode().lower().decode())) if text else Counter()  # bytes.lower() leaves all but A-Z


def misspelt(word: str, prefix: int, every: int) -> str:
    """The word, or without one letter if ``every`` divides the hash that ``prefix`` is continued to."""
    h = crc32(word.encode(), prefix)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    typo_every: int | None = None,
) -> DataFrame:
    """``word, n``: words of at least ``least_length`` letters that occur ``least_count`` times.

    With ``typo_every``, a word of a document whose crc32 of ``<id>:<word>`` is divisible by it
    loses a letter there, which plants misspellings at known places; rows without an id keep
    theirs.  Null and empty texts have no words; repeated rows count again.  Each task counts
    its own rows first.
    """

    def count(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                found, doc_id = words_of(text.as_py()), doc_id.as_py()
                prefix = None if typo_every is None or doc_id is None else crc32(f"{doc_id}:".encode())
                for word, n in found.items():
                    if prefix is not None:
                        word = misspelt(word, prefix, typo_every)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > _HELD_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _class_counts(word: Column) -> Column:
    """How many of the word's letters are in each class: those of equal code point modulo CLASSES."""
    classes = ["".join(chr(c) for c in _LETTERS if c % CLASSES == i) for i in range(CLASSES)]
    return F.array(*[F.length(word) - F.length(F.translate(word, letters, "")) for letters in classes])


def _cell(counts: Column, change: dict[int, int]) -> Column:
    """Name of the block of the words with these counts of letters, changed by an edit."""
    moved = [counts[i] + change[i] if i in change else counts[i] for i in range(CLASSES)]
    possible = [counts[i] > 0 for i, by in change.items() if by < 0]
    return F.when(possible[0], F.concat_ws(",", *moved)) if possible else F.concat_ws(",", *moved)


def _neighbours(counts: Column) -> Column:
    """Blocks that a word visits: those of words without one of its letters, and those with a letter
    of a later class in place of one of an earlier class."""
    changes = [{i: -1} for i in range(CLASSES)] + [{i: -1, j: 1} for i, j in combinations(range(CLASSES), 2)]
    return F.array_compact(F.array(*[_cell(counts, c) for c in changes]))


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Words (rows of Latin-1 codes) x letters.  Single precision is exact up to 4096 letters."""
    rows = np.repeat(np.arange(len(codes)), codes.shape[1]) * len(_LETTERS)
    counts = np.bincount(rows + _INDEX[codes.ravel()], minlength=len(codes) * len(_LETTERS)).reshape(len(codes), -1)
    return counts.astype(np.float32 if codes.shape[1] < 4096 else np.float64)


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def one_edit_apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced letter, or (long rows have one more) one inserted one."""
    size = short.shape[1]
    differs = short != long[:, :size]
    if long.shape[1] == size:
        return differs.sum(axis=1) == 1
    same_before = np.where(differs.any(axis=1), differs.argmax(axis=1), size)
    shifted = short != long[:, 1:]
    last = np.where(shifted.any(axis=1), size - 1 - shifted[:, ::-1].argmax(axis=1), -1)
    return last < same_before


class _Block:
    """Words of one length, their letter counts and squared norms."""

    def __init__(self, words: list[str]):
        self.codes = _codes(words)
        self.counts = letter_counts(self.codes)
        self.norms = (self.counts * self.counts).sum(axis=1)

    def near(self, other: _Block | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places of near words here and in ``other``, whose words are as long or one letter longer;
        without it, of pairs within the block."""
        b = self if other is None else other
        distance = self.norms[:, None] + b.norms - 2 * (self.counts @ b.counts.T)
        i, j = np.nonzero(distance <= 2)
        if other is None:
            i, j = i[i < j], j[i < j]
        step = max(1, _CANDIDATES // b.codes.shape[1])
        keep = [one_edit_apart(self.codes[i[k : k + step]], b.codes[j[k : k + step]]) for k in range(0, len(i), step)]
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        return i[keep], j[keep]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str], list[int]]]:
    """Neighbouring rows of one block and one kind (members or visitors) and length, from sorted batches."""
    for batch in batches:
        keys = [batch.column(c) for c in ("cell", "block", "visits", "size")]
        new = np.zeros(len(batch), bool)
        new[::BLOCK] = True
        for key in keys:
            new[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(new)
        values = zip(*(key.take(pa.array(begins)).to_pylist() for key in keys), strict=True)
        words, ns = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        for key, begin, end in zip(values, begins.tolist(), [*begins[1:].tolist(), len(batch)], strict=True):
            yield key, words[begin:end], ns[begin:end]


def _compare(batches):
    """Near pairs of each block, both ways round."""
    own, members = None, []  # the current block, and its members as (block, words, ns)

    def pairs(a, a_words, a_ns, b, b_words, b_ns):
        i, j = a.near(None if b is a else b)
        for k, m in zip(i.tolist(), j.tolist(), strict=True):
            out.append((a_words[k], b_words[m], b_ns[m]))
            out.append((b_words[m], a_words[k], a_ns[k]))

    out: list[tuple] = []
    for (cell, block, visits, _), words, ns in _runs(batches):
        if own != (cell, block):
            own, members = (cell, block), []
        new = (_Block(words), words, ns)
        for member in members:
            pairs(*member, *new)
        if not visits:
            pairs(*new, *new)
            members.append(new)
        if len(out) >= 10_000:
            yield _pair_batch(out)
            out = []
    if out:
        yield _pair_batch(out)


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    word, near, near_n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], names=["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` for every two distinct words one edit apart, both ways round.

    ``words`` (word, n) are distinct and of Latin-1 letters.  A word has at most as many near
    words as it has edits, so the result grows with the words.
    """
    placed = words.select("word", "n", _class_counts(F.col("word")).alias("counts"))
    placed = placed.select("word", "n", _cell(F.col("counts"), {}).alias("cell"), _neighbours(F.col("counts")).alias("near_cells"))
    cells = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    cells = stored(cells, "spelling-cells")
    hashed = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block")
    members = placed.join(cells, "cell").select("cell", hashed, "word", "n")
    own = members.filter("block > 0").select("cell", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("block"), "word", "n")
    visits = placed.select("word", "n", F.explode("near_cells").alias("cell")).join(cells, "cell")
    visits = visits.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("block"), "word", "n")
    rows = members.withColumn("visits", F.lit(False)).union(own.union(visits).withColumn("visits", F.lit(True))).withColumn("size", F.length("word"))
    keys = ("cell", "block", "visits", "size")
    return rows.repartition("cell", "block").sortWithinPartitions(*keys).mapInArrow(_compare, "word string, near string, near_n long")


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Every word with its ``form``, the most frequent near word (ties: the smallest) if that is ``ratio``
    times as frequent, else null, and its ``root``, where following forms ends (the word itself without one).

    ``n_near`` counts the near words, ``form_n`` is the form's count.  An empty table gives an
    empty one.  Forms are more frequent than their words, so chains end; each round doubles the
    steps taken, and rounds end when nothing moves.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    found = stored(found, "spelling-forms")
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = roots.join(further, roots["root"] == further["at"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = stored(moved, "spelling-roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
