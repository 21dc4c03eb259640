"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts are joined by a break byte and cut at break bytes; every word and every window of
consecutive words gets a 64-bit hash from prefix sums, so nothing loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1_000_000  # texts handled at once; one longer text is a piece of its own

_STEP, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE_BASE, _WORD_BASE = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5  # odd, so that they have inverses modulo 2**64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of uint64 values (splitmix64)."""
    x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def break_bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


BLANKS = break_bytes((0x09, 0x0D), (0x20, 0x20))
LINE_END = break_bytes((0x0A, 0x0A))
NOT_ALPHANUMERIC = break_bytes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # after lower-casing A-Z
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 7)


class Words:
    """Words of a list of texts (bytes; None counts as empty).

    ``start`` and ``end`` are byte positions in ``bytes``; text i has the words
    ``first[i]`` to ``first[i + 1]``; ``hash`` identifies a word.
    """

    def __init__(self, texts: list[bytes | None], breaks: np.ndarray = BLANKS, lower: bool = False):
        joint = bytes([np.flatnonzero(breaks)[-1]])
        data = np.frombuffer(joint.join([t or b"" for t in texts] + [b""]), np.uint8)
        self.bytes = _LOWER[data] if lower else data
        inside = np.empty(len(data) + 1, bool)
        inside[0] = False
        np.logical_not(breaks[self.bytes], out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.start, self.text_start)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.bytes] * _powers(_BYTE_BASE, len(data)), out=self._sums[1:])
        self._inverse = _powers(pow(_BYTE_BASE, -1, 2**64), len(data))
        self.hash = self._hash(self.start, self.end)

    def _hash(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start], seed)

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words longer than ``size`` bytes, and the hash of their first ``size`` bytes."""
        longer = np.flatnonzero(self.end - self.start > size)
        return longer, self._hash(self.start[longer], self.start[longer] + size, size)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of ``size`` consecutive words of one text."""
        return windows(self.hash, self.first, size)


def windows(values: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each run of ``size`` values that lies in one text."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(len(values))  # values from here to the text's end
    at = np.flatnonzero(left >= size)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_WORD_BASE, len(values)), out=sums[1:])
    inverse = _powers(pow(_WORD_BASE, -1, 2**64), len(values) + 1)
    return at, mix((sums[at + size] - sums[at]) * inverse[at], size)


def covered(at: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in [at, at + size) for any of the starts."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return np.cumsum(change[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[0::2], edges[1::2]


def span_lists(mask: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per text, the runs of marked words as a list of (start, end), counted from the text's first word."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    # a run ends with its text: look at the texts one place apart
    split = np.zeros(len(mask) + len(counts), bool)
    split[np.arange(len(mask)) + text] = mask
    begin, stop = runs(split)
    of = np.searchsorted(first[:-1] + np.arange(len(counts)), begin, side="right") - 1
    offset = first[of] + of
    offsets = np.searchsorted(of, np.arange(len(counts) + 1))
    spans = pa.StructArray.from_arrays([pa.array(begin - offset, pa.int32()), pa.array(stop - offset, pa.int32())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def pieces(texts: list[bytes | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs of about ``limit`` bytes."""
    begin = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += size + 1
    if begin < len(texts):
        yield begin, len(texts)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
