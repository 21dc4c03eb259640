"""Statistics of a text that a quality rule can look at.  None looks at an id, source or label."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from salescompass.llm.words import LINE_END, Words, byte_texts, pieces

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "words_per_line", "upper", "digit", "blank", "sentence_mark",
    "loud_mark", "symbol", "not_ascii", "short_words", "long_words", "same_as_before", "repeated_words",
    "repeated_triples", "repeated_lines", "top_word",
)


def _table(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text.encode())] = True
    return out


_CLASSES = {
    "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _table("0123456789"),
    "blank": _table(" \t\n\x0b\x0c\r"),
    "sentence_mark": _table(".,;:"),
    "loud_mark": _table("!?"),
    "symbol": _table("#$%&*+/<=>@[\\]^_`{|}~"),
    "not_ascii": np.arange(256) >= 128,
}


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[edges[1:]] - total[edges[:-1]]).astype(np.float64)


def _repeats(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: values that occur more than once beyond their first time, and the most frequent value's count."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, len(text)))
    top = np.zeros(n)
    np.maximum.at(top, text[begin], counts)
    return np.bincount(text[begin], counts - 1, minlength=n), top


def statistics(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    n = len(texts)
    words = Words(texts)
    lines = Words(texts, LINE_END)
    n_words, n_lines = words.counts.astype(np.float64), lines.counts.astype(np.float64)
    n_bytes = np.diff(words.text_start) - 1.0
    share = lambda part, whole: part / np.maximum(whole, 1)
    # the blank that joins two texts is not theirs
    of_class = {k: _sums(table[words.bytes], words.text_start) - (k == "blank") for k, table in _CLASSES.items()}
    length = words.end - words.start
    word_text = words.text
    again = np.zeros(len(words), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (word_text[1:] == word_text[:-1])
    repeated, top = _repeats(word_text, words.hash, n)
    at, triples = words.windows(3)
    repeated_triples, _ = _repeats(word_text[at], triples, n)
    repeated_lines, _ = _repeats(lines.text, lines.hash, n)
    return {
        "log_bytes": np.log1p(n_bytes), "log_words": np.log1p(n_words), "log_lines": np.log1p(n_lines),
        "word_bytes": share(_sums(length, words.first), n_words), "words_per_line": share(n_words, n_lines),
        **{k: share(v, n_bytes) for k, v in of_class.items()},
        "short_words": share(_sums(length == 1, words.first), n_words), "long_words": share(_sums(length > 20, words.first), n_words),
        "same_as_before": share(_sums(again, words.first), n_words), "repeated_words": share(repeated, n_words),
        "repeated_triples": share(repeated_triples, n_words - 2), "repeated_lines": share(repeated_lines, n_lines), "top_word": share(top, n_words),
    }


def text_statistics(text: Column) -> Column:
    """Struct of the statistics of a whole text; a null or empty text has zeros."""

    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def measure(column: pa.Array) -> pa.Array:
        found = [statistics(texts[low:high]) for texts in [byte_texts(column)] for low, high in pieces(texts)]
        columns = [pa.array(np.concatenate([f[s] for f in found]) if found else [], pa.float64()) for s in STATISTICS]
        return pa.StructArray.from_arrays(columns, list(STATISTICS))

    return measure(text)
