import random

import numpy as np
import pyarrow as pa
import pytest
from plain import BLANK_WORD, LETTER_WORD, lowered

from salescompass.llm.words import BLANKS, LINE_END, NOT_ALPHANUMERIC, Words, covered, pieces, runs, span_lists


def texts(n=60):
    rng = random.Random(1)
    alphabet = "aAbZz09 \t\n\r\x0b\x0c\x1c.,'é日😀\x00\x7f"
    return [None, "", " "] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize(("breaks", "lower", "pattern"), [(BLANKS, False, BLANK_WORD), (NOT_ALPHANUMERIC, True, LETTER_WORD)])
def test_words_are_those_of_the_pattern(breaks, lower, pattern):
    given = texts()
    words = Words([t.encode() if t is not None else None for t in given], breaks, lower)
    data = words.bytes.tobytes()
    for i, text in enumerate(given):
        mine = [data[words.start[k] : words.end[k]].decode() for k in range(words.first[i], words.first[i + 1])]
        assert mine == pattern.findall(lowered(text) if lower else text or "")


def test_equal_words_and_windows_have_equal_hashes():
    given = texts(300)
    words = Words([t.encode() if t else None for t in given])
    data = words.bytes.tobytes()
    spelled = [data[a:b] for a, b in zip(words.start, words.end)]
    assert len(set(spelled)) == len(set(words.hash.tolist())) == len(set(zip(spelled, words.hash.tolist())))
    for size in (1, 2, 3):
        at, hashes = words.windows(size)
        seen = [tuple(spelled[i : i + size]) for i in at]
        assert len(set(seen)) == len(set(hashes.tolist())) == len(set(zip(seen, hashes.tolist())))
        expected = sum(max(0, n - size + 1) for n in words.counts)
        assert len(at) == expected


def test_prefixes():
    words = Words([b"abcdef abcxyz abc ab"])
    of, hashes = words.prefixes(3)
    assert of.tolist() == [0, 1] and hashes[0] == hashes[1]


def test_empty_list():
    words = Words([])
    assert len(words) == 0 and words.windows(3)[0].size == 0 and Words([None], LINE_END).counts.tolist() == [0]


def test_marks():
    assert covered(np.array([1, 2, 6]), 3, 9).tolist() == [False, True, True, True, True, False, True, True, True]
    assert [x.tolist() for x in runs(np.array([True, False, True, True]))] == [[0, 2], [1, 4]]
    first = np.array([0, 3, 3, 5])
    spans = span_lists(np.array([False, True, True, True, False]), first)
    assert spans.to_pylist() == [[{"start": 1, "end": 3}], [], [{"start": 0, "end": 1}]]
    assert span_lists(np.zeros(0, bool), np.array([0])).to_pylist() == [] and isinstance(spans, pa.ListArray)


def test_pieces_cover_all_texts():
    given = [b"x" * n for n in (5, 100, 1, 0, 7)] + [None]
    assert [i for a, b in pieces(given, 10) for i in range(a, b)] == list(range(6))
    assert list(pieces([], 10)) == []
