"""Spelling variants against a comparison of all words with each other."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tables import awkward, empty  # noqa: F401  fixtures

from salescompass.llm import spelling


def lowered(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def plain_counts(rows, least_length=6, least_count=5, every=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lowered(run)
            if every and doc_id is not None and (h := crc32(f"{doc_id}:{word}".encode())) % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, ratio=5):
    found = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, len(found[w]), counts.get(form[w], 0)) for w, n in counts.items())


def mine(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def chain(spark, pairs):
    return spark.createDataFrame(pairs, "word string, n long")


def random_words(letters, n, seed):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.choice((6, 6, 7, 7, 8)))): int(5 * 40 ** rng.random()) for _ in range(n)}


@pytest.mark.parametrize(("letters", "n", "block"), [("abcé", 500, 2048), ("ai", 200, 2048), ("abcéÀÿ", 700, 16), ("aiq", 400, 5)])
def test_groups_of_random_words(spark, monkeypatch, letters, n, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    counts = random_words(letters, n, len(letters))
    assert mine(spelling.variant_groups(chain(spark, list(counts.items())).repartition(3))) == plain_groups(counts)


def test_ties_and_chains(spark):
    counts = {"wordone": 5, "wordonex": 25, "aordone": 25, "wordonexy": 125, "wordonexyz": 625, "lonely": 7, "Ünicode": 9, "Ünicods": 45, "ünicode": 45}
    rows = {r["word"]: r for r in spelling.variant_groups(chain(spark, list(counts.items()))).collect()}
    assert rows["wordone"]["form"] == "aordone" and rows["wordonex"]["root"] == "wordonexyz" and rows["lonely"]["n_near"] == 0
    assert rows["Ünicode"]["form"] == "Ünicods"
    assert mine(spelling.variant_groups(chain(spark, list(counts.items())))) == plain_groups(counts)


def test_very_long_words(spark):
    base = "ab" * 5000
    counts = {base: 500, base[:-1]: 50, base[:4000] + "x" + base[4001:]: 5, base[::-1]: 7}
    assert mine(spelling.variant_groups(chain(spark, list(counts.items())))) == plain_groups(counts)


def test_a_block_of_many_words_is_dealt_out(spark, monkeypatch):
    """All permutations of seven letters are in one block."""
    from itertools import permutations

    monkeypatch.setattr(spelling, "BLOCK", 100)
    words = {"".join(p): 5 for p in permutations("abcdefg")} | {"abcdefgh": 50, "abcdefx": 25}
    placed = spelling.near_words(chain(spark, list(words.items())))
    got = {(r["word"], r["near"]) for r in placed.collect()}
    assert got == {(a, b) for a in ("abcdefgh", "abcdefx") for b in words if near(a, b)} | {(b, a) for a in ("abcdefgh", "abcdefx") for b in words if near(a, b)}


@pytest.mark.parametrize("every", [None, 3])
def test_counts_of_awkward_documents(awkward, every):  # noqa: F811
    rows, df = awkward
    got = spelling.count_words(df, least_length=1, least_count=2, typo_every=every)
    assert {r["word"]: r["n"] for r in got.collect()} == plain_counts([r[:2] for r in rows], 1, 2, every)


def test_tasks_pass_on_what_they_count(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_HELD_WORDS", 10)
    docs = [(i, " ".join(f"word{chr(97 + j)}{chr(97 + i % 9)}Ä×÷" for j in range(26))) for i in range(60)]
    got = spelling.count_words(spark.createDataFrame(docs, "doc_id long, text string"), typo_every=7)
    assert {r["word"]: r["n"] for r in got.collect()} == plain_counts(docs, every=7)


def test_one_edit():
    code = lambda *words: np.array([list(w.encode("latin-1")) for w in words], np.uint8)
    assert spelling.one_edit_apart(code("abcdef", "abcdef", "abcdef"), code("abcdef", "abxdef", "abxdex")).tolist() == [False, True, False]
    long = ["xabcdef", "abcdefx", "abcxdef", "abcddef", "abcdxfx", "bbcdeff"]
    assert spelling.one_edit_apart(code(*["abcdef"] * 6), code(*long)).tolist() == [near("abcdef", w) for w in long]


def test_empty_table(spark, empty):  # noqa: F811
    assert spelling.variant_groups(spelling.count_words(empty, typo_every=199)).collect() == []
