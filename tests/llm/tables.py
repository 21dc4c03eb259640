"""Small awkward tables, as fixtures."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row int, spans string, N_Words int, severity string, _tie int, _part string, _inside int, _fit string, _Grade int, _own_n_words int, `_position` int, x int"


def _rows():
    """Awkward documents: nulls in every column, empty, blank and very long texts, exact and
    near copies, ties, shared passages, other blanks and scripts, and columns that clash."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünïcode", "日本語", "don't", "naïve", "B,C", " ", "\x00"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base, long = prose(60), prose(120), prose(6000)
    texts = [
        None, "", "   \n\t ", "one", "one two", "one two", "A b C d E", prose(12), prose(13), base, base, base + " tail",
        "head " + base, base.replace(" ", "\n"), base.upper(), prose(40) + " " + passage + " " + prose(30),
        passage + "\n" + prose(20), prose(15) + "\n" + passage, passage, passage + " " + passage, long, long + " x",
        "x " * 500, "x " * 500 + "y", "\n\n\n\n\n", "a\nb\nc\nd\ne", "z\na\nb\nc\ny", "a\nb\nc", "b\nc\nd\ne\nf", "q\n" * 9,
        "tab\tand\x0bvertical\x0cfeed\rreturn\x1cno blank", "emoji 😀 " * 20, "😀" * 50,
    ]
    for _ in range(12):  # near copies of one text
        w = base.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    sources = ["b", "a", None, "Z", "ä", "", "a"]
    clashes = (1, "p", None, "f", 2, 3, 4, 5)
    rows = [(i * 3, t, ["en", None][i % 2], sources[i % 7], len(t) if t else None, 0.1, i, "s", None, "x", *clashes) for i, t in enumerate(texts)]
    rows.append((None, "no id " + prose(30), *[None] * 16))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows, and as a table over several partitions."""
    rows = _rows()
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3, F.col("row")).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
